"""The corpus pipeline: toxic documents go, then copies and near-copies; the sources are mixed to
their weights, and what is left becomes token ids.

Each stage is a function of (spark, docs, sf_dir) and calls one operator of ``fillwatch.llm``. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwatch.llm import bpe, exact, mixing, near, toxicity
from fillwatch.llm.queries import vocabulary
from fillwatch.llm.texts import documents
from fillwatch.session import settled

#: Code points in a block of the tokenizing stage, which follows four others in its executors.
BLOCK = 1 << 22


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled ones of ``docs`` and leaves out what it finds toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.fit(docs, labels))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space."""
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 or more of their shingles of five words."""
    return near.drop_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 1, 2, 3, repeating: a document may be left out, or come up to 3 times."""
    return mixing.apply(docs)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row's text, and what they decode to as a check."""
    ranks = bpe.read_ranks(vocabulary("byte_bpe_50k.tiktoken"))
    # written before it is decoded: a task has one Python worker at a time, not two in a row
    encoded = settled(bpe.encode(docs, bpe.rank_coder(spark, ranks), packed=False, block=BLOCK), "ids")
    return bpe.decode(encoded, bpe.token_table(spark, ranks)).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("mixture", mixed),
    ("byte_bpe", tokenized),
]

#: The stages rest on a fitted model and on ids that SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``, each written and read again by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name)
    return docs
