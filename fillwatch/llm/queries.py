"""The queries of this part, one for each operator, over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwatch.llm import (
    bpe,
    exact,
    language,
    licences,
    merkle,
    mixing,
    near,
    oracles,
    phrases,
    shards,
    tokens,
    toxicity,
    warc,
    whitening,
)
from fillwatch.llm.texts import documents
from fillwatch.session import settled, shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model)


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.find(documents(spark, sf_dir), width=4)


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    return language.predict(docs, language.fit(docs)).withColumn(
        "held_out", F.coalesce(held_out, F.lit(False))
    )


@query
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.scan(documents(spark, sf_dir))
    lists = ("sentences", "licences", "unmatched")
    return found.drop("places").withColumns({c: F.array_join(c, ",") for c in lists})


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    ranks = bpe.read_ranks(path or vocabulary("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(documents(spark, sf_dir), bpe.rank_coder(spark, ranks))
    digests = encoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2("packed", 256).alias("ids_sha256"),
    )
    keep = ["doc_id", "n_tokens", "ids_sha256"]
    return bpe.decode(digests, bpe.token_table(spark, ranks), keep).select(
        *keep, F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query
def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shards.shuffled(documents(spark, sf_dir))
    text = F.coalesce("record.text", F.lit(""))
    placed = rows.select(
        "bucket",
        "part",
        "place",
        "record.doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return shards.deal(placed, rows.select("bucket", "part")).withColumn(
        "grown_shard", F.lit(None).cast("int")
    )


@query
def op7_token_files(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = documents(spark, sf_dir)
    path = path or vocabulary("byte_bpe_50k.json")
    coder, added = tokens.library_coder(spark, path), tokens.added_tokens(path)
    folder = shared_dir(spark, "token-files")
    name = tokens.name_of(path)
    runs = tokens.write(docs, folder, end=2, width=2, encoder=bpe.encoder_in_place(coder, 2, added, name))
    buckets = tokens.buckets_of(runs)
    index = settled(tokens.index(runs, buckets), "token-index")
    files = settled(tokens.files_of(runs), "token-files")
    found = tokens.find(docs.select("doc_id"), index, buckets)
    read = tokens.read(found, files.select("shard", "file"), folder).select(
        "doc_id",
        "shard",
        "start",
        F.floor(F.octet_length("packed") / 4).cast("long").alias("n_tokens"),
        F.crc32("packed").alias("ids_crc32"),
    )
    return read.join(files, "shard").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


@query
def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.find(documents(spark, sf_dir)).withColumnRenamed("digest", "text_sha256")


@query
def op9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source", "place", "times")


@query
def op10_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.edits(documents(spark, sf_dir)).withColumn(
        "n_changed", F.size("changed").cast("long")
    ).drop("changed")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(documents(spark, sf_dir))


@query
def op12_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "archives")
    files = warc.archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), folder)
    noted = F.regexp_extract(F.element_at("metadata.payload", 1).cast("string"), "page-id: (-?[0-9]+)", 1)
    kept = ["type", "record_id", "concurrent_to", "refers_to", "payload_digest", "payload_bytes", "payload_sha1", "payload"]
    records = warc.read(files, folder, kept)
    # pages' own payloads are counted and digested where they are read, and left there
    page = F.col("type").isin(*warc.MAIN)
    light = records.withColumns(
        {
            "payload": F.when(F.col("type") == "metadata", F.col("payload")),
            "payload_bytes": F.when(page, F.col("payload_bytes")),
            "payload_sha1": F.when(page, F.col("payload_sha1")),
        }
    )
    found = settled(
        warc.captures(settled(light, "records")).select(
            "capture_id", "record.*", F.nullif(noted, F.lit("")).cast("long").alias("page_id")
        ),
        "captures",
    )
    first = found.filter("type = 'response'").select(
        F.col("capture_id").alias("of"),
        F.col("page_id").alias("of_page"),
        F.col("payload_bytes").alias("of_bytes"),
    )
    revisit = F.col("type") == "revisit"
    # both sides grow with the pages; a response with many revisits is split at run time
    return found.join(first.hint("merge"), F.col("refers_to") == F.col("of"), "left").select(
        "page_id",
        F.when(revisit, F.col("of_bytes")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.substring("payload_digest", 6, 32)).otherwise(F.col("payload_sha1")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(revisit, F.col("of_page")).alias("refers_to"),
    )


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
