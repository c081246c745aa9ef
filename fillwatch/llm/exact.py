"""Exact duplicates by skew-safe combining.

Three stages of grouping, each by digest *and* content, so that texts which merely share a digest
never meet: copies in a map task are combined before anything is shuffled; groups of a digest and
a salt are merged; the winners of the salts are combined over the digest. However large a group of
copies is, a task gets one salt's share of it, and the last stage gets one row per salt.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fillwatch.llm import texts
from fillwatch.session import settled

SALTS = 64


def sha256(content: Column) -> Column:
    return F.sha2(content, 256)


def _winners(rows: DataFrame) -> DataFrame:
    """A row for each digest, content and salt: what stays of the whole group."""
    # the greatest is the longest, then the smallest doc_id: ~x falls as x grows, at no overflow
    best = F.struct("chars", F.bitwise_not("doc_id").alias("inverse"))
    salted = rows.groupBy("digest", "salt", "content").agg(
        F.max(best).alias("best"), F.count("*").alias("n")
    )
    group, digest = Window.partitionBy("digest", "content"), Window.partitionBy("digest")
    alone = F.min("content").over(digest) == F.max("content").over(digest)
    return (
        salted.repartition("digest")
        .withColumns(
            {
                "alone": alone,
                "best": F.max("best").over(group),
                "group_size": F.sum("n").over(group),
            }
        )
        .select(
            "digest",
            "salt",
            "alone",
            F.when(~F.col("alone"), F.col("content")).alias("content"),
            F.bitwise_not("best.inverse").alias("keep_id"),
            F.col("best.chars").alias("keep_chars"),
            "group_size",
        )
    )


def _decided(rows: DataFrame, winners: DataFrame, keys: list[str]) -> DataFrame:
    """The winner of each row's group; rows alike are counted before and told apart by number."""
    alike = rows.groupBy(*keys, "doc_id", "chars").agg(F.count("*").alias("n"))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    return (
        alike.join(winners.select(*keys, "keep_id", "keep_chars", "group_size"), keys)
        .withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (stays & (F.col("number") == 1)).alias("kept"),
            "digest",
        )
    )


def find(
    docs: DataFrame, salts: int = SALTS, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """Each row of ``docs`` with the row that stays for it.

    Texts are equal if identical without white space (``texts.SPACES``); null counts as empty. Of
    equal texts the one with the most code points stays, then the smallest ``doc_id``; a null
    ``doc_id`` comes last. Of rows alike in ``doc_id`` and length one is kept, the rest are
    dropped like any copy. An empty table gives no rows. Only ``doc_id`` and ``text`` are read, so
    further columns of any name do no harm.

    Columns: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``digest`` (of the text without
    white space, SHA-256 in hexadecimal unless another one is given).
    """
    rows = docs.select(
        "doc_id",
        F.length(texts.text_or_empty()).alias("chars"),
        texts.without_spaces(texts.text_or_empty()).alias("content"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    ).withColumn("digest", digest(F.col("content")))
    winners = settled(_winners(rows), "exact")
    shared = winners.filter(~F.col("alone"))
    if shared.isEmpty():
        return _decided(rows, winners, ["digest", "salt"])
    # some digest stands for several contents: its rows are told apart by content here as well
    digests = shared.select("digest").distinct()
    return _decided(
        rows.join(digests, "digest", "left_anti"), winners.filter("alone"), ["digest", "salt"]
    ).unionByName(
        _decided(rows.join(digests, "digest", "left_semi"), shared, ["digest", "salt", "content"])
    )


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def drop_copies(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay by ``find``, with all their columns; one of each group.

    Nulls, empty texts and ties are those of ``find``. Of rows alike in ``doc_id`` and text one
    stays, the first in order of their other columns (of maps, in order of their JSON); a map task
    sends only its own first, so repeated rows are not gathered anywhere. An empty table gives no
    rows. A row is carried as one value, so further columns may have any name and type.
    """
    order = [F.col(f"row.`{f.name}`") if _orderable(f.dataType) else F.to_json(F.struct(F.col(f"row.`{f.name}`"))) for f in docs.schema]
    # a null doc_id is a key as well, so that all steps are dealt out by the same plain columns
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key")
    stay = find(docs.select("doc_id", "text"), salts).filter("kept").select(key, "digest")
    rows = docs.select(
        F.struct("*").alias("row"),
        key,
        F.length(texts.text_or_empty()).alias("chars"),
        sha256(texts.without_spaces(texts.text_or_empty())).alias("digest"),
    )
    alike = Window.partitionBy("key", "digest").orderBy(F.col("chars").desc(), *order)
    return (
        rows.withColumn("place", F.row_number().over(alike))
        .filter("place = 1")
        .join(stay.hint("merge"), ["key", "digest"], "left_semi")
        .select("row.*")
    )
