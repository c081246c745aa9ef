"""A uniform random order of records by a two-pass external shuffle, dealt into even shards.

The first pass scatters records into buckets of bounded size by a seeded hash. The second puts
each bucket, which fits in memory, into random order by Fisher-Yates (Spark's ``shuffle`` of an
array) and writes it. Bucket sizes then give every record its place in the whole order, and the
records are dealt out to the shards in turn.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.llm import texts
from fillwatch.session import settled

#: Bytes of text in a bucket, on average; some times that must fit into a task's memory.
BUCKET_BYTES = 1 << 24
#: Buckets whose sizes are summed up together.
STRETCH = 4096


def _bytes():
    return F.octet_length(texts.text_or_empty()).cast("long") + 1


def shuffled(docs: DataFrame, seed: int = 0, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All records with all their columns, written to the shared folder in random order.

    The hash takes the seed, ``doc_id`` and text. Rows alike in both would all meet in one bucket:
    a bucket of over twice its bytes is scattered again by row. Everything else depends on the
    rows and the seed only. The text may be null or empty; an empty table gives no rows.

    Columns: ``bucket``, ``part``, ``place`` (in the bucket's part, from 0), ``record`` (a struct of
    the columns of ``docs``).
    """
    total = docs.agg(F.sum(_bytes()).alias("n")).first().n or 0
    buckets = max(1, -(-total // bucket_bytes))
    hashed = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))
    own = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("record"),
        hashed.alias("hash"),
        F.pmod(hashed, F.lit(buckets)).cast("int").alias("bucket"),
        _bytes().alias("n"),
    )
    large = (
        own.groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") > 2 * bucket_bytes)
        .select("bucket", F.ceil(F.col("n") / bucket_bytes).cast("int").alias("parts"))
    )
    large = settled(large, "buckets")
    keys = ["bucket", "part"]
    if large.isEmpty():
        # a constant is no key to Spark: dealing out by it too would cost another shuffle
        own, keys = own.withColumn("part", F.lit(0)), ["bucket"]
    else:
        by_row = F.xxhash64(F.lit(seed), F.monotonically_increasing_id())
        own = (
            own.withColumn("row", by_row)
            .join(large, "bucket", "left")
            .withColumn("part", F.pmod("row", F.coalesce("parts", F.lit(1))).cast("int"))
        )
    memory = (
        own.repartition(buckets, *keys)
        .groupBy("bucket", "part")
        .agg(F.collect_list(F.struct("hash", "record")).alias("records"))
        # the order of arrival is Spark's own affair: start from one that is settled by the rows
        .sortWithinPartitions("bucket", "part")
    )

    def by_hash(a, b):
        return F.when(a["hash"] < b["hash"], -1).when(a["hash"] > b["hash"], 1).otherwise(0)

    order = F.shuffle(F.array_sort("records", by_hash), seed)
    return settled(
        memory.select("bucket", "part", F.posexplode(order).alias("place", "of")).select(
            "bucket", "part", "place", "of.record"
        ),
        "shuffled",
    )


def deal(placed: DataFrame, sizes: DataFrame, shards: int = 16) -> DataFrame:
    """Adds ``shard`` and ``slot``: shard counts are at most one apart, slots gapless from 0.

    ``placed`` has ``bucket``, ``part`` and ``place``, ``sizes`` the rows of each bucket's part.
    Starts of buckets are running sums in two levels, within ``STRETCH`` buckets and over these.
    """
    stretch = F.floor(F.col("bucket") / STRETCH)
    each = sizes.groupBy("bucket", "part").agg(F.count("*").alias("n")).withColumn("stretch", stretch)
    inside = Window.partitionBy("stretch").orderBy("bucket", "part").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy().orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    stretches = (
        each.groupBy("stretch")
        .agg(F.sum("n").alias("whole"))
        .select("stretch", F.coalesce(F.sum("whole").over(over), F.lit(0)).alias("start"))
    )
    starts = each.join(stretches, "stretch").select(
        "bucket", "part", (F.col("start") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("start")
    )
    position = F.col("start") + F.col("place")
    return (
        placed.join(starts, ["bucket", "part"])
        .withColumns(
            {
                "shard": F.pmod(position, F.lit(shards)).cast("int"),
                "slot": F.floor(position / F.lit(shards)).cast("long"),
            }
        )
        .drop("bucket", "part", "place", "start")
    )


def write(docs: DataFrame, path: str, shards: int = 16, seed: int = 0) -> None:
    """The records in shuffled order under ``path``, a folder for each shard, sorted by slot."""
    rows = shuffled(docs, seed)
    dealt = deal(rows, rows.select("bucket", "part"), shards)
    dealt.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
