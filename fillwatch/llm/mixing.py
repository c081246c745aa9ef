"""Mixing sources to target weights by hash-threshold histograms; no row is sorted.

A row's place in its source is a hash. The words of a source are summed by hash bucket, the bucket
in which the running sum passes the source's budget is found, and only that bucket is summed again
by finer buckets, until it is a single hash. The thresholds are nested: a larger budget takes the
same rows and more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.llm import texts
from fillwatch.session import settled

#: Hexadecimal digits of a hash, and how many of them each pass looks at.
LENGTH, STEP = 15, 3
#: No row is taken more often, so no source gets more than so many times its size.
MOST = 3


def words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(texts.WORD_PATTERN)).cast("long")


def _on_source(a: DataFrame, b: DataFrame, also: Column | None = None, how: str = "inner") -> DataFrame:
    """Joins on the source, null being one, and ``also``; columns are told apart as a and b."""
    on = F.col("a.source").eqNullSafe(F.col("b.source"))
    return a.alias("a").join(b.alias("b"), on if also is None else on & also, how)


def targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``target`` to rows of (source, weight, source_size), one for each source.

    All sizes together are shared out by weight. No source gets over ``most`` times its size;
    what it can't use goes to the others by weight. With the sources in order of size by weight,
    those that hit their limit come first, so running sums give the level of all others. There is
    one row for each source that the mix names, whatever the number of documents.
    """
    ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "position")
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy()
    ranked = sources.select(
        "*",
        F.sum("source_size").over(all_rows).alias("total"),
        F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)).alias("full"),
        F.sum("weight").over(after).alias("open"),
    ).withColumn(
        "level", (F.col("total") - F.col("full")).cast("double") / F.col("open").cast("double")
    )
    capped = F.col("level") * F.col("weight") >= F.col("source_size") * most
    # the first source under its limit sets the level of those behind it
    level = F.first(F.when(~capped, F.col("level")), ignorenulls=True).over(
        ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return ranked.withColumns({"capped": capped, "common": level}).select(
        *sources.columns,
        F.when(F.col("capped"), (F.col("source_size") * most).cast("double"))
        .otherwise(F.col("common") * F.col("weight"))
        .alias("target"),
    )


def cycling_weights(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1, 2, .., ``cycle``, repeating, to sources by code point, null last."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    return sizes.withColumn("position", F.row_number().over(order)).withColumn(
        "weight", (F.pmod(F.col("position") - 1, F.lit(cycle)) + 1).cast("long")
    )


def _passed(sums: DataFrame) -> DataFrame:
    """The bucket in which a source's budget ends, with the words before it; 16**STEP rows a source."""
    order = Window.partitionBy("source").orderBy("prefix")
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    below = F.col("below") + F.coalesce(before, F.lit(0))
    return sums.withColumn("below", below).filter(
        (F.col("below") <= F.col("rest")) & (F.col("rest") < F.col("below") + F.col("n"))
    )


def _place(seed: int) -> Column:
    """A row's place in its source: the first digits of a hash of seed, ``doc_id`` and text."""
    place = F.md5(
        F.concat_ws(
            ":",
            F.lit(str(seed)),
            F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
            F.md5(texts.text_or_empty()),
        )
    )
    return F.substring(place, 1, LENGTH)


def mix(docs: DataFrame, seed: int = 0, most: int = MOST) -> DataFrame:
    """How often the mix takes each row of ``docs``, and how many words that makes.

    Size is the number of words (``texts.WORD_PATTERN``), 0 for null and empty texts. A source's
    target decides: whole passes over the source first, then a part of it, the rows whose hash of
    (seed, ``doc_id``, text) is low. A row is taken if half of it or more fits, so a source's words
    are within half a row of its target. Rows alike in ``doc_id`` and text share a hash and go
    together; a null ``doc_id`` or text hashes like an empty one; null is a source of its own. An
    empty table gives no rows. Only ``doc_id``, ``text`` and ``source`` are read, so further
    columns of any name do no harm. The same rows and seed give the same result, however the table
    is dealt out.

    Columns: ``doc_id``, ``source``, ``place``, ``size``, ``source_size``, ``target``, ``times``,
    ``taken``.
    """
    rows = settled(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(words(F.col("text")), F.lit(0)).alias("size"),
            _place(seed).alias("place"),
        ),
        "mix",
    )

    def prefix(length: int) -> Column:
        return F.substring("place", 1, length).alias("prefix")

    first = settled(rows.groupBy("source", prefix(STEP)).agg(F.sum("size").alias("n")), "mix")
    sizes = first.groupBy("source").agg(F.sum("n").alias("source_size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    plan = targets(cycling_weights(sizes), most).withColumn(
        "passes", F.least(F.coalesce(passes, F.lit(0)), F.lit(most)).cast("long")
    )
    plan = settled(
        plan.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix"
    )

    budget = plan.select("source", "rest", F.lit(0).cast("long").alias("below"))
    edge = _passed(_on_source(first, budget).select("a.*", "rest", "below"))
    inside = rows
    for length in range(2 * STEP, LENGTH + 1, STEP):
        inside = _on_source(
            inside.withColumn("bucket", prefix(length - STEP)).drop("rest", "below"),
            edge.drop("n"),
            F.col("bucket") == F.col("prefix"),
        ).select("a.source", "place", "size", "rest", "below")
        sums = inside.groupBy("source", prefix(length), "rest", "below").agg(F.sum("size").alias("n"))
        edge = _passed(sums)
    threshold = settled(
        edge.select(
            "source",
            F.col("prefix").alias("threshold"),
            (F.col("below") + F.col("n") / 2 <= F.col("rest")).alias("edge_too"),
        ),
        "mix",
    )

    # rows find their source by (source, first bucket), which deals a large source out evenly
    source = _on_source(plan, threshold, how="left").select("a.*", "threshold", "edge_too")
    known = _on_source(first.drop("n"), source).select("a.*", *[f"b.{c}" for c in source.columns if c != "source"])
    below = (F.col("place") < F.col("threshold")) | (
        (F.col("place") == F.col("threshold")) & F.col("edge_too")
    )
    # rows without words may lie below the threshold of a source that is at its limit
    times = F.least(F.col("passes") + F.coalesce(below, F.lit(False)).cast("long"), F.lit(most))
    return (
        _on_source(rows.withColumn("bucket", prefix(STEP)), known, F.col("bucket") == F.col("prefix"))
        .select("doc_id", "a.source", "place", "size", "source_size", "target", times.alias("times"))
        .withColumn("taken", F.col("size") * F.col("times"))
    )


def apply(docs: DataFrame, seed: int = 0, most: int = MOST) -> DataFrame:
    """The mix itself: each row of ``docs``, with all its columns, as often as ``mix`` takes it.

    Nulls, empty texts and repeated rows are those of ``mix``. An empty table gives no rows. A row is
    carried as one value, so further columns may have any name and type.
    """
    often = mix(docs.select("doc_id", "text", "source"), seed, most)
    often = often.filter("times > 0").select("source", "place", "times").distinct()
    rows = docs.select(F.struct("*").alias("row"), "source", _place(seed).alias("place"))
    repeated = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return (
        _on_source(rows, often.hint("merge"), F.col("a.place") == F.col("b.place"))
        .select("row", repeated.alias("time"))
        .select("row.*")
    )
