"""Features of recent history kept current: a batch adds its own moments and last readings."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fillwatch import schemas
from fillwatch.operators import features, recent
from fillwatch.streaming import store

PACE = "30 seconds"
_PLACES = "source string, run string, batch_id long"


def moments_path(root: str) -> str:
    return f"{root}/recent/moments"


def tails_path(root: str) -> str:
    return f"{root}/recent/tails"


def append(rows: DataFrame, root: str, batch_id: int, run: str = "0", source: str = "stream") -> None:
    """Add the moments and tails of some readings, replacing an earlier try of the same batch and run."""
    place = f"source={source}/run={run}/batch_id={batch_id}"
    recent.moments(rows).write.mode("overwrite").parquet(f"{moments_path(root)}/{place}")
    recent.tails(rows).write.mode("overwrite").parquet(f"{tails_path(root)}/{place}")


def start(spark: SparkSession, root: str, checkpoints: str, available_now: bool = False) -> StreamingQuery:
    """Add what is written to the log of readings, batch by batch; no reading is read again.

    A batch writes a row for each of its (bin, slot) pairs and at most ten readings of each bin.
    Every row of the log counts, so readings are to be written once: one that is written again, by
    a job under a new checkpoint, counts again.
    """
    run: Future[str] = Future()
    pace = {"availableNow": True} if available_now else {"processingTime": PACE}

    def each(batch: DataFrame, batch_id: int) -> None:
        append(batch, root, batch_id, run.result())

    query = (
        store.written(spark, root, schemas.SENSOR_DATA)
        .writeStream.queryName("recent_features")
        .foreachBatch(each)
        .option("checkpointLocation", f"{checkpoints}/recent_features")
        .trigger(**pace)
        .start()
    )
    run.set_result(query.id)
    return query


def moments(spark: SparkSession, root: str) -> DataFrame:
    """All moments that were added, with ``source``, ``run`` and ``batch_id``."""
    return spark.read.schema(f"{recent.MOMENTS}, {_PLACES}").parquet(moments_path(root))


def tails(spark: SparkSession, root: str) -> DataFrame:
    """All last readings that were added, with ``source``, ``run`` and ``batch_id``."""
    return spark.read.schema(f"{recent.TAILS}, {_PLACES}").parquet(tails_path(root))


def table(
    spark: SparkSession,
    root: str,
    as_of: dt.datetime,
    maintenance: DataFrame | None = None,
    bins: DataFrame | None = None,
) -> DataFrame:
    """The features of every bin at ``as_of``, which is on a step (``recent.on_step``)."""
    return recent.build(moments(spark, root), tails(spark, root), as_of, maintenance, bins)


def compact(spark: SparkSession, root: str, into: str, as_of: dt.datetime) -> None:
    """Merge what is under ``root`` into one row per bin and slot, and one tail per bin, under another root.

    Slots that no window reaches at ``as_of`` or later expire: they are left behind. A job goes over
    to ``into`` with its checkpoint; the old root is left as it is.
    """
    if into.rstrip("/") == root.rstrip("/"):
        raise ValueError("partials are merged into another root than their own")
    place = f"source={store.FOLDED}/run=0/batch_id=0"
    first = recent.first_slot(as_of, features.WEEK_HOURS)
    recent.merged(moments(spark, root).filter(F.col("slot") >= first)).write.parquet(f"{moments_path(into)}/{place}")
    recent.tails(tails(spark, root)).write.parquet(f"{tails_path(into)}/{place}")
