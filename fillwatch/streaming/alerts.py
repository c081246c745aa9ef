"""Stateful jobs on the alarms: each alarm once to the outbox, and counts by event time."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fillwatch import schemas
from fillwatch.operators import alarms
from fillwatch.session import remove, shared_dir
from fillwatch.streaming import store

#: How long an alarm's id is remembered, how late alarms may come to be counted, how long a
#: snapshot of the bins serves, and the pace.
REMEMBERED, LATE, REFRESH_SECONDS, PACE = "1 hour", "2 days", 300, "20 seconds"


def first_of_each(rows: DataFrame, time_column: str, remembered: str = REMEMBERED) -> DataFrame:
    """The first row of each ``alarm_id`` in a stream, whichever writer it comes from.

    State holds an id until the watermark has passed its time by ``remembered``.
    """
    return rows.withWatermark(time_column, remembered).dropDuplicatesWithinWatermark(["alarm_id"])


def counts(rows: DataFrame, late: str = LATE, width: str = "1 day") -> DataFrame:
    """Alarms by window of ``triggered_at``, kind and severity, each alarm counted once.

    On a stream this is for append mode: a window comes out once the watermark, the latest time seen
    less ``late``, has passed its end. An alarm that is not after the watermark comes too late and is
    not counted; any other is, whatever the order. Alarms without a time are in no window. State holds
    the open windows and the ids of alarms after the watermark. Of a batch, every window is given.
    """
    timed = rows.filter(F.col("triggered_at").isNotNull())
    once = first_of_each(timed, "triggered_at", late) if rows.isStreaming else timed.dropDuplicates(["alarm_id"])
    return (
        once.groupBy(F.window("triggered_at", width).alias("window"), "alarm_type", "severity")
        .agg(F.count("*").alias("alarms"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "alarm_type",
            "severity",
            "alarms",
        )
    )


def _pace(available_now: bool) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": PACE}


def start_counts(
    rows: DataFrame, root: str, checkpoints: str, late: str = LATE, width: str = "1 day", available_now: bool = False
) -> StreamingQuery:
    """Keep ``counts`` of a stream of alarms in the table ``alarm_counts``, a row for each closed window."""
    return (
        counts(rows, late, width)
        .writeStream.queryName("alarm_counts")
        .format("parquet")
        .outputMode("append")
        .option("path", f"{root}/alarm_counts")
        .option("checkpointLocation", f"{checkpoints}/alarm_counts")
        .trigger(**_pace(available_now))
        .start()
    )


def places(spark: SparkSession, root: str, seconds: float = REFRESH_SECONDS) -> Callable[[], DataFrame]:
    """Where the bins are, folded from their log when first asked for and again after ``seconds``.

    Between that, batches read the snapshot in the shared folder and no log. (A cached DataFrame would
    also serve whoever else reads the bins in this session, and so with old rows.)
    """
    held: list[str] = []
    until = [0.0]

    def of_now() -> DataFrame:
        if not held or time.monotonic() >= until[0]:
            fresh = shared_dir(spark, "bins-snapshot")
            bins = store.current(spark, root, schemas.BINS)
            bins.select("bin_id", "location_lat", "location_lng").write.parquet(fresh)
            for old in held:
                remove(spark, old)
            held[:] = [fresh]
            until[0] = time.monotonic() + seconds
        return spark.read.parquet(held[0])

    return of_now


def start_outbox(
    spark: SparkSession,
    root: str,
    checkpoints: str,
    available_now: bool = False,
    remembered: str = REMEMBERED,
    refresh_seconds: float = REFRESH_SECONDS,
) -> StreamingQuery:
    """Write one message for each alarm that any job writes, into the table ``alert_outbox``.

    The stream is the alarms' own log, so both writers meet in it, and an alarm that is written
    again within ``remembered``, also by a job under a new checkpoint, sends no second message.
    A message is placed by a snapshot of the bins that is up to ``refresh_seconds`` old.
    """
    store.create(spark, root, schemas.ALARMS)
    of_now = places(spark, root, refresh_seconds)
    run: Future[str] = Future()

    def each(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            alarms.outbox(batch, of_now()).write.mode("overwrite").parquet(
                f"{root}/alert_outbox/run={run.result()}/batch_id={batch_id}"
            )

    rows = first_of_each(store.written(spark, root, schemas.ALARMS), "written_at", remembered)
    query = (
        rows.writeStream.queryName("alert_outbox")
        .foreachBatch(each)
        .option("checkpointLocation", f"{checkpoints}/alert_outbox")
        .trigger(**_pace(available_now))
        .start()
    )
    run.set_result(query.id)
    return query
