"""The running jobs: one per topic, alarms derived from readings, and the alert outbox."""

from __future__ import annotations

import logging
import sys
from collections.abc import Callable
from concurrent.futures import Future
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fillwatch import schemas
from fillwatch.operators import alarms, parse
from fillwatch.schemas import Table
from fillwatch.sources import streams as sources
from fillwatch.streaming import alerts, progress, store

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Job:
    """One topic parsed into one table, at its own pace."""

    name: str
    topic: Table
    table: Table
    seconds: int
    derive: Callable[[DataFrame], DataFrame] | None = None


# Which topic feeds which table, and how often in seconds.
JOBS = (
    Job("bins", schemas.BINS, schemas.BINS, 30),
    Job("sensor_data", schemas.SENSOR_DATA, schemas.SENSOR_DATA, 15),
    Job("citizen_reports", schemas.CITIZEN_REPORTS, schemas.CITIZEN_REPORTS, 30),
    Job("maintenance_events", schemas.MAINTENANCE_EVENTS, schemas.MAINTENANCE_EVENTS, 30),
    Job("alarms", schemas.ALARMS, schemas.ALARMS, 20),
    Job("performance_analytics", schemas.PERFORMANCE_ANALYTICS, schemas.PERFORMANCE_ANALYTICS, 60),
    Job("route_history", schemas.ROUTE_HISTORY, schemas.ROUTE_HISTORY, 60),
    Job("sensor_alarms", schemas.SENSOR_DATA, schemas.ALARMS, 20, alarms.detect),
)


def process_batch(
    batch: DataFrame, batch_id: int, job: Job, root: str, sample: int = 0, run: str = "0"
) -> None:
    """Parse one micro-batch and write its rows and rejects.

    The parsed batch is kept for its several writes. Any error is raised: the batch is
    then not committed and comes again, and every write replaces its own earlier try.
    """
    parsed = parse.parsed(batch, job.topic).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows, rejects = parse.split_rejects(parsed, job.topic)
        if job.derive:
            rows = job.derive(rows)
        elif not rejects.isEmpty():
            rejects.write.mode("overwrite").parquet(
                f"{root}/rejects/source={job.name}/run={run}/batch_id={batch_id}"
            )
        if rows.isEmpty():
            logger.info("%s: batch %d is empty", job.name, batch_id)
            return
        if sample:
            rows.show(sample, truncate=False)
        written = Observation()
        counted = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        store.append(counted, root, job.table, job.name, batch_id, run)
        logger.info("%s: batch %d wrote %d rows to %s", job.name, batch_id, written.get["rows"], job.table.name)
    finally:
        parsed.unpersist()


def start(
    messages: DataFrame,
    job: Job,
    root: str,
    checkpoints: str,
    available_now: bool = False,
    sample: int = 0,
) -> StreamingQuery:
    """Start one job; with ``available_now`` it works off what is there and ends.

    The id that a checkpoint keeps for its query names the run that the batches belong to.
    """
    run: Future[str] = Future()

    def each(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, job, root, sample, run.result())

    pace = {"availableNow": True} if available_now else {"processingTime": f"{job.seconds} seconds"}
    query = (
        messages.writeStream.queryName(job.name)
        .foreachBatch(each)
        .outputMode("append")
        .option("checkpointLocation", f"{checkpoints}/{job.name}")
        .trigger(**pace)
        .start()
    )
    run.set_result(query.id)
    return query


def start_all(
    spark: SparkSession,
    root: str,
    checkpoints: str,
    messages: Callable[[SparkSession, str], DataFrame] = sources.kafka_json,
    jobs: tuple[Job, ...] = JOBS,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """Start every job on the messages of its topic, and the outbox if there are alarms among them.

    A later wait is for these, not for earlier ones.
    """
    spark.streams.resetTerminated()
    started = [
        start(messages(spark, job.topic.name), job, root, checkpoints, available_now) for job in jobs
    ]
    if any(job.table is schemas.ALARMS for job in jobs):
        started.append(alerts.start_outbox(spark, root, checkpoints, available_now))
    return started


def status(spark: SparkSession) -> list[dict]:
    """Name, state and last row count of every running job."""
    return [
        {
            "name": q.name,
            "message": q.status["message"],
            "data_available": q.status["isDataAvailable"],
            "rows": (q.lastProgress or {}).get("numInputRows"),
        }
        for q in spark.streams.active
    ]


def await_any(spark: SparkSession) -> None:
    """Wait until a job ends or fails or an interrupt comes, then stop all of them.

    A job's error is raised after the others have been stopped.
    """
    try:
        spark.streams.awaitAnyTermination()
    except KeyboardInterrupt:
        logger.info("interrupted")
    finally:
        stop_all(spark)


def stop_all(spark: SparkSession) -> None:
    for q in spark.streams.active:
        q.stop()


def session() -> SparkSession:
    """The session of the jobs; times without a zone are UTC."""
    return (
        SparkSession.builder.appName("fillwatch").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )


def run(spark: SparkSession, root: str, checkpoints: str, **options: str) -> None:
    """All jobs on Kafka until one ends or an interrupt; ``options`` are options of the source."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ledger = progress.Ledger()
    spark.streams.addListener(ledger)
    try:
        start_all(spark, root, checkpoints, lambda s, topic: sources.kafka_json(s, topic, **options))
        for line in status(spark):
            logger.info("%s", line)
        try:
            await_any(spark)
        finally:
            for run_id in ledger.runs():
                ledger.wait_until_over(run_id)
            for line in ledger.lines():
                logger.info("%s", line)
    finally:
        spark.streams.removeListener(ledger)


def arguments(words: list[str]) -> tuple[str, str, dict[str, str]]:
    """Tables' folder, checkpoints' folder, and source options as ``name=value``."""
    root, checkpoints, *rest = words
    return root, checkpoints, dict(word.split("=", 1) for word in rest)


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO)
    tables_at, checkpoints_at, given = arguments(sys.argv[1:])
    run(session(), tables_at, checkpoints_at, **given)
