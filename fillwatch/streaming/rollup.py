"""Daily figures kept up to date: each batch of new rows adds its partial sums, none is read again."""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fillwatch import schemas
from fillwatch.operators import kpis
from fillwatch.schemas import Table
from fillwatch.streaming import store

#: Which rows of ``kpis.daily_partials`` a table holds, and the pace of its job.
ROWS = {
    schemas.SENSOR_DATA.name: "readings",
    schemas.CITIZEN_REPORTS.name: "reports",
    schemas.MAINTENANCE_EVENTS.name: "maintenance",
    schemas.ALARMS.name: "alarms",
    schemas.ROUTE_HISTORY.name: "routes",
}
PACE = "60 seconds"


def partials_path(root: str) -> str:
    return f"{root}/daily_partials"


def append(rows: DataFrame, root: str, table: Table, batch_id: int, run: str = "0") -> None:
    """Add the partials of some rows of a table, replacing an earlier try of the same batch and run."""
    kpis.daily_partials(**{ROWS[table.name]: rows}).write.mode("overwrite").parquet(
        f"{partials_path(root)}/source={table.name}/run={run}/batch_id={batch_id}"
    )


def start(
    spark: SparkSession, root: str, checkpoints: str, table: Table, available_now: bool = False
) -> StreamingQuery:
    """Add what is written to a table's log to the partials, batch by batch.

    A batch reads its own rows only and writes a row for each of their days (and routes). Every row
    of the log counts, so this is for tables whose rows are written once: a row that is written
    again, by a job under a new checkpoint or as an update, is counted again. Such tables are
    rolled up whole (``kpis.daily_rollup`` of ``store.current``).
    """
    run: Future[str] = Future()
    pace = {"availableNow": True} if available_now else {"processingTime": PACE}

    def each(batch: DataFrame, batch_id: int) -> None:
        append(batch, root, table, batch_id, run.result())

    query = (
        store.written(spark, root, table)
        .writeStream.queryName(f"daily_{table.name}")
        .foreachBatch(each)
        .option("checkpointLocation", f"{checkpoints}/daily_{table.name}")
        .trigger(**pace)
        .start()
    )
    run.set_result(query.id)
    return query


def partials(spark: SparkSession, root: str) -> DataFrame:
    """All partials that were added, with ``source``, ``run`` and ``batch_id``."""
    sums = ", ".join(f"{name} {kind}" for name, kind in kpis.SUMS.items())
    places = "source string, run string, batch_id long"
    return spark.read.schema(f"date date, route_id string, {sums}, {places}").parquet(partials_path(root))


def figures(spark: SparkSession, root: str, bins: DataFrame) -> DataFrame:
    """The daily figures of all rows so far; reads a row per batch and day, and no table but ``bins``."""
    return kpis.daily_figures(partials(spark, root).select("date", "route_id", *kpis.SUMS), bins)


def compact(spark: SparkSession, root: str, into: str) -> None:
    """Merge the partials under ``root`` into one for each day and route under another root."""
    if into.rstrip("/") == root.rstrip("/"):
        raise ValueError("partials are merged into another root than their own")
    merged = kpis.merged_partials(partials(spark, root))
    merged.write.parquet(f"{partials_path(into)}/source={store.FOLDED}/run=0/batch_id=0")
