"""Keyed tables on plain Parquet: writes are appended, and folded to current rows on read.

A table's log has a folder for each micro-batch, ``source=<stream>/run=<run>/batch_id=<n>``, which
Spark reads as partitions of one table. A run is one checkpoint of a stream, so a stream that starts
again under a new checkpoint writes beside its earlier batches and not over them; writing a
batch of the same run again replaces its folder, so a replay changes nothing. Folding is the same
in any grouping, so a log may be folded into a fresh root at any time (``compact``).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fillwatch.operators import tables
from fillwatch.schemas import INT, LONG, TABLES, TEXT, TIME, Table, struct
from fillwatch.sources.streams import ARRIVAL

ARRIVAL_TYPES = struct(written_at=TIME, arrived_at=TIME, arrived_partition=INT, arrived_offset=LONG)
_PLACE = struct(source=TEXT, run=TEXT, batch_id=LONG)
FOLDED = "folded"


def log_path(root: str, table: Table) -> str:
    return f"{root}/{table.name}/log"


def batch_path(root: str, table: Table, source: str, run: str, batch_id: int) -> str:
    return f"{log_path(root, table)}/source={source}/run={run}/batch_id={batch_id}"


def log_schema(table: Table) -> T.StructType:
    return T.StructType([*table.stored, *ARRIVAL_TYPES, *_PLACE])


def append(
    rows: DataFrame, root: str, table: Table, source: str, batch_id: int, run: str = "0"
) -> None:
    """Write one batch to the table's log, replacing an earlier try of the same batch and run."""
    now = F.lit(dt.datetime.now(dt.timezone.utc))
    places = {f.name: F.col(f.name) if f.name in rows.columns else F.lit(None) for f in ARRIVAL_TYPES}
    arrival = [
        (now if f.name == "written_at" else places[f.name]).cast(f.dataType).alias(f.name)
        for f in ARRIVAL_TYPES
    ]
    rows.select(*table.stored.fieldNames(), *arrival).write.mode("overwrite").parquet(
        batch_path(root, table, source, run, batch_id)
    )


def create(spark: SparkSession, root: str, table: Table) -> None:
    """An empty batch, so that the log is there for streams to read."""
    append(spark.createDataFrame([], table.stored), root, table, "none", 0)


def log(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """All writes to a table, with ``source``, ``run`` and ``batch_id``; none where there is no log."""
    schema = log_schema(table)
    try:
        return spark.read.schema(schema).parquet(log_path(root, table))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def written(spark: SparkSession, root: str, table: Table) -> DataFrame:
    """A stream of what is written to a table from here on and what is there; no folded rows.

    Spark's file source keeps the files it has seen in the checkpoint, and forgets those older than
    its ``maxFileAge``.
    """
    rows = spark.readStream.schema(log_schema(table)).parquet(log_path(root, table))
    return rows.filter(F.col("source") != FOLDED)


def _fold(writes: DataFrame, table: Table, ignore_nulls: bool = True, also: tuple[str, ...] = ()) -> DataFrame:
    times = [table.event_time] if table.event_time else []
    order = ["written_at", *times, *ARRIVAL]
    return tables.fold(writes, table.key, order, [*table.stored.fieldNames(), *also], ignore_nulls)


def current(spark: SparkSession, root: str, table: Table | str, ignore_nulls: bool = True) -> DataFrame:
    """One row per key: later batches win, inside a batch later events."""
    table = TABLES[table] if isinstance(table, str) else table
    return _fold(log(spark, root, table), table, ignore_nulls)


def compact(spark: SparkSession, root: str, table: Table | str, into: str) -> None:
    """Fold a table into the log of the same table under the root ``into``.

    Nothing under ``root`` is changed. Readers and jobs go over to ``into`` with their checkpoints
    once all tables are folded; a batch that was written meanwhile is folded by a second call, and
    rows that are folded twice count once. The old root can be deleted then.
    """
    table = TABLES[table] if isinstance(table, str) else table
    if into.rstrip("/") == root.rstrip("/"):
        raise ValueError("a table is folded into another root than its own")
    rows = _fold(log(spark, root, table), table, also=tuple(ARRIVAL_TYPES.fieldNames()))
    rows.write.parquet(batch_path(into, table, FOLDED, uuid.uuid4().hex, 0))
