"""Keyed tables: loading, upserts folded to current rows, and filtered reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fillwatch.functions import times
from fillwatch.schemas import TABLES

# ---------------------------------------------------------------- load and define


def load(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One stored table, under its declared schema."""
    return spark.read.schema(TABLES[name].stored).parquet(f"{path}/{name}")


def create_empty(spark: SparkSession, path: str, names: Sequence[str] = tuple(TABLES)) -> None:
    """Drop and recreate tables as empty Parquet folders with their declared schemas."""
    for name in names:
        empty = spark.createDataFrame([], TABLES[name].stored)
        empty.write.mode("overwrite").parquet(f"{path}/{name}")


def query(
    spark: SparkSession, text: str, args: dict | None = None, **views: DataFrame
) -> DataFrame:
    """SQL with named parameters over the given tables; errors are raised.

    Tables are named in the text as ``{bins}``, parameters as ``:status``.
    """
    return spark.sql(text, args=args or {}, **views)


# ---------------------------------------------------------------- upserts


def latest_by_key(df: DataFrame, key: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row per key. ``order_by`` should end in something unique.

    Spark limits each map task to one row per key ahead of the shuffle, so a key with
    a great many versions sends only one row per task.
    """
    newest = Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in order_by])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def fold(
    writes: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    columns: Sequence[str] | None = None,
    ignore_nulls: bool = True,
) -> DataFrame:
    """One row per key out of many writes, as a keyed store would hold it.

    With ``ignore_nulls`` a null never overwrites an older value, column by column.
    Both forms reduce each key on the map side.
    """
    columns = list(columns or writes.columns)
    if not ignore_nulls:
        return latest_by_key(writes, key, order_by).select(*columns)
    order = F.struct(*order_by)
    merged = [
        F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns if c not in key
    ]
    return writes.groupBy(*key).agg(*merged).select(*columns)


def merge_by_key(
    current: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    ignore_nulls: bool = True,
) -> DataFrame:
    """``current`` after ``batch`` was written to it; rows of ``batch`` in ``order_by`` order."""
    columns = current.columns
    order = [f"_order{i}" for i in range(len(order_by))]
    kinds = {f.name: f.dataType for f in batch.schema}
    old = current.select(
        *columns,
        F.lit(0).alias("_write"),
        *[F.lit(None).cast(kinds[c]).alias(o) for c, o in zip(order_by, order)],
    )
    new = batch.select(
        *columns, F.lit(1).alias("_write"), *[F.col(c).alias(o) for c, o in zip(order_by, order)]
    )
    return fold(old.unionByName(new), key, ["_write", *order], columns, ignore_nulls)


# ---------------------------------------------------------------- filtered reads


def since(
    df: DataFrame,
    column: str,
    as_of: dt.datetime | None,
    *,
    days: float = 0,
    hours: float = 0,
) -> DataFrame:
    """Rows from ``as_of`` minus the interval on; no upper bound."""
    cutoff = (as_of or times.now_utc()) - dt.timedelta(days=days, hours=hours)
    return df.filter(F.col(column) >= times.time_literal(df, column, cutoff))


def _equal(df: DataFrame, column: str, value: str | None, any_word: str | None = None) -> DataFrame:
    return df.filter(F.col(column) == value) if value and value != any_word else df


def bins(df: DataFrame, status: str | None = None, bin_type: str | None = None) -> DataFrame:
    """Bins by status and type; ``None``, blank or ``"All"`` means any."""
    df = _equal(_equal(df, "status", status, "All"), "type", bin_type, "All")
    return df.withColumns(
        {
            "bin_id": F.col("bin_id").cast("string"),
            "location_lat": F.col("location_lat").cast("double"),
            "location_lng": F.col("location_lng").cast("double"),
        }
    )


def sensor_data(
    df: DataFrame,
    as_of: dt.datetime | None = None,
    hours_back: float = 24,
    bin_ids: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """Readings of the last hours, of all bins or of some.

    A short list of ids becomes an ``IN`` filter; a DataFrame of ids a semi-join, which
    Spark broadcasts only where it is small.
    """
    df = since(df, "timestamp", as_of, hours=hours_back)
    if bin_ids is None:
        return df
    if isinstance(bin_ids, DataFrame):
        return df.join(bin_ids.select("bin_id"), "bin_id", "left_semi")
    return df.filter(F.col("bin_id").isin(list(bin_ids))) if bin_ids else df


def citizen_reports(
    df: DataFrame,
    as_of: dt.datetime | None = None,
    days_back: float = 7,
    resolved: bool | None = None,
) -> DataFrame:
    """Reports of the last days; a null flag matches neither True nor False."""
    df = since(df, "report_timestamp", as_of, days=days_back)
    return df if resolved is None else df.filter(F.col("resolved") == resolved)


def maintenance_events(
    df: DataFrame, as_of: dt.datetime | None = None, days_back: float = 30
) -> DataFrame:
    return since(df, "event_timestamp", as_of, days=days_back)


def alarms(
    df: DataFrame,
    as_of: dt.datetime | None = None,
    days_back: float = 7,
    severity: str | None = None,
    status: str | None = None,
) -> DataFrame:
    """Alarms of the last days; a blank severity or status means any."""
    df = since(df, "triggered_at", as_of, days=days_back)
    return _equal(_equal(df, "severity", severity), "status", status)


def route_history(
    df: DataFrame, as_of: dt.datetime | None = None, days_back: float = 7
) -> DataFrame:
    return since(df, "service_date", as_of, days=days_back)


def performance_analytics(
    df: DataFrame, as_of: dt.datetime | None = None, days_back: float = 30
) -> DataFrame:
    return since(df, "date", as_of, days=days_back)


def bins_with_readings(readings: DataFrame) -> DataFrame:
    return readings.select("bin_id").distinct()


def sensor_history(readings: DataFrame, limit: int | None = None) -> DataFrame:
    """The columns features need; with a limit, the earliest rows, always the same ones.

    Every task would send ``limit`` rows of its own to the one that merges them, so the
    hour in which the limit is reached is found first, from one row per hour, and later
    readings are dropped where they are read.
    """
    history = readings.select(
        "sensor_id", "bin_id", "timestamp", "fill_level", "temperature", "humidity", "weight"
    )
    if limit is None:
        return history
    hour = F.date_trunc("hour", "timestamp")
    hours = readings.groupBy(hour.alias("hour")).agg(F.count("*").alias("rows"))
    so_far = F.sum("rows").over(Window.orderBy("hour"))
    reached = hours.withColumn("so_far", so_far).filter(F.col("so_far") >= limit)
    last = reached.agg(F.min("hour")).scalar()
    early = F.col("timestamp").isNull() | last.isNull() | (hour <= last)
    return history.filter(early).orderBy("timestamp", "sensor_id").limit(limit)


def column_types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema}


def as_ntz(df: DataFrame) -> DataFrame:
    """Every TIMESTAMP as the same wall-clock TIMESTAMP_NTZ."""
    casts: dict[str, Column] = {
        n: F.col(n).cast("timestamp_ntz")
        for n, t in column_types(df).items()
        if isinstance(t, T.TimestampType)
    }
    return df.withColumns(casts) if casts else df
