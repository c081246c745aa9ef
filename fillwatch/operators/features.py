"""Features of a bin's recent history, once per bin, for serving."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.functions import levels, times
from fillwatch.operators import tables

# The model's inputs in order, and the windows behind them.
FEATURES = (
    "current_fill_level",
    "temperature",
    "humidity",
    "weight",
    "hour_of_day",
    "day_of_week",
    "fill_rate_1h",
    "fill_rate_6h",
    "fill_rate_24h",
    "days_since_maintenance",
    "avg_fill_last_week",
    "temperature_trend",
    "is_weekend",
    "season",
    "horizon",
)
RATE_HOURS = (1, 6, 24)
FORECAST_RATE_HOURS = 12
BUILD_HOURS = (*RATE_HOURS, FORECAST_RATE_HOURS)
WIDE_HOURS = 48
WEEK_HOURS = 7 * 24
RATE_MIN, RATE_MAX = -1.0, 5.0
RATE_MIN_READINGS = 3
TREND_READINGS, TREND_MIN_READINGS = 10, 5
UNKNOWN_DAYS = -1


def with_defaults(readings: DataFrame) -> DataFrame:
    """Missing measures (null or NaN) replaced by their defaults."""
    return readings.withColumns(
        {
            name: F.coalesce(levels.no_nan(F.col(name)), F.lit(default))
            for name, default in levels.MEASURE_DEFAULTS.items()
        }
    )


def _known(readings: DataFrame, as_of: dt.datetime, upper_bound: bool) -> DataFrame:
    if not upper_bound:
        return readings
    return readings.filter(F.col("timestamp") <= times.time_literal(readings, "timestamp", as_of))


def last_readings(readings: DataFrame, n: int) -> DataFrame:
    """The last ``n`` readings of each bin, newest first in ``recency``.

    The rank filter is pushed below the shuffle as a limit per bin and map task.
    """
    newest = Window.partitionBy("bin_id").orderBy(F.desc("timestamp"), F.desc("sensor_id"))
    return readings.withColumn("recency", F.row_number().over(newest)).filter(
        F.col("recency") <= n
    )


def _newest(column: str, alias: str) -> Column:
    return F.max(F.when(F.col("recency") == 1, F.col(column))).alias(alias)


def _trend() -> Column:
    slope = F.regr_slope("temperature", -F.col("recency").cast("double"))
    enough = F.count("*") >= TREND_MIN_READINGS
    return F.when(enough, F.coalesce(slope, F.lit(0.0))).otherwise(0.0).alias("temperature_trend")


def latest(readings: DataFrame) -> DataFrame:
    """Measures of each bin's newest reading."""
    return (
        last_readings(readings, 1)
        .select(
            "bin_id",
            F.col("timestamp").alias("last_reading_at"),
            F.col("fill_level").alias("current_fill_level"),
            "temperature",
            "humidity",
            "weight",
        )
    )


def temperature_trend(readings: DataFrame) -> DataFrame:
    """Slope per reading of the last ten temperatures; 0 under five readings."""
    return last_readings(readings, TREND_READINGS).groupBy("bin_id").agg(_trend())


def rate_of(narrow_n: Column, narrow: Column, wide: Column) -> Column:
    """The narrow slope if enough readings back it, else the wide one, within bounds."""
    slope = F.when(narrow_n >= RATE_MIN_READINGS, narrow).otherwise(wide)
    return levels.clamp(F.coalesce(slope, F.lit(0.0)), RATE_MIN, RATE_MAX)


def _recent_aggregates(
    readings: DataFrame, as_of: dt.datetime, hours: tuple[int, ...]
) -> DataFrame:
    """Rates and the weekly mean per bin in one grouped pass over the last week."""
    x = (times.micros(readings, "timestamp") - times.micros_of(as_of)) / times.MICROS_PER_HOUR
    recent = tables.since(readings, "timestamp", as_of, hours=max(WEEK_HOURS, WIDE_HOURS, *hours))
    recent = recent.select("bin_id", "fill_level", x.alias("x"))
    age = F.col("x")
    inside = {h: age >= -float(h) for h in {*hours, WIDE_HOURS}}
    slopes = {h: F.regr_slope(F.when(c, F.col("fill_level")), age) for h, c in inside.items()}
    return recent.groupBy("bin_id").agg(
        *[
            rate_of(F.count_if(inside[h]), slopes[h], slopes[WIDE_HOURS]).alias(f"fill_rate_{h}h")
            for h in hours
        ],
        F.avg(F.when(age >= -float(WEEK_HOURS), F.col("fill_level"))).alias("avg_fill_last_week"),
    )


def fill_rates(
    readings: DataFrame,
    as_of: dt.datetime,
    hours: tuple[int, ...] = (*RATE_HOURS, FORECAST_RATE_HOURS),
    upper_bound: bool = True,
) -> DataFrame:
    """Fill per hour by least squares over each window; bins without recent readings have 0."""
    known = _known(readings, as_of, upper_bound)
    rates = _recent_aggregates(known, as_of, hours).drop("avg_fill_last_week")
    return (
        tables.bins_with_readings(known)
        .join(rates, "bin_id", "left")
        .fillna(0.0, [f"fill_rate_{h}h" for h in hours])
    )


def avg_fill(readings: DataFrame, as_of: dt.datetime, upper_bound: bool = True) -> DataFrame:
    """Mean fill over the last week; 0 where there is none."""
    known = _known(readings, as_of, upper_bound)
    means = _recent_aggregates(known, as_of, ()).select("bin_id", "avg_fill_last_week")
    return (
        tables.bins_with_readings(known)
        .join(means, "bin_id", "left")
        .fillna(0.0, ["avg_fill_last_week"])
    )


def days_since_maintenance(
    ids: DataFrame,
    as_of: dt.datetime,
    maintenance: DataFrame | None = None,
    bins: DataFrame | None = None,
) -> DataFrame:
    """``ids`` plus whole days since the bin's last maintenance at or before ``as_of``.

    Events come first, then the date in ``bins``; -1 where neither knows.
    """
    moment = F.to_date(F.lit(as_of.isoformat(sep=" ")))
    known: list[Column] = []
    if maintenance is not None:
        upto = F.col("event_timestamp") <= times.time_literal(maintenance, "event_timestamp", as_of)
        last = maintenance.filter(upto).groupBy("bin_id").agg(
            F.max(F.to_date("event_timestamp")).alias("_event_day")
        )
        ids = ids.join(last, "bin_id", "left")
        known.append(F.col("_event_day"))
    if bins is not None:
        upto = F.col("last_maintenance_date") <= times.time_literal(
            bins, "last_maintenance_date", as_of
        )
        dates = bins.filter(upto).select(
            "bin_id", F.to_date("last_maintenance_date").alias("_bin_day")
        )
        ids = ids.join(dates, "bin_id", "left")
        known.append(F.col("_bin_day"))
    days = F.datediff(moment, F.coalesce(*known)) if known else F.lit(None).cast("int")
    return ids.withColumn(
        "days_since_maintenance", F.coalesce(days, F.lit(UNKNOWN_DAYS))
    ).drop("_event_day", "_bin_day")


def calendar_columns(moment: Column) -> dict[str, Column]:
    return times.calendar(moment)


def build(
    readings: DataFrame,
    as_of: dt.datetime,
    maintenance: DataFrame | None = None,
    bins: DataFrame | None = None,
    upper_bound: bool = True,
) -> DataFrame:
    """One feature row per bin with readings, plus the 12-hour rate the forecast steers by.

    Two grouped passes, both reduced on the map side: the last ten readings per bin, and
    sums over the last week. Their results are co-partitioned, so joining them shuffles
    nothing more.
    """
    known = with_defaults(_known(readings, as_of, upper_bound))
    return assemble(known, _recent_aggregates(known, as_of, BUILD_HOURS), as_of, maintenance, bins)


def assemble(
    known: DataFrame,
    recent: DataFrame,
    as_of: dt.datetime,
    maintenance: DataFrame | None = None,
    bins: DataFrame | None = None,
) -> DataFrame:
    """The feature rows out of readings that hold each bin's last ones, and the bins' rates and means."""
    tail = (
        last_readings(known, TREND_READINGS)
        .groupBy("bin_id")
        .agg(
            _newest("fill_level", "current_fill_level"),
            _newest("temperature", "temperature"),
            _newest("humidity", "humidity"),
            _newest("weight", "weight"),
            _trend(),
        )
    )
    filled = [f"fill_rate_{h}h" for h in BUILD_HOURS] + ["avg_fill_last_week"]
    joined = tail.join(recent, "bin_id", "left").fillna(0.0, filled)
    joined = days_since_maintenance(joined, as_of, maintenance, bins)
    moment = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    return joined.withColumns(calendar_columns(moment)).select(
        "bin_id", *FEATURES[:-1], f"fill_rate_{FORECAST_RATE_HOURS}h"
    )
