"""Row-shaping of raw bins, readings and routes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillwatch.functions import levels


def _given(value: Column) -> Column:
    """Zero counts as missing."""
    return F.nullif(value.cast("double"), F.lit(0.0))


def flatten_bins(raw: DataFrame) -> DataFrame:
    """Nested self-registration to the flat bins columns."""
    return raw.select(
        "bin_id",
        F.coalesce(_given(F.col("latitude")), _given(F.col("location.coordinates.lat"))).alias(
            "location_lat"
        ),
        F.coalesce(_given(F.col("longitude")), _given(F.col("location.coordinates.lon"))).alias(
            "location_lng"
        ),
        F.coalesce("type", F.lit("standard")).alias("type"),
        F.coalesce(_given(F.col("capacity")), _given(F.col("capacity_kg"))).alias("capacity"),
        _given(F.col("current_fill_level")).alias("current_fill_level"),
        F.coalesce("status", F.lit("active")).alias("status"),
        F.col("last_maintenance").alias("last_maintenance_date"),
        "installation_date",
    )


def with_status(readings: DataFrame) -> DataFrame:
    return readings.withColumn(
        "status", levels.reading_status(F.col("fill_level"), F.col("temperature"))
    )


def with_fill_class(readings: DataFrame) -> DataFrame:
    return readings.withColumn("fill_class", levels.fill_class(F.col("fill_level")))


def with_weight(readings: DataFrame, bins: DataFrame) -> DataFrame:
    """Weight from fill and the bin's capacity; null where the bin is unknown.

    The join carries no hint: Spark broadcasts ``bins`` only below its size
    threshold, else it shuffles and AQE splits a bin that holds too many readings.
    """
    capacity = bins.select("bin_id", F.col("capacity").alias("_capacity"))
    return (
        readings.join(capacity, "bin_id", "left")
        .withColumn("weight", F.round(F.col("fill_level") / 100 * F.col("_capacity"), 2))
        .drop("_capacity")
    )


# Numeric measures of a wide reading.
MEASURES = ("fill_level", "temperature", "humidity", "weight")


def to_wide(long_readings: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """``(bin_id, timestamp, sensor_type, value)`` to one row per bin and time.

    The measures are given, so no pass over the data is spent finding them, and the
    pivot pre-aggregates before its one shuffle. Of several values of one measure at
    one time the greatest is kept, so that the result does not depend on order.
    """
    return (
        long_readings.groupBy("bin_id", "timestamp")
        .pivot("sensor_type", list(measures))
        .agg(F.max(F.col("value").cast("double")))
    )


def to_long(readings: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    return readings.select("bin_id", "timestamp", *measures).unpivot(
        ["bin_id", "timestamp"], list(measures), "sensor_type", "value"
    )


def explode_stops(routes: DataFrame) -> DataFrame:
    """One route with an array of stops to one row per stop."""
    return routes.select("route_id", F.explode("stops").alias("stop")).select("route_id", "stop.*")
