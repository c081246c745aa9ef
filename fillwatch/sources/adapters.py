"""Views of the generic test tables as sensor-fleet entities.

Times stay TIMESTAMP_NTZ as the files hold them, so time filters reach the scan.
Order and line-item dates are shifted so that one ``AS_OF`` serves every table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwatch.functions import times

AS_OF = dt.datetime(2024, 1, 31)
SHIFT = dt.timedelta(days=8400)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table read as a file stream."""
    schema = table(spark, sf_dir, name).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    return reader.parquet(sf_dir)


def _text(col: Column | str) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("string")


def _capacity(key: str) -> Column:
    quarter = F.floor(F.col(key) / 4) % 4
    return (
        F.when(quarter == 0, 60.0).when(quarter == 1, 120.0).when(quarter == 2, 240.0).otherwise(500.0)
    )


def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    days = lambda n: F.make_dt_interval(days=(key % n).cast("int"))
    kind = key % 4
    zone = F.col("c_nationkey") % 5
    return table(spark, sf_dir, "customer").select(
        _text(key).alias("bin_id"),
        (42.66 + (key % 101 - 50) / 1000.0).alias("location_lat"),
        (21.17 + (key % 97 - 48) / 1000.0).alias("location_lng"),
        F.when(kind == 0, "street")
        .when(kind == 1, "residential")
        .when(kind == 2, "commercial")
        .otherwise("overflow")
        .alias("type"),
        _capacity("c_custkey").alias("capacity"),
        F.when(F.col("c_acctbal") >= 0, F.least(F.col("c_acctbal") / 100, F.lit(100.0))).alias(
            "current_fill_level"
        ),
        F.when(zone == 0, "offline").when(zone == 1, "inactive").otherwise("active").alias("status"),
        (F.lit("2024-01-31 00:00:00").cast("timestamp_ntz") - days(180)).alias("last_maintenance_date"),
        (F.lit("2022-01-31 00:00:00").cast("timestamp_ntz") + days(700)).alias("installation_date"),
    )


def sensor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_sensor_data(table(spark, sf_dir, "events"))


def as_sensor_data(events: DataFrame) -> DataFrame:
    fill = F.least("value", F.lit(100.0))
    temperature = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        _text("event_id").alias("sensor_id"),
        _text("user_id").alias("bin_id"),
        F.col("ts").alias("timestamp"),
        fill.alias("fill_level"),
        temperature.alias("temperature"),
        F.round(fill / 100 * _capacity("user_id"), 2).alias("weight"),
        (25 + F.col("event_id") % 61).cast("double").alias("humidity"),
        F.when((fill >= 90) | (temperature >= 60), "alert").otherwise("normal").alias("status"),
    )


def sensor_data_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings where every third fill and every fifth temperature is null."""
    n = F.col("sensor_id").cast("long")
    return sensor_data(spark, sf_dir).withColumns(
        {
            "fill_level": F.when(n % 3 != 0, F.col("fill_level")),
            "temperature": F.when(n % 5 != 0, F.col("temperature")),
        }
    )


def _since(df: DataFrame, column: str, since: dt.datetime | None) -> DataFrame:
    """Rows whose shifted time is ``since`` or later, by the column as stored: scans prune by it."""
    if since is None:
        return df
    return df.filter(F.col(column) >= times.time_literal(df, column, since - SHIFT))


def citizen_reports(spark: SparkSession, sf_dir: str, since: dt.datetime | None = None) -> DataFrame:
    made = F.col("o_orderdate") + F.lit(SHIFT)
    kind = F.col("o_orderkey") % 3
    wait = F.make_dt_interval(hours=(1 + F.col("o_orderkey") % 72).cast("int"))
    state = F.col("o_orderstatus")
    return _since(table(spark, sf_dir, "orders"), "o_orderdate", since).select(
        _text("o_orderkey").alias("report_id"),
        _text("o_custkey").alias("bin_id"),
        made.alias("report_timestamp"),
        F.when(kind == 0, "overflow").when(kind == 1, "damage").otherwise("odor").alias("report_type"),
        F.concat(F.lit("Issue reported for bin "), _text("o_custkey")).alias("description"),
        F.when(state == "F", True).when(state == "O", False).alias("resolved"),
        F.when(state == "F", made + wait).alias("resolved_timestamp"),
    )


def maintenance_events(spark: SparkSession, sf_dir: str, since: dt.datetime | None = None) -> DataFrame:
    return _since(table(spark, sf_dir, "lineitem"), "l_shipdate", since).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("event_id"),
        _text(F.col("l_partkey") % 150).alias("bin_id"),
        F.when(F.col("l_returnflag") == "R", "repaired").otherwise("emptied").alias("maintenance_type"),
        (F.col("l_shipdate") + F.lit(SHIFT)).alias("event_timestamp"),
        F.concat(F.lit("tech-"), _text(100 + F.col("l_linenumber"))).alias("performed_by"),
        F.col("l_quantity").alias("duration"),
        (F.col("l_extendedprice") / 1000).alias("cost"),
    )


def alarms(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("event_id")
    band = F.floor(n / 3) % 3
    wait = F.make_dt_interval(hours=(1 + n % 48).cast("int"))
    return (
        table(spark, sf_dir, "events")
        .filter(F.col("event_type") == "error")
        .select(
            F.concat(F.lit("a"), _text(n)).alias("alarm_id"),
            _text("user_id").alias("bin_id"),
            F.when(n % 3 == 0, "overflow")
            .when(n % 3 == 1, "temperature")
            .otherwise("co2_high")
            .alias("alarm_type"),
            F.col("ts").alias("triggered_at"),
            F.when(n % 2 == 0, F.col("ts") + wait).alias("resolved_at"),
            F.when(band == 0, "low").when(band == 1, "medium").otherwise("high").alias("severity"),
            F.when(n % 2 == 0, "resolved").otherwise("active").alias("status"),
        )
    )


def route_history(spark: SparkSession, sf_dir: str, since: dt.datetime | None = None) -> DataFrame:
    stop = F.col("l_linenumber") % 4
    return _since(table(spark, sf_dir, "lineitem"), "l_shipdate", since).select(
        _text("l_orderkey").alias("route_id"),
        _text("l_partkey").alias("bin_id"),
        (F.col("l_shipdate") + F.lit(SHIFT)).alias("service_date"),
        F.when(stop == 0, "missed")
        .when(stop == 1, "collected")
        .when(stop == 2, "delayed")
        .otherwise("skipped")
        .alias("collection_status"),
    )


def planned_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One route per order, with its 3 to 12 stops as an array."""
    n = F.col("o_orderkey")
    states = F.array(*[F.lit(s) for s in ("collected", "delayed", "missed", "skipped")])
    stop = lambda i: F.struct(
        _text((n * 7 + i * 13) % 1500).alias("bin_id"),
        (F.col("o_orderdate") + F.lit(SHIFT)).alias("service_date"),
        F.get(states, ((n + i) % 4).cast("int")).alias("collection_status"),
    )
    return table(spark, sf_dir, "orders").select(
        _text(n).alias("route_id"),
        F.transform(F.sequence(F.lit(1).cast("long"), 3 + n % 10), stop).alias("stops"),
    )


def raw_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins as they register themselves: nested, with some fields absent or zero."""
    n = F.col("bin_id").cast("long")
    absent = F.lit(None).cast("double")
    return bins(spark, sf_dir).select(
        "bin_id",
        F.when(n % 6 != 0, F.col("type")).alias("type"),
        F.when(n % 3 == 0, F.col("capacity")).when(n % 3 == 1, 0.0).alias("capacity"),
        F.when(n % 11 != 0, F.col("capacity")).alias("capacity_kg"),
        F.when(n % 4 == 0, F.col("location_lat")).otherwise(absent).alias("latitude"),
        F.when(n % 4 == 0, F.col("location_lng")).when(n % 4 == 1, 0.0).alias("longitude"),
        F.col("current_fill_level"),
        F.col("installation_date"),
        F.col("last_maintenance_date").alias("last_maintenance"),
        F.when(
            n % 13 != 0,
            F.struct(
                F.lit("street").alias("street"),
                F.lit("Center").alias("district"),
                F.struct(F.col("location_lat").alias("lat"), F.col("location_lng").alias("lon")).alias(
                    "coordinates"
                ),
            ),
        ).alias("location"),
        F.when(n % 5 != 0, F.col("status")).alias("status"),
    )
