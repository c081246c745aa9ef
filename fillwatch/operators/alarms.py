"""Alarms raised from readings, and the messages alarms give rise to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwatch.functions import levels

ALARM_COLUMNS = (
    "alarm_id",
    "bin_id",
    "alarm_type",
    "triggered_at",
    "resolved_at",
    "severity",
    "status",
)


def detect(
    readings: DataFrame,
    fill: float = levels.FILL_ALARM,
    temp: float = levels.TEMPERATURE_ALARM,
    fill_critical: float = levels.FILL_CRITICAL,
    temp_critical: float = levels.TEMPERATURE_CRITICAL,
    nan_policy: str = "keep",
) -> DataFrame:
    """One alarm per reading that is too full or too hot.

    The id is a hash of the reading and the alarm type, so reading the same message
    twice gives the same alarm. Spark orders NaN above every number, so a NaN measure
    raises an alarm unless ``nan_policy="null"``.
    """
    level, heat = F.col("fill_level"), F.col("temperature")
    if nan_policy == "null":
        level, heat = levels.no_nan(level), levels.no_nan(heat)
    elif nan_policy != "keep":
        raise ValueError(f"nan_policy is 'keep' or 'null', not {nan_policy!r}")
    kind = F.when(level >= fill, "overflow").when(heat >= temp, "temperature").otherwise("system")
    severity = (
        F.when(level >= fill_critical, "critical")
        .when(heat >= temp_critical, "critical")
        .otherwise("high")
    )
    time_type = readings.schema["timestamp"].dataType
    return readings.filter((level >= fill) | (heat >= temp)).select(
        F.sha2(F.concat_ws("|", "sensor_id", kind), 256).alias("alarm_id"),
        "bin_id",
        kind.alias("alarm_type"),
        F.col("timestamp").alias("triggered_at"),
        F.lit(None).cast(time_type).alias("resolved_at"),
        severity.alias("severity"),
        F.lit("active").alias("status"),
    )


def all_alarms(reported: DataFrame, derived: DataFrame) -> DataFrame:
    """Alarms sent by devices and alarms derived from readings, as one table."""
    return reported.select(*ALARM_COLUMNS).unionByName(derived.select(*ALARM_COLUMNS))


# The wording of an alert message.
SUBJECT = "URGENT: %s - %s"
BODY = """
Alert Details:
- Bin ID: %s
- Alert Type: %s
- Severity: %s
- Timestamp: %s
- Location: https://maps.google.com/?q=%s,%s

Please take immediate action.
"""
ALERT_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def outbox(alarms: DataFrame, bins: DataFrame) -> DataFrame:
    """One message per alarm, placed by its bin; delivery is someone else's job.

    The join carries no hint, see ``records.with_weight``.
    """
    places = bins.select("bin_id", "location_lat", "location_lng")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return alarms.join(places, "bin_id", "left").select(
        "alarm_id",
        "bin_id",
        F.format_string(SUBJECT, "alarm_type", "bin_id").alias("subject"),
        F.format_string(
            BODY,
            F.col("bin_id"),
            F.col("alarm_type"),
            F.coalesce("severity", F.lit("high")),
            F.coalesce(F.date_format("triggered_at", ALERT_TIME), F.lit("")),
            text("location_lat"),
            text("location_lng"),
        ).alias("body"),
    )
