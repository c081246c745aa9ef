"""Value rules on a reading: thresholds, classes, colours, defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Thresholds, labels and defaults of the domain.
FILL_ALARM = 90.0
TEMPERATURE_ALARM = 60.0
FILL_CRITICAL = 95.0
TEMPERATURE_CRITICAL = 70.0
LEVEL_CRITICAL = 90.0
LEVEL_WARNING = 75.0
LEVEL_SEMI_WARNING = 60.0
EMPTY_BELOW = 30.0
PARTIAL_BELOW = 80.0
STATUS_COLORS = {"active": "green", "inactive": "red", "offline": "gray"}
MEASURE_DEFAULTS = {"fill_level": 0.0, "temperature": 20.0, "humidity": 50.0, "weight": 0.0}


def missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value)


def no_nan(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def reading_status(
    fill: Column,
    temperature: Column,
    fill_alarm: float = FILL_ALARM,
    temperature_alarm: float = TEMPERATURE_ALARM,
) -> Column:
    """``alert`` or ``normal``; a null measure never alerts."""
    alert = (fill >= fill_alarm) | (temperature >= temperature_alarm)
    return F.when(alert, "alert").otherwise("normal")


def fill_class(fill: Column) -> Column:
    """``empty``, ``partial`` or ``full``; null stays null, NaN is ``full``."""
    return (
        F.when(fill < EMPTY_BELOW, "empty")
        .when(fill < PARTIAL_BELOW, "partial")
        .when(fill.isNotNull(), "full")
    )


def level(fill: Column) -> Column:
    return (
        F.when(fill >= LEVEL_CRITICAL, "critical")
        .when(fill >= LEVEL_WARNING, "warning")
        .when(fill >= LEVEL_SEMI_WARNING, "semi_warning")
        .when(fill.isNotNull(), "normal")
    )


def marker_size(fill: Column) -> Column:
    """Fill times 1.5 within 20..50; a missing fill is the smallest marker.

    ``least`` and ``greatest`` skip nulls, so without the guard a null would come
    out as 50.
    """
    clamped = F.greatest(F.lit(20.0), F.least(fill * 1.5, F.lit(50.0)))
    return F.when(missing(fill), 20.0).otherwise(clamped)


def status_color(status: Column) -> Column:
    color = F.lit(None).cast("string")
    for name, value in STATUS_COLORS.items():
        color = F.when(status == name, value).otherwise(color)
    return color


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(float(low)), F.least(value, F.lit(float(high))))
