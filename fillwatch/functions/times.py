"""Time expressions: tolerant parsing, cut-offs, calendar fields."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted timestamp patterns.
TIMESTAMP_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)

MICROS_PER_HOUR = 3_600_000_000


def timestamp_any(text: Column) -> Column:
    """Spark's own tolerant parser, then the patterns; null where none fits.

    The tolerant parser reads all that the patterns read but for a rare few, and it does not throw
    on its way. A pattern that misses does, inside of ``try_``, so only texts that begin with a
    date and were not understood meet the patterns.
    """
    tries = [F.try_to_timestamp(text, F.lit(p)) for p in TIMESTAMP_PATTERNS]
    dated = text.rlike(r"^[+-]?\d{4,}-\d\d-\d\d")
    return F.coalesce(F.try_to_timestamp(text), F.when(dated, F.coalesce(*tries)))


def timestamp_or_null(text: Column) -> Column:
    """Blank or null text is a null time."""
    return timestamp_any(F.nullif(text, F.lit("")))


def date_or_null(text: Column) -> Column:
    return text.try_cast("date")


def time_literal(df: DataFrame, column: str, moment: dt.datetime) -> Column:
    """``moment`` (UTC if it has no zone) in the type of ``df[column]``.

    Same type on both sides of a comparison keeps the filter free of casts, so it
    reaches the Parquet scan for TIMESTAMP and TIMESTAMP_NTZ columns alike.
    """
    if moment.tzinfo is not None:
        moment = moment.astimezone(dt.timezone.utc).replace(tzinfo=None)
    text = moment.isoformat(sep=" ")
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    if isinstance(kind, T.DateType):
        return F.lit(moment.date())
    return F.lit(text + "+00:00").cast("timestamp")


def now_utc() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since the epoch; the session zone is UTC throughout."""
    col = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        col = col.cast("timestamp")
    return F.unix_micros(col)


def micros_of(moment: dt.datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    return (moment - epoch) // dt.timedelta(microseconds=1)


def calendar(when: Column) -> dict[str, Column]:
    """Hour, weekday (Monday 0), weekend flag, and calendar quarter (0 = Jan-Mar)."""
    weekday = F.weekday(when)
    return {
        "hour_of_day": F.hour(when),
        "day_of_week": weekday,
        "is_weekend": (weekday >= 5).cast("int"),
        "season": F.quarter(when) - 1,
    }
