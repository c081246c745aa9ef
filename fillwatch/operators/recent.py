"""Features of a bin's recent history out of partials that merge by stacking.

Moments of the fill are kept by bin and slot of time, beside each bin's last readings. Windows end
at a step's boundary and are whole numbers of steps long, so they are made of whole slots: a slot is
either the inside of a step or the instant where two steps meet, which makes windows that hold both
their ends exact.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillwatch.functions import levels, times
from fillwatch.operators import features

#: Length of a slot. Every window of ``features`` is a multiple of it.
STEP = dt.timedelta(minutes=5)
#: What is kept of a slot: its readings, sums over hours since its step's start (u) and fill (y).
SUMS = ("n", "u", "uu", "y", "uy")
MOMENTS = "bin_id string, slot long, n long, u double, uu double, y double, uy double, least double, greatest double"
TAILS = (
    "bin_id string, sensor_id string, timestamp timestamp, fill_level double, temperature double,"
    " humidity double, weight double"
)


def _micros(length: dt.timedelta) -> int:
    return length // dt.timedelta(microseconds=1)


def on_step(moment: dt.datetime, step: dt.timedelta = STEP) -> dt.datetime:
    """The first boundary of a step that is not before ``moment``: the clock to ask for features by."""
    late = -times.micros_of(moment) % _micros(step)
    return moment + dt.timedelta(microseconds=late)


def _slot_of(moment: dt.datetime, step: dt.timedelta) -> int:
    number, rest = divmod(times.micros_of(moment), _micros(step))
    if rest:
        raise ValueError(f"{moment} is not on a step of {step}")
    return 2 * number


def first_slot(as_of: dt.datetime, hours: int, step: dt.timedelta = STEP) -> int:
    """The first slot of the window of so many hours that ends at ``as_of``."""
    return _slot_of(as_of - dt.timedelta(hours=hours), step)


def moments(readings: DataFrame, step: dt.timedelta = STEP) -> DataFrame:
    """Moments by bin and slot, summed on the map side first. Readings without a time are in no slot."""
    at = times.micros(readings, "timestamp")
    size = F.lit(_micros(step))
    timed = features.with_defaults(readings).filter(F.col("timestamp").isNotNull())
    since = F.pmod(at, size)
    number = ((at - since) / size).cast("long")
    return (
        timed.select(
            "bin_id",
            (2 * number + (since > 0).cast("long")).alias("slot"),
            (since / times.MICROS_PER_HOUR).alias("u"),
            F.col("fill_level").alias("y"),
        )
        .groupBy("bin_id", "slot")
        .agg(
            F.count("*").alias("n"),
            F.sum("u").alias("u"),
            F.sum(F.col("u") * F.col("u")).alias("uu"),
            F.sum("y").alias("y"),
            F.sum(F.col("u") * F.col("y")).alias("uy"),
            F.min("u").alias("least"),
            F.max("u").alias("greatest"),
        )
    )


def merged(partials: DataFrame) -> DataFrame:
    """One row of moments for each bin and slot out of any stack of such rows."""
    return partials.groupBy("bin_id", "slot").agg(
        *[F.sum(name).alias(name) for name in SUMS],
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
    )


def tails(readings: DataFrame) -> DataFrame:
    """The last readings of each bin; the same of any stack of tails is the tail of all their rows."""
    timed = features.with_defaults(readings).filter(F.col("timestamp").isNotNull())
    return features.last_readings(timed, features.TREND_READINGS).select(
        "bin_id", "sensor_id", "timestamp", *levels.MEASURE_DEFAULTS
    )


def _slope(inside: Column, offset: Column) -> Column:
    """Least-squares slope of fill by hours over the slots inside, which start at ``offset``."""

    def total(value: Column) -> Column:
        return F.sum(F.when(inside, value))

    n, y = total(F.col("n")), total(F.col("y"))
    x = total(F.col("u") + offset * F.col("n"))
    xx = total(F.col("uu") + 2 * offset * F.col("u") + offset * offset * F.col("n"))
    xy = total(F.col("uy") + offset * F.col("y"))
    first = F.min(F.when(inside, F.col("least") + offset))
    last = F.max(F.when(inside, F.col("greatest") + offset))
    return F.when(first < last, (n * xy - x * y) / (n * xx - x * x))


def aggregates(
    partials: DataFrame, as_of: dt.datetime, hours: tuple[int, ...], step: dt.timedelta = STEP
) -> DataFrame:
    """Rates and the weekly mean per bin, as ``features`` has them of the readings themselves."""
    end = _slot_of(as_of, step)
    width = _micros(step) / times.MICROS_PER_HOUR
    offset = (F.floor(F.col("slot") / 2) - end // 2) * F.lit(width)
    longest = max(features.WEEK_HOURS, features.WIDE_HOURS, *hours)
    recent = partials.filter((F.col("slot") >= first_slot(as_of, longest, step)) & (F.col("slot") <= end))
    inside = {h: F.col("slot") >= first_slot(as_of, h, step) for h in {*hours, features.WIDE_HOURS, features.WEEK_HOURS}}
    slopes = {h: _slope(inside[h], offset) for h in {*hours, features.WIDE_HOURS}}

    def count(h: int) -> Column:
        return F.coalesce(F.sum(F.when(inside[h], F.col("n"))), F.lit(0))

    week = inside[features.WEEK_HOURS]
    return recent.groupBy("bin_id").agg(
        *[
            features.rate_of(count(h), slopes[h], slopes[features.WIDE_HOURS]).alias(f"fill_rate_{h}h")
            for h in hours
        ],
        (F.sum(F.when(week, F.col("y"))) / F.sum(F.when(week, F.col("n")))).alias("avg_fill_last_week"),
    )


def build(
    partials: DataFrame,
    last: DataFrame,
    as_of: dt.datetime,
    maintenance: DataFrame | None = None,
    bins: DataFrame | None = None,
    step: dt.timedelta = STEP,
) -> DataFrame:
    """``features.build`` out of moments and tails.

    ``as_of`` is on a step (``on_step``). Slots and last readings after it are left out; as tails
    hold a fixed number of readings, it should not be before what they were taken from. Repeated
    readings count as often as they came. No partials give no rows.
    """
    known = last.filter(F.col("timestamp") <= times.time_literal(last, "timestamp", as_of))
    recent = aggregates(partials, as_of, features.BUILD_HOURS, step)
    return features.assemble(known, recent, as_of, maintenance, bins)
