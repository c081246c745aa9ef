"""Features of every reading: what was known of its bin when it arrived.

One bin may hold a large part of all readings, so nothing here puts a bin's whole
history, or one hour of it, into one task. Readings are spread over the parts of (bin, hour)
slots: running sums inside a part, plus the sums of the parts before in its slot and of the
slots before, give every prefix and every trailing window exactly. What is carried between
parts is a table of one row per part, at most so many a slot. Row-wise neighbours (the last
ten, the next 24) then come from fixed-size blocks of positions, each with a margin copied
from the blocks beside it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.functions import times
from fillwatch.operators import asof, features
from fillwatch.operators.features import (
    FEATURES,
    RATE_HOURS,
    TREND_MIN_READINGS,
    TREND_READINGS,
    WEEK_HOURS,
    WIDE_HOURS,
)

SLOPE_HOURS = (*RATE_HOURS, WIDE_HOURS)
BLOCK_ROWS = 8192
#: Parts of equal length that an hour is cut into. More of them make a task's share of a dense
#: hour smaller and the table of parts longer; results are the same with any number.
PARTS = 60

_SLOT = ("bin_id", "slot")
_PART = (*_SLOT, "part")
_MEASURES = ("fill_level", "temperature", "humidity", "weight")


# Sums behind a least-squares slope of ``y`` on ``x``, as SQL over those two columns.
MOMENTS = {"n": "1D", "x": "x", "y": "y", "xy": "x * y", "xx": "x * x"}

_BY_PART = "PARTITION BY bin_id, slot, part"
_EARLIER_SLOTS = "PARTITION BY bin_id ORDER BY slot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_EARLIER_PARTS = "PARTITION BY bin_id, slot ORDER BY part RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_LATER_PARTS = _EARLIER_PARTS.replace("ORDER BY part", "ORDER BY part DESC")


# A reading's place in its part, and how many of the part are before its instant.
_RANK = f"row_number() OVER ({_BY_PART} ORDER BY at, sensor_id) AS rank"
_EARLIER = f"(rank() OVER ({_BY_PART} ORDER BY at) - 1)"

_SLOPE = (
    "CASE WHEN n_{h} > same"
    " THEN (n_{h} * xy_{h} - x_{h} * y_{h}) / (n_{h} * xx_{h} - x_{h} * x_{h}) END"
)
"""Slope from sums; null unless the window holds more than the ``same`` instant."""


def _cut(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` with the slot and part that their time ``at`` falls into, and the ``offset`` in the slot."""
    width = times.MICROS_PER_HOUR
    offset = F.pmod(F.col("at"), F.lit(width))
    part = F.floor(offset * parts / width)
    return rows.withColumns({"slot": F.floor(F.col("at") / width), "offset": offset, "part": part})


def _slotted(readings: DataFrame, parts: int) -> DataFrame:
    at = times.micros(readings, "timestamp")
    rows = readings.filter(F.col("timestamp").isNotNull()).select(
        "bin_id", "sensor_id", "timestamp", *_MEASURES, at.alias("at")
    )
    return _cut(rows, parts)


def _same_facts(slots: DataFrame) -> DataFrame:
    return slots


def _before(cells: DataFrame, sums: list[str], facts: Callable[[DataFrame], DataFrame] = _same_facts) -> DataFrame:
    """One row per part: ``before_<sum>`` over all parts before it, its bin's ``total``, and facts."""
    slots = (
        cells.groupBy(*_SLOT)
        .agg(*[F.sum(k).alias(k) for k in sums])
        .selectExpr(
            *_SLOT,
            "sum(size) OVER (PARTITION BY bin_id) AS total",
            *[f"coalesce(sum({k}) OVER ({_EARLIER_SLOTS}), 0) AS slots_{k}" for k in sums],
        )
    )
    inside = cells.selectExpr(
        *_PART, *[f"coalesce(sum({k}) OVER ({_EARLIER_PARTS}), 0) AS parts_{k}" for k in sums]
    )
    known = facts(slots)
    return inside.join(known, list(_SLOT)).selectExpr(
        *_PART,
        "total",
        *[c for c in _FACTS if c in known.columns],
        *[f"slots_{k} + parts_{k} AS before_{k}" for k in sums],
    )


_CARRIED = ("bin_id", "sensor_id", "timestamp", *_MEASURES, "position", "total")


Facts = Callable[[DataFrame], DataFrame]
"""Adds to a table of (bin, hour) slots what is known of the bin, in columns of ``_FACTS``."""

_FACTS = ("days_since_maintenance", "bin_day")


def _finish(rows: DataFrame, carried: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Joins what other parts contribute, and derives place, rates and weekly mean.

    What is known of a bin rides on its slots: readings are never joined by their bin alone, which
    would put all those of one bin into one task.

    Sums, slopes and rates are three projections: in one, each rate would repeat the
    text of the sums below it, and the compiled method would outgrow what the JVM
    optimises.
    """
    known = [c for c in _FACTS if c in carried.columns]
    summed = rows.join(carried, list(_PART)).selectExpr(
        *_CARRIED[:-2],
        "before_size + rank - 1 AS position",
        "total",
        "same",
        *known,
        *[f"{v} AS {k}" for k, v in sums.items()],
    )
    sloped = summed.selectExpr(
        *_CARRIED,
        *known,
        f"coalesce(y_{WEEK_HOURS} / nullif(n_{WEEK_HOURS}, 0D), 0D) AS avg_fill_last_week",
        *[f"n_{h}" for h in RATE_HOURS],
        *[f"{_SLOPE.format(h=h)} AS slope_{h}" for h in SLOPE_HOURS],
    )
    wide = F.col(f"slope_{WIDE_HOURS}")
    return sloped.select(
        *_CARRIED,
        *known,
        "avg_fill_last_week",
        *[
            features.rate_of(F.col(f"n_{h}"), F.col(f"slope_{h}"), wide).alias(f"fill_rate_{h}h")
            for h in RATE_HOURS
        ],
    )


def _literal_windows(rows: DataFrame, as_of: dt.datetime, facts: Facts) -> DataFrame:
    """Windows that end at each reading and begin at ``as_of`` minus the hours."""
    age = (F.col("at") - times.micros_of(as_of)) / times.MICROS_PER_HOUR
    rows = rows.withColumns({"x": age, "y": F.col("fill_level")})
    parts: dict[str, str] = {}
    for h in SLOPE_HOURS:
        parts |= {f"{k}_{h}": f"sum(IF(x >= -{h}, {v}, 0D))" for k, v in MOMENTS.items()}
    parts[f"n_{WEEK_HOURS}"] = f"sum(IF(x >= -{WEEK_HOURS}, 1D, 0D))"
    parts[f"y_{WEEK_HOURS}"] = f"sum(IF(x >= -{WEEK_HOURS}, y, 0D))"

    cells = rows.groupBy(*_PART).agg(
        F.count("*").alias("size"), *[F.expr(v).alias(k) for k, v in parts.items()]
    )
    so_far = f"{_BY_PART} ORDER BY at, sensor_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    rows = rows.selectExpr(
        "*",
        _RANK,
        f"{_EARLIER} AS earlier",
        *[f"{v} OVER ({so_far}) AS {k}" for k, v in parts.items()],
    ).withColumn("same", F.expr("rank - earlier"))
    return _finish(
        rows, _before(cells, ["size", *parts], facts), {k: f"before_{k} + {k}" for k in parts}
    )


def _between(h: int) -> str:
    """Sums over the whole slots inside an ``h``-hour window, seen from the current slot.

    ``recent`` lists the slots before; each one's times are moved to hours relative to
    the current slot, so no large numbers cancel.
    """
    moved = f"transform(filter(recent, s -> s.slot > slot - {h}), s -> named_struct('s', s, 'm', CAST(s.slot - slot AS DOUBLE)))"
    return f"""aggregate({moved},
        named_struct('n', 0D, 'x', 0D, 'y', 0D, 'xy', 0D, 'xx', 0D),
        (a, r) -> named_struct(
            'n', a.n + r.s.n,
            'x', a.x + r.s.x + r.m * r.s.n,
            'y', a.y + r.s.y,
            'xy', a.xy + r.s.xy + r.m * r.s.y,
            'xx', a.xx + r.s.xx + 2 * r.m * r.s.x + r.m * r.m * r.s.n))"""


def _row_windows(rows: DataFrame, facts: Facts) -> DataFrame:
    """Windows that end at each reading and begin the hours before it.

    A window of ``h`` hours over hour slots is: the head of the reading's own slot, the
    whole slots between, and the tail of the slot ``h`` slots ago from the same offset
    on. Every reading therefore also goes, as an edge, to the slots it will be the tail
    of; that is five narrow copies instead of a frame rescanned for every reading. Heads
    and tails are summed inside the reading's part of the slot; the parts before and after
    it, whose sums go to later slots as well, add theirs.
    """
    rows = rows.withColumns(
        {"x": F.col("offset") / float(times.MICROS_PER_HOUR), "y": F.col("fill_level")}
    )
    lags = ", ".join(str(h) for h in (0, *SLOPE_HOURS, WEEK_HOURS))
    cells = rows.groupBy(*_PART).agg(
        F.count("*").alias("size"), *[F.expr(f"sum({v})").alias(k) for k, v in MOMENTS.items()]
    )
    head = f"{_BY_PART} ORDER BY at"
    own = rows.selectExpr(
        "*",
        _RANK,
        f"{_EARLIER} AS earlier",
        *[f"sum({v}) OVER ({head}) AS head_{k}" for k, v in MOMENTS.items()],
    ).withColumn("same", F.expr("head_n - earlier"))

    heads = [f"head_{k}" for k in MOMENTS]
    kept = ("sensor_id", "timestamp", *_MEASURES, "rank", "same", *heads)
    spread = own.selectExpr("*", f"explode(array({lags})) AS lag").selectExpr(
        "bin_id",
        "slot + lag AS slot",
        "part",
        "lag",
        "offset",
        "x - lag AS x",
        "y",
        *[f"IF(lag = 0, {c}, NULL) AS {c}" for c in kept],
    )
    # Edges that fall into a part without readings are looked at by no one. The parts are
    # no more than the rows, and both sides meet in the partitioning the windows need.
    taken = rows.select(*_PART).distinct().hint("shuffle_hash")
    spread = spread.join(taken, list(_PART), "left_semi")
    tails = {h: list(MOMENTS) for h in SLOPE_HOURS} | {WEEK_HOURS: ["n", "y"]}
    columns = [
        f"sum(IF(lag = {h}, {MOMENTS[k]}, 0D)) OVER ({_BY_PART} ORDER BY offset DESC) AS tail_{k}_{h}"
        for h, names in tails.items()
        for k in names
    ]
    own = spread.selectExpr("*", *columns).filter("lag = 0")
    sums = {
        f"{k}_{h}": f"head_{k} + before_{k}_{h} + tail_{k}_{h}"
        for h, names in tails.items()
        for k in names
    }
    return _finish(own, _around(cells, lags, tails, facts), sums)


def _around(cells: DataFrame, lags: str, tails: dict[int, list[str]], facts: Facts) -> DataFrame:
    """One row per part: for each window, ``before_<sum>_<hours>`` over all that lies in it outside
    the part itself and its like ``hours`` slots ago; ``before_size`` and ``total`` of its bin."""
    back = "PARTITION BY bin_id ORDER BY slot RANGE BETWEEN {} PRECEDING AND 1 PRECEDING"
    wide, week = back.format(WIDE_HOURS - 1), back.format(WEEK_HOURS - 1)
    slots = (
        cells.groupBy(*_SLOT)
        .agg(*[F.sum(k).alias(k) for k in ("size", *MOMENTS)])
        .selectExpr(
            *_SLOT,
            f"coalesce(sum(size) OVER ({_EARLIER_SLOTS}), 0) AS slots_size",
            "sum(size) OVER (PARTITION BY bin_id) AS total",
            f"collect_list(struct(slot, n, x, y, xy, xx)) OVER ({wide}) AS recent",
            f"coalesce(sum(n) OVER ({week}), 0D) AS week_n",
            f"coalesce(sum(y) OVER ({week}), 0D) AS week_y",
        )
        .selectExpr(
            *_SLOT,
            "slots_size",
            "total",
            f"named_struct('n', week_n, 'y', week_y) AS mid_{WEEK_HOURS}",
            *[f"{_between(h)} AS mid_{h}" for h in SLOPE_HOURS],
        )
    )
    moved = cells.selectExpr("*", f"explode(array({lags})) AS lag").selectExpr(
        "bin_id",
        "slot + lag AS slot",
        "part",
        "lag",
        "size",
        "n",
        "x - lag * n AS x",
        "y",
        "xy - lag * y AS xy",
        "xx - 2 * lag * x + lag * lag * n AS xx",
    )
    inside = moved.selectExpr(
        *_PART,
        "lag",
        *[
            f"coalesce(sum(IF(lag = 0, {k}, 0)) OVER ({_EARLIER_PARTS}), 0) AS head_{k}"
            for k in ("size", *MOMENTS)
        ],
        *[
            f"coalesce(sum(IF(lag = {h}, {k}, 0D)) OVER ({_LATER_PARTS}), 0D) AS tail_{k}_{h}"
            for h, names in tails.items()
            for k in names
        ],
    ).filter("lag = 0")
    known = facts(slots)
    return inside.join(known, list(_SLOT)).selectExpr(
        *_PART,
        "slots_size + head_size AS before_size",
        "total",
        *[c for c in _FACTS if c in known.columns],
        *[
            f"head_{k} + mid_{h}.{k} + tail_{k}_{h} AS before_{k}_{h}"
            for h, names in tails.items()
            for k in names
        ],
    )


def _neighbours(rows: DataFrame, ahead: tuple[int, ...], block_rows: int) -> DataFrame:
    """The temperature trend up to each reading, and the fill some readings later.

    A block of positions also receives the nine rows before it and the rows after it
    that it looks at, so every reading finds its neighbours inside its own block.
    """
    behind, reach = TREND_READINGS - 1, max(ahead, default=0)
    size = max(block_rows, 2 * (behind + reach) + 2)
    place = F.col("position")
    block = lambda p: F.floor(p / size)
    copies = F.array_distinct(
        F.array(block(place), block(place + behind), block(F.greatest(place - reach, F.lit(0))))
    )
    spread = rows.select("*", F.explode(copies).alias("block"))
    order = Window.partitionBy("bin_id", "block").orderBy("position")
    trend = F.regr_slope("temperature", F.col("position").cast("double")).over(
        order.rowsBetween(-behind, Window.currentRow)
    )
    enough = F.col("position") >= TREND_MIN_READINGS - 1
    return (
        spread.select(
            "*",
            F.when(enough, F.coalesce(trend, F.lit(0.0))).otherwise(0.0).alias("temperature_trend"),
            *[F.lead("fill_level", h).over(order).alias(f"fill_after_{h}") for h in ahead],
        )
        .filter(F.col("block") == block(place))
        .drop("block")
    )


def prefix(
    readings: DataFrame,
    as_of: dt.datetime,
    mode: str = "row",
    maintenance: DataFrame | None = None,
    bins: DataFrame | None = None,
    ahead: tuple[int, ...] = (),
    min_readings: int = 0,
    block_rows: int = BLOCK_ROWS,
    parts: int = PARTS,
) -> DataFrame:
    """The first 14 features at every reading, its position, and its bin's total.

    ``mode="literal"`` takes ``as_of`` as the clock of every row: calendar fields are
    constant and windows begin at ``as_of`` minus their length. ``mode="row"`` takes the
    reading's own time, so a row knows nothing later than itself. ``ahead`` adds
    ``fill_after_<h>``, the fill ``h`` readings later. A task holds a bin's readings of one
    of the ``parts`` of an hour at a time, and no more.
    """
    if mode not in ("literal", "row"):
        raise ValueError(f"mode is 'literal' or 'row', not {mode!r}")
    rows = _slotted(features.with_defaults(readings), parts)
    if mode == "literal":
        rows = _literal_windows(
            rows, as_of, lambda slots: features.days_since_maintenance(slots, as_of, maintenance, bins)
        )
    else:
        rows = _row_windows(rows, lambda slots: slots if bins is None else _with_bin_day(slots, bins))
    if min_readings:
        rows = rows.filter(F.col("total") >= min_readings)
    kept = [
        "bin_id",
        "sensor_id",
        "timestamp",
        "position",
        "total",
        *_MEASURES,
        *[f"fill_rate_{h}h" for h in RATE_HOURS],
        "avg_fill_last_week",
        *[c for c in _FACTS if c in rows.columns],
    ]
    rows = _neighbours(rows.select(*kept), ahead, block_rows)
    if mode == "literal":
        moment = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    else:
        rows = _days_since_at_row(rows, readings, maintenance)
        moment = F.col("timestamp")
    rows = rows.withColumns(features.calendar_columns(moment))
    return rows.withColumnRenamed("fill_level", "current_fill_level").select(
        "bin_id",
        "sensor_id",
        "timestamp",
        "position",
        "total",
        *FEATURES[:-1],
        *[f"fill_after_{h}" for h in ahead],
    )


def _with_bin_day(slots: DataFrame, bins: DataFrame) -> DataFrame:
    dates = bins.select("bin_id", F.to_date("last_maintenance_date").alias("bin_day"))
    return slots.join(dates, "bin_id", "left")


def positions(readings: DataFrame, parts: int = PARTS) -> DataFrame:
    """Key, time, ``position`` and ``total`` of every reading, as ``prefix`` gives them."""
    rows = readings.filter(F.col("timestamp").isNotNull()).select(
        "bin_id", "sensor_id", "timestamp", times.micros(readings, "timestamp").alias("at")
    )
    rows = _cut(rows, parts)
    carried = _before(rows.groupBy(*_PART).agg(F.count("*").alias("size")), ["size"])
    return (
        rows.selectExpr("*", _RANK)
        .join(carried, list(_PART))
        .selectExpr("bin_id", "sensor_id", "timestamp", "before_size + rank - 1 AS position", "total")
    )


def _days_since_at_row(rows: DataFrame, readings: DataFrame, maintenance: DataFrame | None) -> DataFrame:
    known: list[Column] = []
    if maintenance is not None:
        events = maintenance.select(
            "bin_id", "event_timestamp", F.to_date("event_timestamp").alias("_event_day")
        )
        rows = asof.attach(
            rows,
            events,
            "bin_id",
            "timestamp",
            "event_timestamp",
            ["_event_day"],
            slot_hours=1,
            times_of=readings,
        )
        known.append(F.col("_event_day"))
    if "bin_day" in rows.columns:
        known.append(F.when(F.col("bin_day") <= F.to_date("timestamp"), F.col("bin_day")))
    days = F.datediff(F.to_date("timestamp"), F.coalesce(*known)) if known else F.lit(None).cast("int")
    return rows.withColumn(
        "days_since_maintenance", F.coalesce(days, F.lit(features.UNKNOWN_DAYS))
    ).drop("_event_day", "bin_day")
