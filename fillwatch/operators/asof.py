"""As-of join: the nearest event at or before (or after) each probe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.functions import times


def attach(
    probes: DataFrame,
    events: DataFrame,
    key: str,
    probe_time: str,
    event_time: str,
    values: Sequence[str],
    direction: str = "backward",
    slot_hours: int = 24,
    times_of: DataFrame | None = None,
    parts: int = 60,
) -> DataFrame:
    """``probes`` plus ``values`` of the nearest event of the same key; null without one.

    Time is cut into slots and each slot into ``parts``, and the rows of one key are spread over
    them: within a part a running window finds the nearest event, and where the part has none
    yet the nearest event of the parts before in its slot is carried in, or else of the slots
    before. That carry comes from a table with one row per key and part, so no task ever holds
    the whole history of a key, or a dense slot of it. Among events at the same instant the
    greatest ``values`` win looking back, the least looking ahead. A probe without a time has
    no event.

    That table needs to know the probes' parts. Where probes are costly to work out,
    ``times_of`` names a cheaper table with at least their keys and times.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction is 'backward' or 'forward', not {direction!r}")
    back = direction == "backward"
    width = slot_hours * times.MICROS_PER_HOUR
    cut = {
        "slot": F.floor(F.col("at") / width),
        "part": F.floor(F.pmod(F.col("at"), F.lit(width)) * parts / width),
    }
    happened = events.select(
        key,
        times.micros(events, event_time).alias("at"),
        F.struct(times.micros(events, event_time).alias("at"), *values).alias("event"),
    ).filter(F.col("at").isNotNull())
    no_event = F.lit(None).cast(happened.schema["event"].dataType).alias("event")
    asked = probes.select(
        key,
        times.micros(probes, probe_time).alias("at"),
        no_event,
        F.struct(*probes.columns).alias("probe"),
    )
    stacked = (
        happened.withColumn("probe", F.lit(None).cast(probes.schema))
        .unionByName(asked)
        .withColumns(cut)
    )
    if times_of is None:
        times_of = probes
    visited = times_of.select(key, times.micros(times_of, probe_time).alias("at"), no_event)
    # named here, as the join below asks for it of one of the two tables made of ``seen``, which then
    # would be worked out twice
    whole = F.col("at").isNotNull() & F.col("slot").isNotNull() & F.col("part").isNotNull()
    seen = happened.unionByName(visited).withColumns(cut).filter(whole)

    nearest = F.max if back else F.min
    turn = (lambda c: F.col(c).asc()) if back else (lambda c: F.col(c).desc())
    up_to_here = (
        Window.partitionBy(key, "slot", "part")
        .orderBy(turn("at"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier_slots = (
        Window.partitionBy("_key_of").orderBy(turn("_slot_of")).rowsBetween(Window.unboundedPreceding, -1)
    )
    earlier_parts = (
        Window.partitionBy("_key", "_slot").orderBy(turn("_part")).rowsBetween(Window.unboundedPreceding, -1)
    )
    cells = (
        seen.groupBy(F.col(key).alias("_key"), F.col("slot").alias("_slot"), F.col("part").alias("_part"))
        .agg(nearest("event").alias("event"))
    )
    slots = (
        cells.groupBy(F.col("_key").alias("_key_of"), F.col("_slot").alias("_slot_of"))
        .agg(nearest("event").alias("event"))
        .select("_key_of", "_slot_of", nearest("event").over(earlier_slots).alias("before"))
    )
    inside = cells.select("_key", "_slot", "_part", nearest("event").over(earlier_parts).alias("inside"))
    carried = inside.join(
        slots, F.col("_key").eqNullSafe(F.col("_key_of")) & (F.col("_slot") == F.col("_slot_of"))
    ).select("_key", "_slot", "_part", F.coalesce("inside", "before").alias("carried"))
    found = stacked.withColumn("event", nearest("event").over(up_to_here)).filter(
        F.col("probe").isNotNull()
    )
    joined = found.join(
        carried,
        found[key].eqNullSafe(carried["_key"])
        & (found["slot"] == carried["_slot"])
        & (found["part"] == carried["_part"]),
        "left",
    )
    hit = F.coalesce("event", "carried")
    return joined.select("probe.*", *[hit[v].alias(v) for v in values])
