"""Counts, means and daily figures over the fleet's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fillwatch.functions import levels


def bin_summary(bins: DataFrame) -> DataFrame:
    return bins.agg(
        F.count("*").alias("total_bins"),
        F.count_if(F.col("status") == "active").alias("active_bins"),
        F.count_if(F.col("status") == "offline").alias("offline_bins"),
        F.round(F.avg("current_fill_level"), 2).alias("avg_fill"),
    )


def status_distribution(bins: DataFrame) -> DataFrame:
    return bins.groupBy("status").agg(F.count("*").alias("bins"))


def map_points(bins: DataFrame) -> DataFrame:
    return bins.select(
        "bin_id",
        "location_lat",
        "location_lng",
        "status",
        "type",
        "current_fill_level",
        "capacity",
        "last_maintenance_date",
        levels.marker_size(F.col("current_fill_level")).alias("marker_size"),
        levels.status_color(F.col("status")).alias("color"),
    )


def map_center(bins: DataFrame) -> DataFrame:
    return bins.agg(F.avg("location_lat").alias("lat"), F.avg("location_lng").alias("lon"))


def report_resolution(reports: DataFrame) -> DataFrame:
    """A report whose flag is null counts as unresolved."""
    resolved = F.count_if(F.col("resolved"))
    return reports.agg(
        resolved.alias("resolved_reports"), (F.count("*") - resolved).alias("unresolved_reports")
    )


def alarm_severity(alarms: DataFrame) -> DataFrame:
    return alarms.groupBy("severity").agg(F.count("*").alias("alarms"))


def fill_series(readings: DataFrame) -> DataFrame:
    """Fill over time, bins in order: ready to draw."""
    return readings.select("bin_id", "timestamp", "fill_level").orderBy("bin_id", "timestamp")


def bins_emptied_daily(maintenance: DataFrame) -> DataFrame:
    emptied = maintenance.filter(F.col("maintenance_type") == "emptied")
    return emptied.groupBy(F.to_date("event_timestamp").alias("date")).agg(
        F.count("*").alias("bins_emptied")
    )


def reading_counts(readings: DataFrame) -> DataFrame:
    """Readings per bin, and of all bins in the row without a bin."""
    return readings.rollup("bin_id").agg(F.count("*").alias("readings"))


# What a partial row sums, by day and, for stops, by route; ``rows`` are those of other tables.
# Fill is summed as a decimal, so that figures don't depend on how the rows were grouped.
SUMS = {
    "rows": "long",
    "fill_sum": "decimal(38,10)",
    "fill_n": "long",
    "reports": "long",
    "resolved": "long",
    "response_sum": "double",
    "response_n": "long",
    "maintenance": "long",
    "alarms": "long",
    "collected": "long",
    "missed": "long",
}


#: What stops add; every other sum is of a day.
STOP_SUMS = ("collected", "missed")
DAY_SUMS = tuple(f for f in SUMS if f not in STOP_SUMS)


def _facts(df: DataFrame, when: str, sums: tuple[str, ...] = DAY_SUMS, **values: Column) -> DataFrame:
    """``df`` projected to the day and what is summed, absent ones null."""
    keys = [c.alias(k) for k, c in values.items() if k not in SUMS]
    return df.select(
        F.to_date(when).alias("date"),
        *keys,
        *[values.get(f, F.lit(None)).cast(SUMS[f]).alias(f) for f in sums],
    ).filter(F.col("date").isNotNull())


def _summed(rows: DataFrame, sums: tuple[str, ...], *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.sum(f).cast(SUMS[f]).alias(f) for f in sums])


def _merged_days(rows: DataFrame) -> DataFrame:
    """One row of ``DAY_SUMS`` per day with rows of tables other than stops."""
    return _summed(rows.filter(F.col("rows") > 0), DAY_SUMS, "date")


def _merged_stops(rows: DataFrame) -> DataFrame:
    """One row of ``STOP_SUMS`` per day and route.

    Almost every stop of a day is of another route, so a task's table of groups is nearly as long
    as its rows: they carry no other sums.
    """
    known = F.coalesce(*STOP_SUMS).isNotNull()
    return _summed(rows.filter(known), STOP_SUMS, "date", "route_id")


def _stacked(days: DataFrame | None, stops: DataFrame | None) -> DataFrame:
    """Both kinds of partial rows in the columns of the stored ones."""
    parts = [df for df in (days, stops) if df is not None]
    kinds = {"date": "date", "route_id": "string", **SUMS}
    return reduce(
        DataFrame.unionByName,
        [df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in kinds.items()]) for df in parts],
    )


def merged_partials(rows: DataFrame) -> DataFrame:
    """One row per day, and one per day and route, out of several."""
    return _stacked(_merged_days(rows), _merged_stops(rows))


def _day_partials(
    readings: DataFrame | None, reports: DataFrame | None, maintenance: DataFrame | None, alarms: DataFrame | None
) -> DataFrame | None:
    one = F.lit(1)
    parts: list[DataFrame] = []
    if readings is not None:
        fill = F.col("fill_level").try_cast(SUMS["fill_sum"])
        parts.append(
            _facts(readings, "timestamp", rows=one, fill_sum=fill, fill_n=F.when(fill.isNotNull(), 1))
        )
    if reports is not None:
        waited = (
            F.unix_micros(F.col("resolved_timestamp").cast("timestamp"))
            - F.unix_micros(F.col("report_timestamp").cast("timestamp"))
        ) / 60_000_000
        parts.append(
            _facts(
                reports,
                "report_timestamp",
                rows=one,
                reports=one,
                resolved=F.when(F.col("resolved"), 1),
                response_sum=F.when(F.col("resolved"), waited),
                response_n=F.when(F.col("resolved") & waited.isNotNull(), 1),
            )
        )
    if maintenance is not None:
        parts.append(_facts(maintenance, "event_timestamp", rows=one, maintenance=one))
    if alarms is not None:
        parts.append(_facts(alarms, "triggered_at", rows=one, alarms=one))
    return _summed(reduce(DataFrame.unionByName, parts), DAY_SUMS, "date") if parts else None


def _stop_partials(routes: DataFrame) -> DataFrame:
    status = F.col("collection_status")
    return _merged_stops(
        _facts(
            routes,
            "service_date",
            STOP_SUMS,
            route_id=F.col("route_id").cast("string"),
            collected=F.when(status == "collected", 1),
            missed=F.when(status != "collected", 1),
        )
    )


def daily_partials(
    readings: DataFrame | None = None,
    reports: DataFrame | None = None,
    maintenance: DataFrame | None = None,
    alarms: DataFrame | None = None,
    routes: DataFrame | None = None,
) -> DataFrame:
    """What the given rows add to ``daily_figures``: a row per day, and one per day and route.

    Partials of disjoint sets of rows are merged by stacking them, so new rows are worked off by
    themselves. Rows without a time are in no day, stops without a status in no row; a fill that is
    no finite number counts as none. The tables but stops are stacked and grouped once: every map
    task sends one partial row per day, however the days are filled.
    """
    days = _day_partials(readings, reports, maintenance, alarms)
    if days is None and routes is None:
        raise ValueError("no table is given")
    return _stacked(days, None if routes is None else _stop_partials(routes))


def _figures(days: DataFrame, stops: DataFrame, bins: DataFrame) -> DataFrame:
    """The figures out of one row per day and one per day and route."""
    done = stops.filter((F.col("collected") > 0) & (F.coalesce("missed", F.lit(0)) == 0))
    completed = done.groupBy("date").agg(F.count("*").alias("routes"))
    number = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("int")
    fleet = bins.agg(F.count("*").cast("int")).scalar()
    return (
        days.unionByName(completed, allowMissingColumns=True)
        .groupBy("date")
        .agg(
            (F.sum("fill_sum").cast("double") / F.sum("fill_n")).alias("avg_fill_level"),
            number("reports").alias("total_reports"),
            number("resolved").alias("resolved_reports"),
            number("maintenance").alias("maintenance_events_count"),
            (F.sum("response_sum") / F.sum("response_n")).alias("avg_response_time"),
            number("alarms").alias("alarms_count"),
            number("routes").alias("routes_completed"),
        )
        .select(
            F.concat(F.lit("day-"), F.col("date").cast("string")).alias("id"),
            "date",
            fleet.alias("total_bins"),
            "avg_fill_level",
            "total_reports",
            "resolved_reports",
            "maintenance_events_count",
            "avg_response_time",
            "alarms_count",
            "routes_completed",
        )
    )


def daily_figures(partials: DataFrame, bins: DataFrame) -> DataFrame:
    """One row of figures per day out of the partials of all rows, stacked in any grouping.

    A route counts as completed on a day when all its stops of that day were collected. A day that
    has only routes that were not has no figures.
    """
    return _figures(_merged_days(partials), _merged_stops(partials), bins)


def daily_rollup(
    bins: DataFrame,
    readings: DataFrame,
    reports: DataFrame,
    maintenance: DataFrame,
    alarms: DataFrame,
    routes: DataFrame,
) -> DataFrame:
    """One row of figures per day, each table counted by its own time."""
    return _figures(_day_partials(readings, reports, maintenance, alarms), _stop_partials(routes), bins)
