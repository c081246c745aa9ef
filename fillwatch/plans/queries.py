"""The registered queries: every operator over the test tables, whole."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fillwatch import schemas
from fillwatch.functions import times
from fillwatch.operators import (
    alarms,
    anomaly,
    features,
    forecast,
    history,
    kpis,
    parse,
    records,
    tables,
    training,
)
from fillwatch.session import settled, shared_dir
from fillwatch.sources import adapters as ad
from fillwatch.sources import wire
from fillwatch.streaming import alerts, jobs, progress, recent, rollup, store

A = ad.AS_OF
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return tables.as_ntz(f(spark, sf_dir))

    QUERIES[f.__name__] = run
    return run


def rounded(df: DataFrame, places: int = 4) -> DataFrame:
    casts: dict[str, Column] = {
        f.name: F.round(f.name, places) for f in df.schema if isinstance(f.dataType, T.DoubleType)
    }
    return df.withColumns(casts) if casts else df


def messages(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return wire.to_json_value(df, keep, "json_str")


def _round_trip(df: DataFrame, table: schemas.Table) -> DataFrame:
    return parse.read(messages(df), table)


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.with_defaults(ad.sensor_data(spark, sf_dir))


def _rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = (
        ad.bins,
        ad.sensor_data,
        ad.citizen_reports,
        ad.maintenance_events,
        ad.alarms,
        ad.route_history,
    )
    return kpis.daily_rollup(*[source(spark, sf_dir) for source in sources])


# ---------------------------------------------------------------- parsing


@query
def sensor_parse(spark, sf_dir):
    return _round_trip(ad.sensor_data(spark, sf_dir), schemas.SENSOR_DATA)


@query
def bins_parse(spark, sf_dir):
    return _round_trip(ad.bins(spark, sf_dir), schemas.BINS)


@query
def reports_parse(spark, sf_dir):
    return _round_trip(ad.citizen_reports(spark, sf_dir), schemas.CITIZEN_REPORTS)


@query
def maintenance_parse(spark, sf_dir):
    return _round_trip(ad.maintenance_events(spark, sf_dir), schemas.MAINTENANCE_EVENTS)


@query
def alarms_parse(spark, sf_dir):
    return _round_trip(ad.alarms(spark, sf_dir), schemas.ALARMS)


@query
def routes_parse(spark, sf_dir):
    return _round_trip(ad.route_history(spark, sf_dir), schemas.ROUTE_HISTORY)


@query
def performance_parse(spark, sf_dir):
    return rounded(_round_trip(_rollup(spark, sf_dir), schemas.PERFORMANCE_ANALYTICS))


def awkward_messages(events: DataFrame) -> DataFrame:
    """Every event as a sensor message in one of sixteen spellings, some of them broken."""
    kind = F.col("event_id") % 16
    moment = F.col("ts").cast("timestamp")
    shown = lambda p, c=moment: F.date_format(c, p)
    micros = shown("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    two_on = moment + F.expr("INTERVAL '2' HOUR")
    when = (
        F.when(kind == 0, F.concat(micros, F.lit("+00:00")))
        .when(kind == 1, F.concat(micros, F.lit("Z")))
        .when(kind == 2, F.concat(shown("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", two_on), F.lit("+02:00")))
        .when(kind == 3, F.concat(shown("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+00:00")))
        .when(kind == 5, shown("yyyy-MM-dd'T'HH:mm:ss.SSS"))
        .when(kind == 6, shown("yyyy-MM-dd"))
        .when(kind == 7, shown("yyyy-MM-dd HH:mm:ss"))
        .when(kind == 8, F.lit("junk"))
        .otherwise(micros)
    )
    number = F.col("value").cast("string")
    fill = (
        F.when(kind == 9, F.concat(F.lit('"'), number, F.lit('"')))
        .when(kind == 12, F.lit("NaN"))
        .otherwise(number)
    )
    bin_id = (
        F.when(kind == 11, F.lit("null"))
        .when(kind == 14, F.lit('{"k":1}'))
        .otherwise(F.col("user_id").cast("string"))
    )
    body = F.format_string(
        '"sensor_id":%d,"bin_id":%s,"timestamp":"%s","fill_level":%s',
        F.col("event_id"),
        bin_id,
        when,
        fill,
    )
    extra = F.when(kind == 15, F.lit(',"fill_level":1.5,"other":[1,2]')).otherwise(F.lit(""))
    good = F.concat(F.lit("{"), body, extra, F.lit("}"))
    text = (
        F.when(kind == 10, F.concat(F.lit("{"), body))
        .when(kind == 13, F.concat(F.lit("["), good, F.lit("]")))
        .otherwise(good)
    )
    return events.select("event_id", text.alias("json_str"))


@query
def parse_edge_cases(spark, sf_dir):
    rows = parse.parsed(awkward_messages(ad.table(spark, sf_dir, "events")), schemas.SENSOR_DATA)
    good, _ = parse.split_rejects(rows, schemas.SENSOR_DATA)
    return good.select(
        "event_id",
        "sensor_id",
        "bin_id",
        "timestamp",
        F.isnan("fill_level").alias("fill_is_nan"),
        F.nanvl("fill_level", F.lit(-1.0)).alias("fill_level"),
    )


@query
def reject_split(spark, sf_dir):
    rows = parse.parsed(awkward_messages(ad.table(spark, sf_dir, "events")), schemas.SENSOR_DATA)
    reason = F.coalesce("reason", F.lit("good")).alias("reason")
    return (
        parse.judge(rows, schemas.SENSOR_DATA)
        .groupBy(F.lit("sensor_data").alias("topic"), reason)
        .agg(F.count("*").alias("messages"))
    )


@query
def rejected_messages(spark, sf_dir):
    rows = parse.parsed(awkward_messages(ad.table(spark, sf_dir, "events")), schemas.SENSOR_DATA)
    return parse.split_rejects(rows, schemas.SENSOR_DATA)[1]


@query
def json_messages(spark, sf_dir):
    return messages(ad.route_history(spark, sf_dir), ("route_id", "bin_id"))


@query
def critical_fields(spark, sf_dir):
    n = F.col("bin_id").cast("long")
    blank = lambda c, k: F.when(n % k == 0, "").when(n % k != 1, F.date_format(c, "yyyy-MM-dd"))
    rows = ad.bins(spark, sf_dir).select(
        "bin_id",
        blank("installation_date", 5).alias("timestamp"),
        blank("installation_date", 3).alias("installation_date"),
        blank("last_maintenance_date", 4).alias("last_maintenance"),
    )
    return parse.fill_critical(rows, A)


# ---------------------------------------------------------------- records


@query
def bin_flatten(spark, sf_dir):
    return records.flatten_bins(ad.raw_bins(spark, sf_dir))


@query
def reading_status(spark, sf_dir):
    return records.with_status(ad.sensor_data_with_gaps(spark, sf_dir)).select("sensor_id", "status")


@query
def reading_weight(spark, sf_dir):
    weighed = records.with_weight(ad.sensor_data(spark, sf_dir), ad.bins(spark, sf_dir))
    return weighed.select("sensor_id", "bin_id", "weight")


@query
def fill_class(spark, sf_dir):
    classed = records.with_fill_class(ad.sensor_data_with_gaps(spark, sf_dir))
    return classed.select("sensor_id", "fill_class")


@query
def readings_to_wide(spark, sf_dir):
    return records.to_wide(records.to_long(ad.sensor_data(spark, sf_dir)))


@query
def route_stops(spark, sf_dir):
    return records.explode_stops(ad.planned_routes(spark, sf_dir))


@query
def null_defaults(spark, sf_dir):
    filled = features.with_defaults(ad.sensor_data_with_gaps(spark, sf_dir))
    return filled.select("sensor_id", "fill_level", "temperature", "humidity", "weight")


# ---------------------------------------------------------------- alarms


@query
def sensor_alarms(spark, sf_dir):
    return alarms.detect(ad.sensor_data(spark, sf_dir)).drop("alarm_id")


@query
def sensor_alarms_from_json(spark, sf_dir):
    rows = _round_trip(ad.sensor_data(spark, sf_dir), schemas.SENSOR_DATA)
    return alarms.detect(rows)


@query
def sensor_alarm_ids(spark, sf_dir):
    return alarms.detect(ad.sensor_data(spark, sf_dir)).select("alarm_id", "bin_id")


@query
def sensor_alarms_stream(spark, sf_dir):
    """The running job end to end: file stream, JSON, alarms, keyed table."""
    folder = shared_dir(spark, "sensor-alarms")
    job = next(j for j in jobs.JOBS if j.name == "sensor_alarms")
    source = messages(ad.as_sensor_data(ad.table_stream(spark, sf_dir, "events")))
    stream = jobs.start(source, job, f"{folder}/tables", f"{folder}/checkpoints", available_now=True)
    stream.awaitTermination()
    return store.current(spark, f"{folder}/tables", schemas.ALARMS)


@query
def job_rows(spark, sf_dir):
    """Rows by table and job that two jobs on the same messages have written, read after they ended."""
    folder = shared_dir(spark, "job-rows")
    root = f"{folder}/tables"
    for name in ("sensor_data", "sensor_alarms"):
        job = next(j for j in jobs.JOBS if j.name == name)
        source = messages(ad.as_sensor_data(ad.table_stream(spark, sf_dir, "events")))
        jobs.start(source, job, root, f"{folder}/checkpoints", available_now=True).awaitTermination()
    wrote = progress.batches(spark, root, schemas.SENSOR_DATA).unionByName(
        progress.batches(spark, root, schemas.ALARMS)
    )
    return wrote.groupBy("table", "source").agg(F.sum("rows").alias("rows"))


@query
def alarm_counts_stream(spark, sf_dir):
    """Alarms of a stream of readings by day, for the days that the watermark has passed."""
    folder = shared_dir(spark, "alarm-counts")
    source = messages(ad.as_sensor_data(ad.table_stream(spark, sf_dir, "events")))
    raised = alarms.detect(parse.read(source, schemas.SENSOR_DATA))
    stream = alerts.start_counts(raised, f"{folder}/tables", f"{folder}/checkpoints", available_now=True)
    stream.awaitTermination()
    counted = spark.read.schema(alerts.counts(raised).schema).parquet(f"{folder}/tables/alarm_counts")
    return counted.select(F.to_date("window_start").alias("date"), "alarm_type", "severity", "alarms")


@query
def alert_outbox_stream(spark, sf_dir):
    """The outbox job on the alarms that the readings' job has written, and written again."""
    folder = shared_dir(spark, "alert-outbox")
    root = f"{folder}/tables"
    store.append(ad.bins(spark, sf_dir), root, schemas.BINS, "bins", 0)
    raised = alarms.detect(ad.sensor_data(spark, sf_dir))
    for run in ("first", "again"):
        store.append(raised, root, schemas.ALARMS, "sensor_alarms", 0, run)
        alerts.start_outbox(spark, root, f"{folder}/checkpoints", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/alert_outbox").select("alarm_id", "bin_id", "subject", "body")


@query
def all_alarms(spark, sf_dir):
    derived = alarms.detect(ad.sensor_data(spark, sf_dir))
    return alarms.all_alarms(ad.alarms(spark, sf_dir), derived)


@query
def alert_outbox(spark, sf_dir):
    return alarms.outbox(ad.alarms(spark, sf_dir), ad.bins(spark, sf_dir))


# ---------------------------------------------------------------- keyed tables


@query
def latest_by_key(spark, sf_dir):
    return tables.latest_by_key(
        ad.sensor_data(spark, sf_dir), ["bin_id"], ["timestamp", "sensor_id"]
    )


@query
def merge_ignore_nulls(spark, sf_dir):
    rows = ad.sensor_data_with_gaps(spark, sf_dir)
    early = rows.filter(F.col("timestamp") < F.lit("2024-01-16").cast("timestamp_ntz"))
    late = rows.filter(F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    order = ["timestamp", "sensor_id"]
    current = tables.fold(early, ["bin_id"], order)
    return tables.merge_by_key(current, late, ["bin_id"], order)


@query
def route_upsert(spark, sf_dir):
    order = ["service_date", "collection_status"]
    return tables.latest_by_key(ad.route_history(spark, sf_dir), ["route_id", "bin_id"], order)


@query
def maintenance_upsert(spark, sf_dir):
    rows = ad.maintenance_events(spark, sf_dir)
    return tables.latest_by_key(rows, ["event_id"], ["event_timestamp", *rows.drop("event_id", "event_timestamp").columns])


# ---------------------------------------------------------------- filtered reads


@query
def bins_filtered(spark, sf_dir):
    return tables.bins(ad.bins(spark, sf_dir), status="active", bin_type="commercial")


@query
def bins_all(spark, sf_dir):
    return tables.bins(ad.bins(spark, sf_dir), status="All", bin_type=None)


@query
def sensor_recent(spark, sf_dir):
    return tables.sensor_data(ad.sensor_data(spark, sf_dir), A, hours_back=24)


@query
def sensor_recent_for_bins(spark, sf_dir):
    wanted = tables.bins(ad.bins(spark, sf_dir), status="offline")
    return tables.sensor_data(ad.sensor_data(spark, sf_dir), A, hours_back=24, bin_ids=wanted)


@query
def sensor_for_chosen_bins(spark, sf_dir):
    return tables.sensor_data(
        ad.sensor_data(spark, sf_dir), A, hours_back=30 * 24, bin_ids=["7", "11"]
    )


@query
def reports_recent(spark, sf_dir):
    return tables.citizen_reports(ad.citizen_reports(spark, sf_dir, A - dt.timedelta(days=7)), A)


@query
def reports_resolved(spark, sf_dir):
    """Resolved reports of a week and open ones of three days."""
    reports = ad.citizen_reports(spark, sf_dir, A - dt.timedelta(days=7))
    recent = F.col("report_timestamp") >= times.time_literal(
        reports, "report_timestamp", A - dt.timedelta(days=3)
    )
    return tables.citizen_reports(reports, A).filter(F.col("resolved") | (~F.col("resolved") & recent))


@query
def maintenance_recent(spark, sf_dir):
    events = ad.maintenance_events(spark, sf_dir, A - dt.timedelta(days=30))
    return tables.maintenance_events(events, A)


@query
def alarms_recent(spark, sf_dir):
    return tables.alarms(ad.alarms(spark, sf_dir), A, severity="high", status="active")


@query
def routes_recent(spark, sf_dir):
    return tables.route_history(ad.route_history(spark, sf_dir, A - dt.timedelta(days=7)), A)


@query
def performance_recent(spark, sf_dir):
    return rounded(tables.performance_analytics(_rollup(spark, sf_dir), A))


@query
def bins_with_readings(spark, sf_dir):
    return tables.bins_with_readings(ad.sensor_data(spark, sf_dir))


@query
def reading_counts(spark, sf_dir):
    return kpis.reading_counts(ad.sensor_data(spark, sf_dir))


@query
def sensor_history_sample(spark, sf_dir):
    return tables.sensor_history(ad.sensor_data(spark, sf_dir), limit=5000)


@query
def sql_parameters(spark, sf_dir):
    text = (
        "SELECT bin_id, type, capacity FROM {bins}"
        " WHERE status = :status AND capacity >= :least AND location_lat > :south"
    )
    args = {"status": "inactive", "least": 120.0, "south": 42.65}
    return tables.query(spark, text, args, bins=ad.bins(spark, sf_dir))


# ---------------------------------------------------------------- figures


@query
def bin_summary(spark, sf_dir):
    return kpis.bin_summary(ad.bins(spark, sf_dir))


@query
def status_distribution(spark, sf_dir):
    return kpis.status_distribution(ad.bins(spark, sf_dir))


@query
def map_points(spark, sf_dir):
    return kpis.map_points(ad.bins(spark, sf_dir))


@query
def map_center(spark, sf_dir):
    return rounded(kpis.map_center(ad.bins(spark, sf_dir)), 6)


@query
def report_resolution(spark, sf_dir):
    return kpis.report_resolution(ad.citizen_reports(spark, sf_dir))


@query
def alarm_severity(spark, sf_dir):
    return kpis.alarm_severity(ad.alarms(spark, sf_dir))


@query
def fill_series(spark, sf_dir):
    return kpis.fill_series(ad.sensor_data(spark, sf_dir))


@query
def bins_emptied_daily(spark, sf_dir):
    return kpis.bins_emptied_daily(ad.maintenance_events(spark, sf_dir))


@query
def daily_rollup(spark, sf_dir):
    return rounded(_rollup(spark, sf_dir))


@query
def daily_rollup_kept(spark, sf_dir):
    """Daily figures out of partials that jobs have added from the tables' logs, in two goes."""
    folder = shared_dir(spark, "daily-rollup")
    root, checkpoints = f"{folder}/tables", f"{folder}/checkpoints"
    sources = (
        (schemas.SENSOR_DATA, ad.sensor_data),
        (schemas.CITIZEN_REPORTS, ad.citizen_reports),
        (schemas.MAINTENANCE_EVENTS, ad.maintenance_events),
        (schemas.ALARMS, ad.alarms),
        (schemas.ROUTE_HISTORY, ad.route_history),
    )
    for batch in (0, 1):
        for table, source in sources:
            half = F.pmod(F.xxhash64(*table.key), F.lit(2)) == batch
            store.append(source(spark, sf_dir).filter(half), root, table, "history", batch)
            rollup.start(spark, root, checkpoints, table, available_now=True).awaitTermination()
    return rounded(rollup.figures(spark, root, ad.bins(spark, sf_dir)))


# ---------------------------------------------------------------- features


@query
def latest_reading(spark, sf_dir):
    return features.latest(_readings(spark, sf_dir))


@query
def calendar_features(spark, sf_dir):
    rows = ad.sensor_data(spark, sf_dir).select("sensor_id", "timestamp")
    return rows.withColumns(features.calendar_columns(F.col("timestamp")))


@query
def fill_rates(spark, sf_dir):
    return rounded(features.fill_rates(_readings(spark, sf_dir), A), 6)


@query
def avg_fill_week(spark, sf_dir):
    return rounded(features.avg_fill(_readings(spark, sf_dir), A), 6)


@query
def temperature_trend(spark, sf_dir):
    return rounded(features.temperature_trend(_readings(spark, sf_dir)), 6)


@query
def days_since_maintenance(spark, sf_dir):
    bins = ad.bins(spark, sf_dir)
    return features.days_since_maintenance(
        bins.select("bin_id"), A, ad.maintenance_events(spark, sf_dir), bins
    )


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.build(
        ad.sensor_data_with_gaps(spark, sf_dir),
        A,
        ad.maintenance_events(spark, sf_dir),
        ad.bins(spark, sf_dir),
    )


@query
def feature_table(spark, sf_dir):
    return rounded(_features(spark, sf_dir), 6)


@query
def feature_table_kept(spark, sf_dir):
    """The same out of moments and last readings that a job has added from the log, in three goes."""
    folder = shared_dir(spark, "recent-features")
    root, checkpoints = f"{folder}/tables", f"{folder}/checkpoints"
    rows = ad.sensor_data_with_gaps(spark, sf_dir)
    rows = rows.filter(F.col("timestamp") <= times.time_literal(rows, "timestamp", A))
    for batch in range(3):
        third = F.pmod(F.xxhash64(*schemas.SENSOR_DATA.key), F.lit(3)) == batch
        store.append(rows.filter(third), root, schemas.SENSOR_DATA, "history", batch)
        recent.start(spark, root, checkpoints, available_now=True).awaitTermination()
    maintenance, bins = ad.maintenance_events(spark, sf_dir), ad.bins(spark, sf_dir)
    return rounded(recent.table(spark, root, A, maintenance, bins), 6)


def _examples(spark: SparkSession, sf_dir: str, mode: str, unit: str = "rows") -> DataFrame:
    return training.examples(
        ad.sensor_data(spark, sf_dir),
        A,
        mode,
        ad.maintenance_events(spark, sf_dir),
        ad.bins(spark, sf_dir),
        horizon_unit=unit,
    )


@query
def training_examples(spark, sf_dir):
    return rounded(_examples(spark, sf_dir, "literal"), 6)


@query
def training_examples_row_clock(spark, sf_dir):
    return rounded(_examples(spark, sf_dir, "row"), 6)


@query
def training_labels_by_hours(spark, sf_dir):
    return training.labels(ad.sensor_data(spark, sf_dir)).drop("timestamp")


@query
def training_profile(spark, sf_dir):
    return rounded(training.profile(_examples(spark, sf_dir, "row")), 3)


@query
def training_split(spark, sf_dir):
    parts = training.split(_examples(spark, sf_dir, "row"))
    return parts.select("bin_id", "sensor_id", "horizon", "is_train")


# ---------------------------------------------------------------- forecasts

_FITS: dict[tuple[str, str], tuple] = {}


def _fitted(spark: SparkSession, sf_dir: str):
    """The forest and its test examples: one fit for all queries of a session over a folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _FITS:
        parts = settled(training.split(_examples(spark, sf_dir, "row")))
        _FITS[key] = training.fit(parts.filter("is_train")), parts.filter(~F.col("is_train"))
    return _FITS[key]


@query
def forecast_inputs(spark, sf_dir):
    return rounded(forecast.horizon_features(_features(spark, sf_dir)), 6)


@query
def forecast_evaluate(spark, sf_dir):
    model, test = _fitted(spark, sf_dir)
    return training.evaluate(model, test)


@query
def feature_importances(spark, sf_dir):
    model, test = _fitted(spark, sf_dir)
    return training.importances(model, test)


@query
def forecast_bins(spark, sf_dir):
    model, _ = _fitted(spark, sf_dir)
    return forecast.predict(model, _features(spark, sf_dir), bins=ad.bins(spark, sf_dir))


@query
def monotone_step(spark, sf_dir):
    """Everything after the forest, on a stand-in for its output."""
    rows = forecast.horizon_features(_features(spark, sf_dir))
    n, h = F.col("bin_id").cast("long"), F.col("horizon")
    rows = rows.withColumns(
        {
            "tree_mean": ((n * 31 + h * 17) % 1200).cast("double") / 10 - 10,
            "confidence": ((n * 7 + h * 5) % 100).cast("double") / 10,
        }
    )
    out = forecast.with_level(forecast.with_band(forecast.monotone(rows)))
    return rounded(
        out.select("bin_id", "horizon", "predicted_fill", "confidence", "lower", "upper", "level"), 2
    )


@query
def fill_levels(spark, sf_dir):
    rows = forecast.with_level(ad.sensor_data_with_gaps(spark, sf_dir), "fill_level")
    return rows.select("sensor_id", "level")


ANOMALY_COLUMNS = tuple(c for c in features.FEATURES if c != "horizon")


@query
def anomaly_flags(spark, sf_dir):
    rows = history.prefix(
        ad.sensor_data(spark, sf_dir),
        A,
        "row",
        maintenance=ad.maintenance_events(spark, sf_dir),
        bins=ad.bins(spark, sf_dir),
    ).select("bin_id", "sensor_id", *ANOMALY_COLUMNS)
    rows = settled(rows)
    forest = anomaly.fit(rows, ANOMALY_COLUMNS, ("bin_id", "sensor_id"))
    return anomaly.flag(rows, forest).select("bin_id", "sensor_id", "score", "is_anomaly")


# ------------------------------------------- what holds for any forest, beside SQL


@query
def forecast_facts(spark, sf_dir):
    """Every bin and horizon: a forecast exactly where there are readings, in range, never falling."""
    now = _features(spark, sf_dir).select("bin_id", F.col("current_fill_level").alias("now"))
    rows = forecast_bins(spark, sf_dir).join(now, "bin_id", "left")
    before = F.lag("predicted_fill").over(Window.partitionBy("bin_id").orderBy("horizon"))
    fill = F.col("predicted_fill")
    return rows.select(
        "bin_id",
        "horizon",
        fill.isNotNull().alias("forecast"),
        (fill.between(0, 100) & (F.col("lower") <= fill) & (fill <= F.col("upper"))).alias("in_range"),
        (fill >= F.coalesce(before, F.least(F.col("now"), F.lit(100.0)))).alias("never_falls"),
    )


@query
def forecast_evaluate_facts(spark, sf_dir):
    errors = forecast_evaluate(spark, sf_dir)
    return errors.select("examples", ((F.col("rmse") >= F.col("mae")) & (F.col("mae") > 0)).alias("errors_fit"))


@query
def feature_importances_facts(spark, sf_dir):
    """The features' names; together their importances are 1."""
    weights = feature_importances(spark, sf_dir)
    total = weights.agg(F.round(F.sum("importance"), 6).alias("total"))
    return weights.select(
        "feature", (F.col("importance") >= 0).alias("counts"), F.lit(total.first()["total"]).alias("total")
    )


@query
def anomaly_facts(spark, sf_dir):
    """All readings are scored, and about the expected share of them is flagged."""
    share = F.avg(F.col("is_anomaly").cast("double"))
    return anomaly_flags(spark, sf_dir).agg(
        F.count("*").alias("readings"),
        F.min(F.col("score").between(0, 1)).alias("scores_fit"),
        share.between(0.05, 0.11).alias("share_fits"),
    )
