import datetime as dt

import pytest
from pyspark.errors import AnalysisException

from fillwatch import schemas
from fillwatch.operators import kpis, records, tables
from fillwatch.sources import adapters as ad

AS_OF = dt.datetime(2025, 1, 10)


def test_empty_tables_have_the_declared_schema(spark, tmp_path):
    tables.create_empty(spark, str(tmp_path))
    for name, table in schemas.TABLES.items():
        df = tables.load(spark, str(tmp_path), name)
        assert df.schema == table.stored and df.count() == 0


def test_latest_by_key_and_null_merge(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    new = spark.createDataFrame(
        [("a", None, "z", 1), ("c", 5, None, 1), ("c", None, "w", 2)],
        "k string, n int, s string, t int",
    )
    kept = tables.merge_by_key(old, new, ["k"], ["t"])
    assert {tuple(r) for r in kept.collect()} == {("a", 1, "z"), ("b", 2, "y"), ("c", 5, "w")}
    plain = tables.merge_by_key(old, new, ["k"], ["t"], ignore_nulls=False)
    assert {tuple(r) for r in plain.collect()} == {("a", None, "z"), ("b", 2, "y"), ("c", None, "w")}


def test_no_filter_words(spark, small):
    bins = ad.bins(spark, small)
    for value in (None, "", "All"):
        assert tables.bins(bins, value, value).count() == bins.count()
    alarms = ad.alarms(spark, small)
    every = tables.alarms(alarms, ad.AS_OF, 30).count()
    assert tables.alarms(alarms, ad.AS_OF, 30, "", None).count() == every
    assert tables.alarms(alarms, ad.AS_OF, 30, "All").count() == 0


def test_cutoff_is_inclusive_and_open_above(spark):
    rows = [(AS_OF - dt.timedelta(days=7),), (AS_OF - dt.timedelta(days=7, seconds=1),), (AS_OF + dt.timedelta(days=9),)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"event_timestamp {kind}")
        assert tables.maintenance_events(df, AS_OF, 7).count() == 2


def test_null_flag_matches_neither(spark):
    rows = [(AS_OF, True), (AS_OF, False), (AS_OF, None)]
    df = spark.createDataFrame(rows, "report_timestamp timestamp, resolved boolean")
    assert tables.citizen_reports(df, AS_OF).count() == 3
    assert tables.citizen_reports(df, AS_OF, resolved=True).count() == 1
    assert tables.citizen_reports(df, AS_OF, resolved=False).count() == 1
    got = kpis.report_resolution(df).first()
    assert (got.resolved_reports, got.unresolved_reports) == (1, 2)


def test_ids_as_list_or_table(spark, small):
    readings = ad.sensor_data(spark, small)
    ids = ["1", "3", "3"]
    listed = tables.sensor_data(readings, ad.AS_OF, 9999, ids)
    joined = tables.sensor_data(
        readings, ad.AS_OF, 9999, spark.createDataFrame([(i,) for i in ids], "bin_id string")
    )
    assert listed.count() == joined.count() == readings.filter("bin_id IN ('1', '3')").count()


def test_query_errors_are_raised(spark, small):
    bins = ad.bins(spark, small)
    got = tables.query(spark, "SELECT * FROM {b} WHERE status = :s", {"s": "active"}, b=bins)
    assert got.count() == bins.filter("status = 'active'").count()
    with pytest.raises(AnalysisException):
        tables.query(spark, "SELECT nothing FROM {b}", b=bins)


def test_limit_takes_the_same_rows(spark, small):
    readings = ad.sensor_data(spark, small)
    one = tables.sensor_history(readings, 50).collect()
    first = readings.orderBy("timestamp", "sensor_id").limit(50).collect()
    assert [r.sensor_id for r in one] == [r.sensor_id for r in first]
    assert tables.sensor_history(readings, 10**6).count() == readings.count()
    assert one == tables.sensor_history(readings.repartition(5), 50).collect()


def test_wide_and_long(spark, small):
    readings = ad.sensor_data(spark, small).select("bin_id", "timestamp", *records.MEASURES)
    back = records.to_wide(records.to_long(readings)).select(readings.columns)
    assert sorted(back.collect()) == sorted(readings.collect())


class _Session:
    """As much of a session as the shared folder asks for."""

    def __init__(self, master, root=None):
        self.sparkContext = type("Context", (), {"master": master})()
        self.conf = {"spark.checkpoint.dir": root} if root else {}


def test_a_cluster_without_a_shared_folder_is_refused():
    import pytest

    from fillwatch.session import shared_dir

    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(_Session(master), "x")
        assert shared_dir(_Session(master, "s3://b/c/"), "x").startswith("s3://b/c/fillwatch/x-")
    for master in ("local", "local[8]", "local[*]"):
        session = _Session(master)
        shared_dir(session, "x")
        assert session.conf == {}


def test_copies_are_removed_on_release(spark, tmp_path, monkeypatch):
    from fillwatch import session

    monkeypatch.setattr(session, "shared_root", lambda s: str(tmp_path))
    monkeypatch.setattr(session, "_COPIES", set())
    assert session.settled(spark.range(5)).count() == 5
    assert session.settled(spark.range(7), "other").count() == 7
    assert len(list((tmp_path / "fillwatch").iterdir())) == 2
    session.release(spark)
    assert list((tmp_path / "fillwatch").iterdir()) == []
