"""Features against a plain re-computation, with one bin holding most readings."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fillwatch.operators import asof, features, history, training
from fillwatch.sources import adapters as ad

AS_OF = dt.datetime(2024, 1, 10, 5, 30)
COLUMNS = (
    "sensor_id string, bin_id string, timestamp timestamp_ntz, fill_level double,"
    " temperature double, weight double, humidity double"
)


def series(seed=1):
    """A hot bin read every few minutes, a sparse one, one with ties, and short ones."""
    rng = random.Random(seed)
    rows = []
    sizes = {"hot": 700, "sparse": 130, "ties": 90, "short": 12, "one": 1}
    steps = {"hot": 9, "sparse": 110, "ties": 60, "short": 300, "one": 1}
    for bin_id, n in sizes.items():
        at = AS_OF - dt.timedelta(minutes=n * steps[bin_id] * 0.55)
        for i in range(n):
            if not (bin_id == "ties" and i % 3):
                at += dt.timedelta(minutes=rng.uniform(0.2, 1) * steps[bin_id])
            fill = None if rng.random() < 0.05 else rng.uniform(0, 100)
            rows.append(
                (f"{bin_id}{i:04d}", bin_id, at, fill, rng.uniform(10, 80), rng.uniform(0, 99), 50.0)
            )
    rng.shuffle(rows)
    return rows


def slope(points, default=None):
    if len(points) < 2 or len({x for x, _ in points}) == 1:
        return default
    x, y = np.array(points, dtype=float).T
    x = x - x.mean()
    return float((x * (y - y.mean())).sum() / (x * x).sum())


def expected(prefix, clock, upto_ties):
    """Rates, weekly mean and trend of one reading by definition."""
    hours = lambda t: (t - clock).total_seconds() / 3600
    fill = lambda r: r[3] or 0.0
    out = {}
    inside = lambda h: [(hours(r[2]), fill(r)) for r in upto_ties if hours(r[2]) >= -h]
    for h in (1, 6, 24):
        narrow = inside(h)
        rate = slope(narrow, 0.0) if len(narrow) >= 3 else slope(inside(48), 0.0)
        out[f"fill_rate_{h}h"] = max(-1.0, min(5.0, rate))
    week = inside(168)
    out["avg_fill_last_week"] = sum(y for _, y in week) / len(week) if week else 0.0
    last = prefix[-10:]
    out["temperature_trend"] = slope([(i, r[4]) for i, r in enumerate(last)]) if len(last) >= 5 else 0.0
    return out


def by_bin(rows):
    bins = {}
    for r in sorted(rows, key=lambda r: (r[2], r[0])):
        bins.setdefault(r[1], []).append(r)
    return bins


@pytest.mark.parametrize("mode", ["literal", "row"])
@pytest.mark.parametrize("block_rows, parts", [(1, 60), (8192, 1), (8192, 7)])
def test_prefix_features(spark, mode, block_rows, parts):
    rows = series()
    df = spark.createDataFrame(rows, COLUMNS)
    got = {
        r.sensor_id: r
        for r in history.prefix(
            df, AS_OF, mode, ahead=(1, 24), block_rows=block_rows, parts=parts
        ).collect()
    }
    assert len(got) == len(rows)
    for bin_rows in by_bin(rows).values():
        for i, r in enumerate(bin_rows):
            mine = got[r[0]]
            prefix = bin_rows[: i + 1]
            if mode == "row":
                known = [x for x in bin_rows if x[2] <= r[2]]
                want = expected(prefix, r[2], known)
            else:
                want = expected(prefix, AS_OF, prefix)
            for name, value in want.items():
                assert mine[name] == pytest.approx(value, abs=1e-6), (r[0], name)
            assert (mine.position, mine.total) == (i, len(bin_rows))
            for h in (1, 24):
                later = bin_rows[i + h] if i + h < len(bin_rows) else None
                assert mine[f"fill_after_{h}"] == ((later[3] or 0.0) if later else None)
            clock = r[2] if mode == "row" else AS_OF
            assert mine.hour_of_day == clock.hour and mine.day_of_week == clock.weekday()


def dense(spark, n=20000):
    """Nine tenths of the readings in one bin and hour, the others over bins and days."""
    rows = spark.range(n).selectExpr(
        "CAST(id AS STRING) AS sensor_id",
        "IF(id % 10 < 9, 'hot', CONCAT('bin', id % 7)) AS bin_id",
        "CAST(timestamp_micros(CAST(1704067200000000 AS BIGINT) + IF(id % 10 < 9,"
        " pmod(xxhash64(id), 3600000000L), pmod(xxhash64(id, 1), 10 * 86400000000L)))"
        " AS TIMESTAMP_NTZ) AS timestamp",
        "CAST(pmod(xxhash64(id, 2), 100) AS DOUBLE) AS fill_level",
        "CAST(pmod(xxhash64(id, 3), 60) AS DOUBLE) AS temperature",
        "1D AS weight",
        "50D AS humidity",
    )
    return rows


@pytest.mark.parametrize("mode", ["literal", "row"])
def test_a_dense_hour_is_shared_among_tasks(spark, mode):
    rows = dense(spark)
    got = history.prefix(rows, AS_OF, mode, ahead=(1,))
    whole = history.prefix(rows, AS_OF, mode, ahead=(1,), parts=1)
    assert got.columns == whole.columns
    assert got.count() == rows.count()
    left, right = ({r.sensor_id: r for r in df.collect()} for df in (got, whole))
    for key, r in left.items():
        assert all(a == pytest.approx(b, abs=1e-6) for a, b in zip(r, right[key]) if isinstance(a, float))
        assert (r.position, r.total) == (right[key].position, right[key].total)
    # windows over readings are cut by part; those by bin or slot alone see a row for each part
    text = got._jdf.queryExecution().executedPlan().toString()
    ranked = [line for line in text.splitlines() if "row_number()" in line and "Window" in line]
    assert ranked and all("part#" in line.split("windowspecdefinition", 1)[1] for line in ranked)
    sizes = history._slotted(features.with_defaults(rows), history.PARTS).groupBy(*history._PART).count()
    assert sizes.agg(F.max("count")).first()[0] < 3 * rows.count() * 0.9 / history.PARTS


def test_serving_features_equal_the_last_prefix(spark):
    """At ``as_of`` the newest reading's literal prefix is the whole known history."""
    rows = [r for r in series(2) if r[2] <= AS_OF]
    df = spark.createDataFrame(rows, COLUMNS)
    served = {r.bin_id: r for r in features.build(df, AS_OF).collect()}
    for bin_id, bin_rows in by_bin(rows).items():
        want = expected(bin_rows, AS_OF, bin_rows)
        want["current_fill_level"] = bin_rows[-1][3] or 0.0
        for name, value in want.items():
            assert served[bin_id][name] == pytest.approx(value, abs=1e-6), (bin_id, name)


def test_future_readings_count_only_without_the_bound(spark):
    rows = [
        ("a", "b", AS_OF - dt.timedelta(hours=2), 10.0, 20.0, 0.0, 50.0),
        ("c", "b", AS_OF + dt.timedelta(hours=2), 14.0, 20.0, 0.0, 50.0),
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    assert features.build(df, AS_OF).first().current_fill_level == 10.0
    free = features.build(df, AS_OF, upper_bound=False).first()
    assert free.current_fill_level == 14.0
    assert free.fill_rate_6h == pytest.approx(1.0)


@pytest.mark.parametrize(
    "points, rate",
    [
        ([(-3, 10), (-2, 12), (-1, 14)], 2.0),
        ([(-3, 10), (-2, 90), (-1, 99)], 5.0),
        ([(-3, 90), (-2, 10), (-1, 0)], -1.0),
        ([(-40, 10), (-1, 49)], 1.0),
        ([(-1, 10)], 0.0),
        ([(-1, 10), (-1, 20), (-1, 30)], 0.0),
        ([(-100, 10), (-90, 20), (-80, 30)], 0.0),
    ],
)
def test_six_hour_rate(spark, points, rate):
    rows = [
        (str(i), "b", AS_OF + dt.timedelta(hours=h), float(f), 20.0, 0.0, 50.0)
        for i, (h, f) in enumerate(points)
    ]
    df = spark.createDataFrame(rows, COLUMNS)
    assert features.fill_rates(df, AS_OF).first().fill_rate_6h == pytest.approx(rate)


def test_examples_by_rows_and_by_hours(spark):
    rows = series(3)
    df = spark.createDataFrame(rows, COLUMNS)
    bins = by_bin(rows)
    got = training.examples(df, AS_OF, "row").collect()
    assert len(got) == sum(4 * (len(b) - 48) for b in bins.values() if len(b) >= 50)
    got = training.examples(df, AS_OF, "row", horizon_unit="hours").collect()
    want = {}
    for bin_rows in bins.values():
        if len(bin_rows) < 50:
            continue
        for r in bin_rows[24:]:
            for h in (1, 6, 12, 24):
                due = [x for x in bin_rows if x[2] >= r[2] + dt.timedelta(hours=h)]
                if due:
                    first = due[0][2]
                    want[r[0], h] = min(x[3] or 0.0 for x in due if x[2] == first)
    assert {(r.sensor_id, r.horizon): r.label for r in got} == want


@pytest.mark.parametrize("slot_hours, parts", [(24, 60), (24, 1), (1, 7)])
@pytest.mark.parametrize("direction", ["backward", "forward"])
def test_asof(spark, direction, slot_hours, parts):
    rng = random.Random(5)
    moment = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(24 * 30))
    probes = [(f"p{i}", rng.choice("aab"), moment()) for i in range(200)]
    probes.append(("none", "a", None))
    events = [(rng.choice("aaac"), moment(), i) for i in range(60)]
    got = asof.attach(
        spark.createDataFrame(probes, "id string, k string, t timestamp_ntz"),
        spark.createDataFrame(events, "k string, at timestamp_ntz, v int"),
        "k", "t", "at", ["v"], direction, slot_hours, parts=parts,
    )
    assert got.count() == len(probes)
    for r in got.collect():
        if r.t is None:
            assert r.v is None
            continue
        if direction == "backward":
            near = [(t, v) for k, t, v in events if k == r.k and t <= r.t]
            want = max(near)[1] if near else None
        else:
            near = [(t, v) for k, t, v in events if k == r.k and t >= r.t]
            want = min(near)[1] if near else None
        assert r.v == want


def test_days_since_maintenance_prefers_events(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "bin_id string")
    events = spark.createDataFrame(
        [("a", AS_OF - dt.timedelta(days=3)), ("a", AS_OF + dt.timedelta(days=3))],
        "bin_id string, event_timestamp timestamp_ntz",
    )
    bins = spark.createDataFrame(
        [("a", AS_OF - dt.timedelta(days=9)), ("b", AS_OF - dt.timedelta(days=9))],
        "bin_id string, last_maintenance_date timestamp_ntz",
    )
    got = features.days_since_maintenance(ids, AS_OF, events, bins).collect()
    assert {r.bin_id: r.days_since_maintenance for r in got} == {"a": 3, "b": 9, "c": -1}


def test_split_holds_under_repartitioning(spark):
    df = spark.range(5000).selectExpr(
        "CAST(id % 7 AS STRING) AS bin_id", "CAST(id AS STRING) AS sensor_id", "1 AS horizon"
    )
    one = {r.sensor_id: r.is_train for r in training.split(df).collect()}
    two = {r.sensor_id: r.is_train for r in training.split(df.repartition(7)).collect()}
    assert one == two
    assert 0.77 < sum(one.values()) / len(one) < 0.83


def test_labels_are_those_of_the_examples(spark, small):
    readings = ad.sensor_data(spark, small)
    key = ["bin_id", "sensor_id", "timestamp", "horizon", "label"]
    few = {"min_readings": 10, "warmup": 3}
    want = training.examples(readings, ad.AS_OF, "literal", horizon_unit="hours", **few).select(key)
    got = training.labels(readings, **few)
    assert got.columns == key and got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0
