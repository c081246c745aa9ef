"""Features kept as mergeable partials beside those of the readings themselves."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fillwatch import schemas
from fillwatch.operators import features, recent
from fillwatch.streaming import recent as kept
from fillwatch.streaming import store

A = dt.datetime(2025, 1, 20, 12, 0)
HOURS = (1, 6, 12, 24, 48, 168)


def made(seed=0, n=600):
    """Readings at the ends of all windows, a microsecond beside them, and anywhere; ties and nulls too."""
    draw = random.Random(seed)
    ends = [A - dt.timedelta(hours=h, microseconds=m) for h in HOURS for m in (-1, 0, 1)] + [A]
    rows = []
    for i in range(n):
        # a third of the readings are of one bin
        name = "hot" if i % 3 == 0 else f"b{draw.randint(0, 5)}"
        at = draw.choice(ends) if draw.random() < 0.3 else A - dt.timedelta(seconds=draw.randint(0, 9 * 86400))
        fill = draw.choice([None, float("nan"), draw.randint(0, 400) / 4])
        rows.append((f"s{i}", name, at, fill, draw.randint(-40, 400) / 4, None, 2.0))
    rows += [("none", "hot", None, 9.0, 9.0, 9.0, 9.0), ("old", "idle", A - dt.timedelta(days=30), 9.0, 9.0, 9.0, 9.0)]
    rows.append(("one", "single", A - dt.timedelta(minutes=1), 50.0, 20.0, 40.0, 1.0))
    return rows


def table(spark, rows):
    df = spark.createDataFrame(
        rows,
        "sensor_id string, bin_id string, timestamp timestamp_ntz, fill_level double, temperature double,"
        " humidity double, weight double",
    )
    stored = schemas.SENSOR_DATA.stored
    return df.select(
        *[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in stored]
    )


def same(got, want):
    names = [name for name in want.columns if name != "bin_id"]
    got, want = ({r.bin_id: [r[n] for n in names] for r in df.collect()} for df in (got, want))
    assert got.keys() == want.keys()
    for name in want:
        assert got[name] == pytest.approx(want[name], rel=1e-7, abs=1e-7), name


def test_partials_of_any_grouping_give_the_features(spark):
    rows = made()
    readings = table(spark, rows)
    want = features.build(readings, A)
    same(recent.build(recent.moments(readings), recent.tails(readings), A), want)
    parts = [table(spark, rows[i::4]) for i in range(4)]
    sums, last = recent.moments(parts[0]), recent.tails(parts[0])
    for part in parts[1:]:
        sums, last = sums.unionByName(recent.moments(part)), last.unionByName(recent.tails(part))
    same(recent.build(sums, last, A), want)
    same(recent.build(recent.merged(sums), recent.tails(last), A), want)
    # another step gives other slots and the same features
    step = dt.timedelta(hours=1)
    same(recent.build(recent.moments(readings, step), recent.tails(readings), A, step=step), want)


def test_clock_is_on_a_step(spark):
    assert recent.on_step(A) == A
    assert recent.on_step(A + dt.timedelta(microseconds=1)) == A + recent.STEP
    empty = table(spark, made()).limit(0)
    with pytest.raises(ValueError):
        recent.build(recent.moments(empty), recent.tails(empty), A + dt.timedelta(seconds=1))
    assert recent.build(recent.moments(empty), recent.tails(empty), A).count() == 0


def test_job_adds_its_own_batch_and_old_slots_expire(spark, tmp_path):
    root, checkpoints = str(tmp_path / "tables"), str(tmp_path / "checkpoints")
    rows = made(1, 300)
    for batch in range(3):
        store.append(table(spark, rows[batch::3]), root, schemas.SENSOR_DATA, "s", batch)
        kept.start(spark, root, checkpoints, available_now=True).awaitTermination()
        upto = table(spark, [r for i, r in enumerate(rows) if i % 3 <= batch])
        same(kept.table(spark, root, A), features.build(upto, A))
    # each batch holds the moments of its own readings only, and no bin more than ten last ones
    counted = {r.batch_id: r.n for r in kept.moments(spark, root).groupBy("batch_id").agg(F.sum("n").alias("n")).collect()}
    assert counted == {b: sum(r[2] is not None for r in rows[b::3]) for b in range(3)}
    most = kept.tails(spark, root).groupBy("batch_id", "bin_id").count().agg(F.max("count")).first()[0]
    assert most == features.TREND_READINGS
    into = str(tmp_path / "merged")
    kept.compact(spark, root, into, A)
    same(kept.table(spark, into, A), features.build(table(spark, rows), A))
    left = kept.moments(spark, into)
    assert left.filter(F.col("slot") < recent.first_slot(A, features.WEEK_HOURS)).isEmpty()
    assert left.groupBy("bin_id", "slot").count().filter("count > 1").isEmpty()
    # a batch that is written again replaces itself
    kept.append(table(spark, rows[:5]), into, 7, "r")
    kept.append(table(spark, rows[:5]), into, 7, "r")
    assert kept.moments(spark, into).filter("batch_id = 7").agg(F.sum("n")).first()[0] == 5
    with pytest.raises(ValueError):
        kept.compact(spark, root, root, A)
