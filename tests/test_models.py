import math

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from fillwatch.operators import anomaly, forecast, training
from fillwatch.operators.features import FEATURES
from fillwatch.plans import queries
from fillwatch.session import settled
from fillwatch.sources import adapters as ad

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fitted(spark):
    parts = settled(training.split(queries._examples(spark, SF, "row")))
    return training.fit(parts.filter("is_train"), trees=12, depth=6), parts.filter("NOT is_train")


@pytest.fixture(scope="module")
def served(spark):
    return settled(queries._features(spark, SF))


def test_spread_equals_the_trees_one_by_one(spark, fitted, served):
    model, _ = fitted
    scored = model.transform(forecast.horizon_features(served))
    rows = forecast.tree_spread(scored, forecast.leaf_values(spark, model)).limit(40).collect()
    trees = model.stages[-1].trees
    for r in rows:
        each = np.array([t.predict(Vectors.dense(r.features)) for t in trees])
        assert r.tree_mean == pytest.approx(each.mean())
        assert r.tree_mean == pytest.approx(r.prediction)
        half = (np.percentile(each, 90) - np.percentile(each, 10)) / 2
        assert r.tree_half_spread == pytest.approx(half)


def test_forecast_properties(spark, fitted, served):
    model, _ = fitted
    bins = ad.bins(spark, SF)
    got = forecast.predict(model, served, bins=bins).collect()
    assert len(got) == 4 * bins.count()
    current = {r.bin_id: r.current_fill_level for r in served.collect()}
    by_bin = {}
    for r in got:
        by_bin.setdefault(r.bin_id, []).append(r)
    for bin_id, rows in by_bin.items():
        rows.sort(key=lambda r: r.horizon)
        assert [r.horizon for r in rows] == [1, 6, 12, 24]
        fills = [r.predicted_fill for r in rows]
        if bin_id not in current:
            assert fills == [None] * 4 and {r.confidence for r in rows} == {None}
            continue
        assert fills == sorted(fills) and fills[0] >= round(current[bin_id], 2) - 0.005
        for r in rows:
            assert 0 <= r.predicted_fill <= 100 and r.confidence >= 0
            assert r.upper - r.lower == pytest.approx(2 * r.confidence)


def test_forecasts_repeat_unless_shaken(spark, fitted, served):
    inputs = forecast.horizon_features(served)
    assert inputs.collect() == forecast.horizon_features(served).collect()
    shaken = forecast.horizon_features(served, noise=1.0)
    diff = shaken.join(inputs.withColumnRenamed("temperature", "t"), ["bin_id", "horizon"])
    moved = diff.agg(F.stddev(F.col("temperature") - F.col("t"))).first()[0]
    assert 0.3 < moved < 0.7
    assert shaken.filter("humidity < 0 OR humidity > 100").count() == 0


def test_trees_grown_in_turns_are_one_forest(spark, fitted, served):
    """With room for a third of the trees at once, all of them count, in one order everywhere."""
    _, test = fitted
    train = settled(training.split(queries._examples(spark, SF, "row"))).filter("is_train")
    model = training.fit(train, trees=5, depth=4, pairs=2 * train.count())
    grown = training.forests(model)
    assert [f.getNumTrees for f in grown] == [1, 2, 2]
    trees = [t for f in grown for t in f.trees]
    values = forecast.leaf_values(spark, model).first()["leaf_values"]
    assert len(values) == 5
    rows = model.transform(test).limit(50).collect()
    for row in rows:
        each = [t.predict(row["features"]) for t in trees]
        assert row["prediction"] == pytest.approx(sum(each) / 5)
        assert [v[int(leaf)] for v, leaf in zip(values, row["leaves"])] == pytest.approx(each)
    weights = [r.importance for r in training.importances(model, test).collect()]
    assert weights == pytest.approx(np.mean([t.featureImportances.toArray() for t in trees], axis=0), abs=1e-9)
    assert training.evaluate(model, test).first().mae < 40
    assert forecast.predict(model, served).filter("predicted_fill IS NULL").isEmpty()
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_errors_and_importances(spark, fitted):
    model, test = fitted
    got = training.evaluate(model, test).first()
    pairs = [(r.prediction, r.label) for r in model.transform(test).collect()]
    errors = np.array([p - y for p, y in pairs])
    assert got.examples == len(pairs)
    assert got.mae == pytest.approx(np.abs(errors).mean())
    assert got.rmse == pytest.approx(math.sqrt((errors**2).mean()))
    weights = training.importances(model, test).collect()
    assert [r.feature for r in weights] == list(FEATURES)
    assert sum(r.importance for r in weights) == pytest.approx(1.0)


def points(spark, n=600):
    return spark.range(n).select(
        F.col("id").cast("string").alias("k"),
        F.randn(1).alias("a"),
        F.randn(2).alias("b"),
    ).union(spark.createDataFrame([("far", 9.0, -9.0)], "k string, a double, b double"))


def test_scores_follow_the_trees(spark):
    df = settled(points(spark))
    forest = anomaly.fit(df, ("a", "b"), ("k",), trees=25, sample=64)
    assert forest.sample == 64
    nodes = {(r.tree, r.node): r for r in forest.nodes.itertuples()}
    got = anomaly.flag(df, forest).collect()
    for r in got[::40] + got[-1:]:
        lengths = []
        for tree in range(25):
            node = nodes[tree, 0]
            while node.feature >= 0:
                goes_left = (r.a, r.b)[node.feature] <= node.threshold
                node = nodes[tree, node.left if goes_left else node.right]
            lengths.append(node.path)
        assert r.score == pytest.approx(2 ** (-np.mean(lengths) / anomaly.expected_path(64)))
    assert max(got, key=lambda r: r.score).k == "far"
    assert 0.07 < sum(r.is_anomaly for r in got) / len(got) < 0.13


def test_trees_are_bounded_and_repeatable(spark):
    df = settled(points(spark))
    forest = anomaly.fit(df, ("a", "b"), ("k",), trees=10, sample=32)
    again = anomaly.fit(df.repartition(7), ("a", "b"), ("k",), trees=10, sample=32)
    assert forest.nodes.equals(again.nodes) and forest.threshold == again.threshold
    assert forest.nodes.groupby("tree").size().max() <= 2 * 32 - 1


def test_trees_draw_alike_at_every_size(spark):
    df = settled(points(spark))
    n = df.count()
    few = anomaly._samples(df, ("a", "b"), ("k",), 5, 64, 7).collect()
    many = anomaly._samples(df, ("a", "b"), ("k",), 50, 64, 7).collect()
    assert 5 * 64 < n < 50 * 64
    for trees, drawn in ((5, few), (50, many)):
        assert {len({(r.a, r.b) for r in drawn if r.tree == t}) for t in range(trees)} == {64}
    # a tree draws the same rows however many others there are
    assert {(r.a, r.b) for r in few if r.tree == 3} == {(r.a, r.b) for r in many if r.tree == 3}


def test_fewer_rows_than_the_sample(spark):
    df = points(spark, 20)
    forest = anomaly.fit(df, ("a", "b"), ("k",), trees=5, sample=256)
    assert forest.sample == 21
    assert anomaly.flag(df, forest).count() == 21


def test_expected_path():
    assert [anomaly.expected_path(n) for n in (0, 1, 2)] == [0.0, 0.0, 1.0]
    assert anomaly.expected_path(256) == pytest.approx(10.2448, abs=1e-3)


def test_nothing_to_learn_from(spark, small):
    from fillwatch.operators import forecast
    from fillwatch.sources import adapters as ad

    none = spark.createDataFrame([], ", ".join(f"{c} double" for c in training.FEATURES) + ", label double")
    model = training.fit(none)
    assert model is None
    bins = ad.bins(spark, small)
    rows = forecast.predict(model, bins.select("bin_id"), bins=bins).collect()
    assert len(rows) == bins.count() * len(forecast.HORIZONS)
    assert all(r.predicted_fill is None and r.lower is None for r in rows)
    assert training.evaluate(model, none).first().examples == 0
    assert {r.importance for r in training.importances(model, none).collect()} == {None}
