import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from fillwatch.operators import asof, grower, training
from fillwatch.operators.features import FEATURES
from fillwatch.session import settled


def test_thresholds_part_the_values_alike():
    assert grower.thresholds(np.array([1.0, 6, 12, 24, 1, 6]), 32).tolist() == [3.5, 9.0, 18.0]
    assert grower.thresholds(np.zeros(5), 32).tolist() == []
    values = np.random.default_rng(3).normal(size=40_000)
    cuts = grower.thresholds(values, 32)
    share = np.histogram(values, [-np.inf, *cuts, np.inf])[0] / len(values)
    assert len(cuts) == 31 and np.all(np.abs(share - 1 / 32) < 0.001)
    # a value with much of the weight leaves fewer thresholds, on both sides of it
    cuts = grower.thresholds(np.concatenate([np.zeros(90_000), values]), 32)
    assert len(cuts) < 31 and (cuts < 0).any() and (cuts > 0).any()


def test_draws_are_poisson():
    values, counts = np.unique(grower._DRAWS, return_counts=True)
    assert counts @ values / counts.sum() == pytest.approx(1, abs=1e-3)
    assert counts[0] / counts.sum() == pytest.approx(np.exp(-1), abs=1e-4)
    assert values.max() >= 7


def examples(spark, n=3000):
    """Keys that repeat, a feature without spread and one with two values."""
    noise = {c: F.rand(i) for i, c in enumerate(FEATURES)}
    noise |= {"season": F.lit(1.0), "is_weekend": (F.rand(50) > 0.6).cast("double"), "horizon": F.col("id") % 4}
    rows = spark.range(n).withColumns({c: v.cast("double") for c, v in noise.items()})
    label = 10 * F.col("temperature") + 20 * F.col("is_weekend") + F.rand(60)
    stamp = F.timestamp_seconds(F.col("id") % 700)
    key = {"bin_id": F.lit("b"), "sensor_id": (F.col("id") % 900).cast("string"), "timestamp": stamp, "label": label}
    return settled(rows.withColumns(key).drop("id"))


def test_each_node_has_the_best_split_of_its_draws(spark, monkeypatch):
    """Levels against a plain search over the examples that a tree draws."""
    monkeypatch.setattr(grower, "BLOCK", 256)
    rows = settled(examples(spark, 2000).repartition(3, "sensor_id", "timestamp"))
    values = np.array(rows.select(*FEATURES).toPandas())
    cuts = [grower.thresholds(v, 8) for v in values.T]
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    held = settled(grower.blocks(vectors, cuts))
    low, high = rows.agg(F.min("label"), F.max("label")).first()
    trees, depth, least, drawn, seed = 3, 4, 2, 4, 11
    levels = grower.grow(held, trees, depth, seed, cuts, least, drawn, low, high)
    blocks = [
        (r.part, r.block, np.frombuffer(r.bins, np.uint8).reshape(-1, len(FEATURES)), np.frombuffer(r.labels))
        for r in held.collect()
    ]
    assert sum(len(b[3]) for b in blocks) == 2000 and max(len(b[3]) for b in blocks) <= 256
    known = grower._Levels(trees, seed, len(cuts), drawn, 8, low, high)
    for tree in range(trees):
        bins, labels, draws = [], [], []
        for part, block, b, y in blocks:
            one = grower._Block(part, block, b.ravel(), y)
            at, _, _, often = known.walk(tree, [], one)
            bins.append(b[at].repeat(often, axis=0))
            labels.append(y[at].repeat(often))
        bins, labels = np.concatenate(bins), np.concatenate(labels)
        node = np.zeros(len(labels), int)
        for level in range(depth):
            at = levels[level]
            subsets = grower._subsets(seed, tree, level, 1 << level, len(cuts), drawn)
            for i in range(1 << level):
                mine, b = labels[node == i], bins[node == i]
                assert at["sums"][tree, 0, i] == len(mine)
                assert at["sums"][tree, 1, i] == pytest.approx(mine.sum())
                assert at["sums"][tree, 2, i] == pytest.approx((mine**2).sum())
                falls = {}
                for f in subsets[i].tolist():
                    for cut in range(len(cuts[f])):
                        left, right = mine[b[:, f] <= cut], mine[b[:, f] > cut]
                        if min(len(left), len(right)) >= least:
                            falls[f, cut] = mine.var() - (len(left) * left.var() + len(right) * right.var()) / len(mine)
                assert at["split"][tree, i] == bool(falls)
                if falls:
                    chosen = (int(at["feature"][tree, i]), int(at["bin"][tree, i]))
                    assert falls[chosen] == pytest.approx(max(falls.values()), abs=1e-4)
            bin_ = np.where(at["split"][tree], at["bin"][tree], 255)[node]
            feature = at["feature"][tree][node]
            node = 2 * node + (bins[np.arange(len(node)), feature] > bin_)


def test_beyond_what_sparks_forest_holds_all_trees_grow_together(spark):
    """One forest where there were 100 turns, alike at each run; as good as Spark's, and by the same features."""
    train = examples(spark)
    model = training.fit(train, trees=100, depth=5, pairs=3000, turn_pairs=1 << 30)
    (forest,) = training.forests(model)
    assert forest.getNumTrees == 100 and max(t.depth for t in forest.trees) == 5
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    plain = training.fit(train, trees=100, depth=5)
    error, usual = (training.evaluate(m, train).first().rmse for m in (model, plain))
    assert error == pytest.approx(usual, rel=0.15)
    weight, used = ({r.feature: r.importance for r in training.importances(m, train).collect()} for m in (model, plain))
    assert sum(weight.values()) == pytest.approx(1) and weight["season"] == 0
    assert all(weight[c] == pytest.approx(used[c], abs=0.05) for c in FEATURES)
    again = training.fit(train, trees=100, depth=5, pairs=3000, turn_pairs=1 << 30)
    assert training.forests(again)[0].toDebugString.split("\n")[1:] == forest.toDebugString.split("\n")[1:]


def test_labels_alike_make_leaves_only(spark):
    train = examples(spark, 500).withColumn("label", F.lit(7.25))
    model = training.fit(train, trees=3, depth=4, pairs=500)
    assert [t.numNodes for f in training.forests(model) for t in f.trees] == [1, 1, 1]
    assert training.evaluate(model, train).first().mae == pytest.approx(0)


def test_the_table_of_events_is_made_once(spark):
    """The as-of join makes two tables of events and times by part; the second is to reuse the first's shuffle."""
    stamp = F.timestamp_seconds(F.col("id") * 977).cast("timestamp_ntz")
    rows = settled(spark.range(400).select((F.col("id") % 7).cast("string").alias("k"), stamp.alias("at"), "id"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = asof.attach(rows.withColumnRenamed("id", "n"), rows.withColumnRenamed("at", "then"), "k", "at", "then", ["id"])
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in plan
    assert found.filter(F.col("id") == F.col("n")).count() == 400
