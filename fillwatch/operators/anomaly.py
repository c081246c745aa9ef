"""Isolation forest (Liu, Ting and Zhou, 2008) over feature rows.

Every tree sees a bounded sample, so trees are grown one per group; scoring streams over
all rows against the broadcast trees.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Share of rows flagged and the seed.
CONTAMINATION = 0.1
SEED = 42
TREES, SAMPLE = 100, 256

NODES = "tree int, node int, feature int, threshold double, left int, right int, path double"
EULER = 0.5772156649015329


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + EULER) - 2.0 * (n - 1) / n


@dataclass(frozen=True)
class IsolationForest:
    columns: tuple[str, ...]
    nodes: pd.DataFrame
    sample: int
    threshold: float


def _grow(values: np.ndarray, rng: np.random.Generator, limit: int) -> list[tuple]:
    """Nodes of one tree: split feature, threshold, children, and path length at a leaf."""
    nodes: list[tuple] = []
    stack = [(np.arange(len(values)), 0, -1, False)]
    while stack:
        rows, depth, parent, is_right = stack.pop()
        place = len(nodes)
        if parent >= 0:
            feature, threshold, left, right, path = nodes[parent]
            nodes[parent] = (
                (feature, threshold, left, place, path)
                if is_right
                else (feature, threshold, place, right, path)
            )
        part = values[rows]
        varying = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 else []
        if depth >= limit or len(varying) == 0:
            nodes.append((-1, 0.0, -1, -1, depth + expected_path(len(rows))))
            continue
        feature = int(rng.choice(varying))
        low, high = part[:, feature].min(), part[:, feature].max()
        threshold = float(rng.uniform(low, high))
        goes_left = part[:, feature] <= threshold
        nodes.append((feature, threshold, -1, -1, 0.0))
        stack.append((rows[~goes_left], depth + 1, place, True))
        stack.append((rows[goes_left], depth + 1, place, False))
    return nodes


def _samples(
    rows: DataFrame, columns: Sequence[str], key: Sequence[str], trees: int, sample: int, seed: int
) -> DataFrame:
    """``sample`` rows for each tree, drawn without replacement; every row where there are fewer.

    Each tree draws on its own, whatever the number of rows: the rows with the least hash of tree
    and key. A row is dropped where it is read for all trees whose hash is far from the least;
    about twice what a tree needs gets past that (a tree that gets less than ``sample`` of it
    would be over ten standard deviations off), so the task that orders a tree's rows stays small.
    """
    n = rows.count()
    least, span = -(2**63), 2**64
    cut = min(least + int(min(1.0, 2.0 * sample / max(n, 1)) * span), 2**63 - 1)
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda tree: F.named_struct(
            F.lit("tree"), tree, F.lit("draw"), F.xxhash64(F.lit(seed), tree, *[F.col(k) for k in key])
        ),
    )
    drawn = rows.select(*columns, F.explode(F.filter(draws, lambda d: d["draw"] <= F.lit(cut))).alias("_d"))
    order = Window.partitionBy("tree").orderBy("_draw", *columns)
    return (
        drawn.select(*columns, F.col("_d.tree").alias("tree"), F.col("_d.draw").alias("_draw"))
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= sample)
    )


def fit(
    rows: DataFrame,
    columns: Sequence[str],
    key: Sequence[str],
    contamination: float = CONTAMINATION,
    trees: int = TREES,
    sample: int = SAMPLE,
    seed: int = SEED,
) -> IsolationForest:
    """Grow the trees and find the score above which the given share of rows lies.

    ``key`` tells the rows apart; a hash of it decides which are sampled.

    The trees are at most trees x (2 x sample - 1) rows, whatever the data's size, so
    the driver may hold and broadcast them.
    """
    columns = tuple(columns)
    limit = math.ceil(math.log2(max(sample, 2)))
    typed = rows.select(*key, *[F.col(c).cast("double").alias(c) for c in columns])

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        tree = int(part["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        ordered = part.sort_values("_rank")
        nodes = _grow(ordered[list(columns)].to_numpy(dtype=float), rng, limit)
        out = pd.DataFrame(nodes, columns=["feature", "threshold", "left", "right", "path"])
        out.insert(0, "node", np.arange(len(out), dtype="int32"))
        out.insert(0, "tree", tree)
        out["rows"] = len(part)
        return out

    sampled = _samples(typed, columns, key, trees, sample, seed).drop("_draw")
    nodes = (
        sampled.groupBy("tree").applyInPandas(grow, NODES + ", rows long").orderBy("tree", "node")
    ).toPandas()
    used = int(nodes["rows"].iloc[0]) if len(nodes) else 0
    forest = IsolationForest(columns, nodes.drop(columns="rows"), used, math.nan)
    if not used:
        return forest
    cut = (
        score(typed, forest)
        .agg(F.percentile_approx("score", 1.0 - contamination, 10_000).alias("cut"))
        .first()["cut"]
    )
    return IsolationForest(columns, forest.nodes, used, float(cut))


def score(rows: DataFrame, forest: IsolationForest) -> DataFrame:
    """``rows`` plus ``score``: near 1 is anomalous, well under 0.5 is ordinary."""
    spark: SparkSession = rows.sparkSession
    nodes = forest.nodes
    roots = np.flatnonzero(nodes["node"].to_numpy() == 0)
    start = np.repeat(roots, np.diff(np.append(roots, len(nodes))))
    # Children as places in one flat table; a leaf points to itself.
    here = np.arange(len(nodes))
    leaf = nodes["feature"].to_numpy() < 0
    flat = {
        "feature": np.where(leaf, 0, nodes["feature"].to_numpy()),
        "threshold": nodes["threshold"].to_numpy(),
        "left": np.where(leaf, here, start + nodes["left"].to_numpy()),
        "right": np.where(leaf, here, start + nodes["right"].to_numpy()),
        "path": nodes["path"].to_numpy(),
        "roots": roots,
        "leaf": leaf,
    }
    shared = spark.sparkContext.broadcast(flat)
    norm = expected_path(forest.sample) or 1.0

    @F.pandas_udf("double")
    def isolation(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        t = shared.value
        for batch in batches:
            values = np.column_stack([b.to_numpy(dtype=float) for b in batch])
            total = np.zeros(len(values))
            rows_at = np.arange(len(values))
            for root in t["roots"]:
                at = np.full(len(values), root)
                while not t["leaf"][at].all():
                    goes_left = values[rows_at, t["feature"][at]] <= t["threshold"][at]
                    at = np.where(goes_left, t["left"][at], t["right"][at])
                total += t["path"][at]
            yield pd.Series(2.0 ** (-(total / len(t["roots"])) / norm))

    return rows.withColumn("score", isolation(*[F.col(c).cast("double") for c in forest.columns]))


def flag(rows: DataFrame, forest: IsolationForest) -> DataFrame:
    """``rows`` plus ``score`` and ``is_anomaly``."""
    return score(rows, forest).withColumn("is_anomaly", F.col("score") > F.lit(forest.threshold))
