"""A random forest of regression trees grown over blocks of binned examples, all trees level by level.

It follows Spark's own: candidate thresholds by quantiles of each feature, a Poisson draw of the examples
and a random subset of the features for each tree and node, the split with the greatest fall in variance.
What differs is what is held: nothing is kept for an example and tree. A block has one byte a feature
and the label; draws come again from a seed of block and tree, and an example's node is found by walking
the levels known so far. A level is one pass, which sends counts by node, feature and bin. Splits are
chosen by labels as whole steps of 2^-21 of their spread, so that a count and a sum fit one number and add
up exactly; a last pass sums the labels themselves, and means, impurities and gains come from those.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwatch.session import shared_dir

#: Examples in a block, and in a task at most. A task sends 16 bytes for each node, drawn feature and bin,
#: so fewer and larger tasks send less.
BLOCK, TASK_ROWS = 1 << 15, 1 << 21
#: Draws of a block are fewer than 2^16 and a label under ``STEPS``, so their sum is under ``ONE`` and what
#: stands for so many draws and their sum, under 2^53.
STEPS, ONE = 1 << 21, 2.0**37
#: Examples whose values place the candidate thresholds; Spark itself looks at 10,000.
SPLIT_ROWS = 100_000
#: Nodes whose counts are added up together.
CHUNK = 64
#: A fall in variance under this share of the mean's square is rounding.
NOTHING = 2.0**-46

_BLOCKS = "part int, block int, bins binary, labels binary"
_COUNTS = "tree int, chunk int, part int, counts binary"
_FOUND = ["n", "left_n", "gain"]
_SPLITS = "tree int, slot int, feature int, bin int, " + ", ".join(f"{c} double" for c in _FOUND)


def _draw_table() -> np.ndarray:
    """How often an example is drawn, by 16 random bits: Poisson with mean 1."""
    chances = np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)])
    return np.searchsorted(np.cumsum(chances), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


_DRAWS = _draw_table()


def thresholds(values: np.ndarray, bins: int) -> np.ndarray:
    """Up to ``bins - 1`` thresholds between neighbouring distinct values, with about as many on each side."""
    distinct, counts = np.unique(values, return_counts=True)
    middles = (distinct[:-1] + distinct[1:]) / 2
    if len(middles) < bins:
        return middles
    below = np.cumsum(counts)[:-1]
    wanted = np.arange(1, bins) * (len(values) / bins)
    at = np.clip(np.searchsorted(below, wanted), 1, len(below) - 1)
    return middles[np.unique(at - (wanted - below[at - 1] < below[at] - wanted))]


def _columns(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column("values")
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def blocks(scaled: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """Rows of ``BLOCK`` examples in the order given: a byte for each example and feature, and the labels."""
    schema = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("bins", pa.binary()), ("labels", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, held, bins, labels = TaskContext.get().partitionId(), 0, 0, [], []

        def block() -> pa.RecordBatch:
            row = [[part], [made], [np.concatenate(bins).tobytes()], [np.concatenate(labels).tobytes()]]
            return pa.record_batch([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

        for batch in batches:
            values, label = _columns(batch), batch.column("label").to_numpy(zero_copy_only=False)
            binned = np.empty(values.shape, np.uint8)
            for f, cut in enumerate(cuts):
                binned[:, f] = np.searchsorted(cut, values[:, f])
            while held + len(label) >= BLOCK:
                take = BLOCK - held
                bins.append(binned[:take])
                labels.append(label[:take])
                yield block()
                binned, label, made, held, bins, labels = binned[take:], label[take:], made + 1, 0, [], []
            bins.append(binned)
            labels.append(label)
            held += len(label)
        if held:
            yield block()

    return scaled.select(vector_to_array("features").alias("values"), F.col("label").cast("double")).mapInArrow(
        work, _BLOCKS
    )


def _subsets(seed: int, tree: int, level: int, nodes: int, features: int, drawn: int) -> np.ndarray:
    """The features that each node of a level may split on."""
    chance = np.random.default_rng([seed, tree, level, 1]).random((nodes, features))
    return np.argsort(chance, axis=1)[:, :drawn]


class _Block(NamedTuple):
    part: int
    number: int
    bins: np.ndarray
    labels: np.ndarray


class _Levels:
    """What is known of all trees: by level, an array of trees x nodes. A node without a split sends all left."""

    def __init__(self, trees: int, seed: int, features: int, drawn: int, bins: int, low: float, high: float):
        self.trees, self.seed, self.features, self.drawn, self.bins = trees, seed, features, drawn, bins
        self.low, self.step = low, (high - low) / (STEPS - 1)
        self.feature: list[np.ndarray] = []
        self.bin: list[np.ndarray] = []
        self.slot = np.zeros((trees, 1), np.int32)
        """Number of each node of the next level among those that may split, or -1."""

    def subsets(self, tree: int) -> np.ndarray:
        level, slots = len(self.feature), self.slot[tree]
        return _subsets(self.seed, tree, level, len(slots), self.features, self.drawn)[slots >= 0]

    def path(self, tree: int) -> list[tuple[np.ndarray, np.ndarray]]:
        return [(f[tree].astype(np.intp), b[tree]) for f, b in zip(self.feature, self.bin)]

    def walk(self, tree: int, path: list, block: _Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The examples that a tree draws of a block: place, place of their bins, node, how often."""
        size = len(block.labels)
        chance = np.random.default_rng([self.seed, tree, block.part, block.number, 2])
        draws = _DRAWS.take(chance.integers(0, 1 << 64, -(-size // 4), np.uint64).view(np.uint16)[:size])
        rows = np.flatnonzero(draws > 0)
        first = rows * self.features
        node = np.zeros(len(rows), np.intp)
        for feature, bin_ in path:
            at = feature.take(node)
            at += first
            right = block.bins.take(at) > bin_.take(node)
            node += node
            node += right
        return rows, first, node, draws.take(rows)

    def packed(self, block: _Block) -> np.ndarray:
        """``ONE`` and the label in steps."""
        steps = np.floor((block.labels - self.low) / self.step) if self.step else np.zeros(len(block.labels))
        return np.clip(steps, 0, STEPS - 1) + ONE

    def counts(self, tree: int, held: list[_Block], packed: list[np.ndarray]) -> np.ndarray:
        """Draws and sums of labels, by node, drawn feature and bin."""
        path, slots, subsets = self.path(tree), self.slot[tree].astype(np.intp), self.subsets(tree)
        size, some = len(subsets) * self.bins, slots.min() < 0
        columns = [np.ascontiguousarray(c, np.intp) for c in subsets.T]
        total = np.zeros((self.drawn, 2, size))
        for block, ones in zip(held, packed):
            rows, first, node, draws = self.walk(tree, path, block)
            slot = slots.take(node)
            if some:
                alive = np.flatnonzero(slot >= 0)
                slot, rows, first, draws = (x.take(alive) for x in (slot, rows, first, draws))
            each = ones.take(rows) * draws
            start = slot * self.bins
            for k, column in enumerate(columns):
                at = column.take(slot)
                at += first
                sums = np.bincount(block.bins.take(at) + start, each, size)
                n = np.floor(sums * (1 / ONE))
                total[k, 0] += n
                n *= ONE
                sums -= n
                total[k, 1] += sums
        return total.reshape(self.drawn, 2, len(subsets), self.bins).transpose(2, 0, 1, 3)

    def leaves(self, tree: int, held: list[_Block]) -> np.ndarray:
        """Draws and sums of labels and of their squares, by node of the last level."""
        path = self.path(tree)
        total = np.zeros((3, 1 << len(path)))
        for block in held:
            rows, _, node, draws = self.walk(tree, path, block)
            labels = block.labels.take(rows)
            each = draws.astype(np.float64)
            for j in range(3):
                total[j] += np.bincount(node, each, total.shape[1])
                each = each * labels
        return total


def _blocks_of(batches: Iterator[pa.RecordBatch]) -> list[_Block]:
    held = [
        _Block(row["part"], row["block"], np.frombuffer(row["bins"], np.uint8), np.frombuffer(row["labels"]))
        for batch in batches
        for row in batch.to_pylist()
    ]
    return sorted(held, key=lambda block: block[:2])


def _sent(tree: int, part: int, chunks: list[np.ndarray]) -> pa.RecordBatch:
    n = len(chunks)
    columns = [pa.array(x, pa.int32()) for x in ([tree] * n, range(n), [part] * n)]
    counts = pa.array([np.ascontiguousarray(c).tobytes() for c in chunks], pa.binary())
    return pa.record_batch([*columns, counts], names=["tree", "chunk", "part", "counts"])


def _counted(known: _Levels):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _blocks_of(batches)
        packed = [known.packed(block) for block in held]
        for tree in range(known.trees if held else 0):
            if known.slot[tree].max() >= 0:
                counts = known.counts(tree, held, packed)
                yield _sent(tree, TaskContext.get().partitionId(), [counts[i : i + CHUNK] for i in range(0, len(counts), CHUNK)])

    return work


def _summed(known: _Levels):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _blocks_of(batches)
        for tree in range(known.trees if held else 0):
            yield _sent(tree, TaskContext.get().partitionId(), [known.leaves(tree, held)])

    return work


def _total(table: pa.Table) -> tuple[int, int, np.ndarray]:
    table = table.sort_by("part")  # sums come out alike whichever task ends first
    total = sum(np.frombuffer(v.as_buffer()) for v in table.column("counts"))
    return table.column("tree")[0].as_py(), table.column("chunk")[0].as_py(), total


def best(counts: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """The split of each node with the greatest fall in variance; a gain of 0 or less where there is none.

    ``counts`` is nodes x features x (draws, sum) x bins.
    """
    left = np.cumsum(counts, axis=3)
    n, s = left[:, :1, 0, -1:], left[:, :1, 1, -1:]
    ln, ls = left[:, :, 0, :-1], left[:, :, 1, :-1]
    rn, rs = n - ln, s - ls
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ls * ls / ln + rs * rs / rn - s * s / n
        gain = np.where((ln >= least) & (rn >= least) & (gain > NOTHING * s * s / n), gain / n, -np.inf)
    flat = gain.reshape(len(gain), -1)
    top = flat.argmax(axis=1)
    k, b = np.divmod(top, gain.shape[2])
    row = np.arange(len(gain))
    return {"n": n[:, 0, 0], "left_n": ln[row, k, b], "gain": flat[row, top], "drawn": k, "bin": b}


def _chosen(known: _Levels, least: int):
    drawn, bins = known.drawn, known.bins

    def work(table: pa.Table) -> pa.Table:
        tree, chunk, total = _total(table)
        found = best(total.reshape(-1, drawn, 2, bins), least)
        slot = chunk * CHUNK + np.arange(len(found["n"]))
        feature = known.subsets(tree)[slot, found["drawn"]]
        whole = [np.full(len(slot), tree), slot, feature, found["bin"]]
        return pa.table(
            [pa.array(x, pa.int32()) for x in whole] + [pa.array(found[c], pa.float64()) for c in _FOUND],
            names=["tree", "slot", "feature", "bin", *_FOUND],
        )

    return work


def _added(table: pa.Table) -> pa.Table:
    tree, _, total = _total(table)
    return pa.table([pa.array([tree], pa.int32()), pa.array([total.tolist()])], names=["tree", "sums"])


def grow(
    held: DataFrame, trees: int, depth: int, seed: int, cuts: list[np.ndarray], least: int, drawn: int, low: float, high: float
) -> list[dict[str, np.ndarray]]:
    """By level, arrays (trees x nodes) of each node's sums, whether it splits, and its feature and bin."""
    known = _Levels(trees, seed, len(cuts), drawn, 1 + max(len(c) for c in cuts), low, high)
    splits = []
    for level in range(depth):
        if known.slot.max() < 0:
            break
        rows = (
            held.mapInArrow(_counted(known), _COUNTS)
            .groupBy("tree", "chunk")
            .applyInArrow(_chosen(known, least), _SPLITS)
            .toArrow()
        )
        got = {c: rows.column(c).to_numpy() for c in rows.column_names}
        at = np.full((trees, known.slot.max() + 1), -1)
        tree, node = np.nonzero(known.slot >= 0)
        at[tree, known.slot[tree, node]] = node
        nodes, found = 1 << level, got["gain"] > 0
        got = {c: v[found] for c, v in got.items()}
        tree, node = got["tree"], at[got["tree"], got["slot"]]
        feature, bin_ = np.zeros((trees, nodes), np.uint8), np.full((trees, nodes), 255, np.uint8)
        split, below = np.zeros((trees, nodes), bool), np.zeros((trees, nodes, 2))
        split[tree, node], feature[tree, node], bin_[tree, node] = True, got["feature"], got["bin"]
        below[tree, node] = np.stack([got["left_n"], got["n"] - got["left_n"]], axis=1)
        splits.append(split)
        known.feature.append(feature)
        known.bin.append(bin_)
        may = below.reshape(trees, 2 * nodes) >= 2 * least
        known.slot = np.where(may, np.cumsum(may, axis=1) - 1, -1).astype(np.int32)
    rows = held.mapInArrow(_summed(known), _COUNTS).groupBy("tree").applyInArrow(_added, "tree int, sums array<double>")
    sums = np.zeros((trees, 3, 1 << len(splits)))
    for row in rows.toArrow().to_pylist():
        sums[row["tree"]] = np.reshape(row["sums"], sums.shape[1:])
    levels = [{"sums": sums, "split": np.zeros(sums[:, 0].shape, bool), "feature": None, "bin": None}]
    for split, feature, bin_ in reversed([*zip(splits, known.feature, known.bin)]):
        sums = sums[:, :, 0::2] + sums[:, :, 1::2]
        levels.append({"sums": sums, "split": split, "feature": feature, "bin": bin_})
    return levels[::-1]


def _nodes(levels: list[dict[str, np.ndarray]], cuts: list[np.ndarray]) -> pa.Table:
    """The trees in the rows that Spark saves a forest in: nodes numbered from the root, left before right."""
    rows: dict[str, list] = {c: [] for c in ("tree", "id", "n", "s", "ss", "left", "right", "feature", "cut")}
    for tree in range(len(levels[0]["split"])):
        count, todo, start = 0, [(0, 0, -1)], len(rows["id"])
        while todo:
            level, node, parent = todo.pop()
            at = levels[level]
            split = at["split"][tree, node]
            if parent >= 0:
                rows["right"][start + parent] = count
            for c, v in zip(("n", "s", "ss"), at["sums"][tree, :, node].tolist()):
                rows[c].append(v)
            feature = int(at["feature"][tree, node]) if split else -1
            rows["tree"].append(tree)
            rows["id"].append(count)
            rows["left"].append(count + 1 if split else -1)
            rows["right"].append(-1)
            rows["feature"].append(feature)
            rows["cut"].append([float(cuts[feature][at["bin"][tree, node]])] if split else [])
            if split:
                todo += [(level + 1, 2 * node + 1, count), (level + 1, 2 * node, -1)]
            count += 1
    n, s, ss = (np.array(rows[c]) for c in ("n", "s", "ss"))
    impurity = np.maximum((ss - s * s / n) / n, 0.0)
    left, right = np.array(rows["left"]), np.array(rows["right"])
    left, right = (x + np.arange(len(n)) - np.array(rows["id"]) for x in (left, right))
    kept = np.array(rows["feature"]) < 0
    left[kept] = right[kept] = 0
    fall = impurity - (n[left] * impurity[left] + n[right] * impurity[right]) / n
    stats = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * 3, pa.int32()), np.stack([n, s, ss], 1).ravel())
    whole = lambda c: pa.array(rows[c], pa.int32())
    split = pa.StructArray.from_arrays(
        [whole("feature"), pa.array(rows["cut"], pa.list_(pa.float64())), pa.array([-1] * len(n), pa.int32())],
        ["featureIndex", "leftCategoriesOrThreshold", "numCategories"],
    )
    data = {
        "id": whole("id"),
        "prediction": pa.array(s / n),
        "impurity": pa.array(impurity),
        "impurityStats": stats,
        "rawCount": pa.array(n.astype(np.int64)),
        "gain": pa.array(np.where(kept, -1.0, np.maximum(fall, 0.0))),
        "leftChild": whole("left"),
        "rightChild": whole("right"),
        "split": split,
    }
    return pa.table({"treeID": whole("tree"), "nodeData": pa.StructArray.from_arrays([*data.values()], [*data])})


def fit(
    held: DataFrame,
    few: DataFrame,
    forest: RandomForestRegressor,
    cuts: list[np.ndarray],
    low: float,
    high: float,
) -> RandomForestRegressionModel:
    """``forest`` fitted on the ``blocks`` in ``held``, with labels from ``low`` to ``high``.

    ``few`` rows give the saved model its form.
    """
    trees, depth, least = forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode()
    drawn = int(np.ceil(np.sqrt(len(cuts))))
    levels = grow(held, trees, depth, forest.getSeed(), cuts, least, drawn, low, high)
    spark, path = held.sparkSession, shared_dir(held.sparkSession, "grown")
    forest.fit(few).write().save(path)
    schema = spark.read.parquet(f"{path}/data").schema
    spark.createDataFrame(_nodes(levels, cuts), schema).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestRegressionModel.load(path)
