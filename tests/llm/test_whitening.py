"""Whitening beside exact integer covariances and a dense eigensolver."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fillwatch.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n int, v string, k long, width int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in rows], SCHEMA).repartition(3)


def kept(rows):
    good = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = max((len(v) for _, v in good), default=0)
    x = [[math.floor(64 * float(np.float32(c))) + 1000000 for c in [*v, *[0.0] * (d - len(v))]] for _, v in good]
    return [i for i, _ in good], x


def check(got, rows, most=32):
    """Everything that does not hang on signs and on the basis of equal eigenvalues."""
    ids, x = kept(rows)
    n, d = len(x), len(x[0])
    sums = [sum(c) for c in zip(*x)]
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1], vector[:, ::-1]
    k = min(most, int((value > 1e-12 * value[0]).sum()))
    table = {}
    for r in got:
        table.setdefault(r.vec_id, []).append(r)
    assert len(got) == n * k and set(table) == set(ids)
    exact = {i: sum((n * a - s) ** 2 for a, s in zip(row, sums)) for i, row in zip(ids, x)}
    exact = {i: e if e < 1 << 63 else None for i, e in exact.items()}
    w = np.zeros((n, k))
    for row, i in enumerate(ids):
        own = sorted(table[i], key=lambda r: r.component)
        assert [r.component for r in own] == list(range(1, k + 1))
        assert {(r.n, r.deviation) for r in own} == {(n, exact[i])}
        assert np.allclose([r.explained for r in own], value[:k] / value.sum(), rtol=1e-9)
        w[row] = [r.whitened for r in own]
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9
    assert got[0].identity_error < 1e-9 and len({r.identity_error for r in got}) == 1
    # the components, from the whitened rows: unit vectors that belong to their eigenvalue
    unit = np.linalg.lstsq(centred, w * np.sqrt(value[:k]), rcond=1e-12)[0]
    assert np.allclose(np.linalg.norm(unit, axis=0), 1, atol=1e-9)
    assert np.abs(centred.T @ (centred @ unit) / n - unit * value[:k]).max() < 1e-10 * value[0]
    alone = [j for j in range(k) if min(abs(value[j] - o) for i, o in enumerate([*value, -math.inf]) if i != j) > 1e-3 * value[0]]
    assert np.allclose(np.abs((unit * vector[:, :k]).sum(axis=0))[alone], 1, atol=1e-10)


def random_rows(n, d, seed=0, scale=None):
    values = np.random.default_rng(seed).standard_normal((n, d)) * (1 if scale is None else scale)
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(values)]


def test_the_table(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check(queries.op13_whitening(spark, small).collect(), rows)


@pytest.mark.parametrize("d,most", [(1, 32), (5, 3), (40, 32), (40, 64)])
def test_other_sizes(spark, d, most):
    rows = random_rows(200, d, seed=d)
    check(whitening.whiten(table(spark, rows), most=most).collect(), rows, most)


def test_scales_far_apart(spark):
    rows = random_rows(300, 12, 3, 10.0 ** np.arange(0, 6, 0.5))
    check(whitening.whiten(table(spark, rows)).collect(), rows)


def test_nulls_lengths_repeats_and_dropped_rows(spark):
    rows = random_rows(60, 6, 4)
    rows += [(100, None), (101, [1.0, None, 2.0]), (102, [math.nan] * 6), (103, [math.inf, 0.0]), (104, [0.5, -0.5]), (105, [])]
    check(whitening.whiten(table(spark, rows)).collect(), rows)
    twice = whitening.whiten(table(spark, rows + [(None, rows[0][1])] * 2 + rows[:5])).collect()
    assert sum(r.vec_id is None for r in twice) == 12 and {r.n for r in twice} == {69}


def test_equal_eigenvalues_and_lost_dimensions(spark):
    # plus and minus each unit vector: all eigenvalues equal; one dimension constant, one a copy
    rows = [(i, [float(s * 4 * (j == i % 5)) for j in range(5)]) for s in (1, -1) for i in range(5)]
    rows = [(n, [*v, 7.0, v[0]]) for n, (_, v) in enumerate(rows)]
    check(whitening.whiten(table(spark, rows)).collect(), rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [3.0]), (2, [3.0])], [(1, []), (2, [])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whiten(table(spark, rows)).count() == 0


def test_many_blocks(spark, monkeypatch):
    rows = random_rows(700, 3, 9)
    doubled = table(spark, rows).withColumn("embedding", F.col("embedding").cast("array<double>"))
    check(whitening.whiten(doubled.repartition(40)).collect(), rows)


def test_deviations_past_64_bits():
    mean = whitening.Mean(10**9, [0, 10**9 * 2**50])
    found = np.array([[3, 2**50], [3, 2**50 + 1], [3 * 10**9, 2**50]], np.int64)
    assert whitening.deviations(found, mean) == [9 * 10**18, None, None]


def test_huge_entries_are_held_within_bounds(spark):
    got = whitening.whiten(table(spark, [(1, [3e38, 1.0]), (2, [-3e38, 0.0]), (3, [0.0, 0.5])])).collect()
    assert len(got) == 3 * len({r.component for r in got}) > 0 and all(math.isfinite(r.whitened) for r in got)


def test_too_many_dimensions(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MOST_DIMENSIONS", 4)
    with pytest.raises(ValueError):
        whitening.whiten(table(spark, random_rows(5, 6)))
