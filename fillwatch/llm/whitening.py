"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

1. A pass over the vectors turns them into blocks of small integers in the shared folder; every
   later pass reads those.
2. The centred rows X are bidiagonalised, X V = U B: a step multiplies X with a direction v and
   X transposed with the u that comes out, in one pass over the blocks. A left vector is as
   long as the table, so it is never kept: u = X p, and only p, as long as a row, is held.
   Each task adds up its share, and the shares are summed by dimension in Spark, so the driver gets
   one row per dimension.
3. New directions on both sides are made orthogonal to all before them. As the inner products of
   left vectors are those of their p with what the step's pass gives anyway, that costs no pass;
   where much had to be taken away, the step is done again.
4. The singular values of the small B give deviations, its right vectors with V the components.

As many steps as there are dimensions are done, and a direction that leads nowhere is replaced by
a fresh one, so equal eigenvalues are all found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwatch.session import settled

#: Numbers in a block, and rows given out at once, about.
BLOCK, ROWS = 1 << 18, 1 << 16
#: Dimensions; the driver holds three square matrices of that size.
MOST_DIMENSIONS = 4096
#: Entries are turned into integers at this scale, and held within these bounds.
SCALE, SHIFT, BOUND = 64, 1_000_000, 1 << 52
#: Components with less than this share of the largest deviation are rounding noise.
NOISE = 1e-7

_KINDS = ("<i2", "<i4", "<i8")
_BLOCKS = "ids array<long>, n long, width int, kind string, values binary, sums array<long>"

Part = Callable[[np.ndarray], np.ndarray]


def blocks(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """The vectors as blocks of integers floor(64 c), written to the shared folder.

    Rows whose vector is null or holds a null, infinite or NaN entry are left out. Entries are held
    within 2**52, where sums and differences stay exact. Null keys and rows that repeat others are
    rows as any. An empty table gives no blocks. Other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            keep = lists.is_valid().to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            value = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
            size = np.where(keep, np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)), 0).astype(np.int64)
            at = np.append(0, np.cumsum(size))
            bad = np.append(0, np.cumsum(~np.isfinite(value)))
            keep &= bad[at[1:]] == bad[at[:-1]]
            rows = np.flatnonzero(keep)
            width = int(size[rows].max(initial=0))
            step = max(1, BLOCK // max(1, width))
            for low in range(0, len(rows), step):
                own = rows[low : low + step]
                whole = np.zeros((len(own), width), np.int64)
                place = np.arange(width)[None, :] < size[own][:, None]
                inside = np.concatenate([value[at[i] : at[i + 1]] for i in own])
                whole[place] = np.clip(np.floor(inside * SCALE), -BOUND, BOUND).astype(np.int64)
                most = max(int(whole.max(initial=0)), -int(whole.min(initial=0)))
                kind = next(k for k in _KINDS if most < 1 << (8 * int(k[2]) - 1))
                # a block's sums stay within 64 bits: at most 2**11 rows of the greatest entries
                for part in np.array_split(np.arange(len(own)), max(1, -(-len(own) // 2048))):
                    yield pa.RecordBatch.from_pylist(
                        [
                            {
                                "ids": batch.column("k").take(pa.array(own[part])).to_pylist(),
                                "n": len(part),
                                "width": width,
                                "kind": kind,
                                "values": whole[part].astype(kind).tobytes(),
                                "sums": whole[part].sum(axis=0).tolist(),
                            }
                        ],
                        schema,
                    )

    schema = pa.schema(
        [("ids", pa.list_(pa.int64())), ("n", pa.int64()), ("width", pa.int32()), ("kind", pa.string()),
         ("values", pa.binary()), ("sums", pa.list_(pa.int64()))]
    )
    picked = vectors.select(
        F.col(key).cast("long").alias("k"), F.col(column).cast("array<double>").alias("v")
    )
    return settled(picked.mapInArrow(work, _BLOCKS), "vectors")


def _rows(row: dict, dimensions: int) -> np.ndarray:
    """The integers of a block; entries that a shorter vector lacks are 0."""
    found = np.frombuffer(row["values"], row["kind"]).reshape(row["n"], row["width"]).astype(np.int64)
    return np.pad(found, ((0, 0), (0, dimensions - row["width"])))


@dataclass(frozen=True)
class Mean:
    """How many rows, their exact sums (of the integers in blocks), and the mean in two parts."""

    n: int
    sums: list[int]

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    def centred(self, found: np.ndarray) -> np.ndarray:
        whole = [round(s / self.n) if abs(s) < 1 << 50 else s // self.n for s in self.sums]
        rest = [(s - self.n * w) / self.n for s, w in zip(self.sums, whole)]
        return (found - np.array(whole, np.int64)) - np.array(rest)


def mean_of(held: DataFrame) -> Mean:
    """Exact counts and sums of ``blocks``: one row per dimension comes to the driver."""
    size = held.agg(F.sum("n").alias("n"), F.max("width").alias("width")).first()
    if size.n is None:
        return Mean(0, [])
    if size.width > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {size.width} entries are longer than {MOST_DIMENSIONS}")
    sums = (
        held.select(F.posexplode("sums").alias("place", "value"))
        .groupBy("place")
        .agg(F.sum(F.col("value").cast("decimal(38, 0)")).alias("value"))
        .collect()
    )
    out = [0] * size.width
    for row in sums:
        out[row.place] = int(row.value)
    return Mean(size.n, out)


def summed(held: DataFrame, mean: Mean, part: Part) -> np.ndarray:
    """``part`` of each block's centred rows, summed over all blocks; a vector of fixed length."""
    dimensions = mean.dimensions

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in batch.to_pylist():
                own = part(mean.centred(_rows(row, dimensions)))
                total = own if total is None else total + own
        if total is not None:
            yield pa.record_batch({"place": pa.array(np.arange(len(total), dtype=np.int32)), "value": pa.array(total)})

    shares = held.select("n", "width", "kind", "values").mapInArrow(work, "place int, value double")
    rows = shares.groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(len(rows))
    for row in rows:
        out[row.place] = row.value
    return out


def bidiagonal(product: Callable[[np.ndarray], tuple[np.ndarray, float]], d: int, scale: float, seed: int = 0):
    """V and B with X V = U B for a matrix of ``d`` columns that is only known by its products.

    ``product(q)`` gives X'Xq and the squared length of Xq; ``scale`` is the Frobenius norm of X.
    """
    random = np.random.default_rng(seed)
    v, p, g = (np.zeros((d, d)) for _ in range(3))  # g: X'u
    b = np.zeros((d, d))
    tiny = 1e-14 * scale

    def fresh(j: int, new: np.ndarray) -> tuple[np.ndarray, float]:
        """``new`` without what lies along the directions so far, and its length."""
        for _ in range(2):
            new = new - v[:, :j] @ (v[:, :j].T @ new)
        return new, float(np.linalg.norm(new))

    def start(j: int) -> np.ndarray:
        new, length = fresh(j, random.standard_normal(d))
        return fresh(j, new / length)[0]

    first = start(0)
    v[:, 0] = first / np.linalg.norm(first)
    for j in range(d):
        q = v[:, j] - (b[j - 1, j] * p[:, j - 1] if j else 0.0)
        for _ in range(3):
            back, square = product(q)
            along = p[:, :j].T @ back  # inner products with the left vectors so far
            q = q - p[:, :j] @ along
            taken = float(along @ along)
            if taken <= 1e-20 * square or square <= tiny * tiny:
                back, square = back - g[:, :j] @ along, square - taken
                break
        alpha = float(np.sqrt(max(square, 0.0)))
        if alpha > tiny:
            b[j, j], p[:, j], g[:, j] = alpha, q / alpha, back / alpha
        if j + 1 == d:
            break
        new, beta = fresh(j + 1, g[:, j] - b[j, j] * v[:, j])
        if beta > tiny:
            b[j, j + 1] = beta
        else:
            new = start(j + 1)
        v[:, j + 1] = new / np.linalg.norm(new)
    return v, b


@dataclass(frozen=True)
class Whitening:
    """Components as columns, and the eigenvalue of each in the covariance with divisor n."""

    mean: Mean
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def project(self, centred: np.ndarray) -> np.ndarray:
        return centred @ (self.components / np.sqrt(self.eigenvalues))


def fit(held: DataFrame, most: int = 32) -> Whitening:
    """The ``most`` first components of ``blocks``, numbered by falling eigenvalue.

    Components that carry nothing but rounding (``NOISE``) are left out, so there are fewer where
    the vectors span fewer dimensions, and none for a single vector or equal ones.
    """
    mean = mean_of(held)
    d = mean.dimensions
    none = Whitening(mean, np.zeros((d, 0)), np.zeros(0), 0.0)
    if not d:
        return none
    square = float(summed(held, mean, lambda x: np.array([(x * x).sum()]))[0])
    if square <= 0:
        return none

    def product(q: np.ndarray) -> tuple[np.ndarray, float]:
        def part(x: np.ndarray) -> np.ndarray:
            u = x @ q
            return np.append(u @ x, u @ u)

        out = summed(held, mean, part)
        return out[:-1], float(out[-1])

    v, b = bidiagonal(product, d, float(np.sqrt(square)))
    _, sigma, right = np.linalg.svd(b)
    keep = np.flatnonzero(sigma > NOISE * sigma[0])[:most]
    return Whitening(mean, v @ right[keep].T, sigma[keep] ** 2 / mean.n, square / mean.n)


def identity_error(held: DataFrame, model: Whitening) -> float:
    """How far the covariance of the whitened rows is from the identity, at most.

    Whitened rows are products of centred ones, so their mean is zero but for rounding.
    """
    k = len(model.eigenvalues)

    def part(x: np.ndarray) -> np.ndarray:
        w = model.project(x)
        return np.append((w.T @ w).reshape(-1), w.sum(axis=0))

    total = summed(held, model.mean, part) / model.mean.n
    mean = total[k * k :]
    return float(np.abs(total[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def deviations(found: np.ndarray, mean: Mean) -> list[int | None]:
    """The sum over dimensions of (n x - S)**2 of each row, exact; null where 64 bits don't hold it."""
    near = ((mean.centred(found) * mean.n) ** 2).sum(axis=1)
    wrapped = lambda value: np.array([value & (1 << 64) - 1], np.uint64).view(np.int64)
    sums = np.concatenate([wrapped(s) for s in mean.sums])
    # wrapped arithmetic is right wherever the true value fits
    own = found * wrapped(mean.n)[0] - sums
    out: list[int | None] = (own * own).sum(axis=1).tolist()
    for i in np.flatnonzero(near > float(1 << 62)).tolist():
        exact = None
        if near[i] < 1.001 * (1 << 63):
            exact = sum((mean.n * x - s) ** 2 for x, s in zip(found[i].tolist(), mean.sums))
        out[i] = exact if exact is not None and exact < 1 << 63 else None
    return out


def whitened(held: DataFrame, model: Whitening) -> DataFrame:
    """A row for each vector of ``blocks`` and each component of ``model``.

    Columns: ``vec_id``, ``component`` (from 1), ``n`` (vectors), ``deviation`` (see
    ``deviations``), ``whitened``, ``explained`` (the component's share of the variance).
    """
    k = len(model.eigenvalues)
    mean, shares = model.mean, model.eigenvalues / model.trace if k else model.eigenvalues

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = max(1, ROWS // max(1, k))
        for batch in batches:
            for row in batch.to_pylist() if k else ():
                found = _rows(row, mean.dimensions)
                for low in range(0, row["n"], step):
                    own = found[low : low + step]
                    n = len(own)
                    repeated = np.repeat(np.arange(n), k)
                    yield pa.record_batch(
                        {
                            "vec_id": pa.array(row["ids"][low : low + step], pa.int64()).take(pa.array(repeated)),
                            "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                            "n": pa.array(np.full(n * k, mean.n, np.int64)),
                            "deviation": pa.array(deviations(own, mean), pa.int64()).take(pa.array(repeated)),
                            "whitened": pa.array(model.project(mean.centred(own)).reshape(-1)),
                            "explained": pa.array(np.tile(shares, n)),
                        }
                    )

    return held.select("ids", "n", "width", "kind", "values").mapInArrow(
        work, "vec_id long, component int, n long, deviation long, whitened double, explained double"
    )


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", most: int = 32) -> DataFrame:
    """``vectors`` on their ``most`` first components, each scaled to unit variance.

    An entry c becomes the integer x = floor(64 c) + 1000000. All vectors that ``blocks`` keeps are
    fitted and projected; a vector shorter than the longest one counts as having zeros at its
    end. Covariances have divisor n. An empty table, one vector, or equal ones give no rows.

    Columns: those of ``whitened`` and ``identity_error``, one value.
    """
    held = blocks(vectors, key, column)
    model = fit(held, most)
    error = identity_error(held, model) if len(model.eigenvalues) else 0.0
    return whitened(held, model).withColumn("identity_error", F.lit(error))
