"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

P(grade > k) = logistic(x.w - c_k): one weight for each feature, shared by all ordered thresholds
c_1 < c_2 < ... The severity of a text is its expected grade, the sum of P(grade > k) over k.

Features are a text's words, without the ASCII marks around them, and their beginnings of 4 to 8
letters, in lower case, each with log(1 + its count). Those that documents of a grade above 0 have
more often than chance allows are weighed by the regression, however few documents or languages
they are from; all others have no weight.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fillwatch.llm import texts
from fillwatch.session import settled

#: Labelled documents of each label that are learned from, at most.
SAMPLE = 6000
#: A kept feature has such a log-likelihood ratio against an equal share of both labels (20 is a
#: chance of 8e-6), is so many times as frequent in toxic texts as elsewhere, and stands between so
#: many different pairs of words there, in all and for each text that it is in.
EVIDENCE, LIFT, LEAST_CONTEXTS, CONTEXTS = 20.0, 2.0, 3, 0.15
BEGINNINGS = (4, 5, 6, 7, 8)
#: The chance of a grade above 0 from which a text counts as toxic. Both labels weigh alike in the
#: fit although toxic texts are the rarer ones, so it is above one half.
LEAST = 0.8
SLICE = 1 << 19

_MARKS = np.zeros(0x110000, bool)
_MARKS[[ord(c) for c in string.punctuation]] = True
_SPACE = np.zeros(0x110000, bool)
_SPACE[[ord(c) for c in texts.SPACES]] = True


def _bare(code: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without the marks at their ends; one of marks alone stays as it is."""
    inner = np.flatnonzero(~(_SPACE[code] | _MARKS[code]))
    if not len(inner):
        return start, end
    low, high = np.searchsorted(inner, start), np.searchsorted(inner, end)
    any_inner = high > low
    return (
        np.where(any_inner, inner[np.minimum(low, len(inner) - 1)], start),
        np.where(any_inner, inner[np.maximum(high, 1) - 1] + 1, end),
    )


def features(whole: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All features of the texts, occurrence by occurrence: their hashes, their texts, and hashes of
    the two words around (0 where a text begins or ends)."""
    code, at = texts.code_points([t.lower() for t in whole])
    start, end = _bare(code, *texts.runs(~_SPACE[code], at))
    first = np.searchsorted(start, at)
    owner = np.repeat(np.arange(len(whole)), np.diff(first))
    hasher = texts.Hasher(code)
    word = hasher.spans(start, end)
    before, after = np.zeros_like(word), np.zeros_like(word)
    before[1:] = word[:-1]
    after[:-1] = word[1:]
    some = np.diff(first) > 0
    before[first[:-1][some]] = 0
    after[first[1:][some] - 1] = 0
    around = texts.mix(before) + after
    value, of, company = [word], [owner], [around]
    for length in BEGINNINGS:
        longer = end - start > length
        # a beginning is another feature than a word of the same letters
        value.append(texts.mix(hasher.spans(start[longer], start[longer] + length)))
        of.append(owner[longer])
        company.append(around[longer])
    return np.concatenate(value), np.concatenate(of), np.concatenate(company)


@dataclass
class Model:
    """Kept features (sorted hashes), their weights, and a threshold between any two grades."""

    features: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))


def _among(kept: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers among the kept features, and which of them are right."""
    if not len(kept):
        return np.zeros(len(hashed), np.int64), np.zeros(len(hashed), bool)
    at = np.minimum(np.searchsorted(kept, hashed), len(kept) - 1)
    return at, kept[at] == hashed


def counted(whole: list[str], kept: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, feature number and count of the kept features in the texts."""
    hashed, owner, _ = features(whole)
    at, hit = _among(kept, hashed)
    width = max(1, len(kept))
    pair, n = np.unique(owner[hit] * width + at[hit], return_counts=True)
    return pair // width, pair % width, n


def fit_ordinal(
    row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int,
    decay: float = 2e-6, steps: int = 600, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds by gradient steps (Adam) on the penalised likelihood.

    The thresholds are a first one and the logarithms of the gaps, so they stay in order. Grade 0
    and all grades above it weigh alike, however many rows there are of either.
    """
    top = int(grade.max())
    share = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    p = np.zeros(width + top)
    p[width:] = 1.0
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        w, gaps = p[:width], np.exp(p[width + 1 :])
        c = p[width] + np.append(0, np.cumsum(gaps))
        score = np.bincount(row, w[column] * value, minlength=len(grade))
        above = 1 / (1 + np.exp(-np.clip(score[:, None] - c, -40, 40)))
        edge = np.column_stack([np.ones(len(grade)), above, np.zeros(len(grade))])
        each = np.arange(len(grade))
        chance = np.maximum(edge[each, grade] - edge[each, grade + 1], 1e-12)
        slope = edge * (1 - edge)
        down = slope[each, grade] / chance * share  # by the threshold below the grade
        up = slope[each, grade + 1] / chance * share
        by_score = down - up
        by_c = np.array([up[grade == k].sum() - down[grade == k + 1].sum() for k in range(top)])
        gradient = np.append(np.bincount(column, by_score[row] * value, minlength=width) - decay * w, 0.0 * by_c)
        tail = np.cumsum(by_c[::-1])[::-1]
        gradient[width] = tail[0]
        gradient[width + 1 :] = tail[1:] * gaps
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        p = p + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return p[:width], p[width] + np.append(0, np.cumsum(np.exp(p[width + 1 :])))


def grades(toxic: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Grades from labels that only say toxic or not: 0 is not toxic, 2 are the toxic texts with
    more occurrences of kept features than the median one, 1 the other toxic ones."""
    grade = (toxic > 0).astype(np.int64)
    if grade.any():
        grade[(grade == 1) & (marked > np.median(marked[grade == 1]))] = 2
    return grade


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from up to ``sample`` labelled documents of each label, those of lowest hash.

    ``labels`` has ``doc_id`` and ``toxic``; of several labels the highest counts, nulls do not.
    Features are counted on Spark, copies of a text once. To the driver come those that pass
    ``EVIDENCE`` and the like, none cut off, and how often each sampled text has them: as much as
    that many texts hold. Labelled ids without a text are left out, so are labels of no document;
    repeated rows count once; further columns of any name are not read. With no toxic or no other
    label, as in an empty table, the model knows no feature and finds nothing toxic.
    """
    marked = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    )
    chosen = texts.lowest(marked, "toxic", "doc_id", sample)
    # at most twice ``sample`` ids
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    rows = rows.filter("text IS NOT NULL").groupBy("text").agg(F.max("toxic").alias("toxic"))
    rows = settled(rows, "labelled")
    size = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = Model(np.zeros(0, np.uint64), np.zeros(0), np.array([40.0, 41.0]))
    if len(size) < 2:
        return none

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, whole = batch.column("toxic").to_numpy(), batch.column("text").to_pylist()
            at = np.append(0, np.cumsum([len(t) for t in whole]))
            for low, high in texts.slices(at, SLICE):
                hashed, owner, _ = features(whole[low:high])
                pair = np.unique(np.stack([owner.astype(np.uint64), hashed]), axis=1)
                label = toxic[low:high][pair[0].astype(np.int64)]
                for k in (0, 1):
                    own, n = np.unique(pair[1][label == k], return_counts=True)
                    yield pa.record_batch(
                        {
                            "feature": pa.array(own.view(np.int64)),
                            "clean": pa.array((n * (1 - k)).astype(np.int64)),
                            "toxic": pa.array((n * k).astype(np.int64)),
                        }
                    )

    share = size[1] / (size[0] + size[1])
    total = F.col("toxic") + F.col("clean")
    lift = ((F.col("toxic") + 0.5) / (size[1] + 1)) / ((F.col("clean") + 0.5) / (size[0] + 1))
    in_clean = F.col("clean") * F.ln(F.col("clean") / (total * (1 - share)))
    evidence = 2 * (
        F.col("toxic") * F.ln(F.col("toxic") / (total * share)) + F.when(F.col("clean") > 0, in_clean).otherwise(0.0)
    )
    best = (
        rows.mapInArrow(present, "feature long, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter((F.col("toxic") >= LEAST_CONTEXTS) & (lift >= LIFT) & (evidence >= EVIDENCE))
        .select("feature", "toxic")
    )
    best = settled(best, "features")
    rough = np.sort(best.toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("text").to_pylist()
            at = np.append(0, np.cumsum([len(t) for t in whole]))
            for low, high in texts.slices(at, SLICE):
                hashed, _, around = features(whole[low:high])
                hit = _among(rough, hashed)[1]
                pair = np.unique(np.stack([hashed[hit], around[hit]]), axis=1).view(np.int64)
                yield pa.record_batch({"feature": pa.array(pair[0]), "around": pa.array(pair[1])})

    # words of a text that was copied and edited keep their company; what marks toxic texts doesn't
    company = (
        rows.filter("toxic = 1")
        .select("text")
        .mapInArrow(contexts, "feature long, around long")
        .groupBy("feature")
        .agg(F.countDistinct("around").alias("contexts"))
    )
    final = (
        best.join(company, "feature")
        .filter((F.col("contexts") >= LEAST_CONTEXTS) & (F.col("contexts") >= CONTEXTS * F.col("toxic")))
        .select("feature")
        .toArrow()
    )
    kept = np.sort(final.column(0).to_numpy().astype(np.int64).view(np.uint64))

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("text").to_pylist()
            at = np.append(0, np.cumsum([len(t) for t in whole]))
            for low, high in texts.slices(at, SLICE):
                row, column, n = counted(whole[low:high], kept)
                cut = np.searchsorted(row, np.arange(high - low + 1))
                yield pa.record_batch(
                    {
                        "toxic": batch.column("toxic").slice(low, high - low),
                        "columns": pa.array(np.split(column, cut[1:-1]), pa.list_(pa.int64())),
                        "counts": pa.array(np.split(n, cut[1:-1]), pa.list_(pa.int64())),
                    }
                )

    known = rows.mapInArrow(sparse, "toxic int, columns array<long>, counts array<long>").toArrow()
    if not len(kept) or not known.num_rows:
        return none
    columns, counts = known.column("columns").combine_chunks(), known.column("counts").combine_chunks()
    row = np.repeat(np.arange(len(columns)), columns.value_lengths().to_numpy(zero_copy_only=False))
    column, n = columns.flatten().to_numpy(), counts.flatten().to_numpy()
    marked = np.bincount(row, n, minlength=len(columns))
    grade = grades(known.column("toxic").to_numpy(), marked)
    weights, thresholds = fit_ordinal(row, column, np.log1p(n), grade, len(kept))
    return Model(kept, weights, thresholds)


def _chances(whole: list[str], model: Model) -> np.ndarray:
    """P(grade > k) for each text and k."""
    row, column, n = counted(whole, model.features)
    total = np.bincount(row, model.weights[column] * np.log1p(n), minlength=len(whole))
    return model.above(total)


def _scored(batch: pa.RecordBatch, model: Model) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their texts' chances."""
    whole = [t or "" for t in batch.column("text").to_pylist()]
    at = np.append(0, np.cumsum([len(t) for t in whole]))
    for low, high in texts.slices(at, SLICE):
        yield batch.slice(low, high - low), _chances(whole[low:high], model)


def score(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """The severity of each row's whole text.

    ``severity`` is the expected grade, ``grade`` the likeliest, and ``toxic`` says whether a grade
    above 0 has a chance of ``least`` or more. Where the labels only say toxic or not, grade 2 is a
    toxic text with more of the model's own features than the median toxic one (``grades``): an
    amount of marked words, not what a reader said of it. Null and empty texts have no features and get what
    the thresholds alone say. An empty table gives no rows, a repeated row comes out as often as it
    is there; only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id``, ``severity``, ``grade``, ``toxic``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, above in _scored(batch, shared.value):
                edge = np.column_stack([np.ones(len(above)), above, np.zeros(len(above))])
                yield pa.record_batch(
                    {
                        "doc_id": part.column("doc_id"),
                        "severity": pa.array(above.sum(axis=1)),
                        "grade": pa.array((edge[:, :-1] - edge[:, 1:]).argmax(axis=1).astype(np.int32)),
                        "toxic": pa.array(above[:, 0] >= least),
                    }
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, severity double, grade int, toxic boolean"
    )


def reject(docs: DataFrame, model: Model, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that ``score`` does not call toxic, with all their columns.

    Null and empty texts stay (the thresholds alone speak for them), repeated rows stay or go alike,
    an empty table stays empty, and further columns of any name come through as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, above in _scored(batch, shared.value):
                yield part.filter(pa.array(above[:, 0] < least))

    return docs.mapInArrow(work, docs.schema)
