"""Language identification by language-bitmask n-gram filters.

The filter is a Bloom filter in bit-sliced form: a place holds one bit for each language, so one
look-up of an n-gram (the AND of its places) returns all languages that hold it. A text's n-grams
give a count for each language; a language's false positives, known from how full its slice is,
are taken off before the counts are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.llm import texts
from fillwatch.llm.bpe import _LETTER, _classes
from fillwatch.session import settled

#: Labelled documents that each language is learned from, at most, and n-grams it keeps, at most.
SAMPLE, NGRAMS = 2000, 30000
#: A language holds an n-gram that is at least so frequent in it, beside where it is most frequent.
SHARE = 0.25
PLACES_PER_NGRAM, PROBES = 16, 4
UNKNOWN = "und"
SLICE = 1 << 19


def ngrams(code: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all 3- and 4-grams, the text of each, and whether each text has a letter.

    Anything but letters is a boundary. An n-gram has letters inside and a letter or a boundary at
    either end, so every letter is inside of one at least.
    """
    n = np.diff(at)
    size = n + 3  # a boundary before each text and two after it
    begin = np.append(0, np.cumsum(size))
    owner = np.repeat(np.arange(len(n)), size)
    padded = np.zeros(begin[-1], np.uint64)
    letter = _classes()[code] == _LETTER
    spot = np.arange(len(code)) + np.repeat(begin[:-1] + 1 - at[:-1], n)
    padded[spot] = np.where(letter, code, 0)
    inside = padded != 0
    has = np.bincount(owner[spot][letter], minlength=len(n)) > 0
    if len(padded) < 3:
        return np.zeros(0, texts.U), np.zeros(0, np.int64), has
    three = padded[:-2] | padded[1:-1] << texts.U(21) | padded[2:] << texts.U(42)
    good = inside[1:-1]
    first = texts.mix(three[good])
    longer = inside[1:-2] & inside[2:-1]
    second = texts.mix(texts.mix(three[:-1][longer]) + padded[3:][longer] + texts.U(1))
    return np.append(first, second), np.append(owner[:-2][good], owner[:-3][longer]), has


@dataclass
class Model:
    """Languages, the one with most documents first, and a filter with a bit for each."""

    languages: list[str]
    slices: np.ndarray  # places x words of 64 languages

    def masks(self, grams: np.ndarray) -> np.ndarray:
        """A bit for each language that holds the n-gram; some are false positives."""
        top = texts.U(len(self.slices) - 1)
        step = (grams >> texts.U(32)) | texts.U(1)
        out = self.slices[(grams & top).astype(np.int64)]
        for j in range(1, PROBES):
            out &= self.slices[((grams + step * texts.U(j)) & top).astype(np.int64)]
        return out

    def bit(self, masks: np.ndarray, language: int) -> np.ndarray:
        return (masks[:, language // 64] >> texts.U(language % 64)) & texts.U(1)

    def false_positives(self) -> np.ndarray:
        fill = [self.bit(self.slices, i).mean() if len(self.slices) else 0.0 for i in range(len(self.languages))]
        return np.array(fill) ** PROBES


def in_training(doc_id: Column) -> Column:
    """Documents that may be learned from: crc32 of the id as text, modulo 3, is not 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) != 1, F.lit(False))


def _filter(languages: list[str], language: np.ndarray, grams: np.ndarray) -> Model:
    most = int(np.bincount(language, minlength=1).max()) if len(language) else 1
    places = 1 << max(10, int(PLACES_PER_NGRAM * most - 1).bit_length())
    slices = np.zeros((places, max(1, -(-len(languages) // 64))), np.uint64)
    step = (grams >> texts.U(32)) | texts.U(1)
    bit = texts.U(1) << (language % 64).astype(np.uint64)
    for j in range(PROBES):
        at = ((grams + step * texts.U(j)) & texts.U(places - 1)).astype(np.int64)
        np.bitwise_or.at(slices, (at, language // 64), bit)
    return Model(languages, slices)


def fit(docs: DataFrame, sample: int = SAMPLE, keep: int = NGRAMS) -> Model:
    """Learns from up to ``sample`` documents of each language, those of lowest hash.

    Only rows with a ``lang``, a ``doc_id`` and ``in_training`` are used, and of these ``text`` and
    ``lang``. Counting runs on Spark; what comes to the driver is the names of the languages and at
    most ``keep`` n-grams for each. Without labelled rows the model knows no language.
    """
    known = docs.filter(in_training(F.col("doc_id")) & F.col("lang").isNotNull())
    chosen = texts.lowest(known.select("doc_id", "lang"), "lang", "doc_id", sample)
    size = {r.lang: r.n for r in chosen.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(size, key=lambda x: (-size[x], x))
    if not languages:
        return Model([], np.zeros((1, 1), np.uint64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([languages.index(x) for x in batch.column("lang").to_pylist()])
            whole = [(t or "").lower() for t in batch.column("text").to_pylist()]
            at = np.append(0, np.cumsum([len(t) for t in whole]))
            for low, high in texts.slices(at, SLICE):
                gram, owner, _ = ngrams(*texts.code_points(whole[low:high]))
                for i in np.unique(lang[low:high]).tolist():
                    own, n = np.unique(gram[lang[low:high][owner] == i], return_counts=True)
                    yield pa.record_batch(
                        {
                            "language": pa.array(np.full(len(own), i, np.int32)),
                            "gram": pa.array(own.view(np.int64)),
                            "n": pa.array(n.astype(np.int64)),
                        }
                    )

    # as many ids as languages times ``sample``: a bounded table
    counted = (
        known.select("doc_id", "lang", "text")
        .join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
        .select("lang", "text")
        .mapInArrow(count, "language int, gram long, n long")
        .groupBy("language", "gram")
        .agg(F.sum("n").alias("n"))
    )
    counted = settled(counted, "ngrams")
    rate = F.col("n") / F.col("all")
    every = counted.groupBy("language").agg(F.sum("n").alias("all"))
    most = Window.partitionBy("language").orderBy(F.col("n").desc(), "gram")
    held = (
        counted.join(F.broadcast(every), "language")
        .withColumn("most", F.max(rate).over(Window.partitionBy("gram")))
        .filter((rate >= SHARE * F.col("most")) & (F.col("n") > 1))
        .withColumn("number", F.row_number().over(most))
        .filter(F.col("number") <= keep)
        .select("language", "gram")
        .toArrow()
    )
    return _filter(
        languages,
        held.column("language").to_numpy().astype(np.int64),
        held.column("gram").to_numpy().astype(np.int64).view(np.uint64),
    )


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """The language of each row's whole text, from its text alone.

    ``lang_pred`` is a learned language, or ``und`` for a null text, one without a letter, and if
    no language was learned. ``score`` is the share of the text's n-grams that the language holds,
    false positives taken off. Of equal languages the one with more documents wins. An empty table
    gives no rows; only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id``, ``lang_pred``, ``score``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        wrong = model.false_positives()
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            whole = [(t or "").lower() for t in batch.column("text").to_pylist()]
            at = np.append(0, np.cumsum([len(t) for t in whole]))
            best, score = [], []
            for low, high in texts.slices(at, SLICE):
                gram, owner, has = ngrams(*texts.code_points(whole[low:high]))
                total = np.maximum(np.bincount(owner, minlength=high - low), 1)
                found = np.zeros((high - low, len(names)))
                masks = model.masks(gram)
                for i in range(len(model.languages)):
                    hits = np.bincount(owner, weights=model.bit(masks, i), minlength=high - low)
                    found[:, i] = (hits / total - wrong[i]) / (1 - wrong[i])
                choice = np.full(high - low, len(names) - 1)
                if model.languages:
                    choice[has] = found[has, :-1].argmax(axis=1)
                best += names[choice].tolist()
                score.append(np.clip(found[np.arange(high - low), choice], 0, 1))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": pa.array(best, pa.string()),
                    "score": pa.array(np.concatenate(score) if score else np.zeros(0)),
                }
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, lang_pred string, score double"
    )
