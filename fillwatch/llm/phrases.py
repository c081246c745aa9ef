"""Phrase collocations, counted by marginalising the longest windows.

1. Each word becomes one window: the word, and in lead columns the words after it in its piece; a
   window that meets the end of its piece is padded. Only these longest windows are counted.
   A block of texts counts its own ones first and sends them, as numbers of a dictionary of its
   words, to the partition of their hash, so a frequent window is a row per block and no key is
   hot.
2. Where a window's count is complete and below ``least``, it is marginalised there: it loses its
   last word, and its count goes on under the shorter prefix. This is done for the longest windows,
   then for those a word shorter, down to two words.
3. A ROLLUP over the window's columns sums what is left by shorter and shorter prefixes. Every
   phrase is the prefix of exactly as many windows as it occurs, so words and shorter phrases
   are never exploded by themselves.
4. Phrases that occur ``least`` times or more are written to the shared folder. All parts of such
   a phrase are among them, so scores come from joins of this table with itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.llm import texts
from fillwatch.llm.bpe import _grouped
from fillwatch.session import settled

#: Characters that end a piece of text, and those that part words. Fixed values.
ENDS = ".,;:!?\n\x0b\x0c\r"
BLANKS = " \t"
UNKNOWN = "und"

#: Bytes of text in a block, about; a longer text is a block of its own. Rows given out at once.
BLOCK, ROWS = 1 << 22, 1 << 16

_END = 10
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[ord(c) for c in ENDS]] = _END
_PLAIN[[ord(c) for c in BLANKS]] = 32
_IN_WORD = np.ones(256, bool)
_IN_WORD[[_END, 32]] = False

_PARTS = "p int, words binary, lengths binary, ids binary, counts binary"

#: Windows: a row of numbers for lang and each word, 0 for no word, and how often each occurs.
Windows = tuple[np.ndarray, np.ndarray]


def _binary(data: np.ndarray | bytes, length: np.ndarray) -> pa.Array:
    """Values of the given lengths, one after another in ``data``."""
    at = np.append(0, np.cumsum(length)).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(length), [None, pa.py_buffer(at), pa.py_buffer(data)]
    )


def _numbered(values: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct values in order of appearance, and the number of each value among them."""
    coded = values.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int32, copy=False)


def _code(columns: np.ndarray) -> np.ndarray:
    """A number for each row of numbers, equal where all are."""
    code, span = columns[0].astype(np.int64), int(columns[0].max(initial=0)) + 1
    for column in columns[1:]:
        width = int(column.max(initial=0)) + 1
        if span > (1 << 62) // width:
            order, begin = _groups(code)
            code = np.empty_like(code)
            code[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
            span = len(begin)
        code *= width
        code += column
        span *= width
    return code


def _groups(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by code, and where each code begins in it."""
    order = np.argsort(code)
    ordered = code[order]
    return order, np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])


def _combined(columns: np.ndarray, count: np.ndarray) -> Windows:
    """Each distinct row of numbers once, with the sum of its counts."""
    if not len(count):
        return columns, count
    order, begin = _groups(_code(columns))
    return columns[:, order[begin]], np.add.reduceat(count[order], begin)


def _marginalised(columns: np.ndarray, count: np.ndarray, level: int, least: int) -> Windows:
    """Windows of ``level`` words give up the last one if their prefix occurs too seldom."""
    if not len(count):
        return columns, count
    order, begin = _groups(_code(columns[: level + 1]))
    total = np.add.reduceat(count[order], begin)
    seldom = np.empty(len(count), bool)
    seldom[order] = np.repeat(total < least, np.diff(np.append(begin, len(order))))
    if level + 1 < len(columns):
        seldom &= columns[level + 1] == 0
    columns = columns.copy()
    columns[level][seldom] = 0
    return _combined(columns, count)


def _pressed(*values: np.ndarray) -> bytes:
    """Numbers below 2**64, compressed byte by byte of equal weight."""
    planes = np.concatenate(values).astype("<u8").view(np.uint8).reshape(-1, 8).T
    used = planes[: int(np.flatnonzero(planes.any(axis=1)).max(initial=0)) + 1]
    return zstandard.ZstdCompressor(level=1).compress(bytes([len(used)]) + used.tobytes())


def _unpressed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    used = planes[1:].reshape(planes[0], -1)
    whole = np.zeros((used.shape[1], 8), np.uint8)
    whole[:, : len(used)] = used.T
    return whole.view("<u8")[:, 0].astype(np.int64)


def _dealt(words: pa.Array, found: Windows, level: int, parts: int) -> pa.RecordBatch:
    """Windows by the partition of their lang and first ``level`` words, each with its dictionary."""
    columns, count = found
    flat, at = texts.bytes_of(words)
    hashed = np.append(texts.U(0), texts.Hasher(flat).spans(at[:-1], at[1:]))
    length = np.diff(at)
    place = np.zeros(len(count), texts.U)
    for column in columns[: level + 1]:
        place = texts.mix(place * texts.U(0x9FB21C651E98DF25) + hashed[column])
    place = (place % texts.U(parts)).astype(np.min_scalar_type(parts))
    press = zstandard.ZstdCompressor(level=1).compress
    out = {name: [] for name in ("p", "words", "lengths", "ids", "counts")}
    for p, own in _grouped(place):
        # the number for no word comes first, whether it is there or not
        ids, used = pd.factorize(np.append(np.int32(0), columns[:, own].reshape(-1)))
        held = used[1:] - 1
        out["p"].append(p)
        out["words"].append(press(texts.bytes_of(words.take(pa.array(held)))[0].tobytes()))
        out["lengths"].append(_pressed(length[held]))
        out["ids"].append(_pressed(ids[1:]))
        out["counts"].append(_pressed(count[own]))
    types = [pa.int32(), *[pa.binary()] * 4]
    return pa.record_batch({n: pa.array(v, t) for (n, v), t in zip(out.items(), types)})


def _read(rows: list[dict], width: int) -> tuple[pa.Array, Windows]:
    """The parts that a partition got, under one dictionary."""
    unpress = zstandard.ZstdDecompressor().decompress
    lengths = [_unpressed(r["lengths"]) for r in rows]
    words, of = _numbered(_binary(b"".join(unpress(r["words"]) for r in rows), np.concatenate(lengths)))
    begin = np.cumsum([0, *map(len, lengths)])
    columns = []
    for row, low, high in zip(rows, begin[:-1], begin[1:]):
        own = np.append(np.int32(0), of[low:high] + 1)
        columns.append(own[_unpressed(row["ids"]).reshape(width, -1)])
    count = np.concatenate([_unpressed(r["counts"]) for r in rows])
    return words, _combined(np.concatenate(columns, axis=1), count)


def _windows(data: np.ndarray, at: np.ndarray, lang: np.ndarray, langs: list[str], longest: int) -> tuple[pa.Array, Windows]:
    """The windows of texts laid end to end; ``lang`` has a number in ``langs`` for each text."""
    data = _PLAIN[data]
    inside = _IN_WORD[data]
    start, end = texts.runs(inside, at)
    # langs are words of the dictionary, too: its first ones
    first = [x.encode() for x in langs]
    flat = np.concatenate([np.frombuffer(b"".join(first), np.uint8), data[inside]])
    words, of = _numbered(_binary(flat, np.append([len(x) for x in first], end - start)))
    text = np.searchsorted(at, start, "right") - 1
    piece = np.searchsorted(np.flatnonzero(data == _END), start) + text
    columns = np.zeros((longest + 1, len(start)), np.int32)
    columns[0] = of[: len(first)][lang[text]] + 1
    columns[1] = of[len(first) :] + 1
    for k in range(1, longest):
        columns[k + 1][:-k] = np.where(piece[k:] == piece[:-k], columns[1][k:], 0)
    return words, _combined(columns, np.ones(len(start), np.int64))


def windows(docs: DataFrame, longest: int, least: int, parts: int | None = None) -> DataFrame:
    """Windows of up to ``longest`` words and their counts, in columns ``lang``, ``w0``, .., ``c``.

    A column after the end of a window is an empty string. For each phrase that occurs ``least``
    times or more, and for each word and lang, the counts of the windows that it begins add up to
    its own. ``parts`` is the number of partitions, Spark's number of shuffle partitions unless
    given; one of them holds its windows in memory.
    """
    parts = parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"w{k}" for k in range(longest)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt() -> pa.RecordBatch:
            flat, lang = np.concatenate(held), np.concatenate(spoken)
            at = np.append(0, np.cumsum(np.concatenate(lengths)))
            return _dealt(*_windows(flat, at, lang, list(langs), longest), longest, parts)

        langs: dict[str, int] = {}
        held, lengths, spoken, size = [], [], [], 0
        for batch in batches:
            data, at = texts.utf8(batch.column("text"))
            own, of = _numbered(batch.column("lang"))
            own = np.array([langs.setdefault(x, len(langs)) for x in own.to_pylist()], np.int64)[of]
            for low, high in texts.slices(at, BLOCK):
                held.append(data[at[low] : at[high]])
                lengths.append(np.diff(at[low : high + 1]))
                spoken.append(own[low:high])
                size += int(at[high] - at[low])
                if size >= BLOCK:
                    yield dealt()
                    held, lengths, spoken, size = [], [], [], 0
        if size:
            yield dealt()

    def merged(level: int):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows in _whole(batches):
                words, found = _read(rows, longest + 1)
                found = _marginalised(*found, level, least)
                if level > 2:
                    yield _dealt(words, found, level - 1, parts)
                else:
                    yield from shown(words, *found)

        return work

    def shown(words: pa.Array, columns: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        words = pa.concat_arrays([pa.array([b""], pa.large_binary()), words]).cast(pa.binary())
        for low in range(0, len(count), ROWS):
            part = columns[:, low : low + ROWS]
            values = [words.take(pa.array(c)).cast(pa.string()) for c in part]
            yield pa.RecordBatch.from_arrays(
                [*values, pa.array(count[low : low + ROWS])], names=["lang", *names, "c"]
            )

    rows = docs.select("text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang")).mapInArrow(cut, _PARTS)
    out = ", ".join(f"{n} string" for n in ["lang", *names]) + ", c long"
    for level in range(longest, 1, -1):
        rows = rows.repartitionById(parts, F.col("p")).sortWithinPartitions("p")
        rows = rows.mapInArrow(merged(level), _PARTS if level > 2 else out)
    return rows


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each partition number; they come in its order."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["p"] != held[0]["p"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def counts(docs: DataFrame, longest: int, least: int) -> DataFrame:
    """How often each phrase of up to ``longest`` words occurs, if ``least`` times or more.

    Columns: ``lang``, ``words`` (how many; 0 for the row that counts all of a lang's words,
    which is there at any count), ``phrase`` (its words, a blank between two), ``f``.
    """
    names = [f"w{k}" for k in range(longest)]
    sums = (
        windows(docs, longest, least)
        .rollup("lang", *names)
        .agg(F.sum("c").alias("f"), F.grouping_id().alias("level"))
    )
    # a column is null where it is rolled up, and the bits of the level say so
    words = (F.lit(longest) - F.bit_count("level")).alias("words")
    last = F.coalesce(*[F.col(n) for n in reversed(names)], F.lit("-"))
    return (
        sums.filter(F.col("lang").isNotNull() & (F.bit_count("level") <= longest) & (last != ""))
        .filter((F.col("f") >= least) | (F.bit_count("level") == longest))
        .select("lang", words, F.concat_ws(" ", *names).alias("phrase"), "f")
    )


def _part(first: Column, many: Column) -> Column:
    return F.array_join(F.slice("w", first, many), " ")


def scored(found: DataFrame) -> DataFrame:
    """The phrases of two words or more in ``found`` (see ``counts``) with their worst cut.

    A cut after k words gives l, r (how often the parts occur) and the score
    floor(1000000 a a / (l r)); products are exact decimals, for counts below 10**16.
    """
    cuts = (
        found.filter("words >= 2")
        .select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
        .select(
            "lang",
            "phrase",
            "words",
            "a",
            "k",
            _part(F.lit(1), F.col("k")).alias("left"),
            _part(F.col("k") + 1, F.col("words") - F.col("k")).alias("right"),
        )
    )

    def part(side: str, count: str) -> DataFrame:
        """Counts of parts; merged, as both sides of the join grow with the documents."""
        own = found.filter("words >= 1")
        return own.select("lang", F.col("phrase").alias(side), F.col("f").alias(count)).hint("merge")

    both = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    # a and r below 10**16 each: the products stay below 10**38
    score = F.expr(
        "(CAST(a AS DECIMAL(16, 0)) * CAST(a AS DECIMAL(16, 0)) * 1000000BD)"
        " div (CAST(l AS DECIMAL(16, 0)) * CAST(r AS DECIMAL(16, 0)))"
    )
    return (
        both.withColumn("score", score)
        .groupBy("lang", "phrase", "words", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("worst"))
        .select("lang", "phrase", "words", "a", "worst.l", "worst.r", "worst.score")
    )


def _covered(found: DataFrame, longest: int) -> DataFrame:
    """Phrases inside longer ones, with the count of the most frequent of these."""
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), n ->"
        " transform(sequence(1, words - n + 1), i -> array_join(slice(w, i, n), ' '))))"
    )
    return (
        found.filter("words >= 3")
        .select("lang", "words", "f", F.split("phrase", " ").alias("w"))
        .select("lang", "f", F.explode(inner).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )


def mine(
    docs: DataFrame,
    longest: int = 3,
    least: int = 10,
    percent: int = 50,
    most: int = 2000,
    shortest: int = 2,
) -> DataFrame:
    """The ``most`` phrases of each lang whose words belong together most closely.

    A-Z is lower-cased, texts are cut into pieces at ``ENDS`` and these into words at ``BLANKS``.
    Candidates are phrases of ``shortest`` (2 or more) to ``longest`` words inside a piece that
    occur ``least`` times or more, overlaps included. One that lies inside a longer candidate with
    ``percent`` % of its count or more is dropped. They are ranked by score, then count, then
    phrase in order of UTF-8 bytes.

    Null and empty texts have no words; a null lang is ``UNKNOWN``; every row counts, also one
    that repeats another; an empty table gives no rows. A lang with no candidate has no row. Only
    ``text`` and ``lang`` are read, so further columns of any name do no harm. Counts are exact,
    and scores are for counts below 10**16.

    Columns: ``lang``, ``rank`` (from 1), ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of
    the parts of its worst cut), ``n`` (words of the lang), ``score``.
    """
    if not 2 <= shortest <= longest:
        raise ValueError(f"phrases have 2 words or more, not {shortest} to {longest}")
    found = settled(counts(docs, longest, least), "phrases")
    kept = scored(found).filter(F.col("words") >= shortest)
    if longest > shortest:
        kept = kept.join(_covered(found, longest).hint("merge"), ["lang", "phrase"], "left").filter(
            F.coalesce(100 * F.col("longer") < percent * F.col("a"), F.lit(True))
        )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    totals = found.filter("words = 0").select("lang", F.col("f").alias("n"))
    return (
        kept.withColumn("rank", F.row_number().over(order).cast("long"))
        .filter(F.col("rank") <= most)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
