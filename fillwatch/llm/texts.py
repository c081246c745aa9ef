"""Column expressions and array helpers on whole texts, used by several operators.

The array part works on the buffers of an Arrow string column: one pass finds all words of many
texts and one more hashes them, without a Python object for each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: White space of the word rules, as a regular expression class and as characters. Fixed values.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
U = np.uint64


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lowest(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """Up to ``most`` rows of each group, those whose key has the lowest hash.

    Rows whose hash is far from the lowest are dropped where they are read: twice what is wanted
    gets past that, out of however many rows, so the task that ranks a group's rows stays small.
    Groups are few, a label or a language each, and callers hold a row of each on the driver; the
    table of their sizes is broadcast, so the drop comes before any rows are shuffled.
    """
    order = Window.partitionBy(group).orderBy("_hash", key)
    sizes = rows.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_size"))
    near = F.col("_hash").cast("double") / 2.0**64 + 0.5 <= 2.0 * most / F.col("_size")
    return (
        rows.withColumn("_hash", F.xxhash64(key))
        .join(F.broadcast(sizes), F.col(group) == F.col("_group"))
        .filter(near)
        .withColumn("_number", F.row_number().over(order))
        .filter(F.col("_number") <= most)
        .select(*rows.columns)
    )


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def without_spaces(text: Column) -> Column:
    """``text`` without any character of ``SPACES``."""
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after another, and where each begins (one entry more); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The same for binary values."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts one after another, and where each begins (one entry more)."""
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=at[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), at


def slices(at: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``limit`` units each; a longer text is a run of its own."""
    low = 0
    while low < len(at) - 1:
        high = max(low + 1, int(np.searchsorted(at, at[low] + limit, "right")) - 1)
        yield low, high
        low = high


def pieces(column: pa.Array, limit: int) -> Iterator[tuple[int, int, list[str]]]:
    """Runs of rows of about ``limit`` bytes of text, and their texts; null is empty."""
    for low, high in slices(utf8(column)[1], limit):
        yield low, high, [t or "" for t in column.slice(low, high - low).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over the whole."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, up to 2**bits of them."""
    out = []
    for base in (_BASE, _INVERSE):
        power = np.full(1 << bits, base, U)
        power[0] = 1
        np.multiply.accumulate(power, out=power)
        out.append(power)
    return out[0], out[1]


class Hasher:
    """Hashes of spans of a sequence, each in constant time after one pass.

    The hash of a span is a polynomial in an odd base modulo 2**64 with its length, mixed; it
    depends on the span's content only. ``spread`` mixes the values too; without it, hashes are
    cheaper and for use where equal ones are compared.
    """

    def __init__(self, values: np.ndarray, spread: bool = True):
        self.power, self.inverse = _powers(max(20, int(len(values)).bit_length()))
        self.sums = np.zeros(len(values) + 1, U)
        own = mix(values.astype(U) + U(1)) if spread else values.astype(U) + U(1)
        np.cumsum(own * self.power[: len(values)], out=self.sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * self.inverse[start]
        return mix(value + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def runs(inside: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, no run going from one text into the next."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    begin = at[:-1][at[:-1] < len(inside)]
    first[begin] = inside[begin]
    before = begin[begin > 0] - 1
    last[before] = inside[before]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


_IS_WORD = np.ones(256, bool)
_IS_WORD[[ord(c) for c in SPACES]] = False


def byte_words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in UTF-8 bytes, and the first word of each text (one more)."""
    start, end = runs(_IS_WORD[data], at)
    return start, end, np.searchsorted(start, at)
