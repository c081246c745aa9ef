"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1. A pass over the texts cuts them into pre-tokens. A block of texts keeps its pre-tokens as
   positions: for each, the slot of its word among the block's distinct words.
2. The distinct words of all blocks are exploded and shuffled by hash; a partition meets every
   occurrence of its words and encodes each of them once.
3. The ids go back to the blocks, are joined to the slots, and the texts are put together again
   by position.

So a frequent word costs one row per block, not one per occurrence, and is encoded once in all.
Decoding looks the bytes of each id up in the vocabulary's token table.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwatch.llm import texts
from fillwatch.session import shared_dir

#: The pattern that ``pre_tokens`` follows. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space in patterns (the Unicode property). Fixed value.
_SPACE = (*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
_LETTER, _NUMBER, _WHITE = 1, 2, 3

#: Bytes of text worked on at once, and code points in a block, about; a longer text is worked on
#: as a whole.
SLICE, BLOCK = 1 << 19, 1 << 23
#: A token table is sent to all executors; larger ones are refused.
MOST_TOKENS = 1 << 22

WordCoder = Callable[[list[bytes]], list[list[int]]]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    named = "".join(map(unicodedata.category, map(chr, range(0x110000)))).encode()  # two letters each
    major = np.frombuffer(named, np.uint8)[::2]
    kind = np.zeros(0x110000, np.uint8)
    kind[major == ord("L")] = _LETTER
    kind[major == ord("N")] = _NUMBER
    kind[list(_SPACE)] = _WHITE
    return kind


def pre_tokens(code: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the matches of ``PATTERN`` begin in texts laid end to end (``at``: their starts).

    Matches tile a text. A new one begins where the class of character changes, but a single
    blank goes with what follows it, other white space before a word gives up its last character,
    and an apostrophe that begins a match takes a contraction's letters.
    """
    n = len(code)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[code]
    first = np.zeros(n + 1, bool)
    first[at] = True
    first = first[:n]
    start = first.copy()
    start[1:] |= kind[1:] != kind[:-1]
    # white space right before something else of the same text
    after = np.flatnonzero(start[1:] & ~first[1:] & (kind[:-1] == _WHITE) & (kind[1:] != _WHITE)) + 1
    start[after - 1] = True
    start[after] = code[after - 1] != 32

    end = np.append(at[1:][np.searchsorted(at[1:], np.flatnonzero(start & (code == 39)), "right")], [])
    mark = np.flatnonzero(start & (code == 39))
    if len(mark):
        padded = np.append(code, [0, 0, 0])
        one, two = padded[mark + 1], padded[mark + 2]
        single = np.isin(one, [ord(c) for c in "stmd"])
        double = ((two == 101) & ((one == 114) | (one == 118))) | ((one == 108) & (two == 108))
        length = np.where(single, 2, np.where(double, 3, 0))
        length[mark + length > end] = 0
        mark, length, end = mark[length > 0], length[length > 0], end[length > 0]
        start[mark + 1] = False
        rest = mark + length
        rest = rest[rest < end]
        start[rest] = True
    return np.flatnonzero(start)


def distinct_words(
    code: np.ndarray, text: str, start: np.ndarray, slots: dict[str, int]
) -> np.ndarray:
    """The slot of each pre-token; words not met before are added to ``slots``.

    Pre-tokens are gathered by hash, and every one is compared with the first of its hash.
    """
    words, of = _distinct(code, text, start)
    return np.array([slots.setdefault(w, len(slots)) for w in words], np.int32)[of]


def _distinct(code: np.ndarray, text: str, start: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The pre-tokens of a slice, each once (but for hashes in common), and which one each is."""
    end = np.append(start[1:], len(code))
    length = end - start
    hashed = texts.Hasher(code, spread=False).spans(start, end)
    _, one, of = np.unique(hashed, return_index=True, return_inverse=True)
    shift = np.repeat(start[one][of] - start, length)
    same = np.array_equal(length[one][of], length) and np.array_equal(
        code, code[np.arange(len(code)) + shift]
    )
    if not same:  # two words share a hash: go through all of them
        one, of = np.arange(len(start)), np.arange(len(start))
    return [text[a:b] for a, b in zip(start[one].tolist(), end[one].tolist())], of


def _pressed(values: np.ndarray) -> bytes:
    """32-bit values, compressed byte by byte of equal weight."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=6).compress(planes.tobytes())


def _unpressed(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return planes.reshape(4, -1).T.copy().view("<u4")[:, 0].astype(np.int64)


def _pressed_rising(values: np.ndarray) -> bytes:
    return _pressed(np.diff(values, prepend=0))


def _unpressed_rising(data: bytes) -> np.ndarray:
    return np.cumsum(_unpressed(data))


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``: a join on it moves the other side only."""
    spark = df.sparkSession
    path, name = shared_dir(spark, "buckets"), f"fillwatch_{uuid.uuid4().hex}"
    (
        df.write.bucketBy(buckets, key)
        .option("path", path)
        .option("compression", "uncompressed")
        .saveAsTable(name, format="parquet")
    )
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, as the path was given
    return table


_BLOCKS = (
    "block long, doc_ids array<long>, counts binary, slots binary,"
    " parts array<struct<p: int, words: binary, lengths: binary, slots: binary>>"
)
_ENCODED = "block long, slots binary, counts binary, ids binary"
_IDS = "doc_id long, ids array<int>"


def blocks(docs: DataFrame, parts: int, most: int = BLOCK) -> DataFrame:
    """Texts in blocks of about ``most`` code points: pre-tokens as slots, and the distinct words in
    ``parts`` by hash."""

    def row(block: int, ids: list, counts: list, found: list, slots: dict[str, int]) -> dict:
        use = np.concatenate(found) if found else np.zeros(0, np.int32)
        order = np.argsort(-np.bincount(use, minlength=len(slots)), kind="stable")
        rank = np.empty(len(slots), np.int64)
        rank[order] = np.arange(len(slots))  # frequent words get small numbers
        words = [w.encode() for w in slots]
        size = np.array([len(w) for w in words], np.int64)
        begin = np.cumsum(size) - size
        flat = np.frombuffer(b"".join(words), np.uint8)
        part = texts.Hasher(flat).spans(begin, begin + size) % texts.U(parts)
        out = []
        press = zstandard.ZstdCompressor(level=6).compress
        for p, own in _grouped(part.astype(np.int64)):
            own = own[np.argsort(rank[own])]
            out.append(
                {
                    "p": p,
                    "words": press(b"".join([words[i] for i in own])),
                    "lengths": _pressed(size[own]),
                    "slots": _pressed_rising(rank[own]),
                }
            )
        return {
            "block": block,
            "doc_ids": ids,
            "counts": _pressed(np.array(counts, np.int64)),
            "slots": _pressed(rank[use]),
            "parts": out,
        }

    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("doc_ids", pa.list_(pa.int64())),
            ("counts", pa.binary()),
            ("slots", pa.binary()),
            (
                "parts",
                pa.list_(
                    pa.struct(
                        [("p", pa.int32()), ("words", pa.binary()), ("lengths", pa.binary()), ("slots", pa.binary())]
                    )
                ),
            ),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, counts, found, slots, size = [], [], [], {}, 0
        for batch in batches:
            for low, high, own in texts.pieces(batch.column("text"), SLICE):
                code, begin = texts.code_points(own)
                start = pre_tokens(code, begin)
                ids += batch.column("doc_id").slice(low, high - low).to_pylist()
                counts += np.diff(np.searchsorted(start, begin)).tolist()
                if len(start):
                    found.append(distinct_words(code, "".join(own), start, slots))
                size += len(code)
                if size >= most:
                    yield pa.RecordBatch.from_pylist([row(block, ids, counts, found, slots)], schema)
                    ids, counts, found, slots, size = [], [], [], {}, 0
                    block += 1
        if ids:
            yield pa.RecordBatch.from_pylist([row(block, ids, counts, found, slots)], schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, _BLOCKS)


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch of large rows, only one of them at a time as Python objects."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _grouped(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(keys, kind="stable")
    cut = np.flatnonzero(np.diff(keys[order])) + 1
    for own in np.split(order, cut):
        if len(own):
            yield int(keys[own[0]]), own


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: adjacent parts of least rank are merged, the leftmost first.

    The parts are a linked list and the possible merges a heap, so a long word takes n log n steps.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    part: list[bytes | None] = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[word[i : i + 2]], i, 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, length = heapq.heappop(heap)
        own = part[i]
        j = after[i]
        if own is None or j >= n or len(own) + len(part[j]) != length:
            continue
        part[i], part[j] = own + part[j], None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            rank = ranks.get(part[i] + part[k])
            if rank is not None:
                heapq.heappush(heap, (rank, i, length + len(part[k])))
        h = before[i]
        if h >= 0:
            rank = ranks.get(part[h] + part[i])
            if rank is not None:
                heapq.heappush(heap, (rank, h, len(part[h]) + length))
    return [ranks[p] for p in part if p is not None]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a line for each token, its bytes in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def rank_coder(spark: SparkSession, ranks: dict[bytes, int]) -> Callable[[], WordCoder]:
    """A coder of words by ranks, for ``encode``; the ranks are as many as the vocabulary."""
    shared = spark.sparkContext.broadcast(_bounded(ranks))
    return lambda: lambda words: [merge(w, shared.value) for w in words]


def _bounded(table: dict) -> dict:
    if len(table) > MOST_TOKENS:
        raise ValueError(f"a vocabulary of {len(table)} tokens is too large to send to all executors")
    return table


def _gather(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Indices of ranges one after another."""
    done = np.cumsum(count)
    return np.arange(done[-1] if len(done) else 0) + np.repeat(begin - (done - count), count)


def encode(
    docs: DataFrame,
    coder: Callable[[], WordCoder],
    parts: int | None = None,
    width: int = 4,
    packed: bool = True,
    block: int = BLOCK,
) -> DataFrame:
    """Token ids of each row's whole text.

    ``coder()`` runs in a task and gives the function that encodes words, see ``rank_coder``.
    ``parts`` is the number of partitions of the distinct words, Spark's number of shuffle
    partitions unless given; one of them holds its words in memory. A task holds a block of ``block`` code points
    at a time; smaller ones take less memory and send words more often. Null and empty texts have no
    ids; rows alike or with a null ``doc_id`` are encoded each for itself; an empty table gives no
    rows. Only ``doc_id`` and ``text`` are read.

    Columns: ``doc_id``, ``ids``, ``packed`` (the ids as little-endian unsigned integers of
    ``width`` bytes, 2 or 4; an id that does not fit is an error). Without ``packed`` it is left out.
    """
    kind = {2: "<u2", 4: "<u4"}[width]
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = _bucketed(blocks(docs, parts, block), "block", parts)

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = coder()
        known: dict[bytes, list[int]] = {}
        part = None
        unpress = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for row in _one_by_one(batch):
                if row["p"] != part:
                    known, part = {}, row["p"]
                flat, words, at = unpress(row["words"]), [], 0
                for n in _unpressed(row["lengths"]).tolist():
                    words.append(flat[at : at + n])
                    at += n
                new = [w for w in words if w not in known]
                known.update(zip(new, to_ids(new)))
                ids = [known[w] for w in words]
                out.append(
                    {
                        "block": row["block"],
                        "slots": row["slots"],
                        "counts": _pressed(np.array([len(x) for x in ids], np.int64)),
                        "ids": _pressed(np.array([i for x in ids for i in x], np.int64)),
                    }
                )
            names = pa.schema([("block", pa.int64()), *((n, pa.binary()) for n in ("slots", "counts", "ids"))])
            yield pa.RecordBatch.from_pylist(out, names)

    coded = (
        held.select("block", F.explode("parts").alias("w"))
        .select("w.p", "block", "w.words", "w.lengths", "w.slots")
        .repartition(parts, "p")
        .sortWithinPartitions("p")
        .mapInArrow(encode_words, _ENCODED)
        .groupBy("block")
        .agg(F.collect_list(F.struct("slots", "counts", "ids")).alias("coded"))
    )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                coded = row["coded"] or []
                slot = [_unpressed_rising(c["slots"]) for c in coded]
                size = [_unpressed(c["counts"]) for c in coded]
                flat = np.concatenate([_unpressed(c["ids"]) for c in coded] or [np.zeros(0, np.int64)])
                n = sum(map(len, slot))
                count, begin = np.zeros(n, np.int64), np.zeros(n, np.int64)
                if n:
                    slot, size = np.concatenate(slot), np.concatenate(size)
                    count[slot], begin[slot] = size, np.cumsum(size) - size
                if len(flat) and int(flat.max()) >= 1 << (8 * width):
                    raise ValueError(f"an id of {int(flat.max())} does not fit into {width} bytes")
                flat = flat.astype(kind)
                word = np.append(0, np.cumsum(_unpressed(row["counts"])))
                use = _unpressed(row["slots"])
                for low, high in texts.slices(word, SLICE):
                    own = use[word[low] : word[high]]
                    each = count[own]
                    ids = flat[_gather(begin[own], each)]
                    at = np.append(0, np.cumsum(each))[word[low : high + 1] - word[low]]
                    out = {
                        "doc_id": pa.array(row["doc_ids"][low:high], pa.int64()),
                        "ids": pa.ListArray.from_arrays(
                            pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))
                        ),
                    }
                    if packed:
                        out["packed"] = pa.Array.from_buffers(
                            pa.binary(), high - low, [None, pa.py_buffer((at * width).astype(np.int32)), pa.py_buffer(ids)]
                        )
                    yield pa.record_batch(out)

    return (
        held.drop("parts")
        .join(coded, "block", "left")
        .select("doc_ids", "counts", "slots", "coded")
        .mapInArrow(assemble, _IDS + (", packed binary" if packed else ""))
    )


#: Words that a Python worker remembers with their ids, in each of two generations.
REMEMBERED = 250_000


class Memory:
    """Words and their ids as bytes; those not met for a generation are forgotten."""

    def __init__(self, most: int):
        self.most = most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def coded(self, words: list[str], code: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The ids of each word; ``code`` gives those of words not remembered."""
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = dict.fromkeys([w for w in words if w not in young])
        again = {w: old[w] for w in missing if w in old}
        young.update(again)
        new = [w for w in missing if w not in again]
        young.update(zip(new, code(new)))
        return [young[w] for w in words]


#: What this worker's tasks have met and its coders, by the name of the coder and the width of its ids.
_MEMORIES: dict[tuple[str, int], tuple[Memory, WordCoder]] = {}


def _remembered(coder: Callable[[], WordCoder], name: str, width: int) -> tuple[Memory, WordCoder]:
    """The memory and the coder of this worker. Tasks reach them by a function of this module: what
    a task's own function names is sent along with it, a fresh copy for each task."""
    if not name:
        return Memory(REMEMBERED), coder()
    if (name, width) not in _MEMORIES:
        _MEMORIES[name, width] = Memory(REMEMBERED), coder()
    return _MEMORIES[name, width]


def added_spans(own: list[str], begin: np.ndarray, added: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the strings ``added`` in texts laid end to end, the longest at a place."""
    pattern = re.compile("|".join(re.escape(a) for a in sorted(added, key=len, reverse=True)))
    found = [
        (at + m.start(), at + m.end())
        for at, text in zip(begin.tolist(), own)
        if any(a in text for a in added)
        for m in pattern.finditer(text)
    ]
    both = np.array(found, np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


Batches = Iterator[pa.RecordBatch]


def encoder_in_place(
    coder: Callable[[], WordCoder],
    width: int = 4,
    added: Sequence[str] = (),
    name: str = "",
) -> Callable[[Batches], Batches]:
    """What ``encode_in_place`` does in a task: batches of ``doc_id`` and ``text`` in, ``doc_id`` and ``packed`` out.

    For tasks that go on with the ids themselves, so that no second worker has to get them.
    """
    kind = {2: "<u2", 4: "<u4"}[width]

    def work(batches: Batches) -> Batches:
        memory, to_ids = _remembered(coder, name, width)

        def coded_bytes(words: list[str]) -> list[bytes]:
            ids = to_ids([w.encode() for w in words])
            flat = np.fromiter(chain.from_iterable(ids), np.int64)
            if len(flat) and int(flat.max()) >= 1 << (8 * width):
                raise ValueError(f"an id of {int(flat.max())} does not fit into {width} bytes")
            data = flat.astype(kind).tobytes()
            end = (np.cumsum([len(own) for own in ids], dtype=np.int64) * width).tolist()
            return [data[a:b] for a, b in zip([0, *end], end)]

        for batch in batches:
            for low, high, own in texts.pieces(batch.column("text"), 2 * SLICE):
                code, begin = texts.code_points(own)
                opens, closes = added_spans(own, begin, added) if added else (begin[:0], begin[:0])
                start = pre_tokens(code, np.sort(np.concatenate([begin, opens, closes])))
                if len(opens):
                    span = np.searchsorted(opens, start, "right") - 1
                    start = start[(span < 0) | (start == opens[span]) | (start >= closes[span])]
                words, of = _distinct(code, "".join(own), start) if len(start) else ([], start)
                coded = memory.coded(words, coded_bytes)
                count = np.fromiter(map(len, coded), np.int64, len(coded)) // width
                flat = np.frombuffer(b"".join(coded), kind)
                each = count[of]
                ids = flat[_gather((np.cumsum(count) - count)[of], each)]
                done = np.append(0, np.cumsum(each))[np.searchsorted(start, begin)]
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").slice(low, high - low),
                        "packed": pa.Array.from_buffers(
                            pa.binary(), high - low, [None, pa.py_buffer((done * width).astype(np.int32)), pa.py_buffer(ids)]
                        ),
                    }
                )

    return work


def encode_in_place(
    docs: DataFrame,
    coder: Callable[[], WordCoder],
    width: int = 4,
    added: Sequence[str] = (),
    name: str = "",
) -> DataFrame:
    """``doc_id`` and ``packed`` as ``encode`` gives them, row by row in the order of ``docs``.

    Each place where a string of ``added`` stands is one word for the coder, and the text before
    and after it is cut into words as a text of its own.

    Nothing is shuffled: each task encodes the words that it has not met before, and with a
    ``name``, which must tell the coder from all others, that its Python worker has not met. For
    texts that must stay where they are, such as sorted ones; ``encode`` encodes a word once in all.
    """
    work = encoder_in_place(coder, width, added, name)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "doc_id long, packed binary")


def token_table(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """The bytes of each id."""
    return spark.createDataFrame(
        [(i, bytearray(t)) for t, i in _bounded(ranks).items()], "id int, bytes binary"
    )


def decode(encoded: DataFrame, tokens: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``encoded`` (with ``ids``), or its columns in ``keep``, and the bytes of its ids as ``decoded``.

    ``tokens`` (``id``, ``bytes``) has a row for each token of a vocabulary; as many as
    ``MOST_TOKENS`` are sent to all tasks and joined there, more are refused. Null ids decode to
    null, no ids to no bytes, and an id that the table lacks makes its row null.
    """
    rows = tokens.select("id", "bytes").limit(MOST_TOKENS + 1).toArrow()
    table = _bounded(dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())))
    shared = encoded.sparkSession.sparkContext.broadcast(table)
    names = [c for c in (encoded.columns if keep is None else keep) if c != "decoded"]
    schema = encoded.select(*names).schema.add("decoded", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = max(shared.value, default=-1) + 1
        size = np.full(top + 1, -1, np.int64)  # the last stands for ids out of range
        for i, value in shared.value.items():
            size[i] = len(value)
        flat = np.frombuffer(b"".join(shared.value.get(i, b"") for i in range(top)), np.uint8)
        begin = np.cumsum(np.maximum(size, 0)) - np.maximum(size, 0)
        for batch in batches:
            ids = batch.column("ids")
            at = np.append(0, np.cumsum(np.nan_to_num(ids.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            every = ids.flatten().to_numpy(zero_copy_only=False)
            for low, high in texts.slices(at, SLICE):
                own = every[at[low] : at[high]].astype(np.int64)
                own[(own < 0) | (own >= top)] = top
                each = np.maximum(size[own], 0)
                data = flat[_gather(begin[own], each)].tobytes()
                cut = np.append(0, np.cumsum(each))[at[low : high + 1] - at[low]].tolist()
                lacks = np.append(0, np.cumsum(size[own] < 0))[at[low : high + 1] - at[low]]
                good = (np.diff(lacks) == 0) & ids.is_valid().to_numpy(zero_copy_only=False)[low:high]
                decoded = [data[a:b] if ok else None for a, b, ok in zip(cut[:-1], cut[1:], good.tolist())]
                part = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in names), pa.array(decoded, pa.binary())],
                    names=[*names, "decoded"],
                )

    return encoded.select(*dict.fromkeys([*names, "ids"])).mapInArrow(work, schema)
