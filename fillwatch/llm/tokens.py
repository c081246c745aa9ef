"""Token ids in binary files, and a minimal perfect hash index over them.

Files: records in ascending key order, a file for each range of keys. A file holds the ids of all
its records one after another (``width`` bytes each, little-endian), then the first id of each
record and the number of all ids (8 bytes each), then a footer (``FOOTER``). So any record is found
by two reads of fixed place and size.

Index: keys are dealt into buckets by hash. A bucket has a minimal perfect hash over its keys,
built by levels: a key that is alone at its place of a level's bit field is settled there, the rest
go on to the next level, and a key's slot is the number of set bits before its own. A slot stores a
fingerprint of its key, which refuses keys that are not in the index, and the key's runs of
records. A look-up takes the same few steps whatever the number of keys.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Callable, Iterator
from urllib.parse import urlparse

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fillwatch.llm import bpe, texts
from fillwatch.llm.near import complete_runs
from fillwatch.session import settled

FOOTER, MAGIC = "<8sIIQQ", b"FWTOKENS"
#: Keys in an index bucket, on average; one task holds one.
BUCKET_KEYS = 1 << 16
#: Bit field places for each key of a level, and bytes of ids read at once.
SPARSE, READ = 2, 1 << 23
#: Up to this character, Python and the library know the same letters, numbers and blanks. Fixed value.
SURE = 0x7FF

_RUNS = "doc_id long, file string, shard int, record long, records long, tokens long"


def _byte_letters() -> np.ndarray:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    letters = np.zeros(256, "<u2")
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = np.setdiff1d(np.arange(256), own)
    letters[own], letters[rest] = own, 256 + np.arange(len(rest))
    return letters


def _is_byte_level(file: dict) -> bool:
    """Whether the library does nothing to a word of ``bpe.PATTERN`` but write its bytes as letters and merge."""
    before = file.get("pre_tokenizer") or {}
    return (
        file.get("normalizer") is None
        and file["model"].get("type") == "BPE"
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
    )


def library_coder(spark: SparkSession, path: str) -> Callable[[], bpe.WordCoder]:
    """A coder of words by a tokenizer file of the tokenizers library, for ``bpe.encode``.

    Where the file is plain byte-level BPE, words go to the library's model as they are: cutting a
    word that is cut already and making an encoding of each took more time than the merges. Words of
    characters above ``SURE``, or that hold an added token, take the library's whole way.
    """
    with open(path, encoding="utf-8") as file:
        text = file.read()
    shared = spark.sparkContext.broadcast(text)
    plain = _is_byte_level(json.loads(text))
    added = [token["content"].encode() for token in json.loads(text).get("added_tokens") or []]

    def coder() -> bpe.WordCoder:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        known = Tokenizer.from_str(shared.value)

        def whole(words: list[bytes]) -> list[list[int]]:
            shown = [w.decode() for w in words]
            return [e.ids for e in known.encode_batch_fast(shown, add_special_tokens=False)]

        letters, tokenize, sure = _byte_letters(), known.model.tokenize, chr(SURE).encode()[0]

        def merged(words: list[bytes]) -> list[list[int]]:
            data = b"".join(words)
            raw = np.frombuffer(data, np.uint8)
            end = np.cumsum([len(w) for w in words], dtype=np.int64)
            odd = set(np.searchsorted(end, np.flatnonzero(raw > sure), "right").tolist())
            if any(a in data for a in added):
                odd.update(i for i, w in enumerate(words) if any(a in w for a in added))
            shown = letters[raw].tobytes().decode("utf-16-le")
            cut = end.tolist()
            ids = [[t.id for t in tokenize(shown[a:b])] for a, b in zip([0, *cut], cut)]
            if odd:
                at = sorted(odd)
                for i, own in zip(at, whole([words[i] for i in at])):
                    ids[i] = own
            return ids

        return merged if plain else whole

    return coder


def name_of(path: str) -> str:
    """A name for the coder of a tokenizer file: two files have one only if they are alike."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def added_tokens(path: str) -> list[str]:
    """The strings of a tokenizer file that have an id of their own wherever they stand in a text."""
    with open(path, encoding="utf-8") as file:
        added = json.load(file).get("added_tokens") or []
    for token in added:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError(f"{token['content']!r} takes in what is around it, which is not supported")
    return [token["content"] for token in added]


def _place(path: str) -> tuple[fs.FileSystem, str]:
    if urlparse(path).scheme in ("", "file"):
        return fs.LocalFileSystem(), urlparse(path).path
    return fs.FileSystem.from_uri(path)


def write(
    docs: DataFrame,
    path: str,
    encode: Callable[[DataFrame], DataFrame] | None = None,
    end: int | None = None,
    width: int = 4,
    encoder: Callable[[bpe.Batches], bpe.Batches] | None = None,
) -> DataFrame:
    """Writes the ids of each row's text to files under ``path`` and returns what is where.

    ``docs`` has ``doc_id`` and ``text``; ``encode`` gives ``doc_id`` and ``packed``, ids of
    ``width`` bytes each, for rows in their order (``bpe.encode_in_place``); an ``encoder`` in its place
    does so in the tasks that write (``bpe.encoder_in_place``), with one Python worker each and not two.
    Records are in
    ascending ``doc_id``, null last; rows of one ``doc_id`` are records of their own. ``end`` is
    appended to each. A file is named after its task's attempt, so a repeated task leaves an unused
    file and never a broken one.

    Columns: a row for each run of records of one key in a file: ``doc_id``, ``file``, ``shard``,
    ``record`` (its first, from 0), ``records``, ``tokens``.
    """
    kind = {2: "<u2", 4: "<u4"}[width]

    def keyed(batches: bpe.Batches) -> bpe.Batches:
        for batch in batches:
            key = batch.column("doc_id")
            columns = [key, batch.column("packed"), key.fill_null(0), key.is_null().cast(pa.int8())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "packed", "shown", "missing"])

    def work(batches: bpe.Batches) -> bpe.Batches:
        task = TaskContext.get()
        shard = task.partitionId()
        store, folder = _place(path)
        name = f"shard-{shard:06d}-{task.taskAttemptId()}.ids"
        starts, done, first_record, out = [], 0, 0, None
        for table, cut in complete_runs(keyed(encoder(batches) if encoder else batches), ["shown", "missing"]):
            if out is None:
                store.create_dir(folder, recursive=True)
                out = store.open_output_stream(f"{folder}/{name}")
            data, at = texts.bytes_of(table.column("packed"))
            ids, count = data.view(kind), np.diff(at) // width
            if end is not None:
                ids = np.insert(ids, at[1:] // width, end)
                count = count + 1
            out.write(ids.tobytes())
            begin = done + np.cumsum(count) - count
            starts.append(begin)
            done += int(count.sum())
            yield pa.record_batch(
                {
                    "doc_id": table.column("doc_id").combine_chunks().take(pa.array(cut[:-1])),
                    "file": pa.array([name] * (len(cut) - 1), pa.string()),
                    "shard": pa.array(np.full(len(cut) - 1, shard, np.int32)),
                    "record": pa.array(first_record + cut[:-1].astype(np.int64)),
                    "records": pa.array(np.diff(cut).astype(np.int64)),
                    "tokens": pa.array(np.add.reduceat(count, cut[:-1]).astype(np.int64)),
                }
            )
            first_record += table.num_rows
        if out is not None:
            out.write(np.append(np.concatenate(starts), done).astype("<u8").tobytes())
            out.write(struct.pack(FOOTER, MAGIC, 1, width, first_record, done))
            out.close()

    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ordered = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    rows = ordered if encoder else encode(ordered).select("doc_id", "packed")
    return settled(rows.mapInArrow(work, _RUNS), "tokens")


def _hash(keys: np.ndarray, seed: int) -> np.ndarray:
    return texts.mix(keys.astype(np.int64).view(np.uint64) ^ texts.mix(np.full(1, seed + 1, np.uint64)))


class PerfectHash:
    """A minimal perfect hash over distinct integers: ``slots`` gives each its own of 0..n-1."""

    def __init__(self, sizes: list[int], bits: list[np.ndarray]):
        self.sizes, self.bits = sizes, bits
        self.before = np.append(0, np.cumsum([int(b.sum()) for b in bits])).astype(np.int64)
        self.ranks = [np.cumsum(b) - 1 for b in bits]

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, bits = [], []
        while len(keys):
            size = max(8, SPARSE * len(keys))
            at = (_hash(keys, len(sizes)) % texts.U(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            bits.append(alone)
            keys = keys[~alone[at]]
        return cls(sizes, bits)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for some keys that are not in the hash."""
        slot = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            at = (_hash(keys[open_], level) % texts.U(size)).astype(np.int64)
            hit = self.bits[level][at]
            slot[open_[hit]] = self.before[level] + self.ranks[level][at[hit]]
            open_ = open_[~hit]
        return slot

    def packed(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], "<u8").tobytes()
        return head + b"".join(np.packbits(b).tobytes() for b in self.bits)

    @classmethod
    def unpacked(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<u8", 1)[0])
        sizes = np.frombuffer(data, "<u8", n, 8).astype(int).tolist()
        bits, at = [], 8 * (n + 1)
        for size in sizes:
            end = at + -(-size // 8)
            bits.append(np.unpackbits(np.frombuffer(data[at:end], np.uint8), count=size).astype(bool))
            at = end
        return cls(sizes, bits)


_INDEX = "bucket int, hash binary, fingerprints binary, starts binary, shards binary, records binary, counts binary"


def _bucketed(keys: DataFrame, buckets: int) -> DataFrame:
    """Null keys are a bucket of their own, -1."""
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")
    return keys.withColumn("bucket", F.when(F.col("doc_id").isNull(), -1).otherwise(spread))


def buckets_of(runs: DataFrame) -> int:
    return max(1, -(-runs.count() // BUCKET_KEYS))


def index(runs: DataFrame, buckets: int) -> DataFrame:
    """The index over ``runs`` (as ``write`` returns them): a row for each bucket of keys.

    A key with records in several files has a run in each; it has one slot all the same.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cut in complete_runs(batches, ["bucket"]):
            for low, high in zip(cut[:-1].tolist(), cut[1:].tolist()):
                part = table.slice(low, high - low).to_pydict()
                key = np.array([k or 0 for k in part["doc_id"]], np.int64)
                distinct, of = np.unique(key, return_inverse=True)
                perfect = PerfectHash.build(distinct)
                slot = perfect.slots(distinct)
                prints = np.empty(len(distinct), np.uint64)
                prints[slot] = _hash(distinct, 1 << 20)
                order = np.argsort(slot[of], kind="stable")
                starts = np.append(0, np.cumsum(np.bincount(slot[of], minlength=len(distinct))))
                values = {
                    "hash": perfect.packed(),
                    "fingerprints": (prints >> texts.U(32)).astype("<u4").tobytes(),
                    "starts": starts.astype("<u8").tobytes(),
                    "shards": np.array(part["shard"], "<i4")[order].tobytes(),
                    "records": np.array(part["record"], "<u8")[order].tobytes(),
                    "counts": np.array(part["records"], "<u8")[order].tobytes(),
                }
                yield pa.record_batch(
                    {
                        "bucket": pa.array([part["bucket"][0]], pa.int32()),
                        **{k: pa.array([v], pa.binary()) for k, v in values.items()},
                    }
                )

    return (
        _bucketed(runs.select("doc_id", "shard", "record", "records"), buckets)
        .repartition("bucket")
        .sortWithinPartitions("bucket", "doc_id", "shard", "record")
        .mapInArrow(work, _INDEX)
    )


def find(keys: DataFrame, built: DataFrame, buckets: int) -> DataFrame:
    """The runs of records of each distinct key (``doc_id``); keys that the index lacks give none.

    Columns: ``doc_id``, ``shard``, ``record``, ``records``.
    """

    def look_up(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names = ["doc_id", "shard", "record", "records"]
        if not len(asked) or not len(rows):
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in names})
        row = rows.iloc[0]
        missing = int(row["bucket"]) == -1
        key = np.zeros(len(asked), np.int64) if missing else asked["doc_id"].to_numpy().astype(np.int64)
        slot = PerfectHash.unpacked(row["hash"]).slots(key)
        prints = np.frombuffer(row["fingerprints"], "<u4")
        good = (slot >= 0) & (prints[slot] == (_hash(key, 1 << 20) >> texts.U(32)).astype(np.uint32))
        key, slot = key[good], slot[good]
        starts = np.frombuffer(row["starts"], "<u8").astype(np.int64)
        count = starts[slot + 1] - starts[slot]
        run = bpe._gather(starts[slot], count)
        return pd.DataFrame(
            {
                "doc_id": pd.array(np.repeat(key, count), "Int64") if not missing else pd.array([None] * len(run), "Int64"),
                "shard": np.frombuffer(row["shards"], "<i4")[run],
                "record": np.frombuffer(row["records"], "<u8")[run].astype(np.int64),
                "records": np.frombuffer(row["counts"], "<u8")[run].astype(np.int64),
            }
        )

    asked = _bucketed(keys.select(F.col("doc_id").cast("long")).distinct(), buckets)
    return (
        asked.groupBy("bucket")
        .cogroup(built.groupBy("bucket"))
        .applyInPandas(look_up, "doc_id long, shard int, record long, records long")
    )


def read(runs: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """The ids of the records in ``runs`` (``doc_id``, ``shard``, ``record``, ``records``).

    ``files`` (``shard``, ``file``) names each shard's file. Records that lie side by side are read
    together, ``READ`` bytes of ids at a time. ``start`` counts the ids before a record in its file.

    Columns: ``doc_id``, ``shard``, ``start``, ``packed`` (little-endian unsigned 32-bit integers).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _place(path)
        file, name, width = None, None, 0
        n_ids = n_records = 0
        for batch in batches:
            part = batch.to_pydict()
            keys = part["doc_id"]
            at = 0
            while at < len(keys):
                if part["file"][at] != name:
                    name = part["file"][at]
                    file = store.open_input_file(f"{folder}/{name}")
                    end = file.size() - struct.calcsize(FOOTER)
                    magic, _, width, n_records, n_ids = struct.unpack(FOOTER, file.read_at(struct.calcsize(FOOTER), end))
                    if magic != MAGIC:
                        raise ValueError(f"{name} is not a token file")
                # runs that follow each other without a gap
                stop = at + 1
                while (
                    stop < len(keys)
                    and part["file"][stop] == name
                    and part["record"][stop] == part["record"][stop - 1] + part["records"][stop - 1]
                ):
                    stop += 1
                first = part["record"][at]
                count = np.array(part["records"][at:stop], np.int64)
                owner = np.repeat(np.arange(at, stop), count)
                raw = file.read_at(8 * (len(owner) + 1), n_ids * width + 8 * first)
                starts = np.frombuffer(raw, "<u8").astype(np.int64)
                for low, high in texts.slices(starts, READ // width):
                    size = int(starts[high] - starts[low])
                    raw = file.read_at(size * width, int(starts[low]) * width)
                    ids = np.frombuffer(raw, "<u2" if width == 2 else "<u4").astype("<u4")
                    offsets = ((starts[low : high + 1] - starts[low]) * 4).astype(np.int32)
                    yield pa.record_batch(
                        {
                            "doc_id": pa.array([keys[i] for i in owner[low:high].tolist()], pa.int64()),
                            "shard": pa.array([part["shard"][at]] * (high - low), pa.int32()),
                            "start": pa.array(starts[low:high]),
                            "packed": pa.Array.from_buffers(
                                pa.binary(), high - low, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]
                            ),
                        }
                    )
                at = stop

    return (
        runs.join(files, "shard")
        .select("doc_id", "shard", "record", "records", "file")
        .repartitionByRange("shard", "record")
        .sortWithinPartitions("shard", "record")
        .mapInArrow(work, "doc_id long, shard int, start long, packed binary")
    )


def files_of(runs: DataFrame) -> DataFrame:
    """A row for each file: ``shard``, ``file``, ``base`` (the ids in all files before it)."""
    each = runs.groupBy("shard", "file").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy().orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return each.select(
        "shard", "file", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base")
    )
