"""Token files against the library, and the index against a dictionary."""

import struct
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from fillwatch.llm import bpe, tokens
from fillwatch.llm.queries import QUERIES
from fillwatch.session import shared_dir


def test_perfect_hash_is_minimal_and_refuses_none_of_its_keys():
    for n in (0, 1, 2, 1000):
        keys = np.unique(np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n))
        made = tokens.PerfectHash.build(keys)
        again = tokens.PerfectHash.unpacked(made.packed())
        assert sorted(again.slots(keys).tolist()) == list(range(len(keys)))


def test_write_find_and_read(spark):
    rows = [(5, [1, 2]), (3, []), (None, [7]), (5, [9]), (-4, [70000 % 65536]), (None, [8, 8])]
    table = spark.createDataFrame(
        [(k, " ".join(f"{i}" for i in v)) for k, v in rows], "doc_id long, text string"
    )
    folder = shared_dir(spark, "test")
    numbers = lambda: lambda words: [[int(w)] for w in words]
    runs = tokens.write(table, folder, lambda d: bpe.encode_in_place(d, numbers, 2), end=2, width=2)
    index = tokens.index(runs, 3)
    asked = spark.createDataFrame([(5,), (5,), (3,), (None,), (-4,), (77,)], "doc_id long")
    found = tokens.find(asked, index, 3)
    files = tokens.files_of(runs)
    got = tokens.read(found, files.select("shard", "file"), folder).join(files, "shard").collect()
    ids = {}
    for r in sorted(got, key=lambda r: r.base + r.start):
        ids.setdefault(r.doc_id, []).append(list(struct.unpack(f"<{len(r.packed) // 4}I", r.packed)))
    assert sorted(map(str, ids.pop(5))) == ["[1, 2, 2]", "[9, 2]"]
    assert sorted(map(str, ids.pop(None))) == ["[7, 2]", "[8, 8, 2]"]
    assert ids == {3: [[2]], -4: [[70000 % 65536, 2]]}
    order = [r.doc_id for r in sorted(got, key=lambda r: r.base + r.start)]
    assert order == [-4, 3, 5, 5, None, None]


def test_an_id_too_wide_is_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(Exception, match="does not fit"):
        bpe.encode(docs, lambda: lambda words: [[70000] for _ in words], width=2).collect()
    with pytest.raises(Exception, match="does not fit"):
        bpe.encode_in_place(docs, lambda: lambda words: [[70000] for _ in words], width=2).collect()


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    same = lambda: lambda words: [[1] for _ in words]
    runs = tokens.write(none, shared_dir(spark, "test"), lambda d: bpe.encode_in_place(d, same), end=2)
    asked = spark.createDataFrame([(1,)], "doc_id long")
    assert runs.count() == 0 and tokens.find(asked, tokens.index(runs, 1), 1).count() == 0


def test_query_on_the_whole_table(spark, small):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r for r in QUERIES["op7_token_files"](spark, small).collect()}
    start = 0
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [2]
        r = got.pop(d.doc_id)
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)
    assert not got


def test_added_tokens_have_their_one_id(spark, tmp_path):
    end = "<|endoftext|>"
    made = [f"a{end}b", end, f"{end}{end}", f"word  {end}  word's{end}'s", f"{end[:-1]} <|endoftext |>", "plain", "",
            f"é\U0001f600 {end}\n\n x", f"a<{end}>b"]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [library.encode(t, add_special_tokens=False).ids for t in made]
    assert want[0] == [64, 50256, 65]
    path = P.path("byte_bpe_50k.json")
    coder = tokens.library_coder(spark, path)
    got = bpe.encode_in_place(docs, coder, 2, tokens.added_tokens(path)).collect()
    assert [list(struct.unpack(f"<{len(r.packed) // 2}H", r.packed)) for r in sorted(got, key=lambda r: r.doc_id)] == want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    for r in sorted(QUERIES["op7_token_files"](spark, str(tmp_path)).collect(), key=lambda r: r.doc_id):
        ids = want[r.doc_id] + [2]
        assert (r.start, r.n_tokens) == (start, len(ids))
        assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        start += len(ids)


def test_words_are_remembered_for_two_generations():
    memory, asked = bpe.Memory(3), []

    def code(words):
        asked.append(words)
        return [w.encode() for w in words]

    assert memory.coded(["a", "b", "a"], code) == [b"a", b"b", b"a"]
    assert memory.coded(["c", "d", "b"], code) == [b"c", b"d", b"b"]
    assert memory.coded(["a", "e"], code) == [b"a", b"e"]
    assert memory.coded(["f", "g"], code) == [b"f", b"g"]
    assert memory.coded(["a"], code) == [b"a"] and memory.coded(["b"], code) == [b"b"]
    assert asked == [["a", "b"], ["c", "d"], ["e"], ["f", "g"], [], ["b"]]


def test_tasks_of_a_worker_share_what_they_remember_by_name(spark):
    docs = spark.createDataFrame([(i, f"one two {i}") for i in range(200)], "doc_id long, text string").repartition(20)
    first = lambda: lambda words: [[len(w), 1] for w in words]
    other = lambda: lambda words: [[len(w), 2] for w in words]
    for coder, name, last in ((first, "first", 1), (other, "other", 2), (other, "", 2), (first, "first", 1)):
        for r in bpe.encode_in_place(docs, coder, 2, name=name).collect():
            ids = struct.unpack(f"<{len(r.packed) // 2}H", r.packed)
            assert ids == (3, last, 4, last, len(str(r.doc_id)) + 1, last)


def test_tasks_of_a_worker_keep_words_and_coder(spark, tmp_path):
    """As many calls as tasks, and a word in common is met anew once by a worker at most."""
    docs = spark.createDataFrame([(i, f"common{i % 2}") for i in range(64)], "doc_id long, text string").repartition(32)

    def coder():
        import os

        def code(words):
            with open(f"{tmp_path}/{os.getpid()}", "a") as said:
                said.write("".join(f"{w.decode()}\n" for w in words))
            return [[1] for _ in words]

        with open(f"{tmp_path}/{os.getpid()}-made", "a") as said:
            said.write("x")
        return code

    assert bpe.encode_in_place(docs, coder, 2, name=f"{tmp_path}").count() == 64
    made = list(tmp_path.glob("*-made"))
    assert made and all(m.read_text() == "x" for m in made)
    for said in tmp_path.iterdir():
        words = said.read_text().split()
        assert len(words) == len(set(words))


def test_words_of_any_bytes_are_as_the_library_has_them(spark):
    """The coder goes to the library's model for most words; its ids are those of the whole library."""
    path = P.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    odd = ["Ᲊa", "a\U000105c0", "中文", "\U0001f600!", "<|endoftext|>", "a<|endoftext|>b", "߿", "ࠀ"]
    words = [*map(chr, range(0x900)), " café", "привет", " αβ", "'ll", "\n\n", "x" * 3000, *odd]
    want = [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    code = tokens.library_coder(spark, path)()
    assert code([w.encode() for w in words]) == want and code([]) == []


def test_ids_are_written_where_they_are_made(spark, small, tmp_path):
    """With an encoder, texts go through one Python step a task; the files are the same."""
    docs = spark.createDataFrame([(i % 7 or None, f"w{i} a b" * (i % 3)) for i in range(60)], "doc_id long, text string")
    coder = tokens.library_coder(spark, P.path("byte_bpe_50k.json"))
    a, b = shared_dir(spark, "test"), shared_dir(spark, "test")
    one = tokens.write(docs, a, end=2, width=2, encoder=bpe.encoder_in_place(coder, 2))
    two = tokens.write(docs, b, lambda d: bpe.encode_in_place(d, coder, 2), end=2, width=2)
    assert sorted(map(str, one.drop("file").collect())) == sorted(map(str, two.drop("file").collect()))

    def ids(runs, folder):
        asked = tokens.read(runs.select("doc_id", "shard", "record", "records"), runs.select("shard", "file").distinct(), folder)
        return sorted(map(str, asked.collect()))

    assert ids(one, a) == ids(two, b)
