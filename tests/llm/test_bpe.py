"""Encoding against the library it should equal, and the round trip."""

import hashlib
import struct

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from fillwatch.llm import bpe, texts
from fillwatch.llm.queries import QUERIES

RANKS = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
TEXTS = [
    "", " ", "a", "don't we'll they're I'd 's 'tis ''s 've'", "a  b\t\tc\n\n d \r\n", "x" * 3000,
    "\x1c\x85a  b", "ÄÖ ß 12³ ½x", "日本語 text 🙂🙂 !?", "'S 'T", "  ", "\n'll", "a'", "'", "it's's", " 'sx", "a　'dab",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def pieces(text):
    code, at = texts.code_points([text])
    cut = [*bpe.pre_tokens(code, at).tolist(), len(text)]
    return [text[a:b] for a, b in zip(cut[:-1], cut[1:])]


def test_pattern_is_the_vocabularys():
    assert bpe.PATTERN == P.PATTERN


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aZ'stredvlm 1\t\n é.!日", max_size=14))
def test_pre_tokens_are_the_patterns_matches(text):
    assert pieces(text) == regex.findall(P.PATTERN, text)


def test_texts_end_to_end_do_not_mix():
    code, at = texts.code_points(TEXTS)
    start = bpe.pre_tokens(code, at)
    for i, text in enumerate(TEXTS):
        own = start[(start >= at[i]) & (start < at[i + 1])] - at[i]
        cut = [*own.tolist(), len(text)]
        assert [text[a:b] for a, b in zip(cut[:-1], cut[1:])] == regex.findall(P.PATTERN, text)


def test_words_that_share_a_hash_stay_apart(monkeypatch):
    monkeypatch.setattr(texts.Hasher, "spans", lambda self, a, b: (b - a).astype(np.uint64))
    code, at = texts.code_points(["ab cd ab"])
    slots = {}
    use = bpe.distinct_words(code, "ab cd ab", bpe.pre_tokens(code, at), slots)
    assert [list(slots)[i] for i in use] == ["ab", " cd", " ab"]


@given(st.text(max_size=12))
def test_merge_is_the_librarys(library, text):
    assert [i for w in regex.findall(P.PATTERN, text) for i in bpe.merge(w.encode(), RANKS)] == library.encode_ordinary(text)


def test_encode_and_decode(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (99, None), (3, TEXTS[3]), (3, TEXTS[3])]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, ids string, block int")
    encoded = bpe.encode(docs.repartition(3), bpe.rank_coder(spark, RANKS), parts=5)
    got = bpe.decode(encoded, bpe.token_table(spark, RANKS)).collect()
    want = sorted((str(i), library.encode_ordinary(t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), r.ids) for r in got) == want
    by_text = sorted(((str(i), (t or "").encode()) for i, t in rows))
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in got) == by_text
    assert all(bytes(r.packed) == struct.pack(f"<{len(r.ids)}I", *r.ids) for r in got)


def test_unknown_ids_and_nulls(spark):
    some = spark.createDataFrame([(1, [72, 5]), (2, [99]), (3, None), (4, [])], "doc_id long, ids array<int>")
    table = spark.createDataFrame([(72, bytearray(b"h")), (5, bytearray(b"i!"))], "id int, bytes binary")
    got = {r.doc_id: r.decoded and bytes(r.decoded) for r in bpe.decode(some, table).collect()}
    assert got == {1: b"hi!", 2: None, 3: None, 4: b""} or got == {1: b"hi!", 2: None, 3: None, 4: bytearray(b"")}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.encode(docs, bpe.rank_coder(spark, RANKS)).count() == 0


def test_query_on_the_whole_table(spark, small, library):
    got = {r.doc_id: r for r in QUERIES["op5_byte_bpe"](spark, small).collect()}
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode_ordinary(d.text or "")
        r = got[d.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
