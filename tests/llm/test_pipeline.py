"""Each stage of the pipeline on its own input, beside plain Python."""

import hashlib
import re

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_near import wanted as near_wanted

import corpus_pipeline
from fillwatch.llm import bpe, mixing, toxicity
from fillwatch.session import settled


@pytest.fixture(scope="module")
def steps(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settled(stage(spark, out[-1], small), name))
    return out


def test_columns(steps):
    assert all(s.columns == steps[0].columns for s in steps[:-1])


def test_toxic_documents_go(spark, small, steps):
    model = toxicity.fit(steps[0], spark.read.parquet(f"{small}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(steps[0], model).filter("toxic").collect()}
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    assert toxic and ids(steps[1]) == ids(steps[0]) - toxic


def test_one_of_each_group_of_copies_stays(steps):
    groups = {}
    for r in steps[1].collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", r.text or ""), []).append(r)
    best = {min(g, key=lambda r: (-len(r.text or ""), r.doc_id)).doc_id for g in groups.values()}
    assert {r.doc_id for r in steps[2].collect()} == best and steps[2].count() == len(best)


def test_one_of_each_near_group_stays(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    assert sorted(r.doc_id for r in steps[3].collect()) == [w[0] for w in near_wanted(rows, 5) if w[3]]


def test_mix_takes_effect(steps):
    times = {r.doc_id: r.times for r in mixing.mix(steps[3]).collect() if r.times}
    assert {r.doc_id: r["count"] for r in steps[4].groupBy("doc_id").count().collect()} == times


def test_ids_and_round_trip(steps):
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    text = {r.doc_id: r.text or "" for r in steps[4].collect()}
    got = steps[5].collect()
    assert len(got) == steps[4].count()
    for r in got:
        assert r.ids == library.encode_ordinary(text[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages(spark, small, steps):
    got = corpus_pipeline.run(spark, small)
    key = ["doc_id", "n_tokens", "decoded_sha256"]
    assert sorted(map(tuple, got.select(key).collect())) == sorted(map(tuple, steps[5].select(key).collect()))


def test_empty_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").filter(F.lit(False))
    for name, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, small), name)
    assert docs.count() == 0
