"""The external shuffle: whole, even, repeatable, and without order."""

import collections

from fillwatch.llm import shards
from fillwatch.llm.queries import QUERIES
from fillwatch.session import shared_dir

SCHEMA = "doc_id long, text string, bucket string, place int, record int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "b", 1, 2) for i, t in rows], SCHEMA).repartition(3)


def dealt(docs, n=16, **more):
    rows = shards.shuffled(docs, **more)
    return shards.deal(rows, rows.select("bucket", "part"), n)


def check(got, n, count):
    slots = collections.defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert sum(map(len, slots.values())) == count
    sizes = [len(slots[s]) for s in range(n)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_whole_even_and_repeatable(spark):
    rows = [(i, "t" * (i % 50)) for i in range(1003)] + [(None, None), (None, ""), (5, "x"), (5, "x")]
    docs = table(spark, rows)
    one = dealt(docs, bucket_bytes=900).collect()
    check(one, 16, len(rows))
    ids = lambda got: sorted((str(r.record.doc_id), str(r.record.text)) for r in got)
    assert ids(one) == sorted((str(i), str(t)) for i, t in rows)
    spots = lambda got: sorted((str(r.record.doc_id), r.shard, r.slot) for r in got if r.record.doc_id != 5)
    again = dealt(docs.repartition(7, "text"), bucket_bytes=900).collect()
    assert spots(one) == spots(again)
    assert spots(one) != spots(dealt(docs, bucket_bytes=900, seed=1).collect())


def test_rows_alike_do_not_fill_a_bucket(spark):
    docs = table(spark, [(1, "same " * 20)] * 500 + [(i, "other") for i in range(200)])
    rows = shards.shuffled(docs, bucket_bytes=2000)
    sizes = [r["count"] for r in rows.groupBy("bucket", "part").count().collect()]
    assert max(sizes) < 150
    check(shards.deal(rows, rows.select("bucket", "part")).collect(), 16, 700)


def test_every_place_is_as_likely(spark):
    docs = table(spark, [(i, "t") for i in range(64)])
    first = collections.Counter()
    for seed in range(12):
        for r in dealt(docs, 4, seed=seed, bucket_bytes=40).collect():
            first[r.record.doc_id < 32, r.shard] += 1
    assert min(first.values()) > 60  # 96 expected in each of 8 cells


def test_write_and_empty_table(spark):
    docs = table(spark, [(i, f"text {i}") for i in range(50)])
    path = shared_dir(spark, "shards")
    shards.write(docs, path, 4)
    check(spark.read.parquet(path).collect(), 4, 50)
    assert dealt(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_on_the_whole_table(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op6_shards"](spark, small).collect()
    check(got, 16, len(docs))
    import zlib

    for r in got:
        raw = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
