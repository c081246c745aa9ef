"""Exact dedup beside a dictionary; edge cases and digests that collide."""

import collections
import hashlib
import re

from pyspark.sql import functions as F

from fillwatch.llm import exact

SCHEMA = "doc_id long, text string, kept string, digest int, salt double"
ROWS = [
    (5, "a b"), (3, "ab"), (4, "a  b"), (9, "ab "), (1, None), (2, ""), (7, " \t\r\n\x0b\x0c"), (8, "é b"),
    (None, "a   b"), (None, None), (6, "x"), (6, "x"), (6, "y"), (10, "a b"), (11, "long " * 9000),
]


def docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "k", 1, 0.5) for i, t in rows], SCHEMA).repartition(4)


def wanted(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, t or ""))
    out = []
    for content, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        found = False
        for m in members:
            kept = not found and (len(m[1]), m[0]) == (len(best[1]), best[0])
            found |= kept
            out.append((m[0], best[0], len(members), kept, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(map(str, out))


def result(df):
    return sorted(str(tuple(r)) for r in df.select("doc_id", "keep_id", "group_size", "kept", "digest").collect())


def test_find(spark):
    assert result(exact.find(docs(spark))) == wanted(ROWS)


def test_few_salts_and_a_large_group(spark):
    rows = [(i, "same text" if i % 3 else f"t{i % 7}") for i in range(600)]
    assert result(exact.find(docs(spark, rows), salts=3)) == wanted(rows)


def test_texts_that_share_a_digest_stay_apart(spark):
    weak = exact.find(docs(spark), digest=lambda c: F.lit("same"))
    want = [w.rsplit(",", 1)[0] for w in wanted(ROWS)]
    assert [r.rsplit(",", 1)[0] for r in result(weak)] == want


def test_drop_copies_keeps_one_row_of_each_group(spark):
    got = exact.drop_copies(docs(spark))
    assert got.columns == ["doc_id", "text", "kept", "digest", "salt"]
    keep = [(r.doc_id, r.text) for r in got.collect()]
    names = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in keep]
    assert len(names) == len(set(names)) == len({re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in ROWS})
    assert (None, "a   b") in keep and (7, " \t\r\n\x0b\x0c") in keep


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert exact.find(none).count() == 0 and exact.drop_copies(none).count() == 0
