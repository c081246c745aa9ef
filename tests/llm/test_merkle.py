"""Merkle fingerprints beside trees built in Python."""

import hashlib
import re

from pyspark.sql import functions as F

from fillwatch.llm import merkle

SCHEMA = "doc_id long, text string, tree string, copies int, hash string"
md5 = lambda t: hashlib.md5(t.encode()).hexdigest()


def tree_of(text):
    return [[[md5(s) for s in re.split(r"(?<=[.!?]) ", p)] for p in sec.split("\n")] for sec in text.split("\n\n")]


def root_of(tree):
    sections = [md5("".join(md5("".join(p)) for p in s)) for s in tree]
    return hashlib.sha256("".join(sections).encode()).hexdigest()


def like(a, b):
    x, y = ({leaf for s in t for p in s for leaf in p} for t in (a, b))
    return 2 * len(x & y) / (len(x) + len(y))


def wanted(rows):
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + n[:half]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), root_of(tree_of(t)), root_of(tree_of(edited)),
                    like(tree_of(t), tree_of(edited)), like(tree_of(t), tree_of(n))))
    return sorted(map(str, out))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "t", 1, "h") for i, t in rows], SCHEMA).repartition(4)


def result(df):
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return sorted(str(tuple(r)) for r in df.select(*names).collect())


ROWS = [(5, "A b. C d! E\nsecond line\n\nsection two. Ends"), (-3, None), (8, ""), (9, "é" * 7), (None, "of no id. x"),
        (40, "a\n\n\nb"), (41, "a\n\nb\n"), (42, "same"), (43, "same"), (44, "long words. " * 4000)]


def test_edits(spark):
    assert result(merkle.edits(table(spark, ROWS))) == wanted(ROWS)


def test_many_ranges_and_one_document(spark):
    rows = [(i * 7 % 997, f"text {i}. " * (i % 9)) for i in range(997)]
    assert result(merkle.edits(table(spark, rows))) == wanted(rows)
    assert result(merkle.edits(table(spark, [(1, "only. one")]))) == wanted([(1, "only. one")])
    assert merkle.edits(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rows_alike_are_one_document(spark):
    one = [(3, "c. d"), (2, "b. x"), (1, "a")]
    twice = result(merkle.edits(table(spark, one + [(2, "b. x")])))
    assert sorted(set(twice)) == wanted(one) and len(twice) == 4
    same_id = merkle.edits(table(spark, [(2, "b"), (2, "other"), (1, "a")]))
    assert same_id.count() == 3


def test_differing_branches_locate_an_edit(spark):
    a = "one. two\nthree\n\nfour\nfive. six\n\nseven"
    b = "one. two\nthree\n\nfour\nfive. SIX\n\nseven"
    both = spark.createDataFrame([(a, b), (a, a), (a, "one. two")], "a string, b string")
    got = both.select(merkle.located(merkle.tree(F.col("a")), merkle.tree(F.col("b"))).alias("x")).collect()
    assert [[(p.section, p.paragraph) for p in r.x] for r in got] == [
        [(1, 1)], [], [(0, 1), (1, 0), (1, 1), (2, 0)],
    ]


def test_cuts_lose_nothing(spark):
    texts = ["a. b", "a.  b", "a.b", "a\nb", "a\n\nb", "a\n\n\nb", "a b", "", "\n", " ", "a. ", "a."]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert merkle.fingerprints(rows).select("fingerprint").distinct().count() == len(texts)
