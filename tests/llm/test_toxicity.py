"""Ordinal regression on made grades, and held-out labels of the tables."""

import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fillwatch.llm import texts, toxicity

DOCS = "doc_id long, text string, toxic string, severity int"
LABELS = "doc_id long, toxic int, quality int"


def made(seed=0, n=600):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{draw.randint(0, 3000)}" for _ in range(draw.randint(5, 60))]
        toxic = draw.random() < 0.2
        for _ in range(draw.randint(1, 8) * toxic):
            words.insert(draw.randint(0, len(words)), draw.choice(["vilest", "Rotten", "foulness"]))
        docs.append((i, " ".join(words), "x", 1))
        labels.append((i, int(toxic), 1))
    return docs, labels


def test_weights_are_shared_and_thresholds_in_order():
    draw = np.random.default_rng(1)
    x = draw.integers(0, 3, (3000, 6))
    true = np.array([2.0, 1.0, 0, 0, -1.0, 0.5])
    grade = np.digitize(x @ true + draw.logistic(size=3000) * 0.5, [0.5, 2.5, 4.5])
    row, column = np.nonzero(x)
    weights, cut = toxicity.fit_ordinal(row, column, x[row, column].astype(float), grade, 6)
    assert len(cut) == 3 and (np.diff(cut) > 0).all()
    assert np.corrcoef(weights, true)[0, 1] > 0.98
    model = toxicity.Model(np.zeros(0, np.uint64), weights, cut)
    severity = model.above(x @ weights).sum(axis=1)
    means = [severity[grade == k].mean() for k in range(4)]
    assert means == sorted(means) and means[3] - means[0] > 1.2


def test_held_out_documents(spark):
    docs, labels = made()
    table = spark.createDataFrame(docs, DOCS).repartition(4)
    model = toxicity.fit(table, spark.createDataFrame(labels[:400], LABELS))
    got = {r.doc_id: r for r in toxicity.score(table, model).collect()}
    assert np.mean([got[i].toxic == bool(t) for i, t, _ in labels[400:]]) > 0.97
    amount = [sum(w.lower() in ("vilest", "rotten", "foulness") for w in t.split()) for _, t, *_ in docs]
    assert np.corrcoef(amount, [got[i].severity for i in range(len(docs))])[0, 1] > 0.8
    kept = toxicity.reject(table, model)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.toxic}


def test_edge_cases(spark):
    docs, labels = made(2, 200)
    odd = [(None, "rotten vilest foulness", "x", 1), (900, None, "x", 1), (901, "", "x", 1), (902, "rotten vilest " * 20000, "x", 1),
           (903, "w1", "x", 1), (903, "w1", "x", 1)]
    table = spark.createDataFrame(docs + odd, DOCS)
    marks = spark.createDataFrame(labels + [(None, 1, 1), (5, None, 1), (900, 0, 1), (labels[0][0], labels[0][1], 0)], LABELS)
    got = toxicity.score(table, toxicity.fit(table, marks)).collect()
    assert len(got) == len(docs) + len(odd)
    found = {str(r.doc_id): r.toxic for r in got}
    assert found["None"] and found["902"] and not found["900"] and not found["901"] and not found["903"]
    for none in (marks.filter("toxic = 1"), marks.limit(0)):
        model = toxicity.fit(table, none)
        assert not toxicity.score(table, model).filter("toxic").count()
    assert toxicity.score(table.limit(0), toxicity.fit(table, marks)).count() == 0


def test_copies_of_a_toxic_text_lend_their_words_no_weight(spark):
    docs, labels = made(3, 400)
    story = " ".join(f"story{i}" for i in range(30))
    copies = [(1000 + i, story + " vilest", "x", 1) for i in range(40)]
    table = spark.createDataFrame(docs + copies + [(2000, story, "x", 1)], DOCS)
    marks = spark.createDataFrame(labels + [(i, 1, 1) for i, *_ in copies], LABELS)
    got = toxicity.score(table, toxicity.fit(table, marks)).filter("doc_id = 2000").first()
    assert not got.toxic


def test_a_small_share_of_toxic_texts_lends_its_words_weight(spark):
    docs, labels = made(4, 2000)
    # a lexicon of its own, in under one in forty of the toxic texts
    rare = [(5000 + i, f"x{i} gruesom* y{i} z{i}", "x", 1) for i in range(8)]
    marks = spark.createDataFrame(labels + [(i, 1, 1) for i, *_ in rare], LABELS)
    unseen = [(6000, "one two GRUESOM three four", "x", 1), (6001, "one two three four", "x", 1)]
    table = spark.createDataFrame(docs + rare + unseen, DOCS)
    got = toxicity.score(table, toxicity.fit(table, marks)).filter("doc_id >= 6000").collect()
    assert {r.doc_id: r.toxic for r in got} == {6000: True, 6001: False}


def test_words_lose_the_marks_around_them():
    bare = toxicity.features(["ab,cd efg", "ab,cd efg"])[0]
    marked = toxicity.features(["(ab,cd!! *efg*.", '"ab,cd" efg###'])[0]
    assert sorted(bare.tolist()) == sorted(marked.tolist())
    alone = toxicity.features(["!!", "", "???"])
    assert alone[1].tolist() == [0, 2] and len(set(alone[0].tolist())) == 2


def test_scores_by_plain_python(spark):
    docs, labels = made(5, 300)
    docs += [(900, None, "x", 1), (901, "", "x", 1), (902, "vilest!! Rotten, " * 3000, "x", 1)]
    table = spark.createDataFrame(docs, DOCS)
    model = toxicity.fit(table, spark.createDataFrame(labels, LABELS))
    weight = dict(zip(model.features.tolist(), model.weights.tolist()))
    hashes = {}  # of a word alone, by the operator; everything else is worked out here

    def of(word):
        if word not in hashes:
            hashes[word] = toxicity.features([word])[0].tolist()
        return hashes[word]

    for r in toxicity.score(table, model).collect():
        text = next(t for i, t, *_ in docs if i == r.doc_id) or ""
        n = Counter(f for word in text.lower().split() for f in of(word))
        total = sum(weight[f] * math.log1p(k) for f, k in n.items() if f in weight)
        above = [1 / (1 + math.exp(-min(40, max(-40, total - c)))) for c in model.thresholds]
        assert math.isclose(r.severity, sum(above), rel_tol=1e-9)
        assert r.toxic == (above[0] >= toxicity.LEAST)


def test_held_out_labels_of_the_table_by_language(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    n = Counter()
    for unseen in (held, ~held):
        model = toxicity.fit(docs, labels.filter(~unseen))
        right = labels.filter(unseen).select("doc_id", (F.col("toxic") > 0).alias("wanted"))
        scored = toxicity.score(docs, model).join(right, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
        for r in scored.filter("lang IS NOT NULL").groupBy("lang", "wanted", "toxic").count().collect():
            n[r.lang, r.wanted, r.toxic] += r["count"]
    assert {lang for lang, *_ in n} == {"de", "en", "es", "fr"}
    for lang in ("de", "en", "es", "fr"):
        hits, missed = n[lang, True, True], n[lang, True, False]
        wrong, right = n[lang, False, True], n[lang, False, False]
        print(lang, hits, hits + missed, wrong, wrong + right)
        assert hits >= 0.9 * (hits + missed), n
        assert wrong <= 0.02 * (wrong + right) + 1, n


def test_rows_far_from_the_lowest_hash_go_before_the_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(1000).selectExpr("id AS doc_id", "id % 2 AS toxic")
        chosen = texts.lowest(rows, "toxic", "doc_id", 10)
        plan = chosen._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert chosen.groupBy("toxic").count().collect() and chosen.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
