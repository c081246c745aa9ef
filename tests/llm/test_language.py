"""Language identification: held-out accuracy, and filters beside sets."""

import zlib

import numpy as np

from fillwatch.llm import language, texts
from fillwatch.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score string, lang_pred int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 1) for i, t, g in rows], SCHEMA).repartition(3)


def test_ngrams_of_letters_and_boundaries():
    whole = ["ab, c", "", "1 2", "x", "日本"]
    gram, owner, has = language.ngrams(*texts.code_points(whole))
    # by letter: one 3-gram; by two letters in a row: one 4-gram
    assert np.bincount(owner, minlength=5).tolist() == [3 + 1, 0, 0, 1, 2 + 1]
    assert has.tolist() == [True, False, False, True, True]
    alone = [sorted(language.ngrams(*texts.code_points([t]))[0].tolist()) for t in whole]
    assert [sorted(gram[owner == i].tolist()) for i in range(5)] == alone


def test_filter_returns_all_languages_of_an_ngram():
    names = [f"l{i:03d}" for i in range(130)]
    draw = np.random.default_rng(0)
    grams = draw.integers(0, 1 << 63, 500).astype(np.uint64)
    pairs = draw.integers(0, 500, 4000), draw.integers(0, 130, 4000)
    model = language._filter(names, pairs[1], grams[pairs[0]])
    masks = model.masks(grams)
    held = np.stack([model.bit(masks, i) for i in range(130)], 1).astype(bool)
    assert held[pairs[0], pairs[1]].all()
    other = draw.integers(0, 1 << 63, 20000).astype(np.uint64)
    wrong = np.stack([model.bit(model.masks(other), i) for i in range(130)], 1).mean(0)
    assert np.allclose(wrong, model.false_positives(), atol=0.02)


def test_edge_cases(spark):
    rows = [(i, t, g) for i, (t, g) in enumerate([("the cat and the dog", "en"), ("der hund und die katze", "de")] * 40)]
    docs = table(spark, rows)
    model = language.fit(docs)
    odd = [(None, "the dog", None), (1, None, "en"), (2, "", "en"), (3, " 12 !", "en"), (4, "漢字", None),
           (5, "hund und katze", "x"), (5, "hund und katze", "x"), (6, "the dog and the cat " * 9000, None)]
    got = language.predict(table(spark, odd), model).collect()
    found = sorted((str(r.doc_id), r.lang_pred) for r in got)
    tie = next(r.lang_pred for r in got if r.doc_id == 4)
    assert tie in ("en", "de")
    assert found == sorted([("None", "en"), ("1", "und"), ("2", "und"), ("3", "und"), ("4", tie), ("5", "de"), ("5", "de"), ("6", "en")])
    assert all(0 <= r.score <= 1 for r in got)


def test_nothing_to_learn_and_empty_table(spark):
    docs = table(spark, [(1, "abc", None), (2, "abc", None)])
    assert [r.lang_pred for r in language.predict(docs, language.fit(docs)).collect()] == ["und", "und"]
    assert language.predict(table(spark, []) if False else spark.createDataFrame([], SCHEMA), language.fit(docs)).count() == 0


def test_held_out_documents_of_the_table(spark, small):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = QUERIES["op3_language"](spark, small).collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([docs[r.doc_id].lang == r.lang_pred for r in held]) > 0.97
