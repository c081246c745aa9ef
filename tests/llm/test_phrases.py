"""Collocations beside plain counting; padding, ties, nulls and products past 64 bits."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from fillwatch.llm import phrases

SCHEMA = "doc_id long, lang string, text string, w0 string, phrase int, p string, c int"


def docs(spark, rows):
    return spark.createDataFrame([(i, la, t, "x", 1, "y", 2) for i, (la, t) in enumerate(rows)], SCHEMA).repartition(3)


def wanted(rows, longest=3, least=10, percent=50, most=2000, shortest=2):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) >= 2 and a >= least}
    out = collections.defaultdict(list)
    for (lang, w), a in found.items():
        if len(w) < shortest:
            continue
        inside = [
            b for (other, v), b in found.items()
            if other == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))
        ]
        if any(100 * b >= percent * a for b in inside):
            continue
        cuts = [(k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w))]
        score, _, left, right = min((10**6 * a * a // (x * y), k, x, y) for k, x, y in cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted(
        (lang, i, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, rows in out.items()
        for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:most], 1)
    )


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


ROWS = [
    ("en", "New York is big. New\tYork is, new york is"),
    ("en", "new york\nis new york; a a a a a"),
    (None, "é É é é|é new york"),
    ("und", "new york é É"),
    ("", "new york new york"),
    ("fr", None),
    ("fr", ""),
    ("fr", " \t\n.;:!?,\r\x0b\x0c"),
    ("en", "new york\x85is\xa0new york"),
    ("en", "a a a a a"),
    ("en", "a a a a a"),
]


@pytest.mark.parametrize("least", [1, 2, 3, 5])
@pytest.mark.parametrize("longest", [2, 3, 5])
def test_beside_counting(spark, least, longest):
    got = phrases.mine(docs(spark, ROWS), longest=longest, least=least)
    assert result(got) == wanted(ROWS, longest, least)


def test_other_parameters(spark):
    got = phrases.mine(docs(spark, ROWS), longest=4, least=2, percent=80, most=3, shortest=3)
    assert result(got) == wanted(ROWS, 4, 2, 80, 3, 3)
    with pytest.raises(ValueError):
        phrases.mine(docs(spark, ROWS), shortest=1)


def test_tables_of_documents(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("lang", "text").collect()
    got = phrases.mine(spark.read.parquet(f"{small}/documents.parquet"), most=50)
    # plain counting looks at every pair of candidates: the small table is enough
    assert result(got) == wanted([tuple(r) for r in rows], most=50)


def test_windows_of_many_blocks_add_up(spark, monkeypatch):
    text = " ".join(f"w{i % 7} w{i % 5} the end." for i in range(400))
    rows = [("en", text)] * 30 + [("de", text)] * 2
    whole = phrases.mine(docs(spark, rows), least=2)
    table = docs(spark, rows).repartition(16)
    assert result(phrases.mine(table, least=2)) == result(whole) == wanted(rows, least=2)


def test_rows_of_windows_end_at_rare_phrases(spark):
    rows = [("en", "a b c")] * 12 + [("en", "a b d")] * 3 + [("en", "a e f")] * 4
    got = {(r.w0, r.w1, r.w2): r.c for r in phrases.windows(docs(spark, rows), 3, 10).collect() if r.w0 == "a"}
    assert got == {("a", "b", "c"): 12, ("a", "b", ""): 3, ("a", "", ""): 4}


def test_products_past_64_bits(spark):
    big = 10**14
    found = spark.createDataFrame(
        [("x", 1, "a", 3 * big), ("x", 1, "b", 2 * big), ("x", 2, "a b", big), ("x", 0, "", 9 * big)],
        "lang string, words int, phrase string, f long",
    )
    assert [tuple(r) for r in phrases.scored(found).collect()] == [
        ("x", "a b", 2, big, 3 * big, 2 * big, 10**6 // 6)
    ]


def test_empty_tables(spark):
    none = docs(spark, ROWS).filter(F.lit(False))
    assert phrases.mine(none).count() == 0
    assert phrases.mine(docs(spark, [("fr", None), (None, "one two")])).count() == 0


def test_very_long_text_and_word(spark):
    rows = [("en", "x" * 300_000 + " " + "ab cd " * 200_000), ("en", "ab cd")]
    assert result(phrases.mine(docs(spark, rows))) == wanted(rows)
