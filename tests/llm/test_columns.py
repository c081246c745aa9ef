"""Operators that return their input's rows: further columns of any name and type come through."""

import pytest
from pyspark.sql import functions as F

from fillwatch.llm import exact, mixing, near

NAMES = (
    "row key digest chars place time times source_ of _own _number _text_digest _digest _of _kept _source _place"
    " _time kept component_id best stays salt a b group_size"
).split()
TEXTS = ["one two three four five six", "one two three four five six", "other words here", "", None, "x", "x"]


def docs(spark):
    rows = spark.createDataFrame(
        [(i if i < 6 else None, t, f"s{i % 2}", {"k": i}) for i, t in enumerate(TEXTS)],
        "doc_id long, text string, source string, `a.map` map<string, int>",
    )
    return rows.withColumns({n: F.concat(F.lit(f"{n}-"), F.coalesce("text", F.lit("none"))) for n in NAMES})


def whole(rows, columns):
    """Every further column still says what it said of the row's own text."""
    out = []
    for r in rows:
        assert all(r[n] == f"{n}-{'none' if r.text is None else r.text}" for n in NAMES)
        assert r["a.map"] == {"k": 6 if r.doc_id is None else r.doc_id}
        out.append(-1 if r.doc_id is None else r.doc_id)
    return sorted(out)


@pytest.mark.parametrize(
    "operator,want",
    [
        (exact.drop_copies, [0, 2, 3, 5]),
        (near.drop_near_copies, [-1, 0, 2, 3, 4, 5]),
        (lambda d: mixing.apply(d, most=1), None),
    ],
)
def test_rows_come_through_whole(spark, operator, want):
    table = docs(spark)
    got = operator(table)
    assert got.columns == table.columns and got.dtypes == table.dtypes
    found = whole(got.collect(), got.columns)
    if want is None:
        want = sorted(-1 if r.doc_id is None else r.doc_id for r in mixing.mix(table, most=1).collect() if r.times)
    assert found == want


def test_repeated_rows_are_limited_where_they_are_read(spark):
    table = spark.createDataFrame([(1, "a b", 7), (1, "ab", 3), (1, "a b", 5)] * 50, "doc_id long, text string, n int")
    got = exact.drop_copies(table.repartition(8))
    assert [tuple(r) for r in got.collect()] == [(1, "a b", 5)]
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()


def test_no_row_is_taken_more_often_than_allowed(spark):
    rows = [(i, "w " * 40 if i < 30 else None, "big" if i < 30 else "small") for i in range(40)]
    rows += [(100 + i, None if i % 2 else "one", "small") for i in range(40)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert max(r.times for r in got) == 3
