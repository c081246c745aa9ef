"""Near-duplicates beside all pairs; blocks, hot groups, edge cases."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fillwatch.llm import components, near, shingles, texts

SCHEMA = "doc_id long, text string, kept int, digest string, token long"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def set_of(text, width):
    w = words_of(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def wanted(rows, width):
    sets = [(i, set_of(t, width)) for i, t in rows]
    low = {i: i for i, _ in rows}

    def top(i):
        while low[i] != i:
            i = low[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = sorted((top(i), top(j)))
                low[q] = p
    return sorted((i, len(s), top(i), top(i) == i) for i, s in sets)


def corpus(seed, n=160):
    draw = random.Random(seed)
    word = lambda: draw.choice("abcdefg") + str(draw.randint(0, 300))
    rows, line = [], [word() for _ in range(25)]
    base = [word() for _ in range(90)]
    for i in range(n):
        kind = draw.random()
        if kind < 0.5:  # a large group of near copies, some at the edge
            own = list(base)
            for _ in range(draw.randint(0, 6)):
                own[draw.randrange(len(own))] = word()
        elif kind < 0.7 and rows:  # near copies of any other
            own = words_of(draw.choice(rows)[1]) or ["x"]
            own[draw.randrange(len(own))] = word()
        else:  # a common passage in texts of their own
            own = [word() for _ in range(draw.randint(1, 80))] + line * draw.randint(0, 1)
        rows.append((i * 3 + 1, " ".join(own).title() if draw.random() < 0.1 else " ".join(own)))
    return rows + [(9000, None), (9001, ""), (9002, " \n"), (9003, "Ab c"), (9004, "ab C"), (9005, "ÄB c"), (9006, "äb c")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, 1, "d", 5) for i, t in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("seed,width", [(1, 4), (2, 5)])
def test_components_are_those_of_all_pairs(spark, seed, width):
    rows = corpus(seed)
    got = near.find(table(spark, rows), width=width).collect()
    assert sorted(map(tuple, got)) == wanted(rows, width)


def test_blocks_of_long_lists_and_groups(spark, monkeypatch):
    monkeypatch.setattr(near, "LIST", 16)
    monkeypatch.setattr(near, "GROUP", 2000)
    rows = corpus(3)
    assert sorted(map(tuple, near.find(table(spark, rows)).collect())) == wanted(rows, 5)


def test_null_and_repeated_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (7, text), (7, text), (8, text + " more"), (None, None), (7, "something else at all")]
    got = sorted((str(r.doc_id), str(r.component_id), r.kept) for r in near.find(table(spark, rows)).collect())
    assert got == sorted([("None", "None", True)] * 2 + [("7", "7", True)] * 3 + [("8", "7", False)])


def test_drop_near_copies_and_empty_table(spark):
    rows = corpus(4)
    got = near.drop_near_copies(table(spark, rows))
    assert got.columns == ["doc_id", "text", "kept", "digest", "token"]
    assert sorted(r.doc_id for r in got.collect()) == [w[0] for w in wanted(rows, 5) if w[3]]
    assert near.find(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_chain_of_edges(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 100), (5, 5), (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components.label(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100}


def test_sets_match_words_whatever_the_slices():
    rows = [t or "" for _, t in corpus(5)]
    data, at = texts.utf8(pa.array(rows))
    for width in (4, 5):
        assert [len(s) for s in shingles.sets_of(data, at, width)] == [len(set_of(t, width)) for t in rows]
        again = [shingles.sets_of(*texts.utf8(pa.array([t])), width)[0] for t in rows]
        assert all(np.array_equal(a, b) for a, b in zip(again, shingles.sets_of(data, at, width)))


def test_grow_is_exact_on_any_graph():
    draw = np.random.default_rng(0)
    for n in (1, 2, 9, 40):
        for share in (0.02, 0.1, 0.6):
            link = draw.random((n, n)) < share
            link |= link.T
            of = shingles.grow(n, lambda i: np.flatnonzero(link[i])).of
            reach = link | np.eye(n, dtype=bool)
            for _ in range(n):
                reach = reach @ reach
            assert all((of[i] == of[j]) == reach[i, j] for i in range(n) for j in range(n))
