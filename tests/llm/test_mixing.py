"""The mix beside its definition; targets beside water filling step by step."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from fillwatch.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, target int, rest int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 1, 2) for i, t, s in rows], SCHEMA).repartition(3)


def filled(sizes):
    """Targets by sharing out again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        whole = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / whole >= 3 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / whole for s in open_}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
            open_.remove(s)
    return target


def place(i, t, seed=0):
    own = hashlib.md5((t or "").encode()).hexdigest()
    return hashlib.md5(f"{seed}:{'' if i is None else i}:{own}".encode()).hexdigest()[:15]


def rows_of(seed, n=400):
    draw = random.Random(seed)
    sources = [None, "a", "b", "B", "é", "tiny", "empty"]
    out = [(i, " ".join("w" * draw.randint(1, 3) for _ in range(draw.choice([0, 1, 5, 90]))), draw.choice(sources[:5]))
           for i in range(n)]
    return out + [(9001, "one word more", "tiny"), (9002, None, "empty"), (9003, " ", "empty"),
                  (None, "null id here", "a"), (7, "twice the same", "b"), (7, "twice the same", "b")]


@pytest.mark.parametrize("seed", [1, 2])
def test_mix_is_its_definition(spark, seed):
    rows = rows_of(seed)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target = filled(sizes)
    got = mixing.mix(table(spark, rows)).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken == r.times * r.size <= 3 * r.size
        taken.setdefault(r.source, []).append(r)
    for s, own in taken.items():
        passes = min(3, int(target[s] / sizes[s])) if sizes[s] else 0
        rest, below = target[s] - passes * sizes[s], 0
        by_place = {}
        for r in own:
            by_place.setdefault(r.place, []).append(r)
        for key in sorted(by_place):
            n = sum(r.size for r in by_place[key])
            extra = below + n / 2 <= rest + 1e-9
            assert all(r.times == passes + extra for r in by_place[key] if r.size)
            below += n
        most = max(sum(r.size for r in rs) for rs in by_place.values())
        assert abs(sum(r.taken for r in own) - target[s]) <= most / 2 + 1e-6
    assert {r.place for r in got} == {place(i, t) for i, t, _ in rows}


def test_reruns_and_other_partitions_agree(spark):
    one = table(spark, rows_of(3))
    a, b = mixing.mix(one), mixing.mix(one.repartition(7, "text"))
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_apply_repeats_rows(spark):
    docs = table(spark, rows_of(4))
    often = mixing.mix(docs).groupBy().agg(F.sum("times").alias("n")).first().n
    got = mixing.apply(docs)
    assert got.columns == docs.columns and got.count() == often


def test_empty_table_and_no_words(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    (row,) = mixing.mix(table(spark, [(1, None, None)])).collect()
    assert (row["size"], row.target, row.taken) == (0, 0.0, 0)
