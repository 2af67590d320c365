from __future__ import annotations

import random
from collections import defaultdict

import pytest

from weatherloom.llm import mixing
from weatherloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_targets(sizes, cap=3):
    """Share the total by weight, cap, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, list(order), float(sum(sizes.values()))
    while free:
        level = rest / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > cap * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = float(cap * sizes[s])
            rest -= target[s]
            free.remove(s)
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {s: rng.choice([0, 1, 10, 1000, 10**6]) + rng.randint(0, 9) for s in [None, "é", "Z", "a", *map(str, range(seed * 5))]}
    out = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    assert {r.source: r.target for r in out} == pytest.approx(plain_targets(sizes))


def test_settle_keeps_words_and_probability():
    units = [(f"u{i}", float(5 + i % 7), 0.3) for i in range(50)]
    done, held = mixing.settle(units)
    words = {u: w for u, w, _ in units}
    total = sum(w * p for _, w, p in units)
    got = sum(words[u] * n for u, n in done.items()) + (held[1] * held[2] if held else 0)
    assert got == pytest.approx(total) and len(done) >= 49
    ones = defaultdict(int)
    for trial in range(3000):  # each unit keeps its probability over the random numbers
        named = [(f"{trial}-{i}", 4.0 + i, 0.3) for i in range(5)]
        done, held = mixing.settle(named)
        for name, n in done.items():
            ones[name.split("-")[1]] += n
        if held:
            ones[held[0].split("-")[1]] += held[2]
    assert all(n / 3000 == pytest.approx(0.3, abs=0.04) for n in ones.values())


def check(rows):
    size, taken, target, longest = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in rows:
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        longest[r.source] = max(longest[r.source], r.size)
        assert 0 <= r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
    assert target == pytest.approx(plain_targets(size))
    assert {r.source: r.source_size for r in rows} == dict(size)
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in size)


def test_query(spark):
    rows = QUERIES["op3_mixing_sources"](spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    check(rows)


def test_hot_source_many_levels_and_reruns(documents, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 8)
    rng = random.Random(2)
    rows = [(i, "w " * rng.choice([0, 1, 5, 80, 300]), None, "hot" if i % 3 else f"s{i % 7}") for i in range(600)]
    first = mixing.mix(documents(rows)).collect()
    check(first)
    again = mixing.mix(documents(rows[::-1]).repartition(7)).collect()
    assert sorted(map(repr, first)) == sorted(map(repr, again))


def test_edge_rows(documents):
    rows = [(1, None, None, None), (None, "a b", None, None), (None, "a b", None, None), (2, "", None, "a"), (3, "x y z", None, "a"), (3, "x y z", None, "a"), (4, " ", None, "b")]
    out = mixing.mix(documents(rows).selectExpr("*", "1 as size", "2 as unit", "3 as target")).collect()
    assert len(out) == len(rows)
    assert all(r.taken == 0 for r in out if not r.size) and all(r.copies <= 3 for r in out)
    assert len({r.taken for r in out if r.doc_id == 3}) == 1
    assert mixing.mix(documents([])).collect() == []
    assert sum(r.taken for r in mixing.mix(documents([(1, None), (2, "")])).collect()) == 0
