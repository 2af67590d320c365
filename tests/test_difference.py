"""Differences of two tables against a plain comparison, and what equal tables cost."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weatherloom.operators import difference
from weatherloom.operators.difference import difference_counts, table_difference

SCHEMA = "k int, part string, x double, s string"


def plain(a, b):
    out = []
    keys = lambda rows: {k: Counter(r for r in rows if r[:2] == k) for k in {r[:2] for r in rows}}
    left, right = keys(a), keys(b)
    for k in left.keys() | right.keys():
        x, y = left.get(k, Counter()), right.get(k, Counter())
        if x != y:
            kind = "only_left" if not y else "only_right" if not x else "changed"
            out.append((*k, kind, x.total(), y.total()))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def table(rng, n):
    return [(rng.choice([None, *range(n)]), rng.choice(["a", "b", None]), rng.choice([0.0, 1.5, None, rng.random()]), rng.choice(["", "é", None])) for _ in range(n)]


@pytest.mark.parametrize("levels", [0, 1, 2, 4])
def test_against_plain_comparison(spark, levels, monkeypatch):
    rng = random.Random(levels)
    monkeypatch.setattr(difference, "LEVEL_BITS", 4)
    a = table(rng, 400)
    b = [r for r in a if rng.random() > 0.02] + table(rng, 5)
    b = [(*r[:2], 9.0, r[3]) if rng.random() < 0.02 else r for r in b] + [a[0], a[0], a[1]]
    rng.shuffle(b)
    left, right = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA)
    assert got(table_difference(left, right, ["k", "part"], max_levels=levels)) == plain(a, b)
    some = table_difference(left, right, ["k", "part"], ["s"], levels)
    assert got(some) == plain([(*r[:2], r[3]) for r in a], [(*r[:2], r[3]) for r in b])
    counts = difference_counts(table_difference(left, right, ["k", "part"], max_levels=levels)).first()
    assert tuple(counts) == tuple(sum(k in r for r in plain(a, b)) for k in ("only_left", "only_right", "changed"))


def test_equal_and_empty_tables(spark):
    a = [(1, "a", -0.0, None), (None, None, None, None), (1, "a", 2.0, "x"), (1, "a", 2.0, "x")]
    b = [(1, "a", 2.0, "x"), (None, None, None, None), (1, "a", 0.0, None), (1, "a", 2.0, "x")]
    left, right, none = (spark.createDataFrame(x, SCHEMA) for x in (a, b, []))
    equal = table_difference(left, right, ["k", "part"])
    assert equal.collect() == [] and tuple(difference_counts(equal).first()) == (0, 0, 0)
    assert table_difference(none, none, ["k"]).collect() == []
    assert got(table_difference(left, none, ["k", "part"])) == plain([(*r[:2], r[2] and r[2] + 0.0, r[3]) for r in a], [])
    # two copies of a row on one side and two of another on the other cancel in no digest
    twice = spark.createDataFrame([(1, "a", 3.0, "y")] * 2, SCHEMA)
    assert [r.kind for r in table_difference(left.where("x = 2"), twice, ["k"]).collect()] == ["changed"]


def test_equal_tables_cost_one_aggregate_each(spark, monkeypatch):
    calls = []
    original = difference.differing_buckets
    monkeypatch.setattr(difference, "differing_buckets", lambda a, b, level: calls.append(level) or original(a, b, level))
    left = spark.range(5000).select("id", (F.col("id") * 2).alias("v"))
    out = table_difference(left, left.orderBy(F.desc("v")), ["id"])
    assert calls == [0] and out._jdf.queryExecution().optimizedPlan().toString().count("Range") == 0
    changed = left.withColumn("v", F.when(F.col("id") == 7, 0).otherwise(F.col("v")))
    calls.clear()
    assert [(r.id, r.kind) for r in table_difference(left, changed, ["id"]).collect()] == [(7, "changed")]
    assert calls[:2] == [0, 1]


def test_types_must_agree(spark):
    with pytest.raises(TypeError, match="v"):
        table_difference(spark.range(1).selectExpr("id", "1 as v"), spark.range(1).selectExpr("id", "'1' as v"), ["id"])
