"""Quantile profiles and drift against exact ranks and distances."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from weatherloom.operators.drift import (
    distance_error,
    distribution_drift,
    drift_gate,
    merge_profiles,
    quantile_profile,
    rank_error,
    with_quantiles,
)
from weatherloom.operators.gates import failures

SHARES = [0.01, 0.25, 0.5, 0.9, 0.99]
SCHEMA = "station string, year int, x double, y int"


def table(spark, shift=0.0, seed=1, n=4000):
    rng = random.Random(seed)
    rows = []
    for station in ("a", "b", None):
        for year in (2000, 2001):
            move = shift if (station, year) == ("b", 2001) else 0.0
            for _ in range(n if station == "a" else n // 10):
                rows.append((station, year, rng.choice([None, float("nan"), rng.gauss(0, 1) + move, rng.gauss(0, 1) + move]), rng.randrange(5)))
    return rows, spark.createDataFrame(rows, SCHEMA)


def valid(rows, keep):
    return sorted(r[2] for r in rows if keep(r) and r[2] is not None and r[2] == r[2])


def ks(a, b):
    return max(abs(sum(v <= x for v in a) / len(a) - sum(v <= x for v in b) / len(b)) for x in {*a, *b})


def test_quantiles_within_the_stated_error(spark):
    rows, df = table(spark)
    fine = quantile_profile(df, ["x", "y"], ["station", "year"])
    for by in (["station", "year"], ["year"], []):
        got = with_quantiles(merge_profiles(fine, by), SHARES).filter("measure = 'x'").collect()
        assert len(got) == {2: 6, 1: 2, 0: 1}[len(by)]
        for r in got:
            values = valid(rows, lambda t: all(t[("station", "year").index(k)] == r[k] for k in by))
            assert (r.n_values, r.least, r.greatest) == (len(values), values[0], values[-1])
            for share, q in zip(SHARES, r.quantiles):
                assert q in values
                below, upto = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
                assert below - 2 * rank_error() <= share <= upto + 2 * rank_error()


def test_only_the_shifted_year_fails_the_gate(spark):
    rows, df = table(spark)
    moved_rows, moved = table(spark, shift=1.0, seed=2)
    by = ["station", "year"]
    profile = quantile_profile(df, ["x", "y"], by)
    drift = distribution_drift(profile, quantile_profile(moved, ["x", "y"], by), by, 0.05)
    got = drift.collect()
    assert len(got) == 12 and {r.side for r in got} == {"both"}
    assert [(r.station, r.year, r.measure) for r in got if r.drifted] == [("b", 2001, "x")]
    for r in got:
        if r.measure == "x":
            same = lambda t, r=r: t[:2] == (r.station, r.year)
            exact = ks(valid(rows, same), valid(moved_rows, same))
            assert abs(r.distance - exact) <= distance_error()
            assert r.null_rate_before == pytest.approx(1 - len(valid(rows, same)) / sum(map(same, rows)))
    assert [r.check_name for r in failures(drift_gate(drift, "features")).collect()] == ["distribution_drift"]
    again = distribution_drift(profile, quantile_profile(df, ["x", "y"], by), by, 0.05)
    assert failures(drift_gate(again, "features")).count() == 0


def test_one_sided_groups_empty_groups_and_tables(spark):
    before = spark.createDataFrame([("a", 1, None, 1), ("b", 1, 2.0, 1), ("c", 1, None, None)], SCHEMA)
    after = spark.createDataFrame([("a", 1, 5.0, 1), ("c", 1, None, None), (None, None, 1.0, 1)], SCHEMA)
    profiles = [quantile_profile(t, ["x"], ["station"]) for t in (before, after)]
    got = {r.station: (r.side, r.distance, r.drifted) for r in distribution_drift(*profiles, ["station"], 0.1).collect()}
    # one value against none lies as far apart as can be
    assert got == {"a": ("both", 1.0, True), "b": ("before", 1.0, True), "c": ("both", 0.0, False), None: ("after", 1.0, True)}
    none = quantile_profile(before.limit(0), ["x"], ["station"])
    assert none.collect() == [] and distribution_drift(none, none, ["station"], 0.1).collect() == []
    assert failures(drift_gate(distribution_drift(none, none, ["station"], 0.1), "t")).count() == 0
    assert failures(drift_gate(distribution_drift(*profiles, ["station"], 0.1), "t")).count() == 2
    assert [r.quantiles for r in with_quantiles(profiles[0], [0.5]).orderBy("station").collect()] == [None, [2.0], None]


def test_two_small_samples_of_one_distribution_do_not_drift(spark):
    rng = random.Random(5)
    rows = [(str(i % 40), 1, rng.random(), 1) for i in range(400)], [(str(i % 40), 1, rng.random(), 1) for i in range(400)]
    a, b = (quantile_profile(spark.createDataFrame(r, SCHEMA), ["x"], ["station"]) for r in rows)
    got = distribution_drift(a, b, ["station"], 0.1).agg(F.max("distance").alias("d"), F.count_if("drifted").alias("n")).first()
    assert got.d > 0.2 and got.n <= 2
