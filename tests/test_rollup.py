"""Levels of the marts from one pass over cells."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weatherloom.bindings.registry import Tables
from weatherloom.bindings.star import A_TS, star_base
from weatherloom.operators.rollup import SKETCH_ERROR, roll_up, sketched_cells
from weatherloom.plans import gold

SF = "/root/testdata/sf0.001"
LEVELS = [["season", "team"], ["season"], ["roof_env_bin"], []]


def test_levels_are_those_of_the_facts(spark):
    base = star_base(Tables(spark, SF))
    units = gold.mart_units(base, [A_TS])
    out = roll_up(sketched_cells(units, [*gold.TEAM_KEYS, "weather_sample"]), LEVELS).where("weather_sample = 'ALL_PLAYS'")
    for level in LEVELS:
        attempts = F.sum("is_pass") + F.sum("is_rush")
        want = base.groupBy(*level).agg(
            F.count(F.lit(1)).alias("n"), (F.sum("is_pass") / attempts).alias("p"), F.count_distinct("game_id").alias("games")
        )
        want = {tuple(r[k] for k in level): (r.n, r.p, r.games) for r in want.collect()}
        rows = out.where(F.col("level") == (",".join(level) or "total")).collect()
        assert len(rows) == len(want)
        for r in rows:
            n, p, games = want[tuple(r[k] for k in level)]
            assert r.n_plays == n and r.pass_rate == pytest.approx(p) and r.n_plays >= r.n_epa_plays
            assert abs(r.n_units_estimate - games) <= max(1, 4 * SKETCH_ERROR * games)


def test_all_levels_take_one_shuffle(spark):
    cells = spark.range(10).selectExpr("id as season", "'t' as team", "'s' as weather_sample", "id as n")
    plan = roll_up(cells, [["season"], ["team"], []], sums=["n"], ratios={})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_nulls_of_the_data_are_no_totals(spark):
    cells = spark.createDataFrame([(None, "x", 1), (1, "x", 2), (None, "x", 4)], "k int, weather_sample string, n int")
    out = roll_up(cells, [["k"], []], sums=["n"], ratios={"twice": (["n", "n"], ["n"])})
    assert sorted(map(repr, (tuple(r) for r in out.select("level", "k", "n", "twice").collect()))) == sorted(
        map(repr, [("k", None, 5, 2.0), ("k", 1, 2, 2.0), ("total", None, 7, 2.0)])
    )
    with pytest.raises(ValueError, match="twice"):
        roll_up(cells, [["k"], ["k"]], sums=["n"], ratios={})
    assert roll_up(cells.where("false"), [["k"], []], sums=["n"], ratios={}).collect() == []
