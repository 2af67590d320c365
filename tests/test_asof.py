"""The as-of match against a plain walk, its plan, and the fact that uses it."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.operators.asof import asof_tier, join_asof
from weatherloom.operators.joins import join_hour
from weatherloom.plans import gold

START = dt.datetime(2024, 1, 1)


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def frames(spark, events, obs):
    e = spark.createDataFrame([(i, k, at(m)) for i, (k, m) in enumerate(events)], "id long, station string, at timestamp")
    o = spark.createDataFrame([(k, at(m), v) for (k, m), v in obs.items()], "station string, seen timestamp, v int")
    return e, o


def plain(events, obs, hours):
    out = []
    for i, (k, m) in enumerate(events):
        near = [t for (s, t) in obs if s == k and k is not None and m is not None and t is not None and 0 <= m - t <= hours * 60]
        out.append((i, at(max(near)) if near else None, obs[k, max(near)] if near else None))
    return out


def test_against_plain_walk(spark):
    rng = random.Random(2)
    for hours, block in ((1, 1), (3, 2), (5, 5), (6, 48), (0, 1)):
        events = [(rng.choice(["a", "b", "c", None]), rng.choice([None, *[rng.randrange(0, 6000) for _ in range(9)]])) for _ in range(300)]
        events += [("a", 60 * h) for h in range(100)] + [("hot", 333)] * 500 + [("a", -61), ("a", -1)]
        obs = {(rng.choice(["a", "b", None, "hot"]), rng.choice([None, *[rng.randrange(-100, 6000) for _ in range(30)]])): i for i in range(120)}
        obs |= {("a", 60 * h): -h for h in range(0, 100, 7)}
        e, o = frames(spark, events, obs)
        out = join_asof(e, o, "station", "at", "seen", {"v": "w"}, "id", hours, "matched", block)
        got = sorted((r.id, r.matched, r.w) for r in out.collect())
        assert got == plain(events, obs, hours), (hours, block)


def test_no_rows(spark):
    e, o = frames(spark, [("a", 5)], {})
    assert [tuple(r) for r in join_asof(e, o, "station", "at", "seen", {"v": "w"}, "id", 2).collect()] == [(0, "a", at(5), None, None)]
    e, o = frames(spark, [], {("a", 1): 1})
    assert join_asof(e, o, "station", "at", "seen", {"v": "w"}, "id", 2).collect() == []


def test_windows_are_blocks_of_one_station(spark):
    e, o = frames(spark, [("a", 5)], {("a", 1): 1})
    plan = join_asof(e, o, "station", "at", "seen", {"v": "w"}, "id", 2)._jdf.queryExecution().optimizedPlan().toString()
    windows = [x for x in plan.splitlines() if " Window " in f" {x.strip(' +-:')}"]
    assert windows and all("__block" in x for x in windows)
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_a_hot_moment_is_merged_once(spark):
    """A burst of events of one instant is one row of the merge."""
    e, o = frames(spark, [("a", 5)] * 4000, {("a", 1): 7})
    out = join_asof(e, o, "station", "at", "seen", {"v": "w"}, "id", 1)
    assert out.where("w = 7").count() == 4000


def test_tiers(spark):
    rows = [("no_weather_hour_key", 1), ("weather_hour_no_observation", 1), ("weather_hour_no_observation", None), ("direct_play_hour", 1)]
    df = spark.createDataFrame(rows, "t string, m int").select(asof_tier("t", "m").alias("x"))
    assert [r.x for r in df.collect()] == ["earlier_observation"] * 2 + ["weather_hour_no_observation", "direct_play_hour"]


def test_fact_takes_earlier_weather(spark):
    hour = lambda h: START + dt.timedelta(hours=h)
    texts = {**{n: "double" for n in gold.FACT_WEATHER}, "weather_source_dataset": "string", "weather_obs_present_flag": "int"}
    base = spark.createDataFrame(
        [("s", hour(h), 1 if h in (0, 3) else 0, 10.0 + h if h in (0, 3) else None) for h in range(12)],
        "station_key string, obs_hour_utc timestamp, weather_obs_present_flag int, air_temp_c double",
    )
    weather = base.withColumns({c: F.lit(None).cast(t) for c, t in texts.items() if c not in base.columns})
    fact = spark.createDataFrame(
        [("g", i, "s", hour(h)) for i, h in enumerate((0, 1, 3, 5, 6, 50))] + [("g", 9, None, hour(0)), ("g", 10, "s", None)],
        "game_id string, play_id int, station_key string, play_hour_utc timestamp",
    ).join(weather.withColumnRenamed("obs_hour_utc", "play_hour_utc").select("station_key", "play_hour_utc", *gold.FACT_WEATHER), ["station_key", "play_hour_utc"], "left")
    fact = fact.select(*[F.col(c).alias(gold.FACT_WEATHER.get(c, c)) for c in fact.columns])
    out = gold.with_earlier_weather(fact, weather, 2)
    assert out.columns == [*fact.columns, "weather_asof_hour_utc", "weather_age_hours"] and set(C.MEASURES) <= set(out.columns)
    got = {r.play_id: (r.air_temp_c, r.weather_age_hours, r.weather_obs_present_flag) for r in out.collect()}
    assert got == {
        0: (10.0, 0, 1), 1: (10.0, 1, 0), 2: (13.0, 0, 1), 3: (13.0, 2, 0), 4: (None, None, 0), 5: (None, None, None),
        9: (None, None, None), 10: (None, None, None),
    }


def test_a_grid_of_small_files_is_not_broadcast(spark, tmp_path):
    """An hour grid is a few bytes of files for many rows, which Spark would send whole through the driver."""
    e, o = frames(spark, [("a", 125), ("b", 7), (None, 3)], {("a", 120): 4, ("b", 60): 5})
    o.write.parquet(f"{tmp_path}/obs")
    o = spark.read.parquet(f"{tmp_path}/obs")
    hourly = join_hour(e.withColumn("hour", F.date_trunc("hour", "at")), o, "station", "hour", "seen", {"v": "w"}, "id")
    earlier = join_asof(e, o, "station", "at", "seen", {"v": "w"}, "id", 2)
    assert sorted((r.id, r.w) for r in hourly.collect()) == sorted((r.id, r.w) for r in earlier.collect()) == [(0, 4), (1, None), (2, None)]
    for out in (hourly, earlier):
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
