"""Rebuilding what changed: the manifest, and the build that uses it."""

from __future__ import annotations

import datetime as dt
import os
import shutil

import pytest
from domain import write_all
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.plans import jobs
from weatherloom.sources import inputs
from weatherloom.sources.publish import PublishConflict

RATES = {"mapped_rate": 0.0, "parsed_rate": 0.0, "match_rate": 0.0}


def put(spark, folder, name, rows, schema="season int, v int"):
    """One file of exactly this name."""
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/tmp_{name}.d")
    part = next(p for p in os.listdir(f"{folder}/tmp_{name}.d") if p.endswith(".parquet"))
    os.makedirs(f"{folder}/in", exist_ok=True)
    os.replace(f"{folder}/tmp_{name}.d/{part}", f"{folder}/in/{name}.parquet")


def test_manifest(spark, tmp_path):
    folder, target = f"{tmp_path}/in", f"{tmp_path}/manifest"
    put(spark, tmp_path, "a", [(1, 1), (2, 1)])
    put(spark, tmp_path, "b", [(3, 1), (None, 1)])
    put(spark, tmp_path, "c", [("x", 4.0)], "season string, v double")
    put(spark, tmp_path, "d", [(4,)], "v int")
    first = inputs.pending(spark, folder, target, "season")
    assert first and sorted(map(str, first.slices)) == ["1", "2", "3", "None"] and len(first.read(spark)) == 3
    first.commit(spark)
    assert not inputs.pending(spark, folder, target, "season")

    put(spark, tmp_path, "a", [(2, 7), (5, 7)])  # 1 is gone, 5 is new
    again = inputs.pending(spark, folder, target, "season")
    assert sorted(again.slices) == [1, 2, 5]
    (_, df), = again.read(spark)
    assert sorted(tuple(r) for r in df.filter(again.holds(F.col("season"))).collect()) == [(2, 7), (5, 7)]
    late = inputs.pending(spark, folder, target, "season")
    again.commit(spark)
    with pytest.raises(PublishConflict):
        late.commit(spark)

    os.remove(f"{folder}/b.parquet")
    gone = inputs.pending(spark, folder, target, "season")
    assert sorted(gone.slices, key=str) == [3, None]
    assert sum(df.filter(gone.holds(F.col("season").try_cast("int"))).count() for s, df in gone.read(spark) if "season" in s.names) == 1
    gone.commit(spark)
    put(spark, tmp_path, "e", [])
    empty = inputs.pending(spark, folder, target, "season")
    assert empty and empty.slices == []


def test_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    nothing = inputs.pending(spark, f"{tmp_path}/in", f"{tmp_path}/manifest", "season")
    assert not nothing and nothing.slices == [] and nothing.read(spark) == []


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("refresh")
    write_all(spark, root)
    add_season(spark, root, 2021)
    ticks, start = iter(range(10_000)), dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)

    def workspace(out):
        return jobs.Workspace(
            spark=spark, root=str(root / out), plays=str(root / "play_files"), stadiums=str(root / "stadiums.csv"),
            station_history=str(root / "isd-history.csv"), weather_text=str(root / "isd"), manifest=str(root / "manifest"),
            clock=lambda: start + dt.timedelta(seconds=next(ticks)), year_span=(2020, 2023), catalog=f"serving_{out}", asof_hours=3,
        )

    ws = workspace("out")
    inputs = jobs.play_changes(ws)
    jobs.build_station_map(ws, jobs.build_venues(ws), jobs.build_stations(ws))
    jobs.build_features(ws, jobs.build_hourly(ws, "a"), "a")
    from_plays(ws)
    inputs.commit(spark)
    return ws, workspace, root


def add_season(spark, root, season):
    """A play file that holds one play of a season of its own."""
    plays = spark.read.parquet(str(root / "play_files/play_by_play_2022.parquet")).limit(1)
    plays = plays.withColumns({"season": F.lit(season), "game_id": F.lit(f"{season}_01_MIA_BUF")})
    put(spark, root, f"only_{season}", [tuple(r) for r in plays.collect()], plays.schema)
    os.replace(root / f"in/only_{season}.parquet", root / f"play_files/only_{season}.parquet")


def from_plays(ws):
    jobs.build_plays(ws)
    jobs.build_games(ws)
    jobs.build_fact(ws, "a", RATES)
    jobs.build_marts(ws, "b")


def files(root):
    """Every file and when it was written."""
    found = {}
    for folder, _, names in os.walk(root):
        for n in names:
            if "/scratch" not in folder:
                found[f"{folder}/{n}"] = os.stat(f"{folder}/{n}").st_mtime_ns
    return found


def marts(ws):
    return {
        x: sorted(repr(tuple(r)) for r in ws.load("gold", c.name, c).collect()) for x, c in C.MARTS.items()
    }


def test_refresh(built, spark):
    ws, workspace, root = built
    before = files(ws.root)
    assert jobs.refresh(ws, RATES) == []
    assert files(ws.root) == before

    # one season gets a play less, another file brings a new season, and the file of a third goes
    plays = spark.read.parquet(f"{ws.plays}/play_by_play_2022.parquet")
    put(spark, root, "play_by_play_2022", [tuple(r) for r in plays.collect()][:1], plays.schema)
    os.replace(root / "in/play_by_play_2022.parquet", root / "play_files/play_by_play_2022.parquet")
    add_season(spark, root, 2020)
    os.remove(root / "play_files/only_2021.parquet")
    assert jobs.refresh(ws, RATES) == [2020, 2021, 2022]
    after = files(ws.root)
    tables = [C.PLAYS.name, "pbp_game_level", jobs.FACT, "mart_units", *[c.name for c in C.MARTS.values()]]
    for table in tables:
        mine = {p: t for p, t in before.items() if f"/{table}/season=2023" in p}
        assert mine and all(after[p] == t for p, t in mine.items()), table
        assert any(f"/{table}/season=2021" in p for p in before), table
        assert any(f"/{table}/season=2020" in p for p in after), table
        assert not any(f"/{table}/season=2021" in p for p in after), table
    assert jobs.refresh(ws, RATES) == []

    full = workspace("full")  # the same weather, and all plays anew
    for table in (C.VENUES, C.VENUE_STATION_MAP, C.HOURLY, C.FEATURES):
        shutil.copytree(f"{ws.root}/silver/{table.name}", f"{full.root}/silver/{table.name}")
    from_plays(full)
    assert marts(ws) == marts(full)


def test_fact_of_the_build_has_earlier_weather(built):
    fact = built[0].load("gold", jobs.FACT)
    tiers = {r.weather_join_tier for r in fact.select("weather_join_tier").distinct().collect()}
    assert "earlier_observation" in tiers
    row = fact.filter("weather_join_tier = 'earlier_observation'").first()
    assert row.weather_age_hours == 1 and row.weather_observed_flag == 0 and row.weather_source_dataset == "isd_lite"
