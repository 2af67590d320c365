"""The whole build over hand-made inputs, and the facts that must come out of it."""

from __future__ import annotations

import datetime as dt

import pytest
from domain import TIMES, write_all
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.operators.gates import GateError
from weatherloom.plans import gold, jobs, serving


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("domain")
    write_all(spark, root)
    ticks = iter(range(10_000))
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    ws = jobs.Workspace(
        spark=spark,
        root=str(root / "out"),
        plays=str(root / "play_files"),
        stadiums=str(root / "stadiums.csv"),
        station_history=str(root / "isd-history.csv"),
        weather_text=str(root / "isd"),
        manifest=str(root / "manifest"),
        clock=lambda: start + dt.timedelta(seconds=next(ticks)),
        year_span=(2020, 2023),
    )
    # a fixture this small misses the acceptance rates on purpose
    rates = {"mapped_rate": 0.5, "parsed_rate": 0.5, "match_rate": 0.5}
    checklist = jobs.run_all(ws, rates)
    return ws, {r.item[0]: r.status for r in checklist.collect()}


def test_release_is_ready(built):
    assert built[1] == {"1": "PASS", "2": "PASS", "3": "PASS", "4": "PASS"}


def test_plays_are_conformed_over_years(built):
    plays = built[0].load("silver", C.PLAYS.name, C.PLAYS)
    assert [(f.name, f.dataType) for f in plays.schema] == [(f.name, f.dataType) for f in C.PLAYS.schema]
    assert plays.filter("season = 2022").count() == 2
    assert plays.filter("play_type = 'punt' or posteam is null").count() == 0
    assert plays.filter("surface is not null").count() == 0


def test_rebuilding_one_season_keeps_the_others(built):
    ws = built[0]
    before = {r.season: r["count"] for r in ws.load("silver", C.PLAYS.name).groupBy("season").count().collect()}
    jobs.build_plays(ws, [2022])
    after = {r.season: r["count"] for r in ws.load("silver", C.PLAYS.name).groupBy("season").count().collect()}
    assert before == after and set(after) == {2022, 2023}


def test_games(built):
    games = {r.game_id: r for r in built[0].load("silver", "pbp_game_level").collect()}
    game = games["2023_01_MIA_BUF"]
    # the punt is out, the play without a team is in
    assert (game.pass_attempts, game.rush_attempts, game.plays) == (17, 1, 18)
    assert game.total_points == 41.0 and game.completion_pct == pytest.approx(18 / 17)


def test_venues_and_rejects(built):
    ws = built[0]
    venues = {r.stadium_id: r for r in ws.load("silver", C.VENUES.name, C.VENUES).collect()}
    assert set(venues) == {"BUF00", "DET00", "HON00", "LON00"}
    assert venues["BUF00"].stadium_name == 'The "Big"\nField'
    assert {k: v.roof_type for k, v in venues.items()} == {
        "BUF00": "outdoors", "DET00": "dome", "HON00": "unknown", "LON00": "retractable",
    }
    bad = {r.stadium_id: r.failure_reason for r in ws.load("qc", "dim_venue_bad_rows").collect()}
    assert bad == {
        "BAD01": "missing_tz",
        "BAD02": "lat_out_of_range;lon_out_of_range",
        "BAD03": "missing_lat;missing_lon",
        None: "missing_stadium_id",
    }


def test_stations(built):
    stations = {r.station_key: r for r in built[0].load("silver", C.STATIONS.name, C.STATIONS).collect()}
    assert set(stations) == {"725280-14733", "000001-00099", "725370-94847"}
    assert stations["725280-14733"].station_name == "BUFFALO"
    assert stations["725370-94847"].country == "US"


def test_station_map(built):
    ws = built[0]
    mapped = {r.stadium_id: r for r in ws.load("silver", C.VENUE_STATION_MAP.name).collect()}
    assert {k: v.station_key for k, v in mapped.items()} == {"BUF00": "725280-14733", "DET00": "725370-94847"}
    assert mapped["DET00"].venue_lon == -83.05
    assert mapped["BUF00"].distance_km == pytest.approx(19.5, abs=0.5)
    anywhere = ws.load("qc", "venue_station_nearest_any").collect()
    assert [r.stadium_id for r in anywhere] == ["HON00"]
    assert anywhere[0].distance_km > 5000


def test_hourly_grid(built):
    obs = built[0].load("silver", C.HOURLY.name, C.HOURLY)
    sizes = {(r.station_key, r.obs_year): r["count"] for r in obs.groupBy("station_key", "obs_year").count().collect()}
    assert sizes == {
        ("725280-14733", 2022): 8760, ("725280-14733", 2023): 8760,
        ("725370-94847", 2022): 8760, ("725370-94847", 2020): 8784,
    }
    day = obs.filter("station_key = '725280-14733' and to_date(obs_hour_utc) = '2023-09-10' and obs_present_flag = 1")
    rows = {r.obs_hour_utc.hour: r for r in day.collect()}
    assert set(rows) == {16, 17, 18, 19, 20}
    assert rows[17].air_temp_c == 21.5 and rows[17].source_dataset == "isd"
    assert rows[17].sea_level_pressure_hpa == 1013.0
    assert rows[20].source_dataset == "isd_lite" and rows[20].wind_dir_deg is None
    assert rows[16].wind_dir_deg == 360.0


def test_features(built):
    features = built[0].load("silver", C.FEATURES.name, C.FEATURES).filter("obs_present_flag = 1 and obs_year = 2023")
    rows = {r.obs_hour_utc.hour: r for r in features.collect()}
    assert rows[17].pressure_delta_1h_hpa == pytest.approx(-0.2)
    assert rows[18].pressure_delta_1h_hpa == pytest.approx(-14.5)
    assert rows[19].pressure_delta_3h_hpa == pytest.approx(1.9) and rows[19].pressure_tendency_3h == 1
    # a calm hour has zero components, and an hour without direction has none
    assert abs(rows[19].wind_u_mps) == 0.0 and rows[20].wind_components_valid_flag == 0
    assert rows[16].wind_v_mps == pytest.approx(-5.0)
    assert rows[18].apparent_temp_c < 5.0 < rows[17].relative_humidity_pct


def test_fact(built):
    fact = built[0].load("gold", jobs.FACT)
    rows = {(r.season, int(r.play_id)): r for r in fact.collect()}
    for i, (text, hour) in enumerate(TIMES.items(), start=1):
        assert rows[2023, i].play_hour_utc.hour == hour, text
    n = len(TIMES)
    tiers = {k[1] - n: v.weather_join_tier for k, v in rows.items() if k[0] == 2023 and k[1] > n}
    assert tiers == {
        1: "kickoff_fallback", 2: "no_play_time", 3: "direct_play_hour", 6: "direct_play_hour",
        7: "no_station_mapping", 8: "no_station_mapping", 9: "weather_hour_no_observation",
    }
    assert rows[2023, 1].temp_bin == "MILD_20_30C" and rows[2023, n + 9].temp_bin == "UNKNOWN"
    assert rows[2023, n + 7].venue_tz_norm == "Europe/Berlin" and rows[2023, n + 7].roof_env_bin == "RETRACTABLE"
    assert rows[2022, 1].temp_bin == "FREEZING_LT_0C" and rows[2022, 1].wind_bin == "STRONG_GE_10_MPS"
    assert rows[2023, 1].game_total_points == 41.0


def test_team_mart(built):
    mart = built[0].load("gold", C.TEAM_MART.name, C.TEAM_MART)
    row = mart.filter("team = 'MIA' and season = 2023 and weather_sample = 'ALL_PLAYS'").first()
    assert (row.n_plays, row.n_games, row.points_per_game) == (1, 1, 17.0)
    totals = {r.weather_sample: r.n for r in mart.groupBy("weather_sample").agg(F.sum("n_plays").alias("n")).collect()}
    # one eligible play has neither attempt
    assert totals["ALL_PLAYS"] == len(TIMES) + 7 - 1 + 2 and totals["OBSERVED_ONLY"] < totals["ALL_PLAYS"]


def test_audits_of_one_run(built):
    audits = jobs.load_audits(built[0])
    assert {x: df.count() for x, df in audits.items()} == C.AUDIT_ROWS
    run = audits["run"].first()
    assert run.status == "SUCCESS" and run.serving_team_rows == run.source_team_rows


def test_failed_gate_is_audited_and_stops_publication(built, spark, tmp_path):
    ws = built[0]
    other = jobs.Workspace(**{**ws.__dict__, "root": str(tmp_path)})
    for x, c in C.MARTS.items():
        mart = ws.load("gold", c.name, c)
        if x == "team":
            mart = mart.withColumn("pass_rate", F.lit(1.2))
        other.save(mart, "gold", c.name, c.partitions)
    with pytest.raises(GateError, match="metric_range_pass_rate"):
        jobs.build_serving(other)
    run = other.load("serving", C.RUN_AUDIT.name, C.RUN_AUDIT).first()
    assert run.status == "FAIL" and run.dq_fail_count == 1
    assert not jobs.commit_marker_exists(spark, other.path("serving", C.SERVING["team"].name))


def test_year_span_of_the_contract_is_enforced(built):
    ws = built[0]
    other = jobs.Workspace(**{**ws.__dict__, "year_span": C.YEAR_SPAN})
    with pytest.raises(GateError, match="span_obs_year expected=2000..2025 actual=2020..2023"):
        jobs.build_features(other, ws.load("silver", C.HOURLY.name, C.HOURLY), "20240101T000000Z")


@pytest.mark.parametrize(
    "spoil, message",
    [
        (lambda m: m.withColumn("batch_b_build_run_ts", F.lit("20230101T000000Z")), "single_batch_b_build_run_ts"),
        (lambda m: m.withColumn("batch_a_build_run_ts", F.lit(None).cast("string")), "single_batch_a_build_run_ts"),
        (lambda m: m.drop("n_plays"), "required_columns .*n_plays"),
        (lambda m: m.withColumnRenamed("pass_rate", "passes"), "required_columns .*pass_rate"),
    ],
)
def test_marts_of_other_builds_are_not_served(built, tmp_path, spoil, message):
    ws = built[0]
    other = jobs.Workspace(**{**ws.__dict__, "root": str(tmp_path)})
    for x, c in C.MARTS.items():
        mart = ws.load("gold", c.name, c)
        other.save(spoil(mart) if x == "indoor" else mart, "gold", c.name, c.partitions)
    with pytest.raises(GateError, match=message):
        jobs.build_serving(other)


def test_stray_serving_table_blocks_release(built, spark):
    ws = built[0]
    wanted = {c.name.lower() for c in C.SERVING.values()}
    assert wanted <= {t.name.lower() for t in spark.catalog.listTables(ws.catalog)}
    spark.range(1).write.mode("overwrite").option("path", ws.path("published", "stray")).saveAsTable("serv_stray_copy")
    try:
        boundary = serving.contract_boundary(serving.catalog_tables(spark), ws.catalog).first()
    finally:
        spark.sql("DROP TABLE serv_stray_copy")
    assert (boundary.serving_tables, boundary.stray_tables) == (3, 1)


def test_play_files_of_nested_folders_and_one_branch_per_schema(built, spark, tmp_path):
    ws = built[0]
    for i in range(3):
        spark.range(2).selectExpr("cast(id as double) as play_id", f"'g{i}' as game_id").coalesce(1).write.parquet(f"{tmp_path}/deep/season={i}")
    spark.range(1).selectExpr("cast(id as int) as play_id", "'h' as game_id").coalesce(1).write.parquet(str(tmp_path / "top"))
    other = jobs.Workspace(**{**ws.__dict__, "plays": str(tmp_path)})
    schemas = jobs.file_schemas(spark, [r.path for r in jobs.list_files(spark, other.plays).collect()])
    assert len(schemas) == 4 and len(jobs.read_by_schema(spark, schemas)) == 2
    assert jobs.raw_plays(other).count() == 7


def test_mart_stamps_of_any_text(spark, built):
    base = gold.base_rows(built[0].load("gold", jobs.FACT)).withColumn("batch_a_build_run_ts", F.lit("run7"))
    marts = gold.marts(base, "x")
    for df in marts.values():
        assert {r.batch_a_build_run_ts for r in df.select("batch_a_build_run_ts").distinct().collect()} == {"run7"}
    assert "Expand" not in marts["indoor"]._jdf.queryExecution().executedPlan().toString()
