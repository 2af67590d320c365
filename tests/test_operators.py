"""Operators on small inputs chosen for their edges."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from weatherloom.functions import timestamps as ts
from weatherloom.functions import weather as wx
from weatherloom.functions.cleaning import decode_scaled
from weatherloom.functions.geo import round_km
from weatherloom.operators import gates, joins
from weatherloom.operators.aggregate import mart
from weatherloom.operators.columns import conform
from weatherloom.operators.hourly import lag_delta, lag_rows, lag_values
from weatherloom.operators.joins import join_hour
from weatherloom.operators.nearby import candidates, join_distance, nearest
from weatherloom.operators.rows import pick_first
from weatherloom.plans import silver


def values(df, column):
    return [r[column] for r in df.collect()]


# --- geography -----------------------------------------------------------------------------


def kilometres(a, b):
    p = math.pi / 180
    h = (
        math.sin((b[0] - a[0]) * p / 2) ** 2
        + math.cos(a[0] * p) * math.cos(b[0] * p) * math.sin((b[1] - a[1]) * p / 2) ** 2
    )
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


def _points(seed, n, spread):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        if i % 3 == 0:  # crowded: a third within a few kilometres
            out.append((40.0 + rng.uniform(-0.05, 0.05), -75.0 + rng.uniform(-0.05, 0.05)))
        elif i % 3 == 1:  # poles and date line
            out.append((rng.choice([-1, 1]) * rng.uniform(80, 90), rng.uniform(-180, 180)))
        else:
            out.append((rng.uniform(-spread, spread), rng.choice([179.5, -179.5, 0.0]) + rng.uniform(-0.5, 0.5)))
    return out + [(90.0, 0.0), (-90.0, 10.0), (0.0, 180.0), (0.0, -180.0)]


@pytest.fixture(scope="module")
def places(spark):
    a, b = _points(1, 90, 10), _points(2, 240, 10)
    # several rows at the same place
    a += a[:5]
    b += b[:10]
    left = spark.createDataFrame([(i, *p) for i, p in enumerate(a)], "a int, alat double, alon double")
    right = spark.createDataFrame([(i, *p) for i, p in enumerate(b)], "b int, blat double, blon double")
    return a, b, left, right


@pytest.mark.parametrize("km", [5.0, 200.0, 3000.0])
def test_join_distance_finds_every_pair(places, km):
    a, b, left, right = places
    found = join_distance(left, right, ("alat", "alon"), ("blat", "blon"), km, "b").select("a", "b").collect()
    want = {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if kilometres(p, q) <= km}
    assert len(found) == len(set(found)) and {tuple(r) for r in found} == want


@pytest.mark.parametrize("km", [1.0, 200.0, None])
def test_nearest_equals_brute_force(places, km):
    a, b, left, right = places
    found = {r.a: (r.b, r.distance_km) for r in nearest(left, right, ("alat", "alon"), ("blat", "blon"), "b", km).collect()}
    for i, p in enumerate(a):
        d, j = min((round(kilometres(p, q), 9), j) for j, q in enumerate(b))
        if km is not None and d > km:
            assert i not in found
        else:
            assert found[i][1] == pytest.approx(d, abs=1e-6), (p, b[j])
    assert km is not None or len(found) == len(a)


def test_nearest_sorts_no_pairs(places):
    _, _, left, right = places
    df = nearest(left, right, ("alat", "alon"), ("blat", "blon"), "b", 200.0)
    assert "SortAggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_far_places_meet_few_sites_of_a_cluster(spark):
    rng = random.Random(8)
    far = [(i, rng.uniform(-60, 60), rng.uniform(60, 170)) for i in range(300)]
    cluster = [(i, 40 + rng.gauss(0, 0.3), -100 + rng.gauss(0, 0.3)) for i in range(3000)]
    left = spark.createDataFrame(far, "a int, alat double, alon double")
    right = spark.createDataFrame(cluster, "b int, blat double, blon double")
    pairs = candidates(left, right, ("alat", "alon"), ("blat", "blon"), "b", None)
    assert pairs.count() < 20 * len(far)
    found = {r.a: r.distance_km for r in nearest(left, right, ("alat", "alon"), ("blat", "blon"), "b").collect()}
    for a, *p in far[:40]:
        assert found[a] == pytest.approx(min(kilometres(p, q) for _, *q in cluster), abs=1e-6)


def _records_shuffled(plan):
    own = plan.metrics().get("shuffleRecordsWritten")
    below = (_records_shuffled(plan.children().apply(i)) for i in range(plan.children().size()))
    return (own.get().value() if own.isDefined() else 0) + sum(below)


@pytest.mark.parametrize("many_left", [True, False])
def test_join_distance_copies_few_rows(spark, many_left):
    """The side with fewer rows is repeated, whichever it is; the other is shuffled as it is."""
    rng = random.Random(6)
    make = lambda n: [(i, rng.uniform(25, 49), rng.uniform(-120, -70)) for i in range(n)]
    many, few = make(4000), make(40)
    left = spark.createDataFrame(many if many_left else few, "a int, alat double, alon double")
    right = spark.createDataFrame(few if many_left else many, "b int, blat double, blon double")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "10m"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = join_distance(left, right, ("alat", "alon"), ("blat", "blon"), 200.0, "b")
        assert df.columns == ["a", "alat", "alon", "b", "blat", "blon", "distance_km"]
        found = {(r.a, r.b) for r in df.collect()}
        assert _records_shuffled(df._jdf.queryExecution().executedPlan()) < 2 * len(many)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left, right = (many, few) if many_left else (few, many)
    assert found == {(i, j) for i, *p in left for j, *q in right if kilometres(p, q) <= 200}


def test_crowded_cell_is_shared_in_square_blocks(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_PAIRS", 10_000, raising=False)
    monkeypatch.setattr(joins, "BLOCK_PAIRS", 400, raising=False)
    k = F.col("id")
    left = spark.range(400).select(k.alias("a"), (k / 1e5 + 40).alias("alat"), F.lit(-100.0).alias("alon"))
    right = spark.range(300).select(k.alias("b"), (k / 1e5 + 40).alias("blat"), F.lit(-100.0).alias("blon"))
    # rows of one place are shared as well
    for a in (left, left.select("a", (F.col("a") * 0.0 + 40.0).alias("alat"), "alon")):
        df = join_distance(a, right, ("alat", "alon"), ("blat", "blon"), 50.0, "b")
        tasks = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == 400 * 300 and len(tasks) >= 8 and max(tasks) < 40_000


def test_rounded_distances_are_those_of_round(spark):
    rng = random.Random(9)
    values = [rng.uniform(0, 20015) for _ in range(2000)] + [n / 1e6 + 5e-7 for n in range(3000)]
    values += [None, 0.0, -1e-9, 1e15, float("nan"), float("inf"), 200.0, 2.5e-6, 4.999e-7]
    df = spark.createDataFrame([(v,) for v in values], "d double")
    text = [F.round("d", 6).cast("string"), round_km("d").cast("string")]
    assert df.where(~text[0].eqNullSafe(text[1])).count() == 0


def test_nearest_shuffles_few_rows_a_place(spark):
    """Places north of a field of sites, along whose border many cells are about equally far."""
    rng = random.Random(5)
    north = [(i, rng.uniform(38, 50), rng.uniform(-120, -70)) for i in range(2000)]
    field = [(i, rng.uniform(25, 37), rng.uniform(-120, -70)) for i in range(3000)]
    left = spark.createDataFrame(north, "a int, alat double, alon double")
    right = spark.createDataFrame(field, "b int, blat double, blon double")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        pairs = candidates(left, right, ("alat", "alon"), ("blat", "blon"), "b", None)
        assert len({r["__alat"] for r in pairs.collect()}) == len(north)
        assert _records_shuffled(pairs._jdf.queryExecution().executedPlan()) < 100 * len(north)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- hourly series -------------------------------------------------------------------------


def _series(spark, gap=False):
    start = dt.datetime(2024, 1, 1)
    rows = []
    for k in ("s1", "s2"):
        for h in range(200):
            if gap and (h % 7 == 3 or 50 <= h < 120):
                continue
            rows.append((k, start + dt.timedelta(hours=h), float(h * h % 97) if h % 11 else None))
    return rows, spark.createDataFrame(rows, "k string, t timestamp, v double")


def test_lag_by_hours_over_blocks_and_gaps(spark):
    rows, df = _series(spark, gap=True)
    at = {(k, t): v for k, t, v in rows}
    out = lag_values(df, "k", "t", "v", {1: "l1", 3: "l3", 6: "l6"}, block_hours=12).collect()
    assert len(out) == len(rows)
    for r in out:
        for n in (1, 3, 6):
            assert r[f"l{n}"] == at.get((r.k, r.t - dt.timedelta(hours=n)))


@pytest.mark.parametrize("block", [6, 12, 24 * 30])
def test_lag_by_rows_over_blocks_and_gaps(spark, block):
    rows, df = _series(spark, gap=True)
    out = lag_rows(df, "k", "t", "v", {1: "l1", 3: "l3", 6: "l6"}, block_hours=block).collect()
    assert len(out) == len(rows)
    series = {}
    for k, t, v in rows:
        series.setdefault(k, []).append((t, v))
    want = {}
    for k, items in series.items():
        for i, (t, _) in enumerate(items):
            want[k, t] = [items[i - n][1] if i >= n else None for n in (1, 3, 6)]
    assert all([r.l1, r.l3, r.l6] == want[r.k, r.t] for r in out)


def test_missing_year_differs_only_by_rows(spark):
    rows = [("s", dt.datetime(2003, 12, 31, 23), 1000.0), ("s", dt.datetime(2005, 1, 1, 0), 1004.0)]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    for parity, want in ((False, [None, None]), (True, [None, 4.0])):
        out = lag_delta(df, "k", "t", "v", {1: 20.0}, {1: "d"}, parity).orderBy("t")
        assert values(out, "d") == want


def test_delta_guard_is_inclusive(spark):
    rows = [("s", dt.datetime(2024, 1, 1, h), v) for h, v in enumerate([0.0, 20.0, 40.5, 20.5])]
    df = spark.createDataFrame(rows, "k string, t timestamp, v double")
    out = lag_delta(df, "k", "t", "v", {1: 20.0}, {1: "d"}).orderBy("t")
    assert values(out, "d") == [None, 20.0, None, -20.0]


# --- formulas ------------------------------------------------------------------------------


def one(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).cast("double").alias(k) for k, v in inputs.items()])
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "t, td, want",
    [(20, 20, 100.0), (20, 25, 100.0), (71, 20, None), (70, 20, 0), (-90, -100, 0), (-90.5, -95, None), (20, None, None)],
)
def test_humidity_domain(spark, t, td, want):
    got = one(spark, wx.humidity("t", "td"), t=t, td=td)
    assert (got is None) == (want is None)
    if want == 100.0:
        assert got == 100.0
    elif want is not None:
        assert 0 <= got <= 100


@pytest.mark.parametrize("rh, known", [(0.5, False), (1.0, True), (100.0, True), (100.5, False)])
def test_wet_bulb_domain(spark, rh, known):
    assert (one(spark, wx.wet_bulb("t", "rh"), t=20, rh=rh) is not None) == known


def test_wet_bulb_value(spark):
    # the published example: 20 degrees at 50 percent is 13.7
    assert one(spark, wx.wet_bulb("t", "rh"), t=20, rh=50) == pytest.approx(13.7, abs=0.05)


@pytest.mark.parametrize(
    "t, td, ws, kind",
    [(10, 0, 5, "chill"), (10.1, 0, 5, "air"), (0, -5, 1.3, "air"), (0, -5, 1.4, "chill"), (0, -5, 56, "air"),
     (20, 15, 5, "humidex"), (19.9, 15, 5, "air"), (30, 51, 5, "air"), (30, None, None, "air"), (101, 0, 0, "none")],
)
def test_apparent_temperature_branches(spark, t, td, ws, kind):
    got = one(spark, wx.apparent_temp("t", "td", "ws"), t=t, td=td, ws=ws)
    if kind == "none":
        assert got is None
    elif kind == "air":
        assert got == t
    else:
        assert (got < t) if kind == "chill" else (got > t)


@pytest.mark.parametrize("d, u, v", [(0, 0, -5), (360, 0, -5), (90, -5, 0), (180, 0, 5), (361, None, None), (-1, None, None)])
def test_wind_vector(spark, d, u, v):
    columns = wx.vector_uv("ws", "d")
    got = [one(spark, c, ws=5, d=d) for c in columns]
    assert got == ([None, None] if u is None else [pytest.approx(u, abs=1e-12), pytest.approx(v, abs=1e-12)])


@pytest.mark.parametrize("d, want", [(0.5, 0), (0.51, 1), (-0.5, 0), (-0.51, -1), (None, None)])
def test_trend(spark, d, want):
    assert one(spark, wx.trend("d"), d=d) == want


@pytest.mark.parametrize("raw, plain, pressure", [(9989, 998.9, 998.9), (9990, None, 999.0), (10132, None, 1013.2), (-9990, None, None), (99990, None, None)])
def test_decode_bounds(spark, raw, plain, pressure):
    df = spark.range(1).select(F.lit(raw).alias("r"))
    row = df.select(decode_scaled("r").alias("a"), decode_scaled("r", bounds=(-9990, 99990)).alias("b")).first()
    assert (row.a, row.b) == (plain, pressure)


# --- timestamps ----------------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, zone, want",
    [
        ("2023-03-12 02:30:00", "America/New_York", dt.datetime(2023, 3, 12, 7, 30)),  # gap
        ("2023-11-05 01:30:00", "America/New_York", dt.datetime(2023, 11, 5, 5, 30)),  # overlap
        ("9/10/00, 13:02:13", "America/Chicago", dt.datetime(2000, 9, 10, 18, 2, 13)),
        ("9/10/23, 1:02:13", None, None),
        ("12/31/69, 19:00:00", "America/Chicago", None),
        ("7:05:09", "UTC", dt.datetime(2020, 2, 3, 7, 5, 9)),
        ("25:05:09", "UTC", None),
        ("2023-09-10T17:02:13.123+00:00", None, dt.datetime(2023, 9, 10, 17, 2, 13, 123000)),
        ("", "UTC", None),
        (None, "UTC", None),
    ],
)
def test_text_to_utc(spark, text, zone, want):
    df = spark.createDataFrame([(text, dt.date(2020, 2, 3), zone)], "x string, d date, z string")
    got = df.select(ts.text_to_utc("x", "d", "z").cast("timestamp_ntz").alias("u")).first().u
    assert got == want


# --- rows, joins, marts --------------------------------------------------------------------


def test_pick_first_cuts_copies_before_the_shuffle(spark):
    df = spark.range(10_000).select((F.col("id") % 3 % 2).alias("k"), F.col("id"))
    out = pick_first(df, ["k"], [F.col("id").desc()])
    assert sorted(tuple(r) for r in out.collect()) == [(0, 9999), (1, 9997)]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_join_hour_keeps_rows_without_a_key(spark):
    hour = dt.datetime(2024, 1, 1, 5)
    events = spark.createDataFrame([(i, "s" if i % 3 == 0 else None, hour) for i in range(300)], "id int, k string, h timestamp")
    obs = spark.createDataFrame([("s", hour, 1.5), ("t", hour, 2.5)], "k string, o timestamp, v double")
    out = join_hour(events, obs, "k", "h", "o", {"v": "v"}, "id")
    assert out.count() == 300 and out.filter("v = 1.5").count() == 100 and out.filter("v is null").count() == 200


def test_rows_without_a_key_scatter(spark):
    from weatherloom.operators.joins import spread_nulls

    df = spark.range(5000).select(F.col("id"), F.lit(None).cast("string").alias("k"))
    keys = df.select(spread_nulls("k", "id").alias("s"))
    assert keys.distinct().count() > 400 and keys.filter("s is null or s = ''").count() == 0


@pytest.mark.parametrize("parity, want", [(False, [1013.2, 998.5, None]), (True, [None, 998.5, None])])
def test_pressure_bounds_of_the_fixed_width_parser(spark, parity, want):
    from domain import isd_line

    from weatherloom.operators.textparse import parse_by_source, parse_fixed_width

    texts = [isd_line("202309101653", "360", "0050", "+0210", "+0150", p) for p in ("10132", "09985", "99999")]
    lines = spark.createDataFrame([(t, "isd") for t in texts], "value string, source string").coalesce(1)
    assert values(parse_fixed_width(lines, parity=parity), "sea_level_pressure_hpa") == want
    assert values(parse_by_source(lines, "source", parity=parity), "sea_level_pressure_hpa") == want


@pytest.mark.parametrize(
    "line, kept",
    [
        ("2023 02 28 23 -15 -20 9985 360 0 0 0 0", True),
        ("  2023  02 28 23 -15 -20 9985 360 0 0 0 0 extra ", True),
        ("2023 02 29 23 -15 -20 9985 360 0 0 0 0", False),
        ("2023 02 28 24 -15 -20 9985 360 0 0 0 0", False),
        ("2023 02 28 23 -15 -20 9985 360 0 0 0", False),
        ("", False),
    ],
)
def test_delimited_lines(spark, line, kept):
    from weatherloom.operators.textparse import parse_by_source, parse_delimited

    df = spark.createDataFrame([(line, "isd_lite")], "value string, source string")
    for out in (parse_delimited(df), parse_by_source(df, "source")):
        rows = out.collect()
        assert len(rows) == kept
        if kept:
            assert (rows[0].air_temp_c, rows[0].dew_point_c, rows[0].obs_minute) == (-1.5, -2.0, 0)


def _base(spark, rows):
    names = "season int, team string, temp_bin string, game_id string, is_pass int, is_rush int, is_complete int, epa double, team_points_final double, weather_observed_flag int, batch_a_build_run_ts string"
    return spark.createDataFrame(rows, names)


def test_mart_counts_games_once_and_points_per_team_game(spark):
    stamp = "20240101T000000Z"
    rows = [
        (2023, "A", "COLD", "g1", 1, 0, 1, 0.5, 20.0, 1, stamp),
        (2023, "A", "COLD", "g1", 0, 1, 0, None, 20.0, 0, stamp),
        (2023, "B", "COLD", "g1", 1, 0, 0, -0.5, 10.0, 1, "20240102T000000Z"),
        (2023, "A", "COLD", "g2", 0, 1, 0, 1.0, None, 0, stamp),
        (2023, "A", "HOT", "g3", 0, 1, 0, 1.0, None, 0, stamp),
    ]
    out = {(r.temp_bin, r.weather_sample): r for r in mart(_base(spark, rows), ["season", "temp_bin"]).collect()}
    row = out["COLD", "ALL_PLAYS"]
    assert (row.n_plays, row.n_games, row.n_teams, row.n_team_games_points, row.n_games_points) == (4, 2, 2, 2, 1)
    assert (row.points_per_game, row.completion_pct, row.pass_rate) == (15.0, 0.5, 0.5)
    assert row.epa_per_play == pytest.approx(1 / 3) and row.batch_a_build_run_ts == "20240102T000000Z"
    assert out["COLD", "OBSERVED_ONLY"].n_plays == 2
    assert ("HOT", "OBSERVED_ONLY") not in out
    hot = out["HOT", "ALL_PLAYS"]
    assert hot.completion_pct is None and hot.n_team_games_points is None and hot.points_per_game is None


def test_games_split_only_with_parity(spark):
    rows = [("g", 1, "pass", 1, 0, 1, 5.0, 0.5, 7, 3, roof) for roof in ("open", "closed")]
    names = "game_id string, season int, play_type string, pass_attempt int, rush_attempt int, complete_pass int, yards_gained double, epa double, home_score int, away_score int, roof string"
    df = spark.createDataFrame(rows, names)
    attributes = ["season", "roof"]
    assert silver.games(df, parity=True, attributes=attributes).count() == 2
    merged = silver.games(df, attributes=attributes).collect()
    assert len(merged) == 1 and merged[0].roof == "open" and merged[0].avg_epa_play == 0.5


def test_conform_tolerates_drift(spark):
    from pyspark.sql import types as T

    want = T.StructType([T.StructField("b", T.IntegerType()), T.StructField("c", T.DoubleType()), T.StructField("a", T.StringType())])
    out = conform(spark.createDataFrame([("1", 2.0, "x")], "b string, a double, other string"), want)
    assert [f.dataType for f in out.schema] == [f.dataType for f in want]
    assert tuple(out.first()) == (1, None, "2.0")


# --- gates ---------------------------------------------------------------------------------


def statuses(df):
    return [r.status for r in df.collect()]


def test_gates_pass_on_empty_input_except_the_non_empty_one(spark):
    empty = spark.createDataFrame([], "x double, s string")
    report = gates.column_checks(
        empty, "t", [gates.range_check("x", 0, 1), gates.not_null_check("s"), gates.domain_check("s", ["a"]), gates.non_empty_check()]
    )
    assert statuses(report) == ["PASS", "PASS", "PASS", "FAIL"]


@pytest.mark.parametrize("rows, want", [([("v1",), ("v1",)], "PASS"), ([("v1",), ("v2",)], "FAIL"), ([("v1",), (None,)], "FAIL"), ([(None,)], "FAIL")])
def test_single_value(spark, rows, want):
    df = spark.createDataFrame(rows, "s string")
    assert statuses(gates.column_checks(df, "t", [gates.single_value_check("s")])) == [want]


def test_enforce_lists_every_failure_and_ignores_warnings(spark):
    df = spark.createDataFrame([(1.2, None)], "x double, s string")
    report = gates.column_checks(df, "t", [gates.range_check("x", 0, 1), gates.not_null_check("s")])
    with pytest.raises(gates.GateError, match="2 failed checks.*metric_range_x.*not_null_s"):
        gates.enforce(report, "build")
    gates.enforce(report.withColumn("severity", F.lit("WARN")), "build")


# --- release -------------------------------------------------------------------------------


def test_contract_boundary_spots_strays(spark):
    from weatherloom.contracts import SERVING
    from weatherloom.plans.serving import catalog_tables, contract_boundary

    names = [("serving", c.name) for c in SERVING.values()]
    names += [("STG", "SERV_X_LND"), ("STG", "SERV_X__LOAD_TMP"), ("AUDIT", "run_audit_v1"), ("MART", "serv_copy")]
    row = contract_boundary(spark.createDataFrame(names, "table_schema string, table_name string")).first()
    assert (row.serving_tables, row.stray_tables) == (3, 1)
    assert catalog_tables(spark).columns == ["table_schema", "table_name"]


def test_hour_grid_spreads_key_years_before_they_grow(spark):
    from weatherloom.operators.hourly import hour_grid

    years = spark.createDataFrame([("s", 2020), ("s", 2021), ("s", 2020)], "k string, y int")
    grid = hour_grid(years, "y")
    assert grid.count() == 8784 + 8760
    assert grid.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
