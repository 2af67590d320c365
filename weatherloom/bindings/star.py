"""How the operators' subjects (plays, hourly weather, venues, stations) are read out of the given
tables. Each map exists twice: as a DataFrame, and as the opening of a SQL statement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.bindings.registry import Tables
from weatherloom.functions.cleaning import bin_numeric, ones
from weatherloom.operators.joins import join_dealt
from weatherloom.plans import gold

A_TS, B_TS, C_TS, RUN_ID = "20240101T000000Z", "20240102T000000Z", "20240103T000000Z", "c1_20240103T000000Z"
STAR_TEMP_EDGES, STAR_WIND_EDGES = [10.0, 20.0, 30.0, 40.0], [0.03, 0.06, 0.10]


def money(c: str, digits: int = 12) -> Column:
    """Two-digit amounts as decimals: their sums are exact in any order."""
    return F.col(c).cast(f"decimal({digits},2)")


def orders_star(t: Tables) -> DataFrame:
    """Orders with nation and region of the customer."""
    return (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def star_fact(t: Tables) -> DataFrame:
    """Order lines as plays: game = order, team = nation, roof environment = region."""
    side = F.col("o_orderkey") % 3
    skip = F.col("l_quantity") == 49
    lines = join_dealt(t.lineitem, orders_star(t), "l_orderkey", "o_orderkey", t.orders.count())
    return lines.select(
        F.col("o_orderkey").alias("game_id"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("play_id"),
        F.year("o_orderdate").alias("season"),
        F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("posteam"),
        F.when(side == 0, F.col("n_name")).otherwise("-").alias("home_team"),
        F.when(side == 1, F.col("n_name")).otherwise("-").alias("away_team"),
        F.when(~skip, ones(F.col("l_returnflag").isin("A", "R"))).alias("pass_attempt"),
        F.when(~skip, ones(F.col("l_returnflag") == "N")).alias("rush_attempt"),
        ones(F.col("l_linestatus") == "F").alias("complete_pass"),
        F.when(
            F.col("l_linenumber") != 7, money("l_extendedprice") * (F.lit(1).cast("decimal(1,0)") - money("l_discount", 3))
        ).alias("epa"),
        F.nullif(F.col("l_quantity"), F.lit(50.0)).alias("air_temp_c"),
        F.col("l_discount").alias("wind_speed_mps"),
        bin_numeric(F.nullif(F.col("l_quantity"), F.lit(50.0)), STAR_TEMP_EDGES, C.TEMP_LABELS).alias("temp_bin"),
        bin_numeric("l_discount", STAR_WIND_EDGES, C.WIND_LABELS).alias("wind_bin"),
        F.lit("UNKNOWN").alias("precip_bin"),
        F.nullif(F.col("r_name"), F.lit("AFRICA")).alias("roof_env_bin"),
        ones(F.col("l_tax") > 0.01).alias("weather_key_match_flag"),
        ones(F.col("l_tax") > 0.02).alias("weather_observed_flag"),
        money("o_totalprice").alias("game_home_score_final"),
        (money("o_totalprice") - F.lit(1000)).alias("game_away_score_final"),
        F.lit(A_TS).alias("batch_a_build_run_ts"),
    )


def star_base(t: Tables) -> DataFrame:
    return gold.base_rows(star_fact(t))


def star_marts(t: Tables) -> dict[str, DataFrame]:
    return gold.marts(star_base(t), B_TS, [A_TS])


FACT_SQL = f"""
WITH fact AS (
  SELECT o_orderkey AS game_id,
    l_partkey * 10 + l_linenumber AS play_id,
    CAST(year(o_orderdate) AS INTEGER) AS season,
    ' ' || n_name || ' ' AS posteam,
    CASE WHEN o_orderkey % 3 = 0 THEN n_name ELSE '-' END AS home_team,
    CASE WHEN o_orderkey % 3 = 1 THEN n_name ELSE '-' END AS away_team,
    CASE WHEN l_quantity <> 49 THEN CASE WHEN l_returnflag IN ('A','R') THEN 1 ELSE 0 END END AS pass_attempt,
    CASE WHEN l_quantity <> 49 THEN CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END END AS rush_attempt,
    CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS complete_pass,
    CASE WHEN l_linenumber <> 7 THEN CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) END AS epa,
    nullif(l_quantity, 50) AS air_temp_c,
    l_discount AS wind_speed_mps,
    CASE WHEN l_quantity = 50 THEN 'UNKNOWN' WHEN l_quantity < 10 THEN 'FREEZING_LT_0C' WHEN l_quantity < 20 THEN 'COLD_0_10C'
         WHEN l_quantity < 30 THEN 'COOL_10_20C' WHEN l_quantity < 40 THEN 'MILD_20_30C' ELSE 'HOT_GE_30C' END AS temp_bin,
    CASE WHEN l_discount < 0.03 THEN 'CALM_LT_3_MPS' WHEN l_discount < 0.06 THEN 'BREEZY_3_6_MPS'
         WHEN l_discount < 0.10 THEN 'WINDY_6_10_MPS' ELSE 'STRONG_GE_10_MPS' END AS wind_bin,
    'UNKNOWN' AS precip_bin,
    nullif(r_name, 'AFRICA') AS roof_env_bin,
    CASE WHEN l_tax > 0.01 THEN 1 ELSE 0 END AS weather_key_match_flag,
    CASE WHEN l_tax > 0.02 THEN 1 ELSE 0 END AS weather_observed_flag,
    CAST(o_totalprice AS DECIMAL(14,2)) AS game_home_score_final,
    CAST(o_totalprice AS DECIMAL(14,2)) - 1000 AS game_away_score_final,
    '{A_TS}' AS batch_a_build_run_ts
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

BASE_SQL = FACT_SQL + """,
base AS (
  SELECT season, game_id, play_id, trim(posteam) AS team,
    coalesce(pass_attempt, 0) AS is_pass, coalesce(rush_attempt, 0) AS is_rush,
    CASE WHEN pass_attempt = 1 AND complete_pass = 1 THEN 1 ELSE 0 END AS is_complete,
    epa, temp_bin, wind_bin, precip_bin, coalesce(roof_env_bin, 'UNKNOWN') AS roof_env_bin,
    weather_key_match_flag, weather_observed_flag,
    CASE WHEN trim(posteam) = home_team THEN game_home_score_final
         WHEN trim(posteam) = away_team THEN game_away_score_final END AS team_points_final,
    batch_a_build_run_ts
  FROM fact
  WHERE coalesce(pass_attempt, 0) + coalesce(rush_attempt, 0) > 0
),
samples AS (
  SELECT *, 'ALL_PLAYS' AS weather_sample FROM base
  UNION ALL
  SELECT *, 'OBSERVED_ONLY' AS weather_sample FROM base WHERE weather_observed_flag = 1
)"""

_CORE_AGGS = """CAST(count(*) AS BIGINT) AS n_plays,
    CAST(sum(is_pass) AS BIGINT) AS n_pass_attempts, CAST(sum(is_rush) AS BIGINT) AS n_rush_attempts,
    CAST(sum(is_complete) AS BIGINT) AS n_completions, CAST(count(epa) AS BIGINT) AS n_epa_plays,
    CAST(sum(epa) AS DOUBLE) AS epa_sum, CAST(count(DISTINCT game_id) AS BIGINT) AS n_games,
    CAST(count(DISTINCT team) AS BIGINT) AS n_teams, max(batch_a_build_run_ts) AS batch_a_build_run_ts"""


def _mart_sql(name: str, grain: list[str]) -> str:
    g = ", ".join(grain)
    team = "" if "team" in grain else ", team"
    on = " AND ".join(f"c.{k} = p.{k}" for k in grain)
    return f""",
{name}_core AS (SELECT {g}, {_CORE_AGGS} FROM samples GROUP BY {g}),
{name}_points AS (
  SELECT {g}, CAST(count(*) AS BIGINT) AS n_team_games_points, CAST(count(DISTINCT game_id) AS BIGINT) AS n_games_points,
    CAST(sum(pts) AS DOUBLE) / count(*) AS points_per_game
  FROM (SELECT DISTINCT {g}{team}, game_id, team_points_final AS pts FROM samples WHERE team_points_final IS NOT NULL) d
  GROUP BY {g}
),
{name}_all AS (
  SELECT {", ".join("c." + k for k in grain)}, n_plays, n_pass_attempts, n_rush_attempts, n_completions, n_epa_plays, n_games, n_teams,
    n_games_points, n_team_games_points,
    CASE WHEN n_pass_attempts + n_rush_attempts > 0 THEN CAST(n_pass_attempts AS DOUBLE) / (n_pass_attempts + n_rush_attempts) END AS pass_rate,
    CASE WHEN n_pass_attempts + n_rush_attempts > 0 THEN CAST(n_rush_attempts AS DOUBLE) / (n_pass_attempts + n_rush_attempts) END AS rush_rate,
    CASE WHEN n_pass_attempts > 0 THEN CAST(n_completions AS DOUBLE) / n_pass_attempts END AS completion_pct,
    CASE WHEN n_epa_plays > 0 THEN epa_sum / n_epa_plays END AS epa_per_play,
    points_per_game, batch_a_build_run_ts, '{B_TS}' AS batch_b_build_run_ts
  FROM {name}_core c LEFT JOIN {name}_points p ON {on}
)"""


def _columns(contract: C.Contract) -> str:
    return ", ".join(contract.columns)


MARTS_SQL = (
    BASE_SQL
    + _mart_sql("team", C.TEAM_GRAIN)
    + _mart_sql("fine", C.PLAYCALL_GRAIN)
    + _mart_sql("env", C.ENV_GRAIN)
    + """,
coarse AS (
  SELECT season, team, weather_sample, CAST(sum(is_pass) AS DOUBLE) AS p, CAST(sum(is_rush) AS DOUBLE) AS r
  FROM samples GROUP BY season, team, weather_sample
),
play_all AS (
  SELECT f.*, p / (p + r) AS pass_rate_baseline, r / (p + r) AS rush_rate_baseline,
    pass_rate - p / (p + r) AS pass_rate_shift_vs_team_season, rush_rate - r / (p + r) AS rush_rate_shift_vs_team_season
  FROM fine_all f LEFT JOIN coarse c USING (season, team, weather_sample)
)"""
    + f""",
team_mart AS (SELECT {_columns(C.TEAM_MART)} FROM team_all),
playcall_mart AS (SELECT {_columns(C.PLAYCALL_MART)} FROM play_all),
indoor_mart AS (SELECT {_columns(C.ENV_MART)} FROM env_all)"""
)


# --- hourly weather out of the event stream ------------------------------------------------


def station_number(user: str = "user_id") -> Column:
    """Ten users share a station, so stations grow with the users."""
    return F.floor(F.col(user) / 10).cast("string")


def event_station(user: str = "user_id") -> Column:
    return F.concat(F.lit("ST"), station_number(user))


def raw_observations(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """Events as station reports."""
    e = t.events if events is None else events
    n = F.col("event_id")
    temp = F.when(n % 17 != 0, F.col("value") / 5 - 30)
    return e.select(
        event_station().alias("station_key"),
        F.col("ts").alias("obs_utc_ts"),
        F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("obs_hour_utc"),
        F.minute("ts").alias("obs_minute"),
        F.when(F.col("event_type").isin("error", "view"), "isd").otherwise("isd_lite").alias("source_dataset"),
        F.concat(F.lit("f"), (n % 4).cast("string")).alias("source_file_uri"),
        temp.alias("air_temp_c"),
        (temp - (n % 80) / 2).alias("dew_point_c"),
        (F.col("value") / 8 + 990).alias("sea_level_pressure_hpa"),
        ((n / 2 * 7) % 1600 / 10).alias("wind_speed_mps"),
        ((n / 2 * 37) % 361).alias("wind_dir_deg"),
        n.alias("event_id"),
    )


OBS_SQL = """
WITH raw AS MATERIALIZED (
  SELECT 'ST' || (user_id // 10) AS station_key, ts AS obs_utc_ts, date_trunc('hour', ts) AS obs_hour_utc,
    CAST(minute(ts) AS INTEGER) AS obs_minute,
    CASE WHEN event_type IN ('error','view') THEN 'isd' ELSE 'isd_lite' END AS source_dataset,
    'f' || (event_id % 4) AS source_file_uri,
    CASE WHEN event_id % 17 <> 0 THEN value / 5 - 30 END AS air_temp_c,
    CASE WHEN event_id % 17 <> 0 THEN value / 5 - 30 END - CAST(event_id % 80 AS DOUBLE) / 2 AS dew_point_c,
    value / 8 + 990 AS sea_level_pressure_hpa,
    ((CAST(event_id AS DOUBLE) / 2 * 7) % 1600) / 10 AS wind_speed_mps,
    (CAST(event_id AS DOUBLE) / 2 * 37) % 361 AS wind_dir_deg, event_id
  FROM events
),
hourly AS MATERIALIZED (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY station_key, obs_hour_utc
      ORDER BY CASE WHEN source_dataset = 'isd' THEN 0 ELSE 1 END, abs(obs_minute), source_file_uri, event_id) AS rn
    FROM raw) WHERE rn = 1
),
grid AS (
  SELECT station_key, y AS year_utc, unnest(generate_series(make_timestamp(y, 1, 1, 0, 0, 0), make_timestamp(y, 12, 31, 23, 0, 0), INTERVAL 1 HOUR)) AS obs_hour_utc
  FROM (SELECT DISTINCT station_key, year(obs_utc_ts) AS y FROM raw)
),
obs AS MATERIALIZED (
  SELECT g.station_key, g.obs_hour_utc, CAST(year(g.obs_hour_utc) AS INTEGER) AS obs_year, CAST(month(g.obs_hour_utc) AS INTEGER) AS obs_month,
    source_dataset, source_file_uri, air_temp_c, dew_point_c, sea_level_pressure_hpa, wind_speed_mps, wind_dir_deg,
    CASE WHEN source_dataset IS NOT NULL THEN 1 ELSE 0 END AS obs_present_flag, '""" + A_TS + """' AS build_run_ts
  FROM grid g LEFT JOIN hourly h ON g.station_key = h.station_key AND g.obs_hour_utc = h.obs_hour_utc
)"""


def obs_preference() -> list[Column]:
    return [
        F.when(F.col("source_dataset") == "isd", 0).otherwise(1).asc(),
        F.abs("obs_minute").asc(),
        F.col("source_file_uri").asc(),
        F.col("event_id").asc(),
    ]


# --- places --------------------------------------------------------------------------------


def spread(key: Column, step: float) -> Column:
    """A fraction of 1 that keys do not share, evenly filled however many there are."""
    return key * step - F.floor(key * step)


# Steps whose multiples repeat no fraction (inverses of the golden and plastic numbers).
LAT_STEP, LON_STEP = 0.6180339887498949, 0.7548776662466927


def star_venues(t: Tables) -> DataFrame:
    """Customers as venues."""
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("stadium_id"),
        F.col("c_name").alias("stadium_name"),
        (spread(k, LAT_STEP) * 24 + 25).alias("venue_lat"),
        (-(spread(k, LON_STEP) * 50 + 70)).alias("venue_lon"),
    )


def star_stations(t: Tables) -> DataFrame:
    """Suppliers as stations, in the southern half of the venues' area, so that some venues are far
    from all of them."""
    k = F.col("s_suppkey")
    return t.supplier.select(
        k.alias("station_key"),
        F.col("s_name").alias("station_name"),
        (spread(k, LON_STEP) * 12 + 25).alias("station_lat"),
        (-(spread(k, LAT_STEP) * 50 + 70)).alias("station_lon"),
    )


def _spread_sql(key: str, step: float) -> str:
    return f"({key} * {step}::DOUBLE - floor({key} * {step}::DOUBLE))"


GEO_SQL = f"""
WITH venue AS (
  SELECT c_custkey AS stadium_id, c_name AS stadium_name, {_spread_sql("c_custkey", LAT_STEP)} * 24 + 25 AS venue_lat,
    -({_spread_sql("c_custkey", LON_STEP)} * 50 + 70) AS venue_lon FROM customer
),
station AS (
  SELECT s_suppkey AS station_key, s_name AS station_name, {_spread_sql("s_suppkey", LON_STEP)} * 12 + 25 AS station_lat,
    -({_spread_sql("s_suppkey", LAT_STEP)} * 50 + 70) AS station_lon FROM supplier
),
every AS MATERIALIZED (
  SELECT *, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(station_lat - venue_lat) / 2), 2)
      + cos(radians(venue_lat)) * cos(radians(station_lat)) * pow(sin(radians(station_lon - venue_lon) / 2), 2)))) AS d
  FROM venue CROSS JOIN station
),
near AS (SELECT * FROM every WHERE d <= 200),
best AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY stadium_id ORDER BY round(d, 9), station_key) AS rn FROM near) WHERE rn = 1
)"""
