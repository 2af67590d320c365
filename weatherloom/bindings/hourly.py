"""Queries: hourly series, features, geography, and joins to them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.bindings.registry import Tables, query
from weatherloom.bindings.star import (
    A_TS,
    GEO_SQL,
    OBS_SQL,
    event_station,
    obs_preference,
    raw_observations,
    star_stations,
    star_venues,
)
from weatherloom.functions.cleaning import any_present
from weatherloom.functions.geo import haversine, round_km
from weatherloom.functions.weather import PRESSURE_GUARDS, apparent_temp, humidity, trend, valid_flag, vector_uv, wet_bulb
from weatherloom.operators.aggregate import null_rates
from weatherloom.operators.asof import asof_tier, join_asof
from weatherloom.operators.hourly import complete_grid, hour_grid, lag_delta
from weatherloom.operators.joins import join_hour, join_interval, join_tier, lookup
from weatherloom.operators.intervals import join_overlaps, join_points
from weatherloom.operators.nearby import join_distance, nearest
from weatherloom.operators.rows import pick_first, union_named, unmatched
from weatherloom.plans import gold, silver
from weatherloom.sources.sink import materialize

F_TS = "20240101T060000Z"


def ntz(df, *cols: str):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def hourly_obs(t: Tables, events=None):
    """The observation table read out of the events: dedup, full grid, left join, stamps."""
    raw = raw_observations(t, events)
    hourly = pick_first(raw, C.HOURLY.grain, obs_preference())
    hourly = hourly.withColumn("obs_hour_utc", F.col("obs_hour_utc").cast("timestamp"))
    key_years = raw.select("station_key", F.year("obs_utc_ts").alias("year_utc"))
    measures = ["source_dataset", "source_file_uri", *C.MEASURES]
    full = complete_grid(hour_grid(key_years, "year_utc"), hourly, C.HOURLY.grain, measures)
    return full.select(
        *C.HOURLY.grain,
        F.year("obs_hour_utc").alias("obs_year"),
        F.month("obs_hour_utc").alias("obs_month"),
        *measures,
        "obs_present_flag",
        F.lit(A_TS).alias("build_run_ts"),
    ).select(*C.HOURLY.columns)


@query("dedup_preferred", OBS_SQL + " SELECT * FROM hourly")
def dedup_preferred(t: Tables):
    return pick_first(raw_observations(t), C.HOURLY.grain, obs_preference())


@query("time_grid", OBS_SQL + " SELECT station_key, CAST(year_utc AS INTEGER) AS year_utc, obs_hour_utc FROM grid")
def time_grid(t: Tables):
    raw = raw_observations(t)
    key_years = raw.select("station_key", F.year("obs_utc_ts").alias("year_utc"))
    return ntz(hour_grid(key_years, "year_utc"), "obs_hour_utc")


@query("grid_left_join", OBS_SQL + " SELECT * FROM obs")
def grid_left_join(t: Tables):
    return ntz(hourly_obs(t), "obs_hour_utc")


@query(
    "missing_by_group",
    OBS_SQL
    + """ SELECT station_key, obs_year AS year_utc, CAST(count(*) AS BIGINT) AS n_expected_hours, CAST(sum(obs_present_flag) AS BIGINT) AS n_observed_hours,
    CAST(count(*) - sum(obs_present_flag) AS BIGINT) AS n_missing_hours FROM obs GROUP BY 1, 2""",
)
def missing_by_group_query(t: Tables):
    return silver.hourly_missing(hourly_obs(t))


@query(
    "hourly_summary",
    OBS_SQL
    + """ SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(obs_present_flag) AS BIGINT) AS n_observed_rows, CAST(count(*) - sum(obs_present_flag) AS BIGINT) AS n_missing_rows,
    CAST(count(DISTINCT station_key) AS BIGINT) AS n_station_keys, min(obs_hour_utc) AS min_obs_hour_utc, max(obs_hour_utc) AS max_obs_hour_utc FROM obs""",
)
def hourly_summary(t: Tables):
    return ntz(silver.hourly_summary(hourly_obs(t)), "min_obs_hour_utc", "max_obs_hour_utc")


_LAG_TAIL = (
    """, lagged AS (SELECT *, """
    + ", ".join(
        f"""sea_level_pressure_hpa - lag(sea_level_pressure_hpa, {n}) OVER (PARTITION BY station_key ORDER BY obs_hour_utc) AS d{n}"""
        for n in PRESSURE_GUARDS
    )
    + """ FROM obs), deltas AS (SELECT *, """
    + ", ".join(
        f"CASE WHEN abs(d{n}) <= {int(g)} THEN d{n} END AS pressure_delta_{n}h_hpa" for n, g in PRESSURE_GUARDS.items()
    )
    + """ FROM lagged), trends AS (SELECT *, CASE WHEN pressure_delta_3h_hpa > 0.5 THEN 1 WHEN pressure_delta_3h_hpa < -0.5 THEN -1
      WHEN pressure_delta_3h_hpa IS NOT NULL THEN 0 END AS pressure_tendency_3h FROM deltas)"""
)
_LAG_SQL = OBS_SQL + _LAG_TAIL
# a third of the events two years earlier: the year between has no grid, so rows and hours differ
_GAP_SQL = OBS_SQL.replace(
    "FROM events", "FROM (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN ts - INTERVAL 730 DAY ELSE ts END AS ts) FROM events)"
)


def _lagged(obs, parity: bool = False):
    return lag_delta(
        obs, "station_key", "obs_hour_utc", "sea_level_pressure_hpa", PRESSURE_GUARDS, C.DELTAS, parity
    )


_DELTA_COLUMNS = ", ".join(C.DELTAS.values())


@query("lag_delta", _LAG_SQL + f" SELECT station_key, obs_hour_utc, {_DELTA_COLUMNS} FROM deltas")
def lag_delta_query(t: Tables):
    return ntz(_lagged(hourly_obs(t)).select(*C.HOURLY.grain, *C.DELTAS.values()), "obs_hour_utc")


@query("lag_delta_rows", _GAP_SQL + _LAG_TAIL + f" SELECT station_key, obs_hour_utc, {_DELTA_COLUMNS} FROM deltas")
def lag_delta_rows(t: Tables):
    """Row-counting variant, over a series with a missing year: the first rows after the gap look
    back to the last ones before it."""
    early = F.when(F.col("event_id") % 3 == 0, F.col("ts") - F.expr("interval 730 days")).otherwise(F.col("ts"))
    obs = hourly_obs(t, t.events.withColumn("ts", early))
    return ntz(_lagged(obs, parity=True).select(*C.HOURLY.grain, *C.DELTAS.values()), "obs_hour_utc")


@query("trend_class", _LAG_SQL + " SELECT station_key, obs_hour_utc, pressure_delta_3h_hpa, pressure_tendency_3h FROM trends")
def trend_class(t: Tables):
    delta = C.DELTAS[3]
    out = _lagged(hourly_obs(t)).select(*C.HOURLY.grain, delta, trend(delta).alias("pressure_tendency_3h"))
    return ntz(out, "obs_hour_utc")


# --- formulas. Results are rounded on both sides: engines differ in the last bit of exp and sin.

_RH = "100 * exp(17.625 * td / (243.04 + td)) / exp(17.625 * t / (243.04 + t))"
_FORMULA_SQL = (
    OBS_SQL
    + f""", measured AS (SELECT event_id, station_key, obs_utc_ts, air_temp_c AS t, dew_point_c AS td, wind_speed_mps AS ws, wind_dir_deg AS wd,
        wind_speed_mps * CAST(3.6 AS DOUBLE) AS kph FROM raw),
    f1 AS (SELECT *, CASE WHEN t BETWEEN -90 AND 70 AND td BETWEEN -100 AND 70 THEN greatest(0.0::DOUBLE, least(100.0::DOUBLE, {_RH})) END AS rh FROM measured),
    f2 AS (SELECT *, t * atan(0.151977::DOUBLE * sqrt(rh + 8.313659::DOUBLE)) + atan(t + rh) - atan(rh - 1.676331::DOUBLE)
        + 0.00391838::DOUBLE * pow(rh, 1.5) * atan(0.023101::DOUBLE * rh) - 4.686035::DOUBLE AS tw FROM f1),
    f3 AS (SELECT *, CASE WHEN t BETWEEN -80 AND 60 AND rh BETWEEN 1 AND 100 AND tw BETWEEN -100 AND 70 AND tw <= t + 2 THEN tw END AS wb,
        CASE WHEN t <= 10 AND kph > 4.8::DOUBLE AND kph <= 200 THEN 13.12::DOUBLE + 0.6215::DOUBLE * t - 11.37::DOUBLE * pow(kph, 0.16::DOUBLE) + 0.3965::DOUBLE * t * pow(kph, 0.16::DOUBLE)
             WHEN t >= 20 AND td BETWEEN -40 AND 50 THEN t + 0.5555::DOUBLE * (6.11::DOUBLE * exp(5417.7530::DOUBLE * (1 / 273.16::DOUBLE - 1 / (td + 273.15::DOUBLE))) - 10)
             ELSE t END AS felt,
        CASE WHEN wd = 360 THEN 0 ELSE wd END AS angle FROM f2),
    formulas AS (SELECT event_id, station_key, obs_utc_ts, round(rh, 9) AS relative_humidity_pct, round(wb, 9) AS wet_bulb_temp_c,
        CASE WHEN felt BETWEEN -100 AND 70 THEN round(felt, 9) END AS apparent_temp_c,
        CASE WHEN ws BETWEEN 0 AND 150 AND angle BETWEEN 0 AND 360 THEN round(-ws * sin(radians(angle)), 9) + 0.0 END AS wind_u_mps,
        CASE WHEN ws BETWEEN 0 AND 150 AND angle BETWEEN 0 AND 360 THEN round(-ws * cos(radians(angle)), 9) + 0.0 END AS wind_v_mps FROM f3)"""
)


def rounded(c: Column) -> Column:
    # adding zero turns -0.0 into 0.0
    return F.round(c, 9) + F.lit(0.0)


@query("feat_humidity", _FORMULA_SQL + " SELECT event_id, relative_humidity_pct FROM formulas")
def feat_humidity(t: Tables):
    raw = raw_observations(t)
    return raw.select("event_id", rounded(humidity("air_temp_c", "dew_point_c")).alias("relative_humidity_pct"))


@query("feat_wet_bulb", _FORMULA_SQL + " SELECT event_id, wet_bulb_temp_c FROM formulas")
def feat_wet_bulb(t: Tables):
    rh = humidity("air_temp_c", "dew_point_c")
    return raw_observations(t).select("event_id", rounded(wet_bulb("air_temp_c", rh)).alias("wet_bulb_temp_c"))


@query("feat_apparent_temp", _FORMULA_SQL + " SELECT event_id, apparent_temp_c FROM formulas")
def feat_apparent_temp(t: Tables):
    felt = apparent_temp("air_temp_c", "dew_point_c", "wind_speed_mps")
    return raw_observations(t).select("event_id", rounded(felt).alias("apparent_temp_c"))


@query("feat_vector_components", _FORMULA_SQL + " SELECT event_id, wind_u_mps, wind_v_mps FROM formulas")
def feat_vector_components(t: Tables):
    u, v = vector_uv("wind_speed_mps", "wind_dir_deg")
    return raw_observations(t).select("event_id", rounded(u).alias("wind_u_mps"), rounded(v).alias("wind_v_mps"))


@query(
    "feat_valid_flags",
    _FORMULA_SQL
    + """ SELECT event_id, CAST(relative_humidity_pct IS NOT NULL AS INTEGER) AS rh_valid_flag, CAST(wet_bulb_temp_c IS NOT NULL AS INTEGER) AS wet_bulb_valid_flag,
    CAST(wind_u_mps IS NOT NULL AND wind_v_mps IS NOT NULL AS INTEGER) AS wind_components_valid_flag FROM formulas""",
)
def feat_valid_flags(t: Tables):
    measures = raw_observations(t).withColumns(silver.weather_measures())
    flags = ["rh_valid_flag", "wet_bulb_valid_flag", "wind_components_valid_flag"]
    return measures.select("event_id", *[valid_flag(*C.VALID_FLAGS[f]).alias(f) for f in flags])


FEATURES_SQL = (
    _FORMULA_SQL
    + ", "
    + _LAG_SQL[len(OBS_SQL) + 2 :]
    + """, picked AS (SELECT h.station_key, h.obs_hour_utc, f.* EXCLUDE (station_key, obs_utc_ts, event_id) FROM hourly h JOIN formulas f USING (event_id)),
    features AS (SELECT t.station_key, t.obs_hour_utc, obs_year, obs_month, source_dataset, obs_present_flag,
      relative_humidity_pct, wet_bulb_temp_c, apparent_temp_c, wind_u_mps, wind_v_mps, pressure_delta_1h_hpa, pressure_delta_3h_hpa, pressure_delta_6h_hpa, pressure_tendency_3h,
      CAST(relative_humidity_pct IS NOT NULL AS INTEGER) AS rh_valid_flag, CAST(wet_bulb_temp_c IS NOT NULL AS INTEGER) AS wet_bulb_valid_flag,
      CAST(apparent_temp_c IS NOT NULL AS INTEGER) AS apparent_temp_valid_flag, CAST(wind_u_mps IS NOT NULL AND wind_v_mps IS NOT NULL AS INTEGER) AS wind_components_valid_flag,
      CAST(pressure_delta_1h_hpa IS NOT NULL AS INTEGER) AS pressure_delta_valid_1h_flag, CAST(pressure_delta_3h_hpa IS NOT NULL AS INTEGER) AS pressure_delta_valid_3h_flag,
      CAST(pressure_delta_6h_hpa IS NOT NULL AS INTEGER) AS pressure_delta_valid_6h_flag, '"""
    + A_TS
    + "' AS source_build_run_ts, '"
    + F_TS
    + """' AS feature_build_run_ts, 'v1' AS feature_version
      FROM trends t LEFT JOIN picked p ON t.station_key = p.station_key AND t.obs_hour_utc = p.obs_hour_utc)"""
)


def features(t: Tables):
    return silver.weather_features(hourly_obs(t), F_TS, A_TS)


ROUNDED_FEATURES = ["relative_humidity_pct", "wet_bulb_temp_c", "apparent_temp_c", "wind_u_mps", "wind_v_mps"]


@query("weather_features", FEATURES_SQL + " SELECT * FROM features")
def weather_features(t: Tables):
    out = features(t).withColumns({c: rounded(F.col(c)) for c in ROUNDED_FEATURES})
    return ntz(out, "obs_hour_utc")


@query(
    "feature_null_rates",
    FEATURES_SQL
    + " SELECT station_key, obs_year, CAST(count(*) AS BIGINT) AS n_rows, "
    + ", ".join(f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) AS null_rate_{c}" for c in C.FEATURE_MEASURES)
    + " FROM features GROUP BY station_key, obs_year",
)
def feature_null_rates(t: Tables):
    return null_rates(features(t), C.FEATURE_MEASURES, ["station_key", "obs_year"])


# both sides of the join are computed once, before it
_JOIN_SQL = re.sub(r"\b(formulas|lagged|deltas|trends|picked|features) AS \(", r"\1 AS MATERIALIZED (", FEATURES_SQL)


@query(
    "join_inner",
    _JOIN_SQL
    + """ SELECT o.station_key, o.obs_hour_utc, o.obs_present_flag AS weather_obs_present_flag, o.air_temp_c, o.sea_level_pressure_hpa, f.relative_humidity_pct, f.pressure_delta_1h_hpa, f.feature_version
    FROM obs o JOIN features f ON o.station_key = f.station_key AND o.obs_hour_utc = f.obs_hour_utc""",
)
def join_inner(t: Tables):
    obs = materialize(hourly_obs(t), "obs")  # joined with what is derived from it
    wide = gold.weather_wide(obs, silver.weather_features(obs, F_TS, A_TS))
    wide = wide.withColumn("relative_humidity_pct", rounded(F.col("relative_humidity_pct")))
    columns = [
        *C.HOURLY.grain, "weather_obs_present_flag", "air_temp_c", "sea_level_pressure_hpa", "relative_humidity_pct",
        "pressure_delta_1h_hpa", "feature_version",
    ]
    return ntz(wide.select(*columns), "obs_hour_utc")


@query(
    "union_by_name",
    """SELECT event_id, CAST(ts AS VARCHAR)[:19] AS at, value, CAST(NULL AS VARCHAR) AS props FROM events WHERE event_type IN ('error','view')
    UNION ALL SELECT event_id, CAST(ts AS VARCHAR)[:19], CAST(NULL AS DOUBLE), props FROM events WHERE event_type NOT IN ('error','view')""",
)
def union_by_name(t: Tables):
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at")
    isd = F.col("event_type").isin("error", "view")
    return union_named(
        t.events.filter(isd).select("event_id", at, "value"), t.events.filter(~isd).select("event_id", at, "props")
    )


# --- event to weather ----------------------------------------------------------------------

_TIER_SQL = (
    OBS_SQL
    + """, play AS (
    SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN 'ST' || (user_id // 10) END AS station_key,
      CASE WHEN event_id % 13 = 0 THEN ts - INTERVAL 2000 DAY WHEN event_id % 7 <> 0 THEN ts
        WHEN event_id % 5 <> 0 THEN date_trunc('day', ts) END AS play_ts_utc,
      CASE WHEN event_id % 7 <> 0 THEN 'time_of_day' WHEN event_id % 5 <> 0 THEN 'start_time' ELSE 'none' END AS play_ts_source
    FROM events),
  joined AS (SELECT p.*, date_trunc('hour', play_ts_utc) AS play_hour_utc, o.obs_hour_utc AS weather_hour_utc, o.air_temp_c, o.obs_present_flag
    FROM play p LEFT JOIN obs o ON p.station_key = o.station_key AND date_trunc('hour', play_ts_utc) = o.obs_hour_utc)"""
)


@query(
    "event_hour_join",
    _TIER_SQL
    + """ SELECT event_id, station_key, play_ts_utc, play_ts_source, play_hour_utc, weather_hour_utc, air_temp_c,
    CASE WHEN weather_hour_utc IS NULL THEN 0 ELSE 1 END AS weather_key_match_flag, coalesce(obs_present_flag, 0) AS weather_observed_flag,
    CASE WHEN station_key IS NULL THEN 'no_station_mapping' WHEN play_ts_utc IS NULL THEN 'no_play_time' WHEN weather_hour_utc IS NULL THEN 'no_weather_hour_key'
      WHEN obs_present_flag = 0 THEN 'weather_hour_no_observation' WHEN play_ts_source = 'time_of_day' THEN 'direct_play_hour'
      WHEN play_ts_source = 'start_time' THEN 'kickoff_fallback' ELSE 'matched_observed' END AS weather_join_tier FROM joined""",
)
def event_hour_join(t: Tables):
    """Events as plays; some are put years before the weather, so every tier occurs."""
    out = join_hour(
        _event_plays(t), hourly_obs(t), "station_key", "play_hour_utc", "obs_hour_utc",
        {"air_temp_c": "air_temp_c", "obs_present_flag": "obs_present_flag"}, "event_id",
    )
    out = out.withColumns(
        {
            "weather_key_match_flag": F.when(any_present("weather_hour_utc"), 1).otherwise(0),
            "weather_observed_flag": F.coalesce("obs_present_flag", F.lit(0)),
            "weather_join_tier": _event_tier(),
        }
    ).drop("obs_present_flag")
    return ntz(out, "play_ts_utc", "play_hour_utc", "weather_hour_utc")


def _event_plays(t: Tables):
    n = F.col("event_id")
    return t.events.select(
        "event_id",
        F.when(n % 11 != 0, event_station()).alias("station_key"),
        F.when(n % 13 == 0, F.col("ts").cast("timestamp") - F.expr("interval 2000 days"))
        .when(n % 7 != 0, F.col("ts").cast("timestamp"))
        .when(n % 5 != 0, F.date_trunc("day", F.col("ts").cast("timestamp")))
        .alias("play_ts_utc"),
        F.when(n % 7 != 0, "time_of_day").when(n % 5 != 0, "start_time").otherwise("none").alias("play_ts_source"),
    ).withColumn("play_hour_utc", F.date_trunc("hour", "play_ts_utc"))


def _event_tier():
    return join_tier("station_key", "play_ts_utc", "weather_hour_utc", "obs_present_flag", "play_ts_source")


@query(
    "event_asof_join",
    _TIER_SQL
    + """, filled AS (
    SELECT j.*, CASE WHEN coalesce(j.obs_present_flag, 0) = 0 AND j.play_hour_utc - o.obs_hour_utc <= INTERVAL 6 HOUR THEN o.obs_hour_utc END AS weather_asof_hour_utc,
      o.air_temp_c AS earlier_temp_c
    FROM joined j ASOF LEFT JOIN (SELECT station_key, obs_hour_utc, air_temp_c FROM obs WHERE obs_present_flag = 1) o
      ON j.station_key = o.station_key AND j.play_hour_utc >= o.obs_hour_utc)
  SELECT event_id, station_key, play_hour_utc, weather_asof_hour_utc, CASE WHEN weather_asof_hour_utc IS NULL THEN air_temp_c ELSE earlier_temp_c END AS air_temp_c,
    CAST(CASE WHEN obs_present_flag = 1 THEN 0 ELSE date_diff('hour', weather_asof_hour_utc, play_hour_utc) END AS INTEGER) AS weather_age_hours,
    CASE WHEN station_key IS NULL THEN 'no_station_mapping' WHEN play_ts_utc IS NULL THEN 'no_play_time' WHEN weather_asof_hour_utc IS NOT NULL THEN 'earlier_observation'
      WHEN weather_hour_utc IS NULL THEN 'no_weather_hour_key' WHEN obs_present_flag = 0 THEN 'weather_hour_no_observation' WHEN play_ts_source = 'time_of_day' THEN 'direct_play_hour'
      WHEN play_ts_source = 'start_time' THEN 'kickoff_fallback' ELSE 'matched_observed' END AS weather_join_tier FROM filled""",
)
def event_asof_join(t: Tables):
    """Hours without an observation take one of up to six hours before."""
    obs = materialize(hourly_obs(t), "obs")
    out = join_hour(
        _event_plays(t), obs, "station_key", "play_hour_utc", "obs_hour_utc",
        {"air_temp_c": "air_temp_c", "obs_present_flag": "obs_present_flag"}, "event_id",
    )
    observed = F.coalesce("obs_present_flag", F.lit(0)) == 1
    out = join_asof(
        out.withColumn("gap_hour", F.when(~observed, F.col("play_hour_utc"))), obs.filter("obs_present_flag = 1"),
        "station_key", "gap_hour", "obs_hour_utc", {"air_temp_c": "earlier_temp_c"}, "event_id", 6, "weather_asof_hour_utc",
    )
    taken = F.col("weather_asof_hour_utc")
    age = (F.unix_timestamp("play_hour_utc") - F.unix_timestamp(taken)) / 3600
    out = out.select(
        "event_id", "station_key", "play_hour_utc", "weather_asof_hour_utc",
        F.when(taken.isNull(), F.col("air_temp_c")).otherwise(F.col("earlier_temp_c")).alias("air_temp_c"),
        F.when(observed, 0).otherwise(age.cast("int")).alias("weather_age_hours"),
        asof_tier(_event_tier(), taken).alias("weather_join_tier"),
    )
    return ntz(out, "play_hour_utc", "weather_asof_hour_utc")


@query(
    "asof_match",
    """SELECT e.event_id, CASE WHEN e.ts - r.ts <= INTERVAL 12 HOUR THEN r.ts END AS error_ts, CASE WHEN e.ts - r.ts <= INTERVAL 12 HOUR THEN r.value END AS error_value
    FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'error' GROUP BY user_id, ts) r
      ON e.user_id = r.user_id AND e.ts >= r.ts""",
)
def asof_match(t: Tables):
    """Every event beside the last error of its user, of up to twelve hours before."""
    e = t.events.select("event_id", "event_type", "ts", "value", F.col("user_id").cast("string").alias("user"))
    errors = e.filter("event_type = 'error'").groupBy("user", "ts").agg(F.max("value").alias("value"))
    out = join_asof(e.drop("value"), errors, "user", "ts", "ts", {"value": "error_value"}, "event_id", 12, "error_ts")
    return ntz(out.select("event_id", "error_ts", "error_value"), "error_ts")


@query(
    "join_interval",
    """SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INTEGER) AS season, c_name, CAST(1995 + c_custkey % 4 AS BIGINT) AS begin_year, CAST(1998 + c_custkey % 4 AS BIGINT) AS end_year
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND year(o_orderdate) BETWEEN 1995 + c_custkey % 4 AND 1998 + c_custkey % 4""",
)
def join_interval_query(t: Tables):
    span = t.customer.select(
        F.col("c_custkey").alias("o_custkey"),
        "c_name",
        (F.col("c_custkey") % 4 + 1995).alias("begin_year"),
        (F.col("c_custkey") % 4 + 1998).alias("end_year"),
    )
    facts = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("season"))
    out = join_interval(facts, span, ["o_custkey"], "season", "begin_year", "end_year")
    # outside its interval a fact keeps its key but has no dimension values
    return out


@query(
    "left_lookup",
    """SELECT o_orderkey, o_custkey, game_total, game_day FROM orders LEFT JOIN (
      SELECT o_custkey AS k, o_totalprice AS game_total, CAST(o_orderdate AS DATE) AS game_day,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'F') d
    ON o_custkey = k AND rn = 1""",
)
def left_lookup(t: Tables):
    """Every order with the newest finished order of its customer: the dimension has many rows per
    key and must not multiply the facts."""
    dim = t.orders.filter(F.col("o_orderstatus") == "F").withColumn("day", F.col("o_orderdate").cast("date"))
    return lookup(
        t.orders.select("o_orderkey", "o_custkey"),
        dim,
        ["o_custkey"],
        {"o_totalprice": "game_total", "day": "game_day"},
        [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()],
    )


# --- geography -----------------------------------------------------------------------------


@query(
    "haversine",
    GEO_SQL
    + """ SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, round(2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(station_lat - venue_lat) / 2), 2)
      + cos(radians(venue_lat)) * cos(radians(station_lat)) * pow(sin(radians(station_lon - venue_lon) / 2), 2)))), 6) AS distance_km
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN venue ON o_custkey = stadium_id
    JOIN station ON l_suppkey = station_key""",
)
def haversine_query(t: Tables):
    """Distance from the customer to the supplier of each order line."""
    out = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(star_venues(t), F.col("o_custkey") == F.col("stadium_id"))
        .join(star_stations(t), F.col("l_suppkey") == F.col("station_key"))
    )
    d = haversine("venue_lat", "venue_lon", "station_lat", "station_lon")
    return out.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.round(d, 6).alias("distance_km"))


_PAIR = "stadium_id, stadium_name, station_key, station_name, round(d, 6) AS distance_km"
_POINTS = (("venue_lat", "venue_lon"), ("station_lat", "station_lon"))
_PAIR_COLUMNS = ["stadium_id", "stadium_name", "station_key", "station_name"]


def _pair(df):
    return df.select(*_PAIR_COLUMNS, round_km("distance_km").alias("distance_km"))


@query("join_distance", GEO_SQL + f" SELECT {_PAIR} FROM near")
def join_distance_query(t: Tables):
    return _pair(join_distance(star_venues(t), star_stations(t), *_POINTS, 200.0, "station_key"))


@query("nearest_match", GEO_SQL + f" SELECT {_PAIR}, 'nearest_within_max_km' AS selection_reason FROM best")
def nearest_match(t: Tables):
    best = nearest(star_venues(t), star_stations(t), *_POINTS, "station_key", 200.0)
    return _pair(best).withColumn("selection_reason", F.lit("nearest_within_max_km"))


@query(
    "join_anti",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
)
def join_anti(t: Tables):
    buyers = t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return unmatched(t.customer.select("c_custkey", "c_name", "c_mktsegment"), buyers, ["c_custkey"])


@query(
    "unmapped_report",
    GEO_SQL + " SELECT stadium_id, stadium_name FROM venue WHERE stadium_id NOT IN (SELECT stadium_id FROM best)",
)
def unmapped_report(t: Tables):
    best = nearest(star_venues(t), star_stations(t), *_POINTS, "station_key", 200.0)
    return unmatched(star_venues(t), best, ["stadium_id"]).select("stadium_id", "stadium_name")


@query(
    "nearest_unmatched",
    GEO_SQL
    + f""", tight AS (SELECT * FROM every WHERE stadium_id NOT IN (SELECT stadium_id FROM every WHERE d <= 25))
    SELECT {_PAIR} FROM (SELECT *, row_number() OVER (PARTITION BY stadium_id ORDER BY round(d, 9), station_key) AS rn FROM tight) WHERE rn = 1""",
)
def nearest_unmatched(t: Tables):
    """Venues without a station within 25 km, with the closest one at any distance."""
    close = nearest(star_venues(t), star_stations(t), *_POINTS, "station_key", 25.0)
    rest = unmatched(star_venues(t), close, ["stadium_id"])
    return _pair(nearest(rest, star_stations(t), *_POINTS, "station_key"))


_SPANS_SQL = """WITH span AS (SELECT s_suppkey, DATE '1995-01-01' + CAST(s_suppkey * 37 % 2000 AS INTEGER) AS first_day,
    DATE '1995-01-01' + CAST(s_suppkey * 37 % 2000 + s_suppkey % 60 - 5 AS INTEGER) AS last_day FROM supplier)"""


def _span(key: str, step: int, length: int) -> tuple[Column, Column]:
    day = F.lit("1995-01-01").cast("date")
    first = (F.col(key) * step % 2000).cast("int")
    return F.date_add(day, first), F.date_add(day, (first + F.col(key) % length - 5).cast("int"))


def _supplier_spans(t: Tables):
    first, last = _span("s_suppkey", 37, 60)
    return t.supplier.select("s_suppkey", first.alias("first_day"), last.alias("last_day"))


@query(
    "join_interval_no_key",
    _SPANS_SQL
    + """ SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day, s_suppkey, first_day, last_day
    FROM orders LEFT JOIN span ON CAST(o_orderdate AS DATE) BETWEEN first_day AND last_day""",
)
def join_interval_no_key(t: Tables):
    """Orders inside the suppliers' periods; nothing but the day relates the two."""
    orders = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_day"))
    return join_points(orders, _supplier_spans(t), "order_day", "first_day", "last_day", row_id="o_orderkey")


@query(
    "join_overlaps",
    _SPANS_SQL
    + """, stay AS (SELECT c_custkey, DATE '1995-01-01' + CAST(c_custkey * 13 % 2000 AS INTEGER) AS arrival,
      DATE '1995-01-01' + CAST(c_custkey * 13 % 2000 + c_custkey % 30 - 5 AS INTEGER) AS departure FROM customer)
    SELECT c_custkey, arrival, departure, s_suppkey, first_day, last_day FROM stay JOIN span ON arrival <= departure AND first_day <= last_day
      AND arrival <= last_day AND first_day <= departure""",
)
def join_overlaps_query(t: Tables):
    """Stays of customers that overlap periods of suppliers."""
    arrival, departure = _span("c_custkey", 13, 30)
    stays = t.customer.select("c_custkey", arrival.alias("arrival"), departure.alias("departure"))
    return join_overlaps(stays, _supplier_spans(t), ("arrival", "departure"), ("first_day", "last_day"))
