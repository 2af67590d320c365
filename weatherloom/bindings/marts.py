"""Queries: base rows, sample expansion, marts, baselines, summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.bindings.registry import Tables, query
from weatherloom.bindings.star import (
    A_TS,
    B_TS,
    BASE_SQL,
    FACT_SQL,
    MARTS_SQL,
    money,
    star_base,
    star_fact,
    star_marts,
)
from weatherloom.functions.cleaning import normalize_category, safe_ratio
from weatherloom.operators.columns import fill_unknown
from weatherloom.operators.aggregate import (
    category_distribution,
    coverage,
    distinct_then,
    null_rates,
    qc_metrics,
    row_count,
    summarize,
    summarize_distinct,
    table_stats,
)
from weatherloom.operators.joins import with_baseline
from weatherloom.operators.rollup import SKETCH_ERROR, roll_up, sketched_cells
from weatherloom.operators.rows import expand_samples
from weatherloom.plans import gold, silver
from weatherloom.sources.sink import materialize

BASE_COLUMNS = (
    "season, game_id, play_id, team, is_pass, is_rush, is_complete, CAST(epa AS DOUBLE) AS epa, temp_bin, wind_bin, precip_bin, "
    "roof_env_bin, weather_key_match_flag, weather_observed_flag, CAST(team_points_final AS DOUBLE) AS team_points_final, batch_a_build_run_ts"
)


def _doubles(df):
    return df.withColumns({c: F.col(c).cast("double") for c in ("epa", "team_points_final")})


@query("base_rows", BASE_SQL + f" SELECT {BASE_COLUMNS} FROM base")
def base_rows(t: Tables):
    return _doubles(star_base(t))


@query("sample_expand", BASE_SQL + f" SELECT {BASE_COLUMNS}, weather_sample FROM samples")
def sample_expand(t: Tables):
    return _doubles(
        expand_samples(star_base(t), {"ALL_PLAYS": None, "OBSERVED_ONLY": F.col("weather_observed_flag") == 1})
    )


@query("mart_team_season", MARTS_SQL + " SELECT * FROM team_mart")
def mart_team_season(t: Tables):
    return gold.mart_team_season(star_base(t), B_TS, [A_TS])


@query("mart_play_calling", MARTS_SQL + " SELECT * FROM playcall_mart")
def mart_play_calling(t: Tables):
    return gold.mart_play_calling(star_base(t), B_TS, [A_TS])


@query("mart_env_compare", MARTS_SQL + " SELECT * FROM indoor_mart")
def mart_env_compare(t: Tables):
    return gold.mart_env_compare(star_base(t), B_TS, [A_TS])


@query(
    "distinct_then_avg",
    BASE_SQL
    + """ SELECT season, roof_env_bin, CAST(count(*) AS BIGINT) AS n_team_games_points, CAST(count(DISTINCT game_id) AS BIGINT) AS n_games_points,
    CAST(sum(p) AS DOUBLE) / count(*) AS points_per_game
    FROM (SELECT DISTINCT season, roof_env_bin, team, game_id, team_points_final AS p FROM base WHERE team_points_final IS NOT NULL) d GROUP BY season, roof_env_bin""",
)
def distinct_then_avg(t: Tables):
    grain = ["season", "roof_env_bin"]
    scored = star_base(t).filter(F.col("team_points_final").isNotNull())
    return distinct_then(
        scored,
        [*grain, "team", "game_id"],
        grain,
        "team_points_final",
        {
            "n_team_games_points": row_count(),
            "n_games_points": F.count_distinct("game_id"),
            "points_per_game": safe_ratio(F.sum("team_points_final"), row_count()),
        },
    )


@query(
    "safe_ratio",
    """SELECT l_suppkey, CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS BIGINT) AS n_part, CAST(count(*) FILTER (WHERE l_tax > 0.07) AS BIGINT) AS n_whole,
    CASE WHEN count(*) FILTER (WHERE l_tax > 0.07) > 0 THEN CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) / count(*) FILTER (WHERE l_tax > 0.07) END AS ratio
    FROM lineitem GROUP BY l_suppkey""",
)
def safe_ratio_query(t: Tables):
    counts = summarize(
        t.lineitem,
        {"n_part": F.count_if(F.col("l_returnflag") == "A"), "n_whole": F.count_if(F.col("l_tax") > 0.07)},
        ["l_suppkey"],
    )
    return counts.withColumn("ratio", safe_ratio("n_part", "n_whole"))


@query(
    "game_rollup",
    """WITH game AS (
      SELECT o_orderkey AS game_id, CAST(max(year(o_orderdate)) AS INTEGER) AS season, max(CAST(o_orderdate AS DATE)) AS game_date, max(o_orderpriority) AS roof,
        CAST(sum(CASE WHEN l_returnflag IN ('A','R') THEN 1 ELSE 0 END) AS BIGINT) AS pass_attempts,
        CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS rush_attempts,
        CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS completions,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total_yards,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) AS total_epa,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) / count(l_extendedprice) AS avg_epa_play,
        max(o_totalprice) AS home_score_final, max(l_extendedprice) AS away_score_final
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus IN ('F','O') GROUP BY o_orderkey)
    SELECT *, home_score_final + away_score_final AS total_points, pass_attempts + rush_attempts AS plays,
      CASE WHEN pass_attempts + rush_attempts > 0 THEN CAST(pass_attempts AS DOUBLE) / (pass_attempts + rush_attempts) END AS pass_rate,
      CASE WHEN pass_attempts > 0 THEN CAST(completions AS DOUBLE) / pass_attempts END AS completion_pct
    FROM game""",
)
def game_rollup(t: Tables):
    plays = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("game_id"),
        F.year("o_orderdate").alias("season"),
        F.col("o_orderdate").cast("date").alias("game_date"),
        F.col("o_orderpriority").alias("roof"),
        F.when(F.col("l_linestatus") == "F", "pass").otherwise("run").alias("play_type"),
        F.col("l_returnflag").isin("A", "R").cast("int").alias("pass_attempt"),
        (F.col("l_returnflag") == "N").cast("int").alias("rush_attempt"),
        (F.col("l_linestatus") == "F").cast("int").alias("complete_pass"),
        F.col("l_quantity").cast("bigint").alias("yards_gained"),
        money("l_extendedprice").alias("epa"),
        F.col("o_totalprice").alias("home_score"),
        F.col("l_extendedprice").alias("away_score"),
    )
    games = silver.games(plays, attributes=["season", "game_date", "roof"])
    return games.withColumn("total_epa", F.col("total_epa").cast("double"))


@query(
    "baseline_shift",
    """WITH fine AS (
      SELECT l_suppkey, l_linestatus, CAST(sum(CASE WHEN l_returnflag <> 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n_pass, CAST(sum(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS n_rush
      FROM lineitem GROUP BY l_suppkey, l_linestatus),
    base AS (SELECT l_suppkey, CAST(sum(n_pass) AS DOUBLE) / CAST(sum(n_pass) + sum(n_rush) AS DOUBLE) AS b FROM fine GROUP BY l_suppkey)
    SELECT fine.*, CAST(n_pass AS DOUBLE) / (n_pass + n_rush) AS pass_rate, b AS pass_rate_baseline,
      CAST(n_pass AS DOUBLE) / (n_pass + n_rush) - b AS pass_rate_shift
    FROM fine JOIN base USING (l_suppkey)""",
)
def baseline_shift(t: Tables):
    fine = summarize(
        t.lineitem,
        {"n_pass": F.count_if(F.col("l_returnflag") != "N"), "n_rush": F.count_if(F.col("l_returnflag") == "N")},
        ["l_suppkey", "l_linestatus"],
    ).withColumn("pass_rate", safe_ratio("n_pass", F.col("n_pass") + F.col("n_rush")))
    return with_baseline(fine, ["l_suppkey"], {"pass_rate": ("n_pass", "n_rush")}, "shift")


_RUN_SUMMARY = """ SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT season) AS BIGINT) AS n_seasons,
   min(season) AS min_season, max(season) AS max_season, CAST(count(DISTINCT weather_sample) AS BIGINT) AS n_weather_samples,
   CAST(sum(n_plays) AS BIGINT) AS sum_n_plays, CAST(sum(n_pass_attempts) AS BIGINT) AS sum_n_pass_attempts,
   CAST(sum(n_rush_attempts) AS BIGINT) AS sum_n_rush_attempts, max(batch_a_build_run_ts) AS batch_a_build_run_ts, '{name}' AS mart_name FROM {table}"""


@query(
    "run_summary",
    MARTS_SQL
    + " UNION ALL ".join(
        _RUN_SUMMARY.format(name=C.MARTS[x].name, table=f"{x}_mart") for x in ("team", "playcall", "indoor")
    ),
)
def run_summary(t: Tables):
    marts = star_marts(t)
    first, *rest = [gold.mart_summary(df, C.MARTS[x].name) for x, df in marts.items()]
    for df in rest:
        first = first.unionByName(df)
    return first


@query(
    "fact_summary",
    FACT_SQL
    + """ SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT game_id) AS BIGINT) AS n_games, CAST(count(DISTINCT season) AS BIGINT) AS n_seasons,
    CAST(sum(weather_key_match_flag) AS BIGINT) AS n_weather_key_matched_rows, CAST(sum(weather_observed_flag) AS BIGINT) AS n_weather_observed_rows,
    CAST(sum(weather_observed_flag) AS DOUBLE) / count(*) AS rate_weather_observed FROM fact""",
)
def fact_summary(t: Tables):
    out = summarize_distinct(
        star_fact(t),
        {"game_id": "n_games", "season": "n_seasons"},
        {
            "weather_key_match_flag": "n_weather_key_matched_rows",
            "weather_observed_flag": "n_weather_observed_rows",
        },
    )
    return out.withColumn("rate_weather_observed", safe_ratio("n_weather_observed_rows", "n_rows"))


@query(
    "sample_totals",
    MARTS_SQL
    + """ SELECT weather_sample, CAST(sum(n_plays) AS BIGINT) AS sum_n_plays, CAST(sum(n_pass_attempts) AS BIGINT) AS sum_n_pass_attempts,
    CAST(sum(n_rush_attempts) AS BIGINT) AS sum_n_rush_attempts FROM team_mart GROUP BY weather_sample""",
)
def sample_totals(t: Tables):
    return gold.sample_totals(gold.mart_team_season(star_base(t), B_TS, [A_TS]))


@query(
    "coverage_by_group",
    FACT_SQL
    + """ SELECT season, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(weather_key_match_flag) AS BIGINT) AS n_matched, CAST(sum(weather_observed_flag) AS BIGINT) AS n_observed,
    CAST(sum(weather_observed_flag) AS DOUBLE) / count(*) AS rate_weather_observed_flag FROM fact GROUP BY season""",
)
def coverage_by_group(t: Tables):
    flags = {"weather_key_match_flag": "n_matched", "weather_observed_flag": "n_observed"}
    return coverage(star_fact(t), flags, ["season"], ["weather_observed_flag"])


@query(
    "null_rates",
    FACT_SQL
    + """ SELECT season, CAST(count(*) AS BIGINT) AS n_rows,
    CAST(count(*) - count(air_temp_c) AS DOUBLE) / count(*) AS null_rate_air_temp_c,
    CAST(count(*) - count(epa) AS DOUBLE) / count(*) AS null_rate_epa,
    CAST(count(*) - count(roof_env_bin) AS DOUBLE) / count(*) AS null_rate_roof_env_bin FROM fact GROUP BY season""",
)
def null_rates_query(t: Tables):
    return null_rates(star_fact(t), ["air_temp_c", "epa", "roof_env_bin"], ["season"])


@query(
    "category_distribution",
    """SELECT CASE WHEN p_type LIKE '%ECONOMY%' THEN 'retractable' WHEN lower(p_type) = 'small' THEN 'closed' ELSE 'unknown' END AS roof_type,
    CAST(count(*) AS BIGINT) AS "count" FROM part GROUP BY 1""",
)
def category_distribution_query(t: Tables):
    rules = [("contains", "economy", "retractable"), ("equals", "small", "closed")]
    return category_distribution(t.part.select(normalize_category("p_type", rules).alias("roof_type")), "roof_type")


@query(
    "qc_metrics",
    """SELECT 'total_input_rows' AS metric, CAST(count(*) AS BIGINT) AS value FROM part
    UNION ALL SELECT 'hard_fail_rows', CAST(count(*) FILTER (WHERE p_size > 40) AS BIGINT) FROM part
    UNION ALL SELECT 'final_rows', CAST(count(*) FILTER (WHERE p_size <= 40) AS BIGINT) FROM part
    UNION ALL SELECT 'min_size', CAST(min(p_size) AS BIGINT) FROM part
    UNION ALL SELECT 'distinct_brands', CAST(count(DISTINCT p_brand) AS BIGINT) FROM part""",
)
def qc_metrics_query(t: Tables):
    return qc_metrics(
        t.part,
        {
            "total_input_rows": row_count(),
            "hard_fail_rows": F.count_if(F.col("p_size") > 40),
            "final_rows": F.count_if(F.col("p_size") <= 40),
            "min_size": F.min("p_size"),
            "distinct_brands": F.count_distinct("p_brand"),
        },
        "bigint",
    )


@query(
    "table_stats",
    MARTS_SQL
    + """ SELECT CAST(count(*) AS BIGINT) AS serving_row_count, min(season) AS min_season, max(season) AS max_season,
    CAST(count(DISTINCT weather_sample) AS BIGINT) AS n_weather_samples, CAST(sum(n_plays) AS BIGINT) AS sum_n_plays, 'team' AS table_name FROM team_mart""",
)
def table_stats_query(t: Tables):
    return table_stats(gold.mart_team_season(star_base(t), B_TS, [A_TS]), "team")


@query(
    "dim_bins",
    FACT_SQL
    + """, dim(bin_type, bin_value, bin_label, lower_inclusive, upper_exclusive, sort_order) AS (VALUES
      ('temp_bin','UNKNOWN','Unknown',NULL,NULL,0),('temp_bin','FREEZING_LT_0C','< 0C',NULL,0.0,1),('temp_bin','COLD_0_10C','0-10C',0.0,10.0,2),
      ('temp_bin','COOL_10_20C','10-20C',10.0,20.0,3),('temp_bin','MILD_20_30C','20-30C',20.0,30.0,4),('temp_bin','HOT_GE_30C','>= 30C',30.0,NULL,5),
      ('wind_bin','UNKNOWN','Unknown',NULL,NULL,0),('wind_bin','CALM_LT_3_MPS','< 3 m/s',NULL,3.0,1),('wind_bin','BREEZY_3_6_MPS','3-6 m/s',3.0,6.0,2),
      ('wind_bin','WINDY_6_10_MPS','6-10 m/s',6.0,10.0,3),('wind_bin','STRONG_GE_10_MPS','>= 10 m/s',10.0,NULL,4),('precip_bin','UNKNOWN','Unknown',NULL,NULL,0),
      ('roof_env_bin','UNKNOWN','Unknown',NULL,NULL,0),('roof_env_bin','INDOOR','Indoor',NULL,NULL,1),('roof_env_bin','OUTDOOR','Outdoor',NULL,NULL,2),('roof_env_bin','RETRACTABLE','Retractable',NULL,NULL,3)),
    used AS (SELECT 'temp_bin' AS bin_type, temp_bin AS bin_value, count(*) AS n FROM fact GROUP BY 2
      UNION ALL SELECT 'wind_bin', wind_bin, count(*) FROM fact GROUP BY 2
      UNION ALL SELECT 'precip_bin', precip_bin, count(*) FROM fact GROUP BY 2
      UNION ALL SELECT 'roof_env_bin', coalesce(roof_env_bin, 'UNKNOWN'), count(*) FROM fact GROUP BY 2)
    SELECT bin_type, bin_value, bin_label, CAST(lower_inclusive AS DOUBLE) AS lower_inclusive, CAST(upper_exclusive AS DOUBLE) AS upper_exclusive,
      CAST(sort_order AS BIGINT) AS sort_order, CAST(coalesce(n, 0) AS BIGINT) AS n_plays
    FROM dim LEFT JOIN used USING (bin_type, bin_value)""",
)
def dim_bins(t: Tables):
    """The bin dimension with the number of plays in each member."""
    families = C.BINS
    pairs = [F.struct(F.lit(b).alias("bin_type"), F.col(b).alias("bin_value")) for b in families]
    used = fill_unknown(star_fact(t), families).groupBy(*families).agg(row_count().alias("n"))
    used = used.select("n", F.inline(F.array(*pairs))).groupBy("bin_type", "bin_value").agg(F.sum("n").alias("n_plays"))
    dim = gold.bin_dimension(t.spark)
    return dim.join(used, C.BIN_DIMENSION.grain, "left").withColumn("n_plays", F.coalesce("n_plays", F.lit(0)).cast("long"))


LEVELS = [["season", "team"], ["season", "roof_env_bin"], ["temp_bin", "wind_bin"], ["season"], []]
_LEVEL_KEYS = ["season", "team", "roof_env_bin", "temp_bin", "wind_bin"]
_LEVEL_SQL = (
    "CASE "
    + " ".join(
        "WHEN " + " AND ".join(f"grouping({k}) = {int(k not in level)}" for k in _LEVEL_KEYS) + f" THEN '{','.join(level) or 'total'}'" for level in LEVELS
    )
    + " END AS level"
)
_SETS_SQL = "GROUP BY GROUPING SETS (" + ", ".join(f"({', '.join(['weather_sample', *level])})" for level in LEVELS) + ")"


def _cells(t: Tables):
    return sketched_cells(gold.mart_units(star_base(t), [A_TS]), [*gold.TEAM_KEYS, "weather_sample"])


@query(
    "mart_levels",
    BASE_SQL
    + f""" SELECT weather_sample, {_LEVEL_SQL}, {', '.join(_LEVEL_KEYS)}, CAST(count(*) AS BIGINT) AS n_plays, CAST(sum(is_pass) AS BIGINT) AS n_pass_attempts,
    CAST(sum(is_rush) AS BIGINT) AS n_rush_attempts, CAST(sum(is_complete) AS BIGINT) AS n_completions, CAST(count(epa) AS BIGINT) AS n_epa_plays,
    CAST(sum(is_pass) AS DOUBLE) / sum(is_pass + is_rush) AS pass_rate, CAST(sum(is_rush) AS DOUBLE) / sum(is_pass + is_rush) AS rush_rate,
    CASE WHEN sum(is_pass) > 0 THEN CAST(sum(is_complete) AS DOUBLE) / sum(is_pass) END AS completion_pct,
    CASE WHEN count(epa) > 0 THEN CAST(sum(epa) AS DOUBLE) / count(epa) END AS epa_per_play FROM samples {_SETS_SQL}""",
)
def mart_levels(t: Tables):
    """Five levels of the marts from one pass over their cells, ratios weighted by what they divide."""
    return roll_up(_cells(t).drop("unit_sketch"), LEVELS).drop("epa_sum")


@query(
    "games_by_sketch",
    BASE_SQL
    + f""" SELECT weather_sample, {_LEVEL_SQL}, {', '.join(_LEVEL_KEYS)}, CAST(count(DISTINCT game_id) AS BIGINT) AS n_games, true AS within_error FROM samples {_SETS_SQL}""",
)
def games_by_sketch(t: Tables):
    """Distinct games of five levels by merged sketches, beside the exact counts: within four standard errors."""
    units = materialize(gold.mart_units(star_base(t), [A_TS]), "units")
    cells = sketched_cells(units, [*gold.TEAM_KEYS, "weather_sample"])
    keys = ["weather_sample", "level", *_LEVEL_KEYS]
    estimate = roll_up(cells, LEVELS).select(*keys, "n_units_estimate")
    games = units.select(*_LEVEL_KEYS, "weather_sample", "game_id").distinct()
    spread = roll_up(games.withColumn("n", F.lit(1)), [[*x, "game_id"] for x in LEVELS], sums=["n"], ratios={})
    level = F.regexp_replace(F.regexp_replace("level", ",?game_id$", ""), "^$", "total")
    exact = spread.withColumn("level", level).groupBy(*keys).agg(row_count().alias("n_games"))
    same = [estimate[k].eqNullSafe(exact[k]) for k in keys]
    off = F.abs(F.col("n_units_estimate") - F.col("n_games")) <= F.greatest(F.lit(1.0), 4 * SKETCH_ERROR * F.col("n_games"))
    return exact.join(estimate, same).select(*[exact[k] for k in keys], "n_games", off.alias("within_error"))
