"""Queries: gates, audits, serving, reconciliation, readiness. Broken inputs are derived from the
given tables, so that gates which must fire do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom import contracts as C
from weatherloom.bindings.hourly import F_TS, FEATURES_SQL, hourly_obs
from weatherloom.bindings.registry import Tables, query
from weatherloom.bindings.star import A_TS, B_TS, C_TS, FACT_SQL, MARTS_SQL, RUN_ID, star_base, star_fact, star_marts
from weatherloom.operators.aggregate import null_rates, row_count
from weatherloom.operators.difference import table_difference
from weatherloom.operators.drift import (
    distribution_drift,
    drift_gate,
    merge_profiles,
    quantile_profile,
    rank_error,
    with_quantiles,
)
from weatherloom.operators.gates import (
    agreement_check,
    any_null_check,
    column_checks,
    domain_check,
    duplicate_check,
    duplicate_counts,
    failures,
    filled_check,
    formula_check,
    key_parity,
    non_empty_check,
    not_null_check,
    range_check,
    rate_check,
    reconstruction_deviation,
    required_columns_check,
    row_parity_check,
    run_gates,
    schema_check,
    single_value_check,
    span_check,
    zero_denominator_check,
)
from weatherloom.operators.observed import ObservedChecks
from weatherloom.plans import gold, serving, silver
from weatherloom.plans.validators import bins_complete, run_alignment, summary_match, totals_agree, validate_marts
from weatherloom.sources.sink import materialize, scratch_path, write_partitioned

META = {"a_ts": A_TS, "b_ts": B_TS, "run_ts": C_TS, "run_id": RUN_ID}


def _row(check: str, table: str, expected: str, actual: str, ok: str, severity: str = "ERROR") -> str:
    """One gate row in SQL; ``expected`` and ``actual`` are SQL expressions."""
    return (
        f"'{check}' AS check_name, '{table}' AS table_name, CAST({expected} AS VARCHAR) AS expected_value, "
        f"CAST({actual} AS VARCHAR) AS actual_value, CASE WHEN {ok} THEN 'PASS' ELSE 'FAIL' END AS status, '{severity}' AS severity"
    )


def _zero(check: str, table: str, actual: str) -> str:
    return _row(check, table, "'0'", f"CAST({actual} AS BIGINT)", f"({actual}) = 0")


@query(
    "dq_required_columns",
    "SELECT " + _row("required_columns", "orders", "'none missing'", "'stadium_id,tz'", "false") + ", CAST(count(*) AS BIGINT) AS n_rows FROM orders",
)
def dq_required_columns(t: Tables):
    return required_columns_check(t.orders, "orders", ["o_orderkey", "stadium_id", "o_orderdate", "tz"])


ORDER_SCHEMA = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


@query(
    "dq_schema",
    "SELECT " + _row("schema", "orders", "'matches contract'", "'matches contract'", "true") + ", CAST(count(*) AS BIGINT) AS n_rows FROM orders"
    " UNION ALL SELECT " + _row("schema", "swapped", "'matches contract'", "'column order'", "false") + ", CAST(count(*) AS BIGINT) AS n_rows FROM orders",
)
def dq_schema(t: Tables):
    good = schema_check(t.orders, "orders", ORDER_SCHEMA)
    swapped = t.orders.select(*reversed(t.orders.columns))
    return good.unionByName(schema_check(swapped, "swapped", ORDER_SCHEMA))


_DUPS = "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"


@query("dq_duplicate_keys", "SELECT CAST(count(*) AS BIGINT) AS duplicate_keys FROM " + _DUPS)
def dq_duplicate_keys(t: Tables):
    return duplicate_counts(t.lineitem, ["l_orderkey", "l_linenumber"]).select("duplicate_keys")


@query(
    "dq_duplicate_rows",
    "SELECT " + _zero("duplicate_grain_rows", "lineitem", "coalesce(sum(n - 1), 0)") + " FROM " + _DUPS
    + " UNION ALL SELECT " + _zero("duplicate_grain_rows", "orders", "coalesce(sum(n - 1), 0)")
    + " FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey HAVING count(*) > 1)",
)
def dq_duplicate_rows(t: Tables):
    return run_gates(
        [
            duplicate_check(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"], surplus=True),
            duplicate_check(t.orders, "orders", ["o_orderkey"], surplus=True),
        ]
    )


@query(
    "dq_range",
    "SELECT " + _zero("metric_range_l_discount", "lineitem", "count(*) FILTER (WHERE l_discount < 0 OR l_discount > 1)") + " FROM lineitem UNION ALL SELECT "
    + _zero("metric_range_l_tax", "lineitem", "count(*) FILTER (WHERE l_tax < 0.01 OR l_tax > 0.07)") + " FROM lineitem",
)
def dq_range(t: Tables):
    return column_checks(
        t.lineitem, "lineitem", [range_check("l_discount", 0.0, 1.0), range_check("l_tax", 0.01, 0.07)]
    )


@query(
    "dq_nulls",
    FACT_SQL + " SELECT " + _zero("not_null_season", "fact", "count(*) FILTER (WHERE season IS NULL)") + " FROM fact UNION ALL SELECT "
    + _zero("not_null_epa", "fact", "count(*) FILTER (WHERE epa IS NULL)") + " FROM fact UNION ALL SELECT "
    + _zero("null_bins", "fact", "count(*) FILTER (WHERE temp_bin IS NULL OR wind_bin IS NULL OR precip_bin IS NULL OR roof_env_bin IS NULL)") + " FROM fact",
)
def dq_nulls(t: Tables):
    checks = [not_null_check("season"), not_null_check("epa"), any_null_check("null_bins", C.BINS)]
    return column_checks(star_fact(t), "fact", checks)


@query(
    "dq_row_parity",
    "SELECT " + _row("row_count_match", "serving", "a", "b", "a = b") + " FROM (SELECT (SELECT count(*) FROM orders) AS a, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS b)",
)
def dq_row_parity(t: Tables):
    return row_parity_check(t.orders, t.orders.filter(F.col("o_orderstatus") != "P"), "serving")


@query(
    "dq_domain",
    "SELECT " + _zero("o_orderstatus_domain", "orders", "count(*) FILTER (WHERE o_orderstatus NOT IN ('F','O'))") + " FROM orders UNION ALL SELECT "
    + _zero("priority", "orders", "count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW'))") + " FROM orders",
)
def dq_domain(t: Tables):
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    checks = [domain_check("o_orderstatus", ["F", "O"]), domain_check("o_orderpriority", priorities, "priority")]
    return column_checks(t.orders, "orders", checks)


@query(
    "dq_single_value",
    FACT_SQL + " SELECT " + _row("single_batch_a_build_run_ts", "fact", "'one value'", "max(batch_a_build_run_ts)", "min(batch_a_build_run_ts) = max(batch_a_build_run_ts)")
    + " FROM fact UNION ALL SELECT " + _row("single_season", "fact", "'one value'", "min(season) || '..' || max(season)", "min(season) = max(season)") + " FROM fact UNION ALL SELECT "
    + _row("single_epa", "fact", "'one value'", "'null'", "false") + " FROM (SELECT 1)",
)
def dq_single_value(t: Tables):
    checks = [single_value_check(c) for c in ("batch_a_build_run_ts", "season", "epa")]
    return column_checks(star_fact(t), "fact", checks)


@query(
    "dq_rate_threshold",
    "SELECT " + _row("mapped_rate", "orders", "'0.95'", "r", "r >= 0.95") + " FROM (SELECT avg(CASE WHEN o_orderkey % 40 <> 0 THEN 1 ELSE 0 END) AS r FROM orders) UNION ALL SELECT "
    + _row("parsed_rate", "orders", "'0.95'", "r", "r >= 0.95") + " FROM (SELECT avg(CASE WHEN o_orderkey % 4 <> 0 THEN 1 ELSE 0 END) AS r FROM orders) UNION ALL SELECT "
    + _row("match_rate", "orders", "'0.965'", "r", "r >= 0.965") + " FROM (SELECT avg(CASE WHEN o_orderkey % 100 <> 1 THEN 1 ELSE 0 END) AS r FROM orders WHERE o_orderkey % 40 <> 0 AND o_orderkey % 4 <> 0)",
)
def dq_rate_threshold(t: Tables):
    n = F.col("o_orderkey")
    mapped, parsed = n % 40 != 0, n % 4 != 0
    return column_checks(
        t.orders,
        "orders",
        [
            rate_check("mapped_rate", mapped, 0.95),
            rate_check("parsed_rate", parsed, 0.95),
            rate_check("match_rate", n % 100 != 1, 0.965, among=mapped & parsed),
        ],
    )


@query(
    "dq_formula",
    MARTS_SQL + " SELECT " + _zero("pass_rate_shift", "playcall", "count(*) FILTER (WHERE abs(pass_rate - pass_rate_baseline - pass_rate_shift_vs_team_season) > 1e-9)")
    + " FROM playcall_mart UNION ALL SELECT " + _zero("off", "playcall", "count(*) FILTER (WHERE abs(pass_rate - rush_rate_baseline - pass_rate_shift_vs_team_season) > 1e-9)") + " FROM playcall_mart",
)
def dq_formula(t: Tables):
    mart = gold.mart_play_calling(star_base(t), B_TS, [A_TS])
    shift = "pass_rate_shift_vs_team_season"
    return column_checks(
        mart,
        "playcall",
        [
            formula_check("pass_rate_shift", "pass_rate", "pass_rate_baseline", shift),
            formula_check("off", "pass_rate", "rush_rate_baseline", shift),
        ],
    )


@query(
    "dq_reconcile",
    MARTS_SQL
    + """, side AS (SELECT weather_sample, CAST(count(*) AS BIGINT) AS expected FROM samples GROUP BY 1)
    SELECT s.weather_sample, expected, t.n AS team, p.n AS playcall, i.n AS indoor, CASE WHEN expected = t.n AND expected = p.n AND expected = i.n THEN 'PASS' ELSE 'FAIL' END AS status
    FROM side s JOIN (SELECT weather_sample, CAST(sum(n_plays) AS BIGINT) AS n FROM team_mart GROUP BY 1) t USING (weather_sample)
    JOIN (SELECT weather_sample, CAST(sum(n_plays) AS BIGINT) AS n FROM playcall_mart GROUP BY 1) p USING (weather_sample)
    JOIN (SELECT weather_sample, CAST(sum(n_plays) AS BIGINT) AS n FROM indoor_mart GROUP BY 1) i USING (weather_sample)""",
)
def dq_reconcile(t: Tables):
    base = star_base(t)
    return totals_agree(base, gold.marts(base, B_TS, [A_TS]))


@query(
    "dq_summary_match",
    "SELECT " + _row("summary_n_rows", "orders", "n", "n", "true") + " FROM (SELECT count(*) AS n FROM orders) UNION ALL SELECT "
    + _row("summary_n_keys", "orders", "a", "b", "a = b") + " FROM (SELECT count(*) AS a, count(DISTINCT o_custkey) AS b FROM orders)",
)
def dq_summary_match(t: Tables):
    """A stored summary whose second value was computed wrongly."""
    stored = t.orders.agg(row_count().alias("n_rows"), row_count().alias("n_keys"))
    return summary_match(stored, t.orders, "orders", {"n_rows": row_count(), "n_keys": F.count_distinct("o_custkey")})


@query(
    "dq_zero_denominator",
    MARTS_SQL + " SELECT " + _zero("zero_denominator_completion_pct", "team", "count(*) FILTER (WHERE n_pass_attempts = 0 AND completion_pct IS NOT NULL)")
    + " FROM team_mart UNION ALL SELECT " + _zero("zero_denominator_pass_rate", "team", "count(*) FILTER (WHERE n_pass_attempts = 0 AND pass_rate IS NOT NULL)") + " FROM team_mart",
)
def dq_zero_denominator(t: Tables):
    """The second check pairs a ratio with the wrong denominator and must fire."""
    mart = gold.mart_team_season(star_base(t), B_TS, [A_TS])
    checks = [
        zero_denominator_check("completion_pct", "n_pass_attempts"),
        zero_denominator_check("pass_rate", "n_pass_attempts"),
    ]
    return column_checks(mart, "team", checks)


@query(
    "dq_reconstruction",
    FEATURES_SQL
    + """ SELECT CAST(count(*) FILTER (WHERE wind_u_mps IS NOT NULL AND wind_v_mps IS NOT NULL) AS BIGINT) AS n_vectors,
    CAST(count(*) FILTER (WHERE abs(sqrt(wind_u_mps * wind_u_mps + wind_v_mps * wind_v_mps) - w) > 0.1) AS BIGINT) AS n_deviating
    FROM (SELECT f.*, CASE WHEN o.sea_level_pressure_hpa > 1020 THEN o.wind_speed_mps + 1 ELSE o.wind_speed_mps END AS w FROM features f JOIN obs o ON f.station_key = o.station_key AND f.obs_hour_utc = o.obs_hour_utc)""",
)
def dq_reconstruction(t: Tables):
    obs = materialize(hourly_obs(t), "obs")
    gust = F.when(F.col("sea_level_pressure_hpa") > 1020, F.col("wind_speed_mps") + 1).otherwise(F.col("wind_speed_mps"))
    source = obs.withColumn("wind_speed_mps", gust)
    built = silver.weather_features(obs, F_TS, A_TS)
    return reconstruction_deviation(source, built, C.FEATURES.grain, "wind_speed_mps", "wind_u_mps", "wind_v_mps")


@query(
    "dq_key_parity",
    """WITH a AS (SELECT o_custkey AS k, count(*) AS n FROM orders GROUP BY 1), b AS (SELECT c_custkey AS k, count(*) AS n FROM customer WHERE c_custkey % 3 <> 0 GROUP BY 1)
    SELECT CAST((SELECT count(*) FROM a) AS BIGINT) AS source_keys, CAST((SELECT count(*) FROM b) AS BIGINT) AS feature_keys,
    CAST((SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS BIGINT) AS missing_keys, CAST((SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS BIGINT) AS extra_keys,
    CAST((SELECT count(*) FROM a WHERE n > 1) AS BIGINT) AS source_duplicates, CAST((SELECT count(*) FROM b WHERE n > 1) AS BIGINT) AS feature_duplicates""",
)
def dq_key_parity(t: Tables):
    source = t.orders.select(F.col("o_custkey").alias("k"))
    other = t.customer.filter(F.col("c_custkey") % 3 != 0).select(F.col("c_custkey").alias("k"))
    return key_parity(source, other, ["k"])


_CHANGED_SQL = """(SELECT CASE WHEN o_orderkey % 1013 = 0 THEN o_orderkey + 100000000 ELSE o_orderkey END AS o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
      CASE WHEN o_orderkey % 997 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 1009 <> 0
    UNION ALL SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P'), o_totalprice FROM orders WHERE o_orderkey % 2003 = 1)"""


@query(
    "table_difference",
    f"""WITH a AS (SELECT o_orderkey, count(*) AS n, sum(hash(o_custkey, nullif(o_orderstatus, 'P'), o_totalprice)) AS h FROM orders GROUP BY 1),
    b AS (SELECT o_orderkey, count(*) AS n, sum(hash(o_custkey, o_orderstatus, o_totalprice)) AS h FROM {_CHANGED_SQL} GROUP BY 1)
    SELECT o_orderkey, CASE WHEN b.n IS NULL THEN 'only_left' WHEN a.n IS NULL THEN 'only_right' ELSE 'changed' END AS kind,
      CAST(coalesce(a.n, 0) AS BIGINT) AS n_left, CAST(coalesce(b.n, 0) AS BIGINT) AS n_right
    FROM a FULL JOIN b USING (o_orderkey) WHERE a.n IS DISTINCT FROM b.n OR a.h IS DISTINCT FROM b.h""",
)
def table_difference_query(t: Tables):
    """Orders against a copy in which some are changed, gone, under another key, or there twice."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
    orders = t.orders.select(*columns).withColumn("o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P")))
    key = F.col("o_orderkey")
    other = orders.filter(key % 1009 != 0).withColumns(
        {
            "o_totalprice": F.when(key % 997 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
            "o_orderkey": F.when(key % 1013 == 0, key + 100000000).otherwise(key),
        }
    )
    return table_difference(orders, other.unionByName(orders.filter(key % 2003 == 1)), ["o_orderkey"])


@query(
    "dq_observed",
    "SELECT "
    + " FROM lineitem UNION ALL SELECT ".join(
        [
            _zero("metric_range_l_discount", "lineitem", "count(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.05)"),
            _zero("null_partition_keys", "lineitem", "count(*) FILTER (WHERE l_shipdate IS NULL OR l_returnflag IS NULL)"),
            _zero("l_returnflag_domain", "lineitem", "count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N'))"),
            _row("single_l_linestatus", "lineitem", "'one value'", "min(l_linestatus) || '..' || max(l_linestatus)", "false"),
            _zero("zero_denominator_l_tax", "lineitem", "count(*) FILTER (WHERE l_linenumber - 1 = 0 AND l_tax IS NOT NULL)"),
            _row("not_all_null_l_quantity", "lineitem", "'> 0'", "count(l_quantity)", "count(l_quantity) > 0"),
            _row("non_empty", "lineitem", "'> 0'", "count(*)", "count(*) > 0"),
            _row("span_l_linenumber", "lineitem", "'1..7'", "min(l_linenumber) || '..' || max(l_linenumber)", "min(l_linenumber) = 1 AND max(l_linenumber) = 7"),
        ]
    )
    + " FROM lineitem",
)
def dq_observed(t: Tables):
    """Gates of a table measured while it is written: the report needs no look at the files."""
    checks = [
        range_check("l_discount", 0.0, 0.05),
        any_null_check("null_partition_keys", ["l_shipdate", "l_returnflag"]),
        domain_check("l_returnflag", ["A", "N"]),
        single_value_check("l_linestatus"),
        zero_denominator_check("l_tax", F.col("l_linenumber") - 1),
        filled_check("l_quantity"),
        non_empty_check(),
        span_check("l_linenumber", 1, 7),
    ]
    measured = ObservedChecks(checks, "lineitem")
    write_partitioned(t.lineitem, scratch_path(t.spark, "observed"), ["l_returnflag"], clustered=True, measured=measured)
    return measured.report(t.spark)


@query(
    "dq_bins_complete",
    "WITH used AS (SELECT count(*) FILTER (WHERE l_linenumber = 7) AS n FROM lineitem) SELECT "
    + " UNION ALL SELECT ".join(
        _row(f"unknown_in_{b}", C.BIN_DIMENSION.name, "'1'", "CASE WHEN n > 0 THEN 1 ELSE 0 END" if ok else "'0'", "n > 0" if ok else "false") + " FROM used"
        for b, ok in (("temp_bin", True), ("wind_bin", False), ("precip_bin", True), ("roof_env_bin", False))
    ),
)
def dq_bins_complete(t: Tables):
    """Bin members as they occur in the lines: two families never show an UNKNOWN."""
    seen = t.lineitem.select(
        F.inline(
            F.array(
                F.struct(F.lit("temp_bin").alias("bin_type"), F.when(F.col("l_linenumber") == 7, "UNKNOWN").otherwise("MILD").alias("bin_value")),
                F.struct(F.lit("wind_bin").alias("bin_type"), F.col("l_returnflag").alias("bin_value")),
                F.struct(F.lit("precip_bin").alias("bin_type"), F.when(F.col("l_linenumber") == 7, "UNKNOWN").alias("bin_value")),
                F.struct(F.lit("roof_bin").alias("bin_type"), F.lit("UNKNOWN").alias("bin_value")),
            )
        )
    )
    return bins_complete(seen)


@query(
    "dq_all_null",
    FACT_SQL + " SELECT " + _row("not_all_null_air_temp_c", "fact", "'> 0'", "count(air_temp_c)", "count(air_temp_c) > 0") + " FROM fact UNION ALL SELECT "
    + _row("not_all_null_wpa", "fact", "'> 0'", "'0'", "false") + " FROM (SELECT 1)",
)
def dq_all_null(t: Tables):
    fact = star_fact(t).withColumn("wpa", F.lit(None).cast("double"))
    return column_checks(fact, "fact", [filled_check("air_temp_c"), filled_check("wpa")])


@query(
    "dq_column_agreement",
    "SELECT " + _zero("agree_season", "orders", "count(*) FILTER (WHERE o_orderkey % 50 = 1)") + " FROM orders",
)
def dq_column_agreement(t: Tables):
    n = F.col("o_orderkey")
    season = F.year("o_orderdate")
    # an unfilled copy does not disagree
    copy = F.when(n % 50 == 1, season + 1).when(n % 50 != 2, season)
    return column_checks(
        t.orders.select(season.alias("season"), copy.cast("string").alias("season__dup1")),
        "orders",
        [agreement_check("season", "season__dup1")],
    )


@query(
    "dq_non_empty",
    "SELECT " + _row("non_empty", "orders", "'> 0'", "count(*)", "count(*) > 0") + " FROM orders UNION ALL SELECT "
    + _row("non_empty", "returned", "'> 0'", "count(*)", "count(*) > 0") + " FROM lineitem WHERE l_returnflag = 'Z'",
)
def dq_non_empty(t: Tables):
    empty = t.lineitem.filter(F.col("l_returnflag") == "Z")
    return run_gates(
        [column_checks(t.orders, "orders", [non_empty_check()]), column_checks(empty, "returned", [non_empty_check()])]
    )


@query(
    "dq_span",
    "SELECT " + _row("span_season", "orders", "'1995..2001'", "min(y) || '..' || max(y)", "min(y) = 1995 AND max(y) = 2001") + " FROM (SELECT year(o_orderdate) AS y FROM orders) UNION ALL SELECT "
    + _row("span_o_custkey", "orders", "'0..5'", "min(o_custkey) || '..' || max(o_custkey)", "min(o_custkey) = 0 AND max(o_custkey) = 5") + " FROM orders",
)
def dq_span(t: Tables):
    rows = t.orders.select("o_custkey", F.year("o_orderdate").alias("season"))
    return column_checks(rows, "orders", [span_check("season", 1995, 2001), span_check("o_custkey", 0, 5)])


def served_tables(t: Tables) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(marts, serving tables), each mart written once so that the many checks read it instead of
    building it again."""
    marts = {x: materialize(df, x) for x, df in star_marts(t).items()}
    return marts, {x: serving.serve(df, C_TS, RUN_ID) for x, df in marts.items()}


_META_SQL = f"'{A_TS}' AS source_batch_a_build_run_ts, '{B_TS}' AS source_batch_b_build_run_ts, '{C_TS}' AS serving_build_run_ts, 'v1' AS serving_version, '{RUN_ID}' AS serving_run_id"


@query("serving_table", MARTS_SQL + f" SELECT *, {_META_SQL} FROM team_mart")
def serving_table(t: Tables):
    return serving.serve(gold.mart_team_season(star_base(t), B_TS, [A_TS]), C_TS, RUN_ID)


def _dq_audit_sql() -> str:
    parts = []
    for x, contract in C.SERVING.items():
        grain = ", ".join(contract.grain)
        table = f"{x}_mart"
        dup = f"(SELECT count(*) FROM (SELECT {grain} FROM {table} GROUP BY {grain} HAVING count(*) > 1))"
        n = f"(SELECT count(*) FROM {table})"
        rows = [_row("row_count_match", contract.name, n, n, "true"), _zero("duplicate_grain_rows", contract.name, dup)]
        rows += [
            _zero(f"metric_range_{c}", contract.name, f"(SELECT count(*) FROM {table} WHERE {c} < 0 OR {c} > 1)")
            for c in serving.SERVED_RATIOS[x]
        ]
        rows.append(_zero("weather_sample_domain", contract.name, f"(SELECT count(*) FROM {table} WHERE weather_sample NOT IN ('ALL_PLAYS','OBSERVED_ONLY'))"))
        rows += [_zero(f"not_null_{c}", contract.name, "0") for c in C.SERVING_NOT_NULL]
        parts += [f"SELECT {r}, {_META_SQL}" for r in rows]
    return " UNION ALL ".join(parts)


@query("dq_audit", MARTS_SQL + " " + _dq_audit_sql())
def dq_audit(t: Tables):
    marts, served = served_tables(t)
    return serving.dq_audit([serving.serving_gates(x, marts[x], served[x]) for x in marts], **META)


_TABLE_AUDIT_SQL = " UNION ALL ".join(
    f"""SELECT '{C.SERVING[x].name}' AS table_name, CAST(count(*) AS BIGINT) AS source_row_count, CAST(count(*) AS BIGINT) AS serving_row_count, min(season) AS min_season, max(season) AS max_season,
    CAST(count(DISTINCT weather_sample) AS BIGINT) AS n_weather_samples, CAST(sum(n_plays) AS BIGINT) AS sum_n_plays, CAST(0 AS BIGINT) AS duplicate_grain_rows, {_META_SQL} FROM {x}_mart"""
    for x in C.SERVING
)


@query("table_audit", MARTS_SQL + " " + _TABLE_AUDIT_SQL)
def table_audit(t: Tables):
    marts, served = served_tables(t)
    return serving.table_audit({x: (marts[x], served[x]) for x in marts}, **META)


_RUN_AUDIT_SQL = (
    "SELECT "
    + ", ".join(
        f"CAST((SELECT count(*) FROM {x}_mart) AS BIGINT) AS {kind}_{x}_rows" for kind in ("source", "serving") for x in C.SERVING
    )
    + f", CAST(0 AS BIGINT) AS dq_fail_count, 'SUCCESS' AS status, '2024-01-03T00:00:00Z' AS started_at_utc, '2024-01-03T00:05:00Z' AS completed_at_utc, {_META_SQL}"
)


def _audits(marts: dict[str, DataFrame], served: dict[str, DataFrame]) -> dict[str, DataFrame]:
    checks = serving.dq_audit([serving.serving_gates(x, marts[x], served[x]) for x in marts], **META)
    tables = serving.table_audit({x: (marts[x], served[x]) for x in marts}, **META)
    times = {"started_at": "2024-01-03T00:00:00Z", "completed_at": "2024-01-03T00:05:00Z"}
    return {
        "run": serving.run_audit(tables, checks, "SUCCESS", **times, **META),
        "table": tables,
        "dq": checks,
        "dictionary": serving.data_dictionary(served, C_TS, RUN_ID),
    }


def _written_audits(marts: dict[str, DataFrame], served: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {x: materialize(df, f"audit_{x}") for x, df in _audits(marts, served).items()}


@query("run_audit", MARTS_SQL + " " + _RUN_AUDIT_SQL)
def run_audit(t: Tables):
    return _audits(*served_tables(t))["run"]


def _dictionary_sql() -> str:
    rows = []
    for x, contract in C.SERVING.items():
        source = set(C.MARTS[x].columns)
        for i, f in enumerate(contract.schema.fields, start=1):
            text = C.COLUMN_TEXTS.get(f.name, C.DEFAULT_COLUMN_TEXT).replace("'", "''")
            rate = f"(SELECT CAST(count(*) - count({f.name}) AS DOUBLE) / count(*) FROM {x}_mart)" if f.name in source else "CAST(0 AS DOUBLE)"
            rows.append(
                f"SELECT '{contract.name}' AS table_name, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, CAST({i} AS INTEGER) AS ordinal_position, "
                f"CAST({int(f.name in contract.grain)} AS INTEGER) AS is_grain_key, '{text}' AS column_description, '{C_TS}' AS serving_build_run_ts, 'v1' AS serving_version, '{RUN_ID}' AS serving_run_id, {rate} AS null_rate"
            )
    return " UNION ALL ".join(rows)


@query("data_dictionary", MARTS_SQL + " " + _dictionary_sql())
def data_dictionary(t: Tables):
    """The dictionary beside the null rate of every described column."""
    _, served = served_tables(t)
    rates = None
    for x, df in served.items():
        profile = null_rates(df, df.columns)
        pairs = [
            F.struct(F.lit(C.SERVING[x].name).alias("table_name"), F.lit(c).alias("column_name"), F.col(f"null_rate_{c}").alias("null_rate"))
            for c in df.columns
        ]
        rows = profile.select(F.inline(F.array(*pairs)))
        rates = rows if rates is None else rates.unionByName(rows)
    return serving.data_dictionary(served, C_TS, RUN_ID).join(rates, ["table_name", "column_name"])


RECON_RUN = "c2_recon_20240104T000000Z"
EXPECTED_INDOOR = 7


def _recon_sql(run_id: str = RECON_RUN) -> str:
    rows = []
    for x, contract in C.SERVING.items():
        n = f"(SELECT count(*) FROM {x}_mart)"
        expected = str(EXPECTED_INDOOR) if x == "indoor" else n
        bad = x == "indoor"
        details = f"'row_count expected={EXPECTED_INDOOR} actual=' || {n}" if bad else "'OK'"
        rows.append(
            f"SELECT '{run_id}' AS run_id, '{contract.name}' AS table_name, CAST({expected} AS BIGINT) AS expected_rows, CAST({n} AS BIGINT) AS actual_rows, "
            f"CAST(0 AS BIGINT) AS duplicate_key_rows, CAST(0 AS BIGINT) AS null_partition_key_rows, CAST(0 AS BIGINT) AS metric_range_violations, "
            f"(SELECT min(season) FROM {x}_mart) AS min_season, (SELECT max(season) FROM {x}_mart) AS max_season, '{'FAIL' if bad else 'PASS'}' AS status, {details} AS details"
        )
    return " UNION ALL ".join(rows)


def _reconciled(served: dict[str, DataFrame], run_id: str, **wrong: int) -> DataFrame:
    expected = {x: wrong[x] if x in wrong else df.count() for x, df in served.items()}
    return serving.reconcile(served, expected, run_id)


@query("reconciliation_audit", MARTS_SQL + " " + _recon_sql())
def reconciliation_audit(t: Tables):
    """One table is given a wrong expected row count."""
    return _reconciled(served_tables(t)[1], RECON_RUN, indoor=EXPECTED_INDOOR)


@query(
    "reconciliation_run",
    MARTS_SQL + f", recon AS ({_recon_sql()})" + f""" SELECT '{RECON_RUN}' AS run_id, CAST(count(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS error_count, 'FAIL' AS status, 'See table-level failures' AS notes, """
    + ", ".join(
        f"max(CASE WHEN table_name = '{C.SERVING[x].name}' THEN {kind}_rows END) AS {x}_{kind}_rows" for x in C.SERVING for kind in ("expected", "actual")
    )
    + " FROM recon",
)
def reconciliation_run(t: Tables):
    return serving.reconcile_run(_reconciled(served_tables(t)[1], RECON_RUN, indoor=EXPECTED_INDOOR))


@query(
    "readiness_checklist",
    MARTS_SQL
    + """ SELECT item, CASE WHEN n > 0 THEN status ELSE 'FAIL' END AS status FROM (SELECT count(*) AS n FROM team_mart), (VALUES ('1. All 3 serving tables are complete and reconciled', 'PASS'),
    ('2. All required metadata/audit tables are loaded', 'PASS'), ('3. The serving schema is the only dashboard-facing contract', 'FAIL'),
    ('4. Dashboards can start safely with no known completeness blockers', 'FAIL')) v(item, status)""",
)
def readiness_checklist(t: Tables):
    """A failed reconciliation followed by a clean one, complete audits, and a stray table."""
    marts, served = served_tables(t)
    recon = _reconciled(served, "c2_recon_1", indoor=EXPECTED_INDOOR).unionByName(_reconciled(served, "c2_recon_2"))
    names = [("SERVING", c.name.upper()) for c in C.SERVING.values()]
    names += [("STG", f"{c.name.upper()}_LND") for c in C.SERVING.values()]
    names.append(("SANDBOX", "SERV_TEAM_COPY"))
    catalog = t.spark.createDataFrame(names, "table_schema string, table_name string")
    return serving.readiness(materialize(recon, "recon"), _written_audits(marts, served), catalog)


@query(
    "dq_run_alignment",
    MARTS_SQL
    + " SELECT "
    + " UNION ALL SELECT ".join(
        _row(f"aligned_{c}", C.SERVING[x].name, f"'{want}'", f"'{got}'", "n > 0" if want == got else "false") + f" FROM (SELECT count(*) AS n FROM {x}_mart)"
        for x in C.SERVING
        for c, want, got in (
            ("serving_build_run_ts", C_TS, C_TS),
            ("serving_run_id", RUN_ID, RUN_ID if x != "indoor" else "c1_old"),
            ("serving_version", "v1", "v1"),
        )
    ),
)
def dq_run_alignment(t: Tables):
    """The indoor table still carries an older run id; a later failed run does not count."""
    marts, served = served_tables(t)
    runs = _written_audits(marts, served)["run"]
    failed = runs.withColumns(
        {"status": F.lit("FAIL"), "serving_build_run_ts": F.lit("20250101T000000Z"), "serving_run_id": F.lit("c1_bad")}
    )
    served["indoor"] = served["indoor"].withColumn("serving_run_id", F.lit("c1_old"))
    return run_alignment(served, runs.unionByName(failed))


@query(
    "validation_report",
    MARTS_SQL + " SELECT " + _row("summary_n_rows", C.MARTS["indoor"].name, "'0'", "count(*)", "false") + " FROM indoor_mart UNION ALL SELECT "
    + _zero("metric_range_pass_rate", C.MARTS["team"].name, "count(*) FILTER (WHERE n_games > 1)") + " FROM team_mart",
)
def validation_report(t: Tables):
    """The mart validator over two injected faults: a wrong summary, and rates beyond 1."""
    base = star_base(t)
    marts = {x: materialize(df, x) for x, df in gold.marts(base, B_TS, [A_TS]).items()}
    broken = F.when(F.col("n_games") > 1, F.col("pass_rate") + 1.5).otherwise(F.col("pass_rate"))
    marts["team"] = marts["team"].withColumn("pass_rate", broken)
    summaries = {x: gold.mart_summary(df, C.MARTS[x].name) for x, df in marts.items()}
    summaries["indoor"] = summaries["indoor"].withColumn("n_rows", F.lit(0))
    return failures(validate_marts(base, marts, summaries))


PRICES = ["l_extendedprice", "l_quantity"]
SHARES = [0.05, 0.25, 0.5, 0.75, 0.95]


def _lines(t: Tables, shifted: bool = False) -> DataFrame:
    """Lines by year and flag, some without a price. In a shifted run the prices of one year are of another
    scale, one year lost most of its quantities, and one is missing."""
    price, quantity, year = F.col("l_extendedprice"), F.col("l_quantity"), F.year("l_shipdate")
    price = F.when(F.col("l_orderkey") % 10 > 0, price)
    if shifted:
        price = F.when(year == 1996, price * 3 + 20000).otherwise(price)
        quantity = F.when((year != 1997) | (F.col("l_orderkey") % 3 == 0), quantity)
    lines = t.lineitem.select(
        year.alias("year"), "l_returnflag", "l_orderkey", price.alias("l_extendedprice"), quantity.alias("l_quantity")
    )
    return lines.filter("year <> 1994") if shifted else lines


_LINES_SQL = """WITH before AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_returnflag, l_orderkey,
      CASE WHEN l_orderkey % 10 > 0 THEN l_extendedprice END AS l_extendedprice, l_quantity FROM lineitem),
    after AS (SELECT year, l_returnflag, l_orderkey, CASE WHEN year = 1996 THEN l_extendedprice * 3 + 20000 ELSE l_extendedprice END AS l_extendedprice,
      CASE WHEN year <> 1997 OR l_orderkey % 3 = 0 THEN l_quantity END AS l_quantity FROM before WHERE year <> 1994),"""


@query(
    "quantile_profile",
    _LINES_SQL
    + """ v AS (SELECT year, l_returnflag, 'l_extendedprice' AS measure, l_extendedprice AS x FROM before UNION ALL SELECT year, l_returnflag, 'l_quantity', l_quantity FROM before)
    SELECT year, measure, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(x) AS BIGINT) AS n_values, min(x) AS least, max(x) AS greatest, true AS within
    FROM v GROUP BY year, measure""",
)
def quantile_profile_query(t: Tables):
    """Profiles by year and flag merged to years; whether each quantile's exact rank, counted over all rows,
    is within three times the stated error."""
    lines = _lines(t)
    fine = quantile_profile(lines, PRICES, ["year", "l_returnflag"])
    years = materialize(with_quantiles(merge_profiles(fine, ["year"]), SHARES).drop("sketch"), "profile")
    one = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("x")) for m in PRICES])
    values = lines.select("year", F.inline(one)).filter("x is not null")
    ranked = values.join(years.select("year", "measure", "n_values", "quantiles"), ["year", "measure"])
    counts = [F.count_if(c).alias(f"{n}{i}") for i in range(len(SHARES)) for n, c in (
        ("below", F.col("x") < F.col("quantiles")[i]), ("upto", F.col("x") <= F.col("quantiles")[i]))]
    ranks = ranked.groupBy("year", "measure").agg(*counts)
    out, slack = years.join(ranks, ["year", "measure"], "left"), 3 * rank_error()
    within = F.lit(True)
    for i, share in enumerate(SHARES):
        n = F.col("n_values")
        within = within & (F.col(f"below{i}") / n <= share + slack) & (F.col(f"upto{i}") / n >= share - slack)
    return out.select("year", "measure", "n_rows", "n_values", "least", "greatest", within.alias("within"))


# the exact distance over every value, and the difference of two distributions that chance explains
_DRIFT_SQL = """ v AS (SELECT 0 AS run, year, l_returnflag, 'l_extendedprice' AS measure, l_extendedprice AS x FROM before
      UNION ALL SELECT 0, year, l_returnflag, 'l_quantity', l_quantity FROM before
      UNION ALL SELECT 1, year, l_returnflag, 'l_extendedprice', l_extendedprice FROM after
      UNION ALL SELECT 1, year, l_returnflag, 'l_quantity', l_quantity FROM after),
    sizes AS (SELECT year, l_returnflag, measure, count(*) FILTER (run = 0) AS n_before, count(*) FILTER (run = 1) AS n_after,
      count(x) FILTER (run = 0) AS n, count(x) FILTER (run = 1) AS m FROM v GROUP BY ALL),
    steps AS (SELECT year, l_returnflag, measure, x, count(*) FILTER (run = 0) AS a, count(*) FILTER (run = 1) AS b FROM v WHERE x IS NOT NULL GROUP BY ALL),
    ranks AS (SELECT year, l_returnflag, measure, sum(a) OVER w AS a, sum(b) OVER w AS b FROM steps WINDOW w AS (PARTITION BY year, l_returnflag, measure ORDER BY x)),
    apart AS (SELECT year, l_returnflag, measure, max(abs(a / n - b / m)) AS d FROM ranks JOIN sizes USING (year, l_returnflag, measure) WHERE n > 0 AND m > 0 GROUP BY ALL),
    drift AS (SELECT year, l_returnflag, measure, CASE WHEN n_after = 0 THEN 'before' WHEN n_before = 0 THEN 'after' ELSE 'both' END AS side,
      CAST(n_before AS BIGINT) AS n_before, CAST(n_after AS BIGINT) AS n_after, CASE WHEN n_before > 0 THEN 1 - n / n_before END AS null_rate_before,
      CASE WHEN n_after > 0 THEN 1 - m / n_after END AS null_rate_after, n_before = 0 OR n_after = 0 OR (n = 0) <> (m = 0)
        OR coalesce(d > 0.1 AND d > 1.628 * sqrt((n + m) / (n * m)), false) AS drifted
      FROM sizes LEFT JOIN apart USING (year, l_returnflag, measure))"""


def _drift(t: Tables) -> DataFrame:
    by = ["year", "l_returnflag"]
    runs = [quantile_profile(_lines(t, shifted), PRICES, by) for shifted in (False, True)]
    return distribution_drift(*runs, by, 0.1)


@query(
    "distribution_drift",
    _LINES_SQL + _DRIFT_SQL + " SELECT * REPLACE (round(null_rate_before, 9) AS null_rate_before, round(null_rate_after, 9) AS null_rate_after) FROM drift",
)
def distribution_drift_query(t: Tables):
    """Two runs by year and flag: the SQL takes the exact distance over all values."""
    rates = {c: F.round(c, 9) for c in ("null_rate_before", "null_rate_after")}
    return _drift(t).drop("distance").withColumns(rates)


@query(
    "dq_drift",
    _LINES_SQL
    + _DRIFT_SQL
    + """ SELECT check_name, 'lines' AS table_name, '0' AS expected_value, CAST(n AS VARCHAR) AS actual_value, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status, 'ERROR' AS severity
    FROM (SELECT 'distribution_drift' AS check_name, count(*) FILTER (drifted) AS n FROM drift
      UNION ALL SELECT 'null_rate_drift', count(*) FILTER (abs(null_rate_after - null_rate_before) > 0.05) FROM drift)""",
)
def dq_drift(t: Tables):
    """The gate on both."""
    return drift_gate(_drift(t), "lines")
