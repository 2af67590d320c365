"""Layer validators: each returns one report of gate rows for the built tables of its layer."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.functions.cleaning import ones
from weatherloom.operators.aggregate import row_count
from weatherloom.operators.gates import (
    Check,
    agreement_check,
    any_null_check,
    column_checks,
    domain_check,
    duplicate_check,
    equality_rows,
    filled_check,
    formula_check,
    gate_rows,
    key_parity,
    labelled_totals,
    non_empty_check,
    not_null_check,
    range_check,
    rate_check,
    reconcile_totals,
    reconstruction_deviation,
    required_columns_check,
    row_parity_check,
    run_gates,
    single_value_check,
    span_check,
    zero_denominator_check,
)
from weatherloom.plans.serving import SAMPLE_NAMES, SERVED_RATIOS, latest

# Acceptance rates of the fact.
MAPPED_RATE, PARSED_RATE, MATCH_RATE = 0.95, 0.95, 0.965
SHIFT_EPS = 1e-9


def validate_features(source: DataFrame, features: DataFrame, summary: DataFrame, span: tuple[int, int]) -> DataFrame:
    table = C.FEATURES.name
    parity = key_parity(source, features, C.FEATURES.grain)
    zero = ["missing_keys", "extra_keys", "source_duplicates", "feature_duplicates"]
    parity_rows = gate_rows(
        parity, table, [Check(c, F.col(c), 0, lambda a: a == 0) for c in zero], zero
    )
    monitor = reconstruction_deviation(
        source, features, C.FEATURES.grain, "wind_speed_mps", "wind_u_mps", "wind_v_mps"
    )
    monitor_rows = gate_rows(
        monitor,
        table,
        [Check("wind_reconstruction", F.col("n_deviating"), 0, lambda a: a == 0, "WARN")],
        ["n_deviating"],
    )
    return run_gates(
        [
            row_parity_check(source, features, table),
            parity_rows,
            column_checks(
                features,
                table,
                [
                    range_check("relative_humidity_pct", 0.0, 100.0),
                    domain_check("pressure_tendency_3h", [-1, 0, 1]),
                    domain_check("feature_version", [C.FEATURE_VERSION]),
                    not_null_check("source_build_run_ts"),
                    single_value_check("feature_build_run_ts"),
                    span_check("obs_year", *span),
                ],
            ),
            monitor_rows,
            summary_match(summary, features, table, {"n_rows": row_count(), "n_station_keys": F.count_distinct("station_key")}),
        ]
    )


def summary_match(summary: DataFrame, df: DataFrame, table: str, facts: Mapping) -> DataFrame:
    """Stored QC values against recomputed ones, one gate row per value."""
    now = df.agg(*[c.alias(f"now_{n}") for n, c in facts.items()])
    stored = summary.select(*[F.col(n).cast("long").alias(f"was_{n}") for n in facts])
    both = stored.unionByName(now, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    pairs = {f"summary_{n}": (F.col(f"was_{n}"), F.col(f"now_{n}")) for n in facts}
    return equality_rows(one, table, pairs)


def validate_fact(
    plays: DataFrame, fact: DataFrame, bins: DataFrame, summary: DataFrame, required: list[str],
    mapped_rate: float = MAPPED_RATE, parsed_rate: float = PARSED_RATE, match_rate: float = MATCH_RATE,
) -> DataFrame:
    table = "fact_play_weather_hourly_v1"
    mapped, parsed = F.col("station_mapped_flag") == 1, F.col("play_time_parsed_flag") == 1
    return run_gates(
        [
            required_columns_check(fact, table, required),
            row_parity_check(plays, fact, table),
            duplicate_check(fact, table, C.PLAYS.grain),
            column_checks(
                fact,
                table,
                [
                    any_null_check("null_keys", C.PLAYS.grain),
                    any_null_check("null_bins", C.BINS),
                    rate_check("station_mapped_rate", mapped, mapped_rate),
                    rate_check("play_time_parsed_rate", parsed, parsed_rate),
                    rate_check(
                        "weather_match_rate", F.col("weather_key_match_flag") == 1, match_rate, among=mapped & parsed
                    ),
                    filled_check("air_temp_c"),
                    filled_check("wind_speed_mps"),
                    filled_check("relative_humidity_pct"),
                ],
            ),
            bins_complete(bins),
            summary_match(summary, fact, table, {"n_rows": row_count()}),
        ]
    )


def bins_complete(bins: DataFrame) -> DataFrame:
    """Every bin family must exist and hold an UNKNOWN member."""
    unknown = F.col("bin_value") == "UNKNOWN"
    checks = []
    for family in C.BINS:
        has = F.coalesce(F.max(ones(unknown & (F.col("bin_type") == family))), F.lit(0))
        checks.append(Check(f"unknown_in_{family}", has, 1, lambda a: a == 1))
    return column_checks(bins, C.BIN_DIMENSION.name, checks)


def mart_checks(df: DataFrame, contract: C.Contract, files: DataFrame | None = None) -> DataFrame:
    """Columns, grain, ratios and denominators of one mart; the columns are those of ``files``, the
    mart as read before it was conformed."""
    attempts = F.col("n_pass_attempts") + F.col("n_rush_attempts")
    have = set(df.columns)
    checks = [non_empty_check(), zero_denominator_check("pass_rate", attempts)]
    checks += [range_check(c, 0.0, 1.0) for c in contract.ratios]
    if "completion_pct" in have:
        checks.append(zero_denominator_check("completion_pct", "n_pass_attempts"))
    if "n_epa_plays" in have:
        checks.append(zero_denominator_check("epa_per_play", "n_epa_plays"))
    if "pass_rate_baseline" in have:
        checks += [
            formula_check(f"{r}_shift", r, f"{r}_baseline", f"{r}_shift_vs_team_season", SHIFT_EPS)
            for r in ("pass_rate", "rush_rate")
        ]
    return run_gates(
        [
            required_columns_check(df if files is None else files, contract.name, contract.columns),
            duplicate_check(df, contract.name, contract.grain),
            column_checks(df, contract.name, checks),
        ]
    )


def totals_agree(base: DataFrame, marts: Mapping[str, DataFrame]) -> DataFrame:
    """n_plays per sample in the base rows and in every mart; the base is counted afresh."""
    observed = F.col("weather_observed_flag")
    expected = base.agg(row_count().alias("ALL_PLAYS"), F.coalesce(F.sum(observed), F.lit(0)).cast("long").alias("OBSERVED_ONLY"))
    rows = expected.select(
        F.inline(
            F.array(*[F.struct(F.lit(s).alias("weather_sample"), F.col(s).alias("n_plays")) for s in SAMPLE_NAMES])
        )
    )
    return reconcile_totals({"expected": rows, **marts}, "weather_sample", "n_plays")


def reconcile_rows(side: DataFrame, table: str) -> DataFrame:
    """Gate rows of a side-by-side reconciliation."""
    values = [c for c in side.columns if c not in ("weather_sample", "status")]
    return side.select(
        F.concat(F.lit("n_plays_"), F.col("weather_sample")).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.col("expected").cast("string").alias("expected_value"),
        F.concat_ws(",", *[F.col(c).cast("string") for c in values if c != "expected"]).alias("actual_value"),
        "status",
        F.lit("ERROR").alias("severity"),
    )


def validate_marts(
    base: DataFrame, marts: Mapping[str, DataFrame], summaries: Mapping[str, DataFrame],
    files: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    gates = [mart_checks(df, C.MARTS[x], (files or {}).get(x)) for x, df in marts.items()]
    gates += [summary_match(summaries[x], df, C.MARTS[x].name, {"n_rows": row_count()}) for x, df in marts.items()]
    gates.append(reconcile_rows(totals_agree(base, marts), "marts"))
    return run_gates(gates)


def stamps_agree(marts: Mapping[str, DataFrame]) -> DataFrame:
    """All marts carry one value of each build stamp, the same in all of them, and no nulls."""
    every = reduce(DataFrame.unionByName, [df.select(*C.STAMPS) for df in marts.values()])
    return column_checks(every, "marts", [single_value_check(c) for c in C.STAMPS])


def column_copies_agree(df: DataFrame, table: str) -> DataFrame:
    """Repeated source columns (name and name__dup1) must not contradict each other."""
    copies = [c for c in df.columns if c.endswith("__dup1")]
    checks = [agreement_check(c.removesuffix("__dup1"), c) for c in copies]
    return column_checks(df, table, checks or [non_empty_check()])


def run_alignment(served: Mapping[str, DataFrame], run_audit: DataFrame) -> DataFrame:
    """Run stamp, run id and version of every serving table against the latest successful run."""
    columns = ["serving_build_run_ts", "serving_run_id", "serving_version"]
    last = latest(run_audit, "serving_build_run_ts", F.col("status") == "SUCCESS").agg(
        *[F.max(c).alias(f"want_{c}") for c in columns]
    )
    gates = []
    for label, df in served.items():
        # lowest and highest value: equal to the run's value exactly when all rows carry it
        seen = df.agg(
            *[F.min(c).alias(f"low_{c}") for c in columns],
            *[F.max(c).alias(f"high_{c}") for c in columns],
            *[F.sum(ones(F.col(c).isNull())).alias(f"null_{c}") for c in columns],
        )
        both = last.unionByName(seen, allowMissingColumns=True)
        one = both.agg(*[F.max(c).alias(c) for c in both.columns])
        pairs = {}
        for c in columns:
            low, high = F.col(f"low_{c}"), F.col(f"high_{c}")
            actual = F.when(F.col(f"null_{c}") > 0, F.lit("null")).when(low == high, low).otherwise(
                F.concat_ws("..", low, high)
            )
            pairs[f"aligned_{c}"] = (F.col(f"want_{c}"), actual)
        gates.append(equality_rows(one, C.SERVING[label].name, pairs))
    return run_gates(gates)


def validate_serving(
    sources: Mapping[str, DataFrame], served: Mapping[str, DataFrame], audits: Mapping[str, DataFrame],
    files: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    gates = []
    for label, df in served.items():
        contract = C.SERVING[label]
        gates += [
            required_columns_check((files or served)[label], contract.name, C.SERVING_METADATA),
            row_parity_check(sources[label], df, contract.name),
            duplicate_check(df, contract.name, contract.grain),
            column_checks(df, contract.name, [range_check(c, 0.0, 1.0) for c in SERVED_RATIOS[label]]),
        ]
    gates.append(run_alignment(served, audits["run"]))
    gates.append(audits_complete(audits))
    return run_gates(gates)


def audits_complete(audits: Mapping[str, DataFrame]) -> DataFrame:
    """Audit rows the latest successful run must have left: tables, checks without failures, and a
    dictionary that names exactly the serving tables."""
    run_id = latest(audits["run"], "serving_build_run_ts", F.col("status") == "SUCCESS").select("serving_run_id")
    names = [c.name for c in C.SERVING.values()]

    def of_run(label: str) -> DataFrame:
        return audits[label].join(run_id, "serving_run_id", "left_semi")

    known = F.col("table_name").isin(*names)
    parts = {
        "tables": of_run("table").agg(row_count().alias("n")),
        "checks": of_run("dq").agg(row_count().alias("n")),
        "failed": of_run("dq").agg(F.coalesce(F.sum(ones(F.col("status") == "FAIL")), F.lit(0)).alias("n")),
        "described": of_run("dictionary").agg(F.count_distinct(F.when(known, F.col("table_name"))).alias("n")),
        "undescribed": of_run("dictionary").agg(F.coalesce(F.sum(ones(~known)), F.lit(0)).alias("n")),
    }
    one = labelled_totals(parts, "n")
    checks = [
        Check("table_audit_rows", F.col("tables"), f">= {len(names)}", lambda a: a >= len(names)),
        Check("dq_audit_rows", F.col("checks"), "> 0", lambda a: a > 0),
        Check("dq_audit_failures", F.col("failed"), 0, lambda a: a == 0),
        Check("dictionary_tables", F.col("described"), len(names), lambda a: a == len(names)),
        Check("dictionary_strangers", F.col("undescribed"), 0, lambda a: a == 0),
    ]
    return gate_rows(one, "audits", checks, list(parts))
