"""Serving tables with provenance, their audits, reconciliation and release readiness."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.functions.cleaning import in_domain, ones, outside
from weatherloom.operators.aggregate import row_count, table_stats
from weatherloom.operators.columns import conform, stamp
from weatherloom.operators.gates import (
    domain_check,
    duplicate_counts,
    grain_totals,
    labelled_totals,
    not_null_check,
    range_check,
    run_gates,
    table_checks,
)

SAMPLE_NAMES = ["ALL_PLAYS", "OBSERVED_ONLY"]
# ratios checked before serving; baselines are checked at reconciliation
SERVED_RATIOS = {
    "team": ["pass_rate", "completion_pct"],
    "playcall": ["pass_rate", "rush_rate"],
    "indoor": ["pass_rate", "completion_pct"],
}


def serve(mart: DataFrame, run_ts: str, run_id: str) -> DataFrame:
    """The mart plus its provenance columns."""
    a, b = C.STAMPS
    sourced = mart.withColumns({f"source_{c}": F.col(c) for c in (a, b)})
    return stamp(sourced, serving_build_run_ts=run_ts, serving_version=C.SERVING_VERSION, serving_run_id=run_id)


def serving_gates(label: str, source: DataFrame, served: DataFrame) -> DataFrame:
    """The nine audited checks of one serving table."""
    contract = C.SERVING[label]
    checks = [range_check(c, 0.0, 1.0) for c in SERVED_RATIOS[label]]
    checks.append(domain_check("weather_sample", SAMPLE_NAMES))
    checks += [not_null_check(c) for c in C.SERVING_NOT_NULL]
    return table_checks(source, served, contract.name, contract.grain, checks)


def stamp_serving(df: DataFrame, a_ts: str, b_ts: str, run_ts: str, run_id: str) -> DataFrame:
    return stamp(
        df,
        source_batch_a_build_run_ts=a_ts,
        source_batch_b_build_run_ts=b_ts,
        serving_build_run_ts=run_ts,
        serving_version=C.SERVING_VERSION,
        serving_run_id=run_id,
    )


def dq_audit(reports: list[DataFrame], **meta: str) -> DataFrame:
    return conform(stamp_serving(run_gates(reports), **meta), C.DQ_AUDIT.schema)


def table_audit(pairs: Mapping[str, tuple[DataFrame, DataFrame]], **meta: str) -> DataFrame:
    """One row per serving table from ``{label: (source, served)}``."""
    rows = []
    for label, (source, served) in pairs.items():
        contract = C.SERVING[label]
        stats = table_stats(served, contract.name)
        sizes = source.agg(row_count().alias("source_row_count"))
        dups = duplicate_counts(served, contract.grain).select(F.col("duplicate_keys").alias("duplicate_grain_rows"))
        # three one-row results side by side without a join: stack and take the filled values
        stacked = reduce(
            lambda x, y: x.unionByName(y, allowMissingColumns=True), [stats, sizes, dups]
        )
        rows.append(stacked.agg(*[F.max(c).alias(c) for c in stacked.columns]))
    return conform(stamp_serving(reduce(DataFrame.unionByName, rows), **meta), C.TABLE_AUDIT.schema)


def data_dictionary(tables: Mapping[str, DataFrame], run_ts: str, run_id: str) -> DataFrame:
    """One row per column of each serving table ``{label: table}``."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for label, df in tables.items():
        contract = C.SERVING[label]
        for i, f in enumerate(df.schema.fields, start=1):
            text = C.COLUMN_TEXTS.get(f.name, C.DEFAULT_COLUMN_TEXT)
            rows.append(
                (contract.name, f.name, f.dataType.simpleString(), i, int(f.name in contract.grain), text,
                 run_ts, C.SERVING_VERSION, run_id)
            )
    return spark.createDataFrame(rows, C.DICTIONARY.schema)


def run_audit(
    tables: DataFrame, checks: DataFrame, status: str, started_at: str, completed_at: str, **meta: str
) -> DataFrame:
    """One row per run from the table audit and the check rows."""
    short = {C.SERVING[label].name: label for label in C.SERVING}

    def rows_of(kind: str, label: str, name: str):
        picked = F.max(F.when(F.col("table_name") == name, F.col(f"{kind}_row_count")))
        return F.coalesce(picked, F.lit(0)).alias(f"{kind}_{label}_rows")

    counts = tables.agg(
        *[rows_of(kind, label, name) for kind in ("source", "serving") for name, label in short.items()]
    )
    failed = checks.agg(F.coalesce(F.sum(ones(F.col("status") == "FAIL")), F.lit(0)).alias("dq_fail_count"))
    both = counts.unionByName(failed, allowMissingColumns=True)
    one = both.agg(*[F.max(c).alias(c) for c in both.columns])
    one = stamp(one, status=status, started_at_utc=started_at, completed_at_utc=completed_at)
    return conform(stamp_serving(one, **meta), C.RUN_AUDIT.schema)


def reconcile_table(df: DataFrame, name: str, contract: C.Contract, expected_rows: int, run_id: str) -> DataFrame:
    """One reconciliation row for a published table."""
    # any ratio out of range counts the row once
    bad_ratio = reduce(lambda a, b: a | b, [outside(c, 0.0, 1.0) for c in contract.ratios])
    null_partition = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in contract.partitions])
    n = F.col("n")
    per_key = df.groupBy(*contract.grain).agg(
        row_count().alias("n"),
        F.sum(ones(null_partition)).alias("no_partition"),
        F.sum(ones(bad_ratio)).alias("bad_ratio"),
        F.min("season").alias("low"),
        F.max("season").alias("high"),
    )
    one = per_key.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("actual_rows"),
        F.coalesce(F.sum(n - 1), F.lit(0)).alias("duplicate_key_rows"),
        F.coalesce(F.sum("no_partition"), F.lit(0)).alias("null_partition_key_rows"),
        F.coalesce(F.sum("bad_ratio"), F.lit(0)).alias("metric_range_violations"),
        F.min("low").alias("min_season"),
        F.max("high").alias("max_season"),
    )
    expected, actual = F.lit(expected_rows), F.col("actual_rows")

    def complaint(column: str):
        text = F.concat(F.lit(f"{column}="), F.col(column).cast("string"))
        return F.when(F.col(column) != 0, text)

    wrong_count = F.when(
        actual != expected, F.concat(F.lit(f"row_count expected={expected_rows} actual="), actual.cast("string"))
    )
    details = F.concat_ws(
        "; ", wrong_count, *[complaint(c) for c in ("duplicate_key_rows", "null_partition_key_rows", "metric_range_violations")]
    )
    out = stamp(one, run_id=run_id, table_name=name, expected_rows=expected_rows).withColumn("__d", details)
    out = out.withColumns(
        {
            "status": F.when(F.col("__d") == "", "PASS").otherwise("FAIL"),
            "details": F.when(F.col("__d") == "", "OK").otherwise(F.col("__d")),
        }
    )
    return conform(out, C.RECON_TABLE.schema)


def reconcile(tables: Mapping[str, DataFrame], expected: Mapping[str, int], run_id: str) -> DataFrame:
    rows = [reconcile_table(df, C.SERVING[x].name, C.SERVING[x], expected[x], run_id) for x, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def reconcile_run(table_rows: DataFrame) -> DataFrame:
    """Run row of a reconciliation: overall status, failed tables, and counts per table."""
    counts = [
        F.max(F.when(F.col("table_name") == C.SERVING[label].name, F.col(f"{kind}_rows"))).alias(f"{label}_{kind}_rows")
        for label in C.SERVING
        for kind in ("expected", "actual")
    ]
    errors = F.sum(ones(F.col("status") == "FAIL")).cast("long")
    run = table_rows.groupBy("run_id").agg(errors.alias("error_count"), *counts)
    clean = F.col("error_count") == 0
    return run.withColumns(
        {
            "status": F.when(clean, "PASS").otherwise("FAIL"),
            "notes": F.when(clean, "All serving tables reconciled").otherwise("See table-level failures"),
        }
    )


def latest(df: DataFrame, order: str, where=None) -> DataFrame:
    """The row with the largest ``order`` among those meeting ``where``, kept as a DataFrame; of
    several, the largest by all columns."""
    chosen = df if where is None else df.filter(where)
    return chosen.orderBy(F.col(order).desc(), *[F.col(c).desc() for c in df.columns if c != order]).limit(1)


# What may sit outside the serving schema under a serving name, and checklist texts.
LOADING_SUFFIXES = r"(_LND|_TMP|__LOAD_TMP)$"
READINESS_ITEMS = {
    "serving_ok": "1. All 3 serving tables are complete and reconciled",
    "metadata_ok": "2. All required metadata/audit tables are loaded",
    "contract_ok": "3. The serving schema is the only dashboard-facing contract",
    "ready": "4. Dashboards can start safely with no known completeness blockers",
}


def contract_boundary(catalog: DataFrame, serving_schema: str = "SERVING") -> DataFrame:
    """One row over ``catalog(table_schema, table_name)``: contract tables in the serving schema,
    and tables with a serving name outside it."""
    name, here = F.upper("table_name"), F.upper("table_schema") == serving_schema.upper()
    wanted = [c.name.upper() for c in C.SERVING.values()]
    stray = ~here & name.startswith("SERV_") & ~name.rlike(LOADING_SUFFIXES)
    return catalog.agg(
        F.coalesce(F.sum(ones(here & in_domain(name, wanted))), F.lit(0)).alias("serving_tables"),
        F.coalesce(F.sum(ones(stray)), F.lit(0)).alias("stray_tables"),
    )


def catalog_tables(spark: SparkSession) -> DataFrame:
    rows = []
    for db in spark.catalog.listDatabases():
        rows += [(db.name, t.name) for t in spark.catalog.listTables(db.name) if not t.isTemporary]
    return spark.createDataFrame(rows, "table_schema string, table_name string")


def readiness(
    recon_rows: DataFrame,
    audits: Mapping[str, DataFrame],
    catalog: DataFrame,
    audit_rows: Mapping[str, int] = C.AUDIT_ROWS,
    serving_schema: str = "SERVING",
) -> DataFrame:
    """Four checklist rows (item, status) from the latest reconciliation, the audit tables and the
    table names. Every input is an audit-sized table."""
    n = len(C.SERVING)
    latest_run = F.max("run_id")
    runs = recon_rows.groupBy("run_id").agg(
        row_count().alias("total"), F.sum(ones(F.col("status") == "PASS")).alias("passed")
    )
    serving_ok = runs.agg(
        F.max_by(F.struct("total", "passed"), "run_id").alias("last"), latest_run.alias("run_id")
    ).select(
        F.coalesce((F.col("last.total") == n) & (F.col("last.passed") == n), F.lit(False)).alias("ok")
    )
    metadata = []
    for label, df in audits.items():
        seen = grain_totals(df, C.AUDITS[label].grain, {})
        metadata.append(seen.select(((F.col("n_rows") == audit_rows[label]) & (F.col("duplicate_rows") == 0)).alias("ok")))
    metadata_ok = reduce(DataFrame.unionByName, metadata).agg(F.every("ok").alias("ok"))
    contract_ok = contract_boundary(catalog, serving_schema).select(
        ((F.col("serving_tables") == n) & (F.col("stray_tables") == 0)).alias("ok")
    )
    verdicts = labelled_totals(
        {
            "serving_ok": serving_ok.select(F.col("ok").cast("int")),
            "metadata_ok": metadata_ok.select(F.col("ok").cast("int")),
            "contract_ok": contract_ok.select(F.col("ok").cast("int")),
        },
        "ok",
    ).withColumn("ready", F.least("serving_ok", "metadata_ok", "contract_ok"))
    items = [
        F.struct(F.lit(text).alias("item"), F.when(F.col(c) == 1, "PASS").otherwise("FAIL").alias("status"))
        for c, text in READINESS_ITEMS.items()
    ]
    return verdicts.select(F.inline(F.array(*items)))
