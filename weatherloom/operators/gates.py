"""Data-quality gates. Every gate yields rows (check, table, expected, actual, status, severity).

Checks that are plain aggregates of one table are folded into a single pass over it. Gates are
lazy DataFrames: nothing is collected until a caller asks for the report.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom.functions.cleaning import as_column, ones, outside
from weatherloom.operators.aggregate import row_count

GATE_COLUMNS = ["check_name", "table_name", "expected_value", "actual_value", "status", "severity"]


@dataclass(frozen=True)
class Check:
    """One aggregate of a table and the condition it must meet."""

    name: str
    actual: Column
    expected: object
    passes: Callable[[Column], Column]
    severity: str = "ERROR"


def _zero(name: str, violations: Column, severity: str = "ERROR") -> Check:
    # a sum over no rows is null: an empty table has no violations
    total = F.coalesce(F.sum(ones(violations)), F.lit(0)).cast("long")
    return Check(name, total, 0, lambda a: a == 0, severity)


def range_check(c: str, low: float, high: float) -> Check:
    return _zero(f"metric_range_{c}", outside(c, low, high))


def not_null_check(c: str) -> Check:
    return _zero(f"not_null_{c}", F.col(c).isNull())


def any_null_check(name: str, cols: Sequence[str]) -> Check:
    """Rows in which at least one of the columns is null."""
    broken = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
    return _zero(name, broken)


def domain_check(c: str, values: Sequence[object], name: str | None = None) -> Check:
    """Filled values outside the allowed set; nulls are a matter for the null checks."""
    return _zero(name or f"{c}_domain", ~F.col(c).isin(*values))


def formula_check(name: str, total: str, part: str, difference: str, eps: float = 1e-9) -> Check:
    """total - part must equal difference."""
    off = F.abs(F.col(total) - F.col(part) - F.col(difference)) > F.lit(eps)
    return _zero(name, off)


def zero_denominator_check(ratio: str, denominator: Column | str) -> Check:
    """A ratio may not be filled where its denominator is zero."""
    broken = (as_column(denominator) == 0) & F.col(ratio).isNotNull()
    return _zero(f"zero_denominator_{ratio}", broken)


def agreement_check(a: str, b: str) -> Check:
    """Two copies of a column must not differ where both are filled."""
    return _zero(f"agree_{a}", F.col(a).cast("string") != F.col(b).cast("string"))


def rate_check(name: str, condition: Column, at_least: float, among: Column | None = None) -> Check:
    """Share of rows meeting ``condition`` among those meeting ``among``; 0.0 when there are none."""
    hit = ones(condition) if among is None else F.when(among, ones(condition))
    return Check(name, F.coalesce(F.avg(hit), F.lit(0.0)), at_least, lambda a: a >= F.lit(at_least))


def filled_check(c: str) -> Check:
    """The measure may not be null everywhere."""
    return Check(f"not_all_null_{c}", F.count(c), "> 0", lambda a: a > 0)


def non_empty_check() -> Check:
    return Check("non_empty", row_count(), "> 0", lambda a: a > 0)


def span_check(c: str, low: int, high: int) -> Check:
    span = F.concat_ws("..", F.min(c).cast("string"), F.max(c).cast("string"))
    want = f"{low}..{high}"
    return Check(f"span_{c}", span, want, lambda a: a == F.lit(want))


def single_value_check(c: str, expected: str | None = None) -> Check:
    """Exactly one distinct value and no null. Smallest and largest value decide, which needs no
    shuffle; more than one value shows as low..high."""
    low, high = F.min(c).cast("string"), F.max(c).cast("string")
    holes = F.coalesce(F.sum(ones(F.col(c).isNull())), F.lit(0))
    seen = F.when(holes > 0, F.lit("null")).when(low == high, low).otherwise(F.concat_ws("..", low, high))
    ok = (lambda a: a == F.lit(expected)) if expected is not None else (
        lambda a: ~a.contains("..") & (a != "null") & (a != "")
    )
    return Check(f"single_{c}", seen, expected or "one value", ok)


def _gate_row(name: str, table: str, expected: Column, actual: Column, ok: Column, severity: str) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.coalesce(expected.cast("string"), F.lit("null")).alias("expected_value"),
        F.coalesce(actual.cast("string"), F.lit("null")).alias("actual_value"),
        F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise("FAIL").alias("status"),
        F.lit(severity).alias("severity"),
    )


def _check_row(check: Check, table: str, column: str) -> Column:
    actual = F.col(column)
    return _gate_row(check.name, table, F.lit(str(check.expected)), actual, check.passes(actual), check.severity)


def gate_rows(one_row: DataFrame, table: str, checks: Sequence[Check], actuals: Sequence[str]) -> DataFrame:
    """Gate rows from a one-row DataFrame holding the actual value of each check."""
    return one_row.select(F.inline(F.array(*[_check_row(c, table, a) for c, a in zip(checks, actuals)])))


def column_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """All checks of one table in one pass."""
    names = [f"__check{i}" for i in range(len(checks))]
    totals = df.agg(*[c.actual.alias(n) for c, n in zip(checks, names)])
    return gate_rows(totals, table, checks, names)


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many keys repeat, and how many rows are surplus. The two differ as soon as a
    key occurs three times."""
    n = F.col("__n")
    return (
        df.groupBy(*keys)
        .agg(row_count().alias("__n"))
        .filter(n > 1)
        .agg(
            row_count().alias("duplicate_keys"),
            F.coalesce(F.sum(n - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
        )
    )


def duplicate_check(df: DataFrame, table: str, keys: Sequence[str], surplus: bool = False) -> DataFrame:
    column = "duplicate_rows" if surplus else "duplicate_keys"
    check = Check("duplicate_grain_rows", F.col(column), 0, lambda a: a == 0)
    return gate_rows(duplicate_counts(df, keys), table, [check], [column])


def labelled_totals(parts: Mapping[str, DataFrame], column: str) -> DataFrame:
    """One row with one column per label, from one-row DataFrames holding ``column``."""
    tagged = [df.select(F.lit(label).alias("__label"), F.col(column).alias("__v")) for label, df in parts.items()]
    stacked = reduce(DataFrame.unionByName, tagged)
    return stacked.agg(
        *[F.max(F.when(F.col("__label") == label, F.col("__v"))).alias(label) for label in parts]
    )


def row_parity_check(source: DataFrame, target: DataFrame, table: str, name: str = "row_count_match") -> DataFrame:
    both = labelled_totals(
        {"source": source.agg(row_count().alias("n")), "target": target.agg(row_count().alias("n"))}, "n"
    )
    return equality_rows(both, table, {name: (F.col("source"), F.col("target"))})


def equality_rows(
    one_row: DataFrame, table: str, pairs: Mapping[str, tuple[Column, Column]], severity: str = "ERROR"
) -> DataFrame:
    """Gate rows ``{name: (expected, actual)}`` whose expected values are computed themselves."""
    rows = [_gate_row(n, table, want, got, want.eqNullSafe(got), severity) for n, (want, got) in pairs.items()]
    return one_row.select(F.inline(F.array(*rows)))


def grain_totals(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """One row from one pass over ``df``: n_rows, duplicate_keys, duplicate_rows, and ``sums``, which
    must be totals that add up over keys."""
    n = F.col("__n")
    per_key = df.groupBy(*keys).agg(row_count().alias("__n"), *[c.alias(name) for name, c in sums.items()])
    return per_key.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(ones(n > 1)), F.lit(0)).cast("long").alias("duplicate_keys"),
        F.coalesce(F.sum(n - 1), F.lit(0)).cast("long").alias("duplicate_rows"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
    )


def table_checks(source: DataFrame, df: DataFrame, table: str, keys: Sequence[str], checks: Sequence[Check]) -> DataFrame:
    """Row parity with ``source``, repeated keys, and ``checks`` that count rows, over one pass of
    each table."""
    names = [f"__check{i}" for i in range(len(checks))]
    totals = grain_totals(df, keys, {n: c.actual for n, c in zip(names, checks)})
    stacked = totals.unionByName(source.agg(row_count().alias("source")), allowMissingColumns=True)
    one = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    want, got = F.col("source"), F.col("n_rows")
    rows = [_gate_row("row_count_match", table, want, got, want.eqNullSafe(got), "ERROR")]
    rows.append(_check_row(Check("duplicate_grain_rows", F.col("duplicate_keys"), 0, lambda a: a == 0), table, "duplicate_keys"))
    return one.select(F.inline(F.array(*rows, *[_check_row(c, table, n) for c, n in zip(checks, names)])))


def key_parity(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: distinct keys on each side, keys missing from ``b``, keys ``b`` has in addition,
    and repeated keys on each side. Both tables meet in a single aggregation."""
    one, none = F.lit(1), F.lit(0)
    tagged = a.select(*keys, one.alias("__a"), none.alias("__b")).unionByName(
        b.select(*keys, none.alias("__a"), one.alias("__b"))
    )
    per_key = tagged.groupBy(*keys).agg(F.sum("__a").alias("__a"), F.sum("__b").alias("__b"))
    in_a, in_b = F.col("__a"), F.col("__b")
    counts = {
        "source_keys": in_a > 0,
        "feature_keys": in_b > 0,
        "missing_keys": (in_a > 0) & (in_b == 0),
        "extra_keys": (in_b > 0) & (in_a == 0),
        "source_duplicates": in_a > 1,
        "feature_duplicates": in_b > 1,
    }
    return per_key.agg(
        *[F.coalesce(F.sum(ones(c)), F.lit(0)).cast("long").alias(n) for n, c in counts.items()]
    )


def required_columns_check(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Names absent from the schema, with the number of rows affected as a reminder of the scope."""
    missing = [c for c in columns if c not in df.columns]
    return _schema_gate(df, table, "required_columns", "none missing", ",".join(missing) or "none missing")


def schema_check(df: DataFrame, table: str, contract: T.StructType) -> DataFrame:
    """Names, order and types must equal the contract; nullability is not compared."""
    return _schema_gate(df, table, "schema", "matches contract", schema_difference(df, contract))


def schema_difference(df: DataFrame, contract: T.StructType) -> str:
    want = [f"{f.name} {f.dataType.simpleString()}" for f in contract.fields]
    have = [f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields]
    wrong = sorted(set(want) ^ set(have)) or (["column order"] if want != have else [])
    return "; ".join(wrong) or "matches contract"


def schema_rows(df: DataFrame, table: str, contract: T.StructType) -> DataFrame:
    """The gate row of :func:`schema_check` without the row count, so without reading the table."""
    want, found = "matches contract", schema_difference(df, contract)
    row = ("schema", table, want, found, "PASS" if want == found else "FAIL", "ERROR")
    return df.sparkSession.createDataFrame([row], ", ".join(f"{c} string" for c in GATE_COLUMNS))


def _schema_gate(df: DataFrame, table: str, name: str, expected: str, actual: str) -> DataFrame:
    status = "PASS" if expected == actual else "FAIL"
    return df.agg(row_count().alias("n_rows")).select(
        F.lit(name).alias("check_name"),
        F.lit(table).alias("table_name"),
        F.lit(expected).alias("expected_value"),
        F.lit(actual).alias("actual_value"),
        F.lit(status).alias("status"),
        F.lit("ERROR").alias("severity"),
        "n_rows",
    )


def reconcile_totals(parts: Mapping[str, DataFrame], by: str, value: str) -> DataFrame:
    """Per group, the total of ``value`` in each table side by side, and whether all agree."""
    tagged = [
        df.groupBy(by).agg(F.sum(value).cast("long").alias("__v")).withColumn("__label", F.lit(label))
        for label, df in parts.items()
    ]
    stacked = reduce(DataFrame.unionByName, tagged)
    side = stacked.groupBy(by).agg(
        *[
            F.coalesce(F.max(F.when(F.col("__label") == label, F.col("__v"))), F.lit(0)).alias(label)
            for label in parts
        ]
    )
    labels = list(parts)
    same = reduce(lambda x, y: x & y, [F.col(labels[0]) == F.col(x) for x in labels[1:]])
    return side.withColumn("status", F.when(same, "PASS").otherwise("FAIL"))


def reconstruction_deviation(
    source: DataFrame, features: DataFrame, on: Sequence[str], speed: str, u: str, v: str, eps: float = 0.1
) -> DataFrame:
    """One row: filled wind vectors, and how many of them miss the source speed by more than
    ``eps``. A monitor, not a gate."""
    joined = source.select(*on, speed).join(features.select(*on, u, v), list(on))
    off = F.abs(F.sqrt(F.col(u) * F.col(u) + F.col(v) * F.col(v)) - F.col(speed)) > F.lit(eps)
    return joined.agg(
        F.coalesce(F.sum(ones(F.col(u).isNotNull() & F.col(v).isNotNull())), F.lit(0)).cast("long").alias("n_vectors"),
        F.coalesce(F.sum(ones(off)), F.lit(0)).cast("long").alias("n_deviating"),
    )


def run_gates(gates: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [g.select(*GATE_COLUMNS) for g in gates])


def failures(report: DataFrame) -> DataFrame:
    return report.filter((F.col("status") == "FAIL") & (F.col("severity") == "ERROR"))


class GateError(RuntimeError):
    """Raised once with every failed gate listed."""


def enforce(report: DataFrame, label: str) -> None:
    """Raise when the report holds a failed gate. The report is one row per check, so its size is
    fixed by the code, not the data."""
    broken = failures(report).collect()
    if broken:
        lines = [f"{r.table_name}:{r.check_name} expected={r.expected_value} actual={r.actual_value}" for r in broken]
        raise GateError(f"{label}: {len(broken)} failed checks; " + "; ".join(lines))
