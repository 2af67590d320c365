"""Distributions of measures by group as sketches that merge, and how far two runs are apart.

A profile has one row per group and measure. It is made in one pass, can be stored beside the table it
describes, and is merged to coarser groups, or with the profile of further rows, without the rows. A
changed null rate and a shifted distribution show in comparing two profiles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.operators.aggregate import row_count
from weatherloom.operators.gates import Check, column_checks

#: Size of a sketch: about 20 * K bytes for a group of many values, 8 bytes a value for a small one.
SKETCH_K = 400
#: Quantiles by which two distributions are compared.
GRID = 200
#: Two samples of one distribution of n and m values are farther apart than this, times
#: sqrt((n + m) / (n * m)), once in a hundred (Kolmogorov and Smirnov).
CRITICAL = 1.628


def rank_error(k: int = SKETCH_K) -> float:
    """Share of the values by which a rank, or a quantile's rank, is off at most, in 99 of 100 cases."""
    return 2.296 / k**0.9021


def distance_error(k: int = SKETCH_K) -> float:
    """By how much a distance is off at most, either way: two ranks, and half a step of the grid on each side."""
    return 2 * rank_error(k) + 1 / GRID


def quantile_profile(df: DataFrame, measures: Sequence[str], by: Sequence[str], k: int = SKETCH_K) -> DataFrame:
    """One row per group and measure: ``by``, ``measure``, ``n_rows``, ``n_values`` (neither null nor NaN), ``least``,
    ``greatest``, ``sketch``. Measures are read as doubles; nulls in ``by`` form a group. One pass, combined
    before the shuffle, so a group of a third of all rows is no burden to its task."""
    aggs = [row_count().alias("n_rows")]
    for i, m in enumerate(measures):
        x = F.nanvl(F.col(f"`{m}`").cast("double"), F.lit(None))
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}"), F.kll_sketch_agg_double(x, k).alias(f"s{i}")]
    one = [
        F.struct(F.lit(m).alias("measure"), "n_rows", F.col(f"n{i}").alias("n_values"), F.col(f"lo{i}").alias("least"),
                 F.col(f"hi{i}").alias("greatest"), F.col(f"s{i}").alias("sketch"))
        for i, m in enumerate(measures)
    ]
    return df.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*one)))


def merge_profiles(profiles: DataFrame, by: Sequence[str]) -> DataFrame:
    """Profiles at the coarser grain ``by``, or of several profiles stacked; errors stay those of one sketch."""
    return profiles.groupBy(*by, "measure").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.kll_merge_agg_double("sketch").alias("sketch"),
    )


def with_quantiles(profile: DataFrame, shares: Sequence[float], name: str = "quantiles") -> DataFrame:
    """Add the values at ``shares`` (0 to 1) as an array; null for a group without values."""
    at = F.array(*[F.lit(float(s)) for s in shares])
    return profile.withColumn(name, F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("sketch", at)))


def _distance(a: Column, b: Column) -> Column:
    """Greatest difference of the distribution functions of two arrays of ``GRID`` values: their values in one
    order, counted up for one and down for the other, read where a value ends."""
    up = F.transform(a, lambda x: F.struct(x.alias("x"), F.lit(1).alias("step")))
    down = F.transform(b, lambda x: F.struct(x.alias("x"), F.lit(-1).alias("step")))
    start = F.struct(F.lit(None).cast("double").alias("x"), F.lit(0).alias("sum"), F.lit(0).alias("most"))

    def take(found: Column, p: Column) -> Column:
        same = found["x"].isNull() | (found["x"] == p["x"])
        most = F.when(same, found["most"]).otherwise(F.greatest(found["most"], F.abs(found["sum"])))
        return F.struct(p["x"].alias("x"), (found["sum"] + p["step"]).alias("sum"), most.alias("most"))

    # after the last value both have been counted in full
    return F.aggregate(F.array_sort(F.concat(up, down)), start, take, lambda found: found["most"] / F.lit(float(GRID)))


def distribution_drift(before: DataFrame, after: DataFrame, by: Sequence[str], limit: float, k: int = SKETCH_K) -> DataFrame:
    """Two profiles compared, a row per group and measure of either.

    ``distance`` is the greatest difference of the two distribution functions, off by :func:`distance_error` at
    most: 0 for equal ones, 1 for disjoint ones, and 1 where only one side has values. ``drifted`` is set where it
    exceeds, by more than that error, both ``limit`` and what chance brings about in groups so small. ``side`` is ``both``, ``before`` or ``after``; a group that only one side has
    drifted. Null rates of both sides stand beside it.
    """
    keys = [*by, "measure"]
    grid = [(i + 0.5) / GRID for i in range(GRID)]
    carried = ("n_rows", "n_values", "points")

    def named(profile: DataFrame, side: str) -> DataFrame:
        points = with_quantiles(profile, grid, "points")
        return points.select(*[F.col(c).alias(f"{side}_{c}") for c in (*keys, *carried)])

    a, b = named(before, "a"), named(after, "b")
    match = F.lit(True)
    for key in keys:
        match = match & F.col(f"a_{key}").eqNullSafe(F.col(f"b_{key}"))
    # the measure is never null: it tells which side a row is from
    side = F.when(F.col("b_measure").isNull(), "before").when(F.col("a_measure").isNull(), "after").otherwise("both")
    both = a.join(b, match, "full").withColumn("side", side)
    n, m = F.coalesce("a_n_values", F.lit(0)), F.coalesce("b_n_values", F.lit(0))
    distance = F.when((n == 0) & (m == 0), 0.0).when((n == 0) | (m == 0), 1.0).otherwise(_distance(F.col("a_points"), F.col("b_points")))
    chance = F.when((n > 0) & (m > 0), F.sqrt((n + m) / (n.cast("double") * m)) * CRITICAL).otherwise(0.0)
    slack = distance_error(k)
    out = both.withColumns({"distance": distance, "__chance": chance})
    beyond = (F.col("distance") > limit + slack) & (F.col("distance") > F.col("__chance") + slack)
    return out.select(
        *[F.when(F.col("side") == "after", F.col(f"b_{c}")).otherwise(F.col(f"a_{c}")).alias(c) for c in keys],
        "side",
        F.coalesce("a_n_rows", F.lit(0)).alias("n_before"),
        F.coalesce("b_n_rows", F.lit(0)).alias("n_after"),
        (1 - F.col("a_n_values") / F.nullif("a_n_rows", F.lit(0))).alias("null_rate_before"),
        (1 - F.col("b_n_values") / F.nullif("b_n_rows", F.lit(0))).alias("null_rate_after"),
        "distance",
        ((F.col("side") != "both") | beyond).alias("drifted"),
    )


def drift_gate(drift: DataFrame, table: str, null_rate_change: float = 0.05) -> DataFrame:
    """Two gate rows: no group drifted, and no null rate moved by more than ``null_rate_change``."""
    moved = F.abs(F.col("null_rate_after") - F.col("null_rate_before")) > null_rate_change
    checks = [
        Check("distribution_drift", F.count_if("drifted"), 0, lambda a: a == 0),
        Check("null_rate_drift", F.count_if(moved), 0, lambda a: a == 0),
    ]
    return column_checks(drift, table, checks)
