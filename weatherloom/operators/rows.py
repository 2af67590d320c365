"""Row-level operators: validation, rejects, deterministic picks, unions, sample expansion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import as_column


def keep(df: DataFrame, *predicates: Column) -> DataFrame:
    return reduce(lambda acc, p: acc.filter(p), predicates, df)


def validate_rows(df: DataFrame, rules: Mapping[str, Column], out: str = "failure_reason") -> DataFrame:
    """Semicolon-joined names of the rules a row breaks; empty text for a good row."""
    reasons = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return df.withColumn(out, F.concat_ws(";", *reasons))


def split_rejects(df: DataFrame, reason: str = "failure_reason") -> tuple[DataFrame, DataFrame]:
    """(good, bad) by an empty or filled reason."""
    return df.filter(F.col(reason) == "").drop(reason), df.filter(F.col(reason) != "")


def pick_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order_by``, which must end in a unique column.

    Spark turns the rank filter into a per-task limit ahead of the shuffle, so copies of a hot key
    are cut down where they are read and never meet in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")


def union_named(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def expand_samples(df: DataFrame, samples: Mapping[str, Column | None], out: str = "weather_sample") -> DataFrame:
    """Repeat a row once per sample it belongs to (None = every row), reading the input once."""
    tags = [
        F.lit(name) if member is None else F.when(member, F.lit(name)) for name, member in samples.items()
    ]
    return df.withColumn(out, F.explode(F.array_compact(F.array(*tags))))


def distinct_values(df: DataFrame, c: Column | str) -> DataFrame:
    return df.select(as_column(c)).distinct()


def unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``left`` without a partner. Right keys are made distinct first, so repeated keys
    on the right cost one row each."""
    return left.join(right.select(*on).distinct(), list(on), "left_anti")
