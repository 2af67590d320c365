"""Tables laid out along a space-filling curve over several keys, with the extent of each file.

Neighbouring rows in every key land in the same files, so a filter on any of the keys, or on all, opens
few of them; the extents say which, without a listing or a footer being read.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom.operators.aggregate import row_count
from weatherloom.operators.observed import ObservedChecks

#: Bits a key has in the curve: up to 2**BITS - 1 ranges of about equally many rows.
BITS = 8
_TEXT_BYTES = 6  # a double holds 53 bits exactly


def _position(df: DataFrame, key: str) -> Column:
    """The key as a double whose order does not contradict the key's: equal for keys too close to tell apart."""
    kind, c = df.schema[key].dataType, F.col(f"`{key}`")
    if isinstance(kind, T.StringType):
        digits = F.rpad(F.hex(F.substring(c.cast("binary"), 1, _TEXT_BYTES)), 2 * _TEXT_BYTES, "0")
        return F.conv(digits, 16, 10).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise TypeError(f"{key}: no order for {kind.simpleString()}")


def _cell(x: Column, cuts: Sequence[float]) -> Column:
    """Number of ``cuts`` at or below ``x``, plus 1, by halving; 0 for null."""
    if not cuts:
        return F.when(x.isNull(), 0).otherwise(1)
    table, n = F.array(*[F.lit(float(c)) for c in cuts]), len(cuts)
    steps = [1 << b for b in reversed(range(n.bit_length()))]

    def further(found: Column, step: Column) -> Column:
        at = found + step
        return F.when((at <= n) & (x >= F.get(table, at - 1)), at).otherwise(found)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)
    return F.when(x.isNull(), 0).otherwise(found + 1)


def curve_position(df: DataFrame, keys: Sequence[str]) -> Column:
    """Where a row lies on the curve: the bits of its cells in ``keys``, taken in turn. Cells follow the
    quantiles of ``df``, so that skewed keys use the curve as evenly as others; a value as frequent as many
    cells is one of them. One aggregate pass, whose result is ``2**BITS`` numbers a key."""
    shares = [i / 2**BITS for i in range(1, 2**BITS - 1)]
    places = {k: _position(df, k) for k in keys}
    row = df.agg(*[F.percentile_approx(p, shares, 10_000) for p in places.values()]).first()
    position = F.lit(0).cast("long")
    for j, (place, cuts) in enumerate(zip(places.values(), row)):
        cell = _cell(place, sorted(set(cuts or []))).cast("long")
        for b in range(BITS):
            bit = F.shiftright(cell, b).bitwiseAND(F.lit(1))
            position = position.bitwiseOR(F.shiftleft(bit, b * len(keys) + j))
    return position


def _parts(root: str) -> tuple[str, str]:
    return f"{root.rstrip('/')}/rows", f"{root.rstrip('/')}/extents"


def write_zordered(
    df: DataFrame, root: str, keys: Sequence[str], files: int | None = None, rows_per_file: int = 4_000_000,
    measured: ObservedChecks | None = None,
) -> None:
    """Write ``df`` as about ``files`` files (by default as many as ``rows_per_file`` asks for) of about equal
    size along the curve over ``keys``, and a table of their extents: rows, and least, greatest and nulls of
    each key.

    ``keys`` (one to seven) are numbers, texts, dates or timestamps; NaN counts as the greatest number. A
    range of the curve that holds too many rows, such as those of one frequent key, is dealt further by a
    hash of the row; only copies of a whole row stay together. ``df`` is read three times (quantiles, bounds,
    rows): give a written table. An existing table at ``root`` raises.
    """
    if not 1 <= len(keys) <= 63 // BITS:
        raise ValueError(f"1 to {63 // BITS} keys, not {len(keys)}")
    rows, extents = _parts(root)
    if files is None:
        files = max(1, math.ceil(df.count() / rows_per_file))
    order = [curve_position(df, keys).alias("__z"), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("__hash")]
    laid = df.select("*", *order).repartitionByRange(files, "__z", "__hash").sortWithinPartitions("__z", *[f"`{k}`" for k in keys])
    laid = laid.drop("__z", "__hash")
    (measured.attach(laid) if measured else laid).write.mode("errorifexists").parquet(rows)
    back = df.sparkSession.read.schema(df.schema).parquet(rows)
    found = [row_count().alias("n_rows")]
    for i, k in enumerate(keys):
        c = F.col(f"`{k}`")
        found += [F.min(c).alias(f"min_{i}"), F.max(c).alias(f"max_{i}"), F.count_if(c.isNull()).alias(f"nulls_{i}")]
    named = F.array(*[F.lit(k) for k in keys]).alias("keys")
    back.groupBy(F.col("_metadata.file_name").alias("file")).agg(*found).select("file", "n_rows", named, *[
        f"{m}_{i}" for i in range(len(keys)) for m in ("min", "max", "nulls")
    ]).write.mode("errorifexists").parquet(extents)


def file_extents(spark: SparkSession, root: str) -> DataFrame:
    """One row a file: ``file``, ``n_rows``, ``keys`` and, by a key's number in it, ``min_i``, ``max_i``, ``nulls_i``."""
    return spark.read.parquet(_parts(root)[1])


def files_in_ranges(spark: SparkSession, root: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """Extents of the files that may hold a row with each key of ``ranges`` from its first to its second value,
    both included; None is no bound. A key without an extent raises."""
    extents = file_extents(spark, root)
    one = extents.select("keys").first()
    keys = list(one["keys"]) if one else []
    for k, (low, high) in ranges.items():
        if one and k not in keys:
            raise ValueError(f"{root} has no extents of {k}, only of {keys}")
        if one and low is not None:
            extents = extents.filter(F.col(f"max_{keys.index(k)}") >= F.lit(low))
        if one and high is not None:
            extents = extents.filter(F.col(f"min_{keys.index(k)}") <= F.lit(high))
    return extents


def scan_ranges(spark: SparkSession, root: str, ranges: Mapping[str, tuple]) -> DataFrame:
    """The rows with each key of ``ranges`` within its bounds, from the files that may hold any. Nulls are in
    no range with a bound. The driver gets the names of these files, as it does for any scan."""
    rows, _ = _parts(root)
    schema = spark.read.parquet(rows).schema
    names = [r.file for r in files_in_ranges(spark, root, ranges).select("file").collect()]
    df = spark.read.schema(schema).parquet(*[f"{rows}/{n}" for n in names]) if names else spark.createDataFrame([], schema)
    for k, (low, high) in ranges.items():
        if low is not None:
            df = df.filter(F.col(f"`{k}`") >= F.lit(low))
        if high is not None:
            df = df.filter(F.col(f"`{k}`") <= F.lit(high))
    return df
