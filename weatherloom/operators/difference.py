"""Where two large tables differ, key by key.

Both tables are reduced to digests of hash buckets, in one aggregate each. Buckets whose digests agree
hold the same rows and are done with. The others are cut into smaller buckets, level by level, as long as
that leaves rows out; what is left then meets by key. Equal tables cost one aggregate each, and
tables that differ in few places never shuffle the rows of the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import ones
from weatherloom.operators.aggregate import row_count

#: Bits of the key hash that a level looks at; each level has so many more buckets in each one before.
LEVEL_BITS = 12
MAX_LEVELS = 4
#: A further level must leave out this share of the rows at least to be worth its reading.
WORTH = 0.5

_DIGEST = ["__n", "__low", "__high", "__xor"]


def _hash(cols: Sequence[Column], seed: int) -> Column:
    """Null is a value of its own, at its own place."""
    return F.xxhash64(F.lit(seed), *[x for c in cols for x in (c, c.isNull())])


def _value(df: DataFrame, c: str) -> Column:
    """A column as it is compared: both zeros are one number."""
    simple = df.schema[c].dataType.typeName() in ("float", "double")
    return F.when(F.col(c) == 0, F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c)) if simple else F.col(c)


def _digests() -> list[Column]:
    half = F.lit(0xFFFFFFFF)
    return [
        row_count().alias("__n"),
        F.sum(F.col("__row").bitwiseAND(half)).alias("__low"),
        F.sum(F.shiftrightunsigned("__row", 32)).alias("__high"),
        F.bit_xor("__again").alias("__xor"),
    ]


def _prepared(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    both = [_value(df, c) for c in (*keys, *values)]
    return df.select(
        *keys, _hash([_value(df, k) for k in keys], 0).alias("__place"), _hash(both, 1).alias("__row"), _hash(both, 2).alias("__again")
    )


def _bucket(level: int) -> Column:
    return F.shiftrightunsigned(F.col("__place"), 64 - LEVEL_BITS * (level + 1))


def differing_buckets(a: DataFrame, b: DataFrame, level: int) -> DataFrame:
    """(bucket, n): buckets of prepared tables whose digests differ, with the rows of both."""
    sides = [
        df.groupBy(_bucket(level).alias("__bucket")).agg(*_digests()).withColumn("__side", F.lit(side))
        for side, df in enumerate((a, b))
    ]
    digest = F.struct(*_DIGEST)
    one = F.max(F.when(F.col("__side") == 0, digest)), F.max(F.when(F.col("__side") == 1, digest))
    return (
        sides[0].unionByName(sides[1]).groupBy("__bucket")
        .agg(F.sum("__n").alias("n"), one[0].alias("__a"), one[1].alias("__b"))
        .where(~F.col("__a").eqNullSafe(F.col("__b"))).select(F.col("__bucket").alias("bucket"), "n")
    )


def table_difference(
    a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str] | None = None, max_levels: int = MAX_LEVELS
) -> DataFrame:
    """(*keys, kind, n_left, n_right): the keys whose rows differ between ``a`` and ``b``.

    ``kind`` is ``only_left``, ``only_right``, or ``changed``: other values, or another number of rows.
    ``values`` are the columns compared, by default all others of ``a``; both tables must have them in
    comparable types. Nulls are values; row order does not matter. Rows are compared by sums of 64-bit
    hashes and an exclusive-or of others. Runs a job for each level on definition; the buckets a level
    finds, at most 2**12, come to the driver.
    """
    values = [c for c in a.columns if c not in keys] if values is None else list(values)
    unlike = [c for c in (*keys, *values) if a.schema[c].dataType != b.schema[c].dataType]
    if unlike:
        raise TypeError(f"columns of different types: {unlike}")
    left, right = _prepared(a, keys, values), _prepared(b, keys, values)
    total = None
    for level in range(min(max_levels, 64 // LEVEL_BITS)):
        limit = 1 << LEVEL_BITS
        found = differing_buckets(left, right, level).limit(limit + 1).collect()
        if not found:
            none = F.lit(False)
            left, right = left.where(none), right.where(none)
            break
        rows = sum(r.n for r in found)
        if len(found) > limit or (total is not None and rows > (1 - WORTH) * total):
            break
        stale = _bucket(level).isin(*[r.bucket for r in found])
        left, right, total = left.where(stale), right.where(stale), rows
    return _by_key(left, right, keys)


def _by_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both sides meet in one aggregation, combined before the shuffle."""
    tagged = left.withColumn("__side", F.lit(0)).unionByName(right.withColumn("__side", F.lit(1)))

    def of(side: int, c: Column) -> Column:
        return F.when(F.col("__side") == side, c)

    half = F.lit(0xFFFFFFFF)
    parts = {"n": F.lit(1), "low": F.col("__row").bitwiseAND(half), "high": F.shiftrightunsigned("__row", 32)}
    sums = [F.coalesce(F.sum(of(s, c)), F.lit(0)).alias(f"__{n}{s}") for s in (0, 1) for n, c in parts.items()]
    xors = [F.coalesce(F.bit_xor(of(s, F.col("__again"))), F.lit(0)).alias(f"__xor{s}") for s in (0, 1)]
    n_left, n_right = F.col("__n0"), F.col("__n1")
    same = (n_left == n_right) & (F.col("__low0") == F.col("__low1")) & (F.col("__high0") == F.col("__high1")) & (F.col("__xor0") == F.col("__xor1"))
    kind = F.when(n_right == 0, "only_left").when(n_left == 0, "only_right").otherwise("changed")
    return tagged.groupBy(*keys).agg(*sums, *xors).where(~same).select(
        *keys, kind.alias("kind"), n_left.cast("long").alias("n_left"), n_right.cast("long").alias("n_right")
    )


def difference_counts(difference: DataFrame) -> DataFrame:
    """One row: keys of each kind, for a gate."""
    return difference.agg(*[
        F.coalesce(F.sum(ones(F.col("kind") == k)), F.lit(0)).cast("long").alias(f"{k}_keys") for k in ("only_left", "only_right", "changed")
    ])
