"""Joins: lookups without fan-out, validity intervals, hour keys, coarse baselines."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import as_column, first_match, safe_ratio
from weatherloom.operators.rows import pick_first
from weatherloom.sources.sink import materialize

NULL_SPREAD = 512

#: Rows that a task of a dealt join or aggregation takes on average, and that one key has before it is split.
TASK_ROWS = 300_000
#: Keys are counted in so many buckets, to find those that may need splitting.
KEY_BUCKETS = 1 << 16


def join_unique(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal columns; the caller guarantees ``right`` is unique on them (see the gates)."""
    return left.join(right, list(on), how)


def task_count(spark: SparkSession, rows: int) -> int | None:
    """Tasks that share so many rows, one a core at least; None if a single one takes them all."""
    if rows <= TASK_ROWS:
        return None
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / TASK_ROWS))


def join_dealt(left: DataFrame, right: DataFrame, left_key: str, right_key: str, right_rows: int) -> DataFrame:
    """The inner join of a large table with one that has few rows a key, dealt by rows; names must be distinct.

    Spark joins shuffle partitions by their bytes, as far as the session's settings let it, so tasks may grow
    with the input. Here their number follows from the rows, and nothing joins the partitions again. Left
    rows are counted first, in buckets of keys; ``right_rows`` is the size of the right table. Buckets above
    :data:`TASK_ROWS` are split by a hash of the left rows, and their parts meet a copy of the right rows each.
    """
    spark = left.sparkSession
    left = left.where(F.col(left_key).isNotNull())

    def bucket(key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).alias("__bucket")

    counts = left.groupBy(bucket(left_key)).agg(F.count(F.lit(1)).alias("__n"))
    rows, most = counts.agg(F.sum("__n"), F.max("__n")).first()
    tasks = task_count(spark, (rows or 0) + right_rows)
    hit = F.col(left_key) == F.col(right_key)
    if tasks is None:
        return left.join(right, hit)
    if most <= TASK_ROWS:
        return left.repartition(tasks, left_key).join(right.repartition(tasks, right_key).hint("merge"), hit)
    heavy = counts.where(F.col("__n") > TASK_ROWS)
    ways = materialize(heavy.select("__bucket", F.ceil(F.col("__n") / TASK_ROWS).alias("__ways")), "ways")
    split = F.coalesce("__ways", F.lit(1).cast("long"))
    hashed = [f.name for f in left.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    a = left.withColumn("__bucket", bucket(left_key)).join(F.broadcast(ways), "__bucket", "left")
    a = a.select(*left.columns, F.pmod(F.xxhash64(*hashed), split).alias("__way"))
    b = right.withColumn("__bucket", bucket(right_key)).join(F.broadcast(ways), "__bucket", "left")
    b = b.select(*right.columns, F.explode(F.sequence(F.lit(0).cast("long"), split - 1)).alias("__part"))
    b = b.repartition(tasks, right_key, "__part").hint("merge")
    return a.repartition(tasks, left_key, "__way").join(b, hit & (F.col("__way") == F.col("__part"))).drop("__way", "__part")


#: Pairs of a block join that a task makes on average, pairs of one block, and the most tasks.
TASK_PAIRS, BLOCK_PAIRS, MOST_TASKS = 16_000_000, 4_000_000, 20_000


def join_blocks(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    rows: tuple[Sequence[Column | str], Sequence[Column | str]],
    counts: DataFrame,
    more: tuple[Mapping[str, Column], Mapping[str, Column]] = ({}, {}),
    task_pairs: int | None = None,
    block_pairs: int | None = None,
) -> DataFrame:
    """The inner join on ``keys``, which many rows of both sides share, dealt by its pairs instead of its input.

    ``counts``, written once by the caller, has the rows ``__a`` and ``__b`` of both sides for every key that both
    have. The rows of a key are cut by a hash of the columns ``rows`` of their side into blocks of up to
    ``block_pairs`` pairs, as square as its rows allow: a row is copied once per block of the other side, so
    copies grow with the pairs divided by the root of ``block_pairs``. Columns ``more`` are made behind the shuffle.
    """
    spark = left.sparkSession
    task_pairs, block_pairs = task_pairs or TASK_PAIRS, block_pairs or BLOCK_PAIRS
    pairs, side = F.col("__a") * F.col("__b"), math.isqrt(block_pairs)
    blocks, total = F.ceil(pairs / F.lit(block_pairs)), counts.agg(F.sum(pairs)).first()[0] or 0
    few_a, few_b = F.col("__a") <= side, F.col("__b") <= side
    ways = counts.select(
        *keys,
        F.when(few_b, blocks).when(few_a, 1).otherwise(F.ceil(F.col("__a") / F.lit(side))).alias("__m"),
        F.when(few_b, 1).when(few_a, blocks).otherwise(F.ceil(F.col("__b") / F.lit(side))).alias("__n"),
    )
    least = min(spark.sparkContext.defaultParallelism, math.ceil(total / block_pairs))
    tasks = max(1, least, min(MOST_TASKS, math.ceil(total / task_pairs)))
    at = [*keys, "__i", "__j"]

    def dealt(df: DataFrame, own: str, cut: str, row: Sequence[Column | str], other: str, copied: str) -> DataFrame:
        out = df.join(ways, list(keys)).withColumn(own, F.pmod(F.xxhash64(*row), F.col(cut)))
        out = out.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(copied) - 1)))
        return out.drop("__m", "__n").repartition(tasks, *at)

    a = dealt(left, "__i", "__m", rows[0], "__j", "__n").withColumns(dict(more[0]))
    b = dealt(right, "__j", "__n", rows[1], "__i", "__m").withColumns(dict(more[1]))
    return a.join(b.hint("merge"), at).drop("__i", "__j")


def lookup(
    left: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    cols: Mapping[str, str],
    order_by: Sequence[Column],
    row_id: Column | str | None = None,
) -> DataFrame:
    """Left join attributes ``{dim column: output name}`` from a dimension reduced to one row per
    key, so the row count of ``left`` never changes. Text keys of which many may be null are spread
    over tasks by ``row_id``."""
    one = pick_first(dim, on, order_by)
    if row_id is None:
        return left.join(one.select(*on, *[F.col(c).alias(n) for c, n in cols.items()]), list(on), "left")
    one = one.select(*[F.col(k).alias(f"__{k}") for k in on], *[F.col(c).alias(n) for c, n in cols.items()])
    hit = [spread_nulls(k, row_id) == F.col(f"__{k}") for k in on]
    return left.join(one, hit, "left").drop(*[f"__{k}" for k in on])


def join_interval(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    point: str,
    begin: str,
    end: str,
    how: str = "left",
    row_id: Column | str | None = None,
) -> DataFrame:
    """Equal keys and ``begin <= point <= end``. The keys stay an equi-join; the range is a
    residual filter inside it. Text keys of which many may be null are spread over tasks by
    ``row_id``."""
    theta = [(left[k] if row_id is None else spread_nulls(left[k], row_id)) == right[k] for k in on]
    theta += [left[point] >= right[begin], left[point] <= right[end]]
    joined = left.join(right, theta, how)
    for k in on:
        joined = joined.drop(right[k])
    return joined


def spread_nulls(key: Column | str, row_id: Column | str, ways: int = NULL_SPREAD) -> Column:
    """A string join key in which nulls turn into many different never-matching values.

    In a left join all null keys hash to one task; rows without a station can be a large share.
    """
    k = as_column(key)
    filler = F.concat(F.lit("\x00"), F.pmod(F.xxhash64(as_column(row_id)), F.lit(ways)).cast("string"))
    return F.coalesce(k, filler)


def join_hour(
    events: DataFrame,
    obs: DataFrame,
    key: str,
    hour: str,
    obs_hour: str,
    cols: Mapping[str, str],
    row_id: Column | str,
) -> DataFrame:
    """Left join event rows to the observation of their station and hour.

    ``cols`` maps observation columns to output names; the matched hour itself is returned as
    ``weather_hour_utc``. ``obs`` must be unique on (key, hour). The files of a full hour grid are far
    smaller than its rows, so a sort-merge hint keeps Spark from broadcasting it by their size.
    """
    o = obs.select(
        F.col(key).alias("__k"),
        F.col(obs_hour).alias("weather_hour_utc"),
        *[F.col(c).alias(n) for c, n in cols.items()],
    )
    # rows without an hour match nothing either, and all those of one station would hash alike
    keyed = F.when(F.col(hour).isNotNull(), F.col(key))
    e = events.withColumn("__spread", spread_nulls(keyed, row_id))
    hit = (F.col("__spread") == F.col("__k")) & (F.col(hour) == F.col("weather_hour_utc"))
    return e.join(o.hint("merge"), hit, "left").drop("__spread", "__k")


def join_tier(
    station: Column | str, ts: Column | str, hour: Column | str, present: Column | str, source: Column | str
) -> Column:
    """How well a row was matched; the first reason that applies."""
    src = as_column(source)
    return first_match(
        [
            (as_column(station).isNull(), F.lit("no_station_mapping")),
            (as_column(ts).isNull(), F.lit("no_play_time")),
            (as_column(hour).isNull(), F.lit("no_weather_hour_key")),
            (as_column(present) == 0, F.lit("weather_hour_no_observation")),
            (src == "time_of_day", F.lit("direct_play_hour")),
            (src == "start_time", F.lit("kickoff_fallback")),
        ],
        F.lit("matched_observed"),
    )


def with_baseline(
    fine: DataFrame, coarse_keys: Sequence[str], rates: Mapping[str, tuple[str, str]], suffix: str
) -> DataFrame:
    """Add each rate of the coarser grain and the fine rate's difference from it.

    ``rates`` maps a rate column to its (numerator, other part) counts. Counts add up, so the
    coarse totals are window sums over the already aggregated table and the facts are not read
    again.
    """
    w = Window.partitionBy(*coarse_keys)
    base = {}
    for rate, (part, other) in rates.items():
        n, rest = F.sum(part).over(w), F.sum(other).over(w)
        base[f"{rate}_baseline"] = safe_ratio(n, n + rest)
    out = fine.withColumns(base)
    return out.withColumns({f"{r}_{suffix}": F.col(r) - F.col(f"{r}_baseline") for r in rates})
