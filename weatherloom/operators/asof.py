"""As-of match: each event meets the nearest earlier observation of its key, within a tolerance.

Events and observations are merged by sorting inside blocks of (key, stretch of time). The last
observation of a block is handed to the next one, so an event at the start of a block still finds
what went before. A block is at least as long as the tolerance, so one block back is enough, and no
partition grows with the number of events or observations of one key: a block holds each distinct
moment once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import as_column
from weatherloom.operators.hourly import BLOCK_HOURS
from weatherloom.operators.joins import spread_nulls

ASOF_TIER = "earlier_observation"


def latest_before(
    moments: DataFrame, seen: DataFrame, key: str, ts: str, tolerance_hours: int, block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """(key, ts, __seen) for the moments that have an observation at most ``tolerance_hours`` earlier.

    ``moments`` and ``seen`` have the columns ``key`` and ``ts`` (timestamps, filled). Repeated rows
    count once; a moment meets an observation of the same instant.
    """
    hours = max(block_hours, tolerance_hours, 1)
    block = F.floor(F.unix_timestamp(ts) / F.lit(hours * 3600))
    none = F.lit(None).cast("timestamp")
    rows = moments.distinct().select(key, block.alias("__block"), ts, none.alias("__seen"))
    known = seen.select(key, block.alias("__block"), F.col(ts), F.col(ts).alias("__seen"))
    carried = known.groupBy(key, "__block").agg(F.max("__seen").alias("__seen")).select(
        key, (F.col("__block") + 1).alias("__block"), F.col("__seen").alias(ts), "__seen"
    )
    # observations ascend with time, so the latest so far is the largest so far; equal instants are peers
    w = Window.partitionBy(key, "__block").orderBy(ts)
    merged = rows.withColumn("__event", F.lit(True)).unionByName(
        known.union(carried).withColumn("__event", F.lit(False))
    ).withColumn("__seen", F.max("__seen").over(w))
    near = F.col(ts) <= F.col("__seen") + F.make_dt_interval(hours=F.lit(tolerance_hours))
    return merged.where(F.col("__event") & near).select(key, ts, "__seen")


def join_asof(
    events: DataFrame,
    obs: DataFrame,
    key: str,
    ts: str,
    obs_ts: str,
    cols: Mapping[str, str],
    row_id: Column | str,
    tolerance_hours: int,
    matched: str = "matched_ts",
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Left join each event to the latest observation of its key at or before its time, if that is at
    most ``tolerance_hours`` older.

    ``cols`` maps observation columns to output names; the time of the observation comes back as
    ``matched``. ``obs`` must be unique on (key, time). The text key may be null for many events, and
    so may the time: such events match nothing and are spread over tasks by ``row_id``. Neither side is
    broadcast: both grow with the observations, whose files are far smaller than their rows.
    """
    o = obs.where(F.col(key).isNotNull() & F.col(obs_ts).isNotNull()).select(
        F.col(key).alias("__k"), F.col(obs_ts).cast("timestamp").alias("__t"), *[F.col(c).alias(n) for c, n in cols.items()]
    )
    at = F.col(ts).cast("timestamp")
    timed = events.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(F.col(key).alias("__k"), at.alias("__t"))
    found = latest_before(timed, o.select("__k", "__t"), "__k", "__t", tolerance_hours, block_hours)
    pairs = found.withColumnRenamed("__t", "__at").withColumnRenamed("__seen", "__t").join(o.hint("merge"), ["__k", "__t"]).select(
        "__k", "__at", F.col("__t").alias(matched), *cols.values()
    )
    keyed = F.when(F.col(ts).isNotNull(), F.col(key))
    e = events.withColumn("__spread", spread_nulls(keyed, row_id))
    hit = (F.col("__spread") == F.col("__k")) & (at == F.col("__at"))
    return e.join(pairs.hint("merge"), hit, "left").drop("__spread", "__k", "__at")


def asof_tier(tier: Column | str, matched: Column | str) -> Column:
    """The tier of an hour-matched row, or :data:`ASOF_TIER` where an earlier observation fills its gap."""
    gap = as_column(tier).isin("no_weather_hour_key", "weather_hour_no_observation")
    return F.when(gap & as_column(matched).isNotNull(), F.lit(ASOF_TIER)).otherwise(as_column(tier))
