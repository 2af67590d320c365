"""Hourly series: complete grids and lagged changes that do not put a whole series in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import present_flag

BLOCK_HOURS = 24 * 30


def hour_grid(key_years: DataFrame, year: str, out: str = "obs_hour_utc") -> DataFrame:
    """Every hour of every distinct key-year, January 1 00:00 to December 31 23:00.

    One key-year becomes 8,760 rows or more. Adaptive execution sizes tasks by the few bytes before
    that, so the key-years are spread over a fixed number of tasks first.
    """
    start = F.make_timestamp(F.col(year), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    end = F.make_timestamp(F.col(year), F.lit(12), F.lit(31), F.lit(23), F.lit(0), F.lit(0))
    hours = F.sequence(start, end, F.expr("interval 1 hour"))
    tasks = int(key_years.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return key_years.distinct().repartition(tasks).withColumn(out, F.explode(hours))


def complete_grid(
    grid: DataFrame, obs: DataFrame, on: Sequence[str], measures: Sequence[str], out: str = "obs_present_flag"
) -> DataFrame:
    """One row per grid slot, observed or not, with a 0/1 presence flag."""
    return grid.join(obs.select(*on, *measures), list(on), "left").withColumn(out, present_flag(*measures))


def _hour_number(ts: str):
    return F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / F.lit(3600))


def lag_values(
    df: DataFrame, key: str, ts: str, value: str, lags: Mapping[int, str], block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """Value of the same key exactly ``n`` hours earlier, ``{n: output name}``.

    The series is cut into blocks of hours, and the last rows of a block are also handed to the
    next one. Window partitions are (key, block): bounded in size however long or dominant one
    key is, and gaps never shift a lag. Rows must be unique on (key, hour).
    """
    deepest = max(lags)
    block = F.floor(F.col("__hour") / F.lit(block_hours))
    tail = F.pmod(F.col("__hour"), F.lit(block_hours)) >= F.lit(block_hours - deepest)
    cut = df.withColumn("__hour", _hour_number(ts)).withColumn("__home", block)
    cut = cut.withColumn(
        "__block", F.explode(F.when(tail, F.array("__home", F.col("__home") + 1)).otherwise(F.array("__home")))
    )
    w = Window.partitionBy(key, "__block").orderBy("__hour")
    lagged = cut.withColumns({name: F.max(value).over(w.rangeBetween(-n, -n)) for n, name in lags.items()})
    return lagged.filter(F.col("__block") == F.col("__home")).drop("__hour", "__home", "__block")


def lag_rows(
    df: DataFrame, key: str, ts: str, value: str, lags: Mapping[int, str], block_hours: int = BLOCK_HOURS
) -> DataFrame:
    """Value of the same key ``n`` rows earlier whatever the time between, ``{n: output name}``.

    Same blocks as ``lag_values``. Rows deep enough in a block find their lag inside it; the first
    rows of each block are resolved over the edge rows alone, a small fraction of the series.
    """
    deepest = max(lags)
    cut = df.withColumn("__block", F.floor(_hour_number(ts) / F.lit(block_hours)))
    inside = Window.partitionBy(key, "__block").orderBy(ts)
    numbered = cut.withColumns(
        {
            "__from_start": F.row_number().over(inside),
            "__rows": F.count(F.lit(1)).over(Window.partitionBy(key, "__block")),
            **{name: F.lag(value, n).over(inside) for n, name in lags.items()},
        }
    )
    body = numbered.filter(F.col("__from_start") > deepest)
    from_end = F.col("__rows") - F.col("__from_start")
    edges = numbered.filter((F.col("__from_start") <= deepest) | (from_end < deepest))
    across = Window.partitionBy(key).orderBy(ts)
    heads = edges.withColumns({name: F.lag(value, n).over(across) for n, name in lags.items()}).filter(
        F.col("__from_start") <= deepest
    )
    return body.unionByName(heads).drop("__block", "__from_start", "__rows")


def lag_delta(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    guards: Mapping[int, float],
    names: Mapping[int, str],
    parity: bool = False,
    block_hours: int = BLOCK_HOURS,
) -> DataFrame:
    """Change of ``value`` over each lag; a change beyond its guard is implausible and null.

    ``parity`` counts rows instead of hours, which differs after a missing year.
    """
    lagged = (lag_rows if parity else lag_values)(
        df, key, ts, value, {n: f"__lag{n}" for n in guards}, block_hours
    )
    deltas = {}
    for n, limit in guards.items():
        change = F.col(value) - F.col(f"__lag{n}")
        deltas[names[n]] = F.when(F.abs(change) <= F.lit(limit), change)
    return lagged.withColumns(deltas).drop(*[f"__lag{n}" for n in guards])
