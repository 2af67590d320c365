"""Coarser grains from the cells of a finer one, without going back to the facts.

Cells carry sums, which add up, and a sketch of the units (games) they saw, which merges. Ratios are never
averaged: they are divided anew from the sums of a level. Several levels come from one pass: each cell is
repeated for each level and combined before the one shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import safe_ratio
from weatherloom.operators.aggregate import SAMPLE, SUMMED

#: Log2 of a sketch's registers, and its relative standard error, 1.04 / sqrt(2**k).
SKETCH_K = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_K / 2)
LEVEL = "level"
# ratio: (sums above the line, sums below it)
RATIOS = {
    "pass_rate": (["n_pass_attempts"], ["n_pass_attempts", "n_rush_attempts"]),
    "rush_rate": (["n_rush_attempts"], ["n_pass_attempts", "n_rush_attempts"]),
    "completion_pct": (["n_completions"], ["n_pass_attempts"]),
    "epa_per_play": (["epa_sum"], ["n_epa_plays"]),
}


def sketched_cells(units: DataFrame, grain: Sequence[str], unit: str = "game_id", sums: Sequence[str] = tuple(SUMMED)) -> DataFrame:
    """Cells at ``grain`` from unit totals: ``sums``, and ``unit_sketch``, a mergeable count of distinct units."""
    return units.groupBy(*grain).agg(*[F.sum(c).alias(c) for c in sums], F.hll_sketch_agg(unit, SKETCH_K).alias("unit_sketch"))


def _sum(names: Sequence[str]) -> Column:
    first, *rest = [F.col(c) for c in names]
    for c in rest:
        first = first + c
    return first


def roll_up(
    cells: DataFrame,
    levels: Sequence[Sequence[str]],
    always: Sequence[str] = (SAMPLE,),
    sums: Sequence[str] = tuple(SUMMED),
    ratios: Mapping[str, tuple[Sequence[str], Sequence[str]]] = RATIOS,
) -> DataFrame:
    """All ``levels`` (key lists; an empty one is the total) in one pass over ``cells``.

    Rows carry ``level``, its keys joined by commas, the keys (null where rolled up; a null of the data is a
    group of its own at levels that have the key), ``sums``, ``ratios`` of them, and, if the cells have
    sketches, ``n_units_estimate`` with relative standard error :data:`SKETCH_ERROR`.
    """
    keys = list(dict.fromkeys(k for level in levels for k in level))
    names = [",".join(level) or "total" for level in levels]
    if len(set(names)) < len(names):
        raise ValueError(f"a level is named twice: {names}")
    types = {k: cells.schema[k].dataType for k in keys}

    def one(name: str, level: Sequence[str]) -> Column:
        parts = [(F.col(k) if k in level else F.lit(None).cast(types[k])).alias(k) for k in keys]
        return F.struct(F.lit(name).alias(LEVEL), *parts)

    sketched = "unit_sketch" in cells.columns
    extra = ["unit_sketch"] if sketched else []
    spread = cells.withColumn("__at", F.explode(F.array(*[one(n, x) for n, x in zip(names, levels)])))
    spread = spread.select(*always, "__at.*", *sums, *extra)
    aggs = [F.sum(c).alias(c) for c in sums]
    aggs += [F.hll_sketch_estimate(F.hll_union_agg("unit_sketch")).alias("n_units_estimate")] if sketched else []
    return spread.groupBy(*always, LEVEL, *keys).agg(*aggs).withColumns(
        {r: safe_ratio(_sum(top), _sum(below)) for r, (top, below) in ratios.items()}
    )
