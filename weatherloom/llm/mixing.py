"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source with target share t of its size is wanted t times: floor(t) copies for
certain and one more with probability t - floor(t). Pairs of documents exchange probability mass,
measured in words, until one of the two is settled at 0 or 1; direction and amount are random such
that each document keeps its probability, while the words of the pair stay the same at every step.
What a source takes therefore misses its target by less than its one last unsettled document.

The pairing is a reduction tree. Blocks of documents of one source and similar size are reduced to
one unsettled document each, then blocks of those, until one per source is left. Blocks are set by
hashes and counts, and the random numbers by the documents themselves, so reruns agree whatever
the task layout. A source with a third of all documents is many blocks; no group grows with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherloom.llm.scratch import written
from weatherloom.llm.text import n_words

WEIGHTS = (1, 2, 3)
#: A source gives at most so many times its size, and a document so many copies.
MAX_COPIES = 3
#: Units that one task reduces together.
BLOCK = 2048
SEED = "mix"


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """(source, source_size) -> the same with ``target``.

    Sources by code point, null last, take the weights in turn and share the total size; a target
    stops at ``cap`` times its source's size, and the excess goes to the others by weight. That
    is one level L for all: target = least(cap * size, weight * L), read off the sources in the
    order in which they reach their caps. One row per source, so these windows hold counts only.
    """
    turn = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighted = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    limit = F.col("source_size") * cap
    filling = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy()
    level = (F.sum("source_size").over(everywhere) - F.coalesce(F.sum(limit).over(before), F.lit(0))) / (
        F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    # the first source that does not reach its cap sets the level
    levels = weighted.withColumn("level", level).withColumn("open", F.col("level") * F.col("weight") <= limit)
    final = F.min(F.when(F.col("open"), F.struct(limit / F.col("weight"), "level"))).over(everywhere)["level"]
    return levels.withColumn("final", final).select(
        "source", "source_size",
        F.coalesce(F.least(limit.cast("double"), F.col("final") * F.col("weight")), limit.cast("double")).alias("target"),
    )


def _chance(*parts) -> float:
    name = "\x1f".join(map(repr, (SEED, *parts))).encode()
    return int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "big") / 2**64


def settle(units: Iterable[tuple[str, float, float]]) -> tuple[dict[str, int], tuple[str, float, float] | None]:
    """Reduce units (name, words, p) in order -> settled units, and the one left open, if any.

    Each step moves words between the open unit and the next one: at most so many that one of them
    reaches 0 or 1. Both directions are possible, at odds that keep each unit's probability.
    """
    done: dict[str, int] = {}
    held: tuple[str, float, float] | None = None
    for unit in units:
        if held is None:
            held = unit
            continue
        (a, wa, pa), (b, wb, pb) = held, unit
        up = min((1 - pa) * wa, pb * wb)  # words that may move from b to a
        down = min(pa * wa, (1 - pb) * wb)
        if _chance(a, b) * (up + down) < down:
            if (1 - pa) * wa <= pb * wb:
                done[a], held = 1, (b, wb, pb - up / wb)
            else:
                done[b], held = 0, (a, wa, pa + up / wa)
        elif pa * wa <= (1 - pb) * wb:
            done[a], held = 0, (b, wb, pb + down / wb)
        else:
            done[b], held = 1, (a, wa, pa - down / wa)
        name, _, p = held
        if p <= 1e-9 or p >= 1 - 1e-9:  # both were settled at once
            done[name], held = round(p), None
    return done, held


_UNITS = "source string, unit string, words double, p double"
_REDUCED = _UNITS + ", taken int"


def _reduce(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["words", "unit"], ascending=[False, True], kind="stable")
    source = group["source"].iloc[0]
    done, held = settle(zip(group["unit"], group["words"], group["p"], strict=True))
    rows = [(source, name, 0.0, 0.0, n) for name, n in done.items()]
    rows += [(source, *held, None)] if held else []
    out = pd.DataFrame(rows, columns=["source", "unit", "words", "p", "taken"])
    return out.astype({"taken": "Int32"})


def _block(of: Column, counts: Column) -> Column:
    return F.pmod(F.xxhash64(of), F.ceil(counts / BLOCK)).cast("long")


def round_units(units: DataFrame) -> DataFrame:
    """(source, unit, words, p), units distinct per source, 0 < p < 1 -> (source, unit, taken)."""
    settled = None
    # first level: blocks of similar sizes, so that what moves is about what comes back
    level = units.withColumn("class", F.floor(4 * F.log2("words")).cast("int"))
    while True:
        counts = level.groupBy("source", "class").agg(F.count(F.lit(1)).alias("n"))
        counts = counts.select(F.col("source").alias("_s"), F.col("class").alias("_c"), "n")
        placed = level.join(
            counts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("class") == F.col("_c"))
        ).withColumn("block", _block(F.col("unit"), F.col("n")))
        reduced = written(
            placed.groupBy("source", "class", "block").applyInPandas(_reduce, _REDUCED), "mixed"
        )
        part = reduced.where("taken is not null").select("source", "unit", "taken")
        settled = part if settled is None else settled.unionByName(part)
        left = reduced.where("taken is null").drop("taken")
        most = left.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:  # one unsettled document per source has no partner: the nearer end
            last = left.select("source", "unit", F.when(F.col("p") >= 0.5, 1).otherwise(0).alias("taken"))
            return settled.unionByName(last)
        level = left.withColumn("class", F.lit(0))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = MAX_COPIES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source, ...): size, source_size, target, copies,
    taken.

    Null text has size zero; documents of size zero take no words. A null source is a source.
    Rows alike in id, source and size, null ids included, are one unit and get the same copies.
    No row takes more than ``cap`` copies. Extra columns are ignored; no rows give no rows.
    """
    sized = written(
        docs.select(F.col("doc_id").cast("long"), "source", n_words(F.col("text")).alias("size")), "sized"
    )
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sizes, weights, cap), "targets")
    per_row = targets.select(
        F.col("source").alias("_s"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"),
    )
    rows = sized.join(per_row, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    whole = F.least(F.floor(F.col("rate") + 1e-12), F.lit(cap))
    part = F.greatest(F.col("rate") - whole, F.lit(0.0))
    unit = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("size").cast("string"))
    rows = rows.select("*", unit.alias("unit"), whole.cast("long").alias("whole"), part.alias("p"))
    units = (
        rows.where((F.col("p") > 1e-9) & (F.col("size") > 0)).groupBy("source", "unit")
        .agg(F.sum("size").cast("double").alias("words"), F.max("p").alias("p"))
    )
    extra = written(round_units(units), "rounded").select(
        F.col("source").alias("_s"), F.col("unit").alias("_u"), F.col("taken").alias("extra")
    )
    copies = F.col("whole") + F.coalesce("extra", F.lit(0))
    return rows.join(
        extra, F.col("source").eqNullSafe(F.col("_s")) & (F.col("unit") == F.col("_u")), "left"
    ).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )
