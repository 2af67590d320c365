"""Connected components of a link table by alternating star contractions.

Each round replaces a node's links by links to the least node it can see, first among all its
neighbours, then among the lesser ones. The number of rounds grows with the logarithm of the
longest chain. Every step is a minimum per node and an equi-join; no neighbourhood is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.scratch import written


def _rewire(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with u > v -> links of the next round, same form.

    The least neighbours are written before they meet the links again: both sides of the join are then
    dealt out by it, and a node with a third of all links is split over tasks.
    """
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least-of-all")
    # large star: neighbours greater than u, and u itself, point to u's least neighbour
    large = written(
        both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct(),
        "large-star",
    )
    # small star: lesser neighbours of u point to the least of them
    low = written(large.groupBy("u").agg(F.min("v").alias("m")), "least-below")
    return (
        large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .union(low.select("u", F.col("m").alias("v"))).where("u > v").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``links`` (u long, v long), any order, repeats and loops allowed -> (node, root).

    One row per node that has a link to another; root is the least node reachable. Links with a
    null end are no links. No links give no rows.
    """
    now = written(
        links.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    state = None
    while True:
        seen = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if seen == state or not seen[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state, now = seen, written(_rewire(now), "links")
