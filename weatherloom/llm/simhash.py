"""Near duplicates by SimHash, found through segment popcounts.

A fingerprint is cut into 32 segments of two bits. The vector of the segments' bit counts moves
fingerprints into a grid in which the Manhattan distance never exceeds the number of differing
bits. Vectors within distance 4 agree on all but 4 of any B groups of segments, so the range join
on the grid is an equality join on the cells that keep B - 4 of the groups; every pair in a cell
is then verified on the fingerprints themselves. A cell returns a spanning forest of its links,
not all pairs, and cells above a limit are split into blocks, so no task holds or emits a group's
square. B follows from the number of fingerprints by the cost of cells against candidate pairs;
any B gives the same links.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.batches import sliced
from weatherloom.llm.components import components
from weatherloom.llm.scratch import written
from weatherloom.llm.text import free_name, meet

SHINGLE = 4
SEED = 42
MAX_BITS = 4
SEGMENTS = 32
#: Rows of a cell that one task compares; larger cells are split into pairs of blocks.
CELL_LIMIT = 16384
_CHUNK = 1 << 15


def fingerprint(raw: bytes | None) -> int:
    """SimHash of UTF-8 text as a signed long; zero for null and for texts without a word."""
    tokens = (raw or b"").lower().split()  # for bytes: A-Z only, and the six ASCII spaces
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(SHINGLE, len(tokens))
    n = len(tokens) - width + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        to = min(n, at + _CHUNK)
        spans = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        prints = pa.array([fingerprint(x) for x in batch.column(2).to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), prints], ["doc_id", "text_hash", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp long) of every row."""
    return docs.select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary")
    ).mapInArrow(_fingerprints, "doc_id long, text_hash long, fp long")


def groups_for(n: int) -> int:
    """B for ``n`` distinct fingerprints: least cells written plus candidate pairs compared."""

    def cost(b: int) -> float:
        kept_bits = 1.415 * SEGMENTS * (b - MAX_BITS) / b  # two random counts agree in 3 of 8 cases
        return comb(b, MAX_BITS) * (20.0 * n + n * n / 2 / 2**kept_bits)

    return min(range(MAX_BITS + 2, 17), key=cost)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cell_masks(groups: int) -> list[int]:
    """A mask over the packed counts for each choice of ``groups - MAX_BITS`` groups."""
    edges = [SEGMENTS * i // groups for i in range(groups + 1)]
    parts = [sum(3 << 2 * s for s in range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(kept)) for kept in combinations(parts, groups - MAX_BITS)]


def _forest(points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that span every component of ``points`` (uint64, distinct) at MAX_BITS bits."""
    left = points
    while left.size:
        queue, left = [left[0]], left[1:]
        while queue and left.size:
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= MAX_BITS
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found)
                yield np.full(found.size, at), found


def _links(cells: np.ndarray, points: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within runs of equal ``cells``, which are sorted; ``points`` are distinct in a run."""
    first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    sizes = np.diff(np.r_[first, cells.size])
    small = 64  # up to here, comparing all rows at a distance at once is cheaper than cell by cell
    for d in range(1, min(small, int(sizes.max(initial=1)))):
        a, b = points[:-d], points[d:]
        near = (cells[:-d] == cells[d:]) & (np.bitwise_count(a ^ b) <= MAX_BITS)
        if near.any():
            yield a[near], b[near]
    for k in np.flatnonzero(sizes > small):
        yield from _forest(points[first[k] : first[k] + sizes[k]])


def _compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (t, cell, block, fp), sorted: links of every cell, which may span batches."""
    names = ("t", "cell", "block", "fp")
    held = {n: np.empty(0, np.int64) for n in names}

    def flush(part):
        change = np.zeros(part["fp"].size, bool)
        for n in names[:3]:
            change[1:] |= part[n][1:] != part[n][:-1]
        for a, b in _links(np.cumsum(change), part["fp"].view(np.uint64)):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])

    for batch in batches:
        now = {n: np.r_[held[n], batch.column(i).to_numpy(zero_copy_only=False)] for i, n in enumerate(names)}
        if not now["fp"].size:
            continue
        last = np.ones(now["fp"].size, bool)
        for n in names[:3]:
            last &= now[n] == now[n][-1]
        cut = int(np.argmax(last))
        if cut:
            yield from flush({n: now[n][:cut] for n in names})
        held = {n: now[n][cut:] for n in names}
    if held["fp"].size:
        yield from flush(held)


def links(prints: DataFrame, groups: int | None = None, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """Distinct fingerprints (fp) -> links (u, v) whose components are those of all pairs at
    MAX_BITS or fewer differing bits."""
    masks = cell_masks(groups or groups_for(prints.count()))
    # 32 two-bit counts, packed into one long: of each pair the low bit is a xor, the high bit a carry
    counts = F.expr(
        "((fp ^ shiftrightunsigned(fp, 1)) & 6148914691236517205L)"
        " | shiftleft(fp & shiftrightunsigned(fp, 1) & 6148914691236517205L, 1)"
    )
    cells = prints.select("fp", counts.alias("c")).select(
        "fp", F.posexplode(F.array(*[F.col("c").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "cell")
    ).select(F.col("t").cast("long"), "cell", "fp")
    # two fingerprints at least; the large cells are few: at most the number of rows / cell_limit
    sizes = cells.groupBy("t", "cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / cell_limit).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("m")).cast("long")
    blocks = F.when(F.col("m") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("m") - 1),
            lambda j: F.least(own, j.cast("long")) * F.col("m") + F.greatest(own, j.cast("long")),
        )
    )
    placed = cells.join(sizes, ["t", "cell"]).withColumn("m", parts).select(
        "t", "cell", F.explode(blocks).alias("block"), "fp"
    )
    return (
        placed.repartition("t", "cell", "block")
        .sortWithinPartitions("t", "cell", "block", "fp")
        .mapInArrow(_compare, "u long, v long")
    )


def _classes(docs: DataFrame, groups: int | None, cell_limit: int) -> DataFrame:
    """(doc_id, fp, text_hash, root, component_id) of every row."""
    prints = written(fingerprints(docs), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    roots = components(links(distinct.select("fp"), groups, cell_limit))
    placed = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    placed = written(placed, "placed-prints")
    # written, so that the join can split a component with a third of all prints
    least = written(placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "component-ids")
    named = written(placed.join(least, "root").select("fp", "root", "component_id"), "named-prints")
    return prints.join(named, "fp")


def near_duplicates(docs: DataFrame, groups: int | None = None, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text, ...).

    Null and empty texts, and texts of spaces, have the fingerprint zero and link like any other.
    Repeated rows come back as often as they came. A null doc_id is a row like any other, but names
    a component only if no row of it has an id. Other columns are ignored.
    """
    return _classes(docs, groups, cell_limit).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, groups: int | None = None, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: the one of the least doc_id.

    Of several texts with that doc_id the one of the least hash stays; of rows that share id and
    text, one. Rows without an id stay only where their group has none with one.
    """
    best = (
        _classes(docs, groups, cell_limit).where("doc_id <=> component_id")
        .groupBy("doc_id", "root", "text_hash").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("doc_id", "root").agg(F.min(F.struct("text_hash", "n")).alias("best"))
        .select("doc_id", "best.text_hash", "best.n")
    )
    best = written(best, "representatives")
    marks = (F.col("doc_id").cast("long"), F.xxhash64("text"))

    def kept(of: DataFrame) -> DataFrame:
        return meet(docs, marks, of.select("doc_id", "text_hash"), "inner")

    more = best.where("n > 1")
    if more.isEmpty():  # the texts are dealt out once
        return kept(best)
    again = free_name(docs, "hash")
    of_more = kept(more).withColumn(again, F.xxhash64("text")).dropDuplicates(["doc_id", again]).drop(again)
    return kept(best.where("n = 1")).unionByName(of_more)
