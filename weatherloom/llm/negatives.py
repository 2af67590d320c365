"""Hard negatives: for each anchor and positive, the best rows of other labels in a window below it.

Scores are integer inner products. Anchors and candidates are dealt into tiles by hash; every tile
of anchors meets every tile of candidates once, and their scores are a matrix product by Strassen's
recursion on int64, padded with zeros. int64 sums and products are exact modulo 2^64 at every step,
so scores are exact wherever they fit; a bound on the components is checked for each tile.

Two passes: the first keeps the best rows of the anchor's label, the second, knowing each positive's
score, the best rows of its window. Both keep, for each anchor, a heap as long as the answer, which
tiles merge into; the heaps of a task's tiles merge in the task, those of tasks in a window of Spark.
A task holds a stripe of anchors and one tile of candidates; neither grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherloom.llm.scratch import written

#: Rows of a tile; anchors and candidates that a task takes at most on average.
TILE, STRIPE = 1024, 16 * 1024
#: Below this size in any direction blocks are multiplied as they are.
LEAF = 16
_LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b for int64 matrices, by seven products of half the size, exact modulo 2**64."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    r, k, c = (rows + 1) // 2, (inner + 1) // 2, (columns + 1) // 2
    a = np.pad(a, ((0, 2 * r - rows), (0, 2 * k - inner)))
    b = np.pad(b, ((0, 2 * k - inner), (0, 2 * c - columns)))
    a11, a12, a21, a22 = a[:r, :k], a[:r, k:], a[r:, :k], a[r:, k:]
    b11, b12, b21, b22 = b[:k, :c], b[:k, c:], b[k:, :c], b[k:, c:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * r, 2 * c), np.int64)
    out[:r, :c], out[:r, c:] = m1 + m4 - m5 + m7, m3 + m5
    out[r:, :c], out[r:, c:] = m2 + m4, m1 - m2 + m3 + m6
    return out[:rows, :columns]


class _Heaps:
    """For each of ``n`` owners the best ``k`` of (score, id): higher scores first, then lesser ids, null last."""

    def __init__(self, n: int, k: int):
        self.score = np.full((n, k), _LEAST, np.int64)
        self.id = np.zeros((n, k), np.int64)
        self.kind = np.full((n, k), 2, np.int8)  # 0 an id, 1 a null id, 2 nothing

    def merge(self, at: slice, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """``ids`` ascend, with ``null`` ones at the end, so that the first of equal scores is the best."""
        k = self.score.shape[1]
        left = np.where(allowed, scores, _LEAST)
        rows = np.arange(left.shape[0])
        best_score, best_id, best_kind = [self.score[at]], [self.id[at]], [self.kind[at]]
        for _ in range(min(k, left.shape[1])):
            j = left.argmax(1)
            score = left[rows, j]
            there = allowed[rows, j] & (score > _LEAST)
            best_score.append(score[:, None])
            best_id.append(ids[j][:, None])
            best_kind.append(np.where(there, null[j].astype(np.int8), 2)[:, None])
            left[rows, j] = _LEAST
        score, ids_, kind = (np.concatenate(x, 1) for x in (best_score, best_id, best_kind))
        order = np.lexsort((ids_, kind == 1, ~score, kind == 2), axis=1)[:, :k]  # ~score falls as score rises, without overflow
        self.score[at], self.id[at], self.kind[at] = (np.take_along_axis(x, order, 1) for x in (score, ids_, kind))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of long as rows, padded with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))


class _Stripe:
    """Anchors of one task in order of arrival, and their heaps."""

    def __init__(self, slots: int, keep: int):
        self.slots, self.keep, self.tiles, self.heaps = slots, keep, [], None

    def add(self, tile: dict) -> None:
        self.tiles.append(tile)

    def meet(self, cand: dict, allowed: Callable) -> None:
        if not self.tiles:
            return
        if self.heaps is None:
            n = sum(t["row"].size for t in self.tiles)
            self.heaps = [_Heaps(n, self.keep) for _ in range(self.slots)]
        at = 0
        for tile in self.tiles:
            part = slice(at, at := at + tile["row"].size)
            if 128 * _largest(tile["v"]) * _largest(cand["v"]) * max(1, tile["v"].shape[1]) >= 1 << 63:  # also 100 times a score fits
                raise ArithmeticError("components too large: inner products may not fit a long")
            scores = strassen(tile["v"], np.ascontiguousarray(cand["v"].T))
            for slot, heap in enumerate(self.heaps):
                heap.merge(part, scores, allowed(tile, cand, scores, slot), cand["id"], cand["null"])

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.heaps is None:
            return
        rows = np.concatenate([t["row"] for t in self.tiles])
        for slot, heap in enumerate(self.heaps):
            i, j = np.nonzero(heap.kind < 2)
            ids = pa.array(heap.id[i, j], pa.int64(), mask=heap.kind[i, j] == 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[i]), pa.array(np.full(i.size, slot, np.int32)), ids, pa.array(heap.score[i, j])],
                ["anchor", "slot", "id", "score"],
            )


def _tiles(pairs: DataFrame, width: int, slots: int, keep: int, allowed: Callable) -> DataFrame:
    """(anchor, slot, id, score): the heaps of each pair of stripes. ``pairs`` are sorted batches of
    (ga, gc, is_candidate, null_id, id, row, label, v[, known]); known are scores an anchor's slots refer to."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripe, of = _Stripe(slots, keep), None
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], 1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(key)], strict=True):
                if of != tuple(key[a, :2]):
                    yield from stripe.out()
                    stripe, of = _Stripe(slots, keep), tuple(key[a, :2])
                for lo in range(a, b, TILE):
                    part = batch.slice(lo, min(TILE, b - lo))
                    tile = {
                        "null": part.column(3).to_numpy(zero_copy_only=False).astype(bool), "id": part.column(4).fill_null(0).to_numpy(),
                        "row": part.column(5).to_numpy(), "label": part.column(6).to_numpy(), "v": _matrix(part.column(7), width),
                    }
                    if part.num_columns > 8:
                        tile["known"], tile["n_known"] = _matrix(part.column(8), slots), np.diff(part.column(8).offsets.to_numpy())
                    if key[a, 2]:
                        stripe.meet(tile, allowed)
                    else:
                        stripe.add(tile)
        yield from stripe.out()

    return pairs.mapInArrow(work, "anchor long, slot int, id long, score long")


def _met(anchors: DataFrame, rows: DataFrame, stripes: tuple[int, int]) -> DataFrame:
    """Every stripe of anchors beside every stripe of rows, anchors first, candidates by id."""
    ga, gc = stripes
    extra = [c for c in anchors.columns if c not in rows.columns]

    def stripe(n: int):
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    columns = ["ga", "gc", "is_candidate", "null_id", "id", "row", "label", "v", *extra]
    left = anchors.withColumn("ga", stripe(ga)).withColumn("gc", F.explode(F.sequence(F.lit(0), F.lit(gc - 1)))).withColumn("is_candidate", F.lit(0))
    right = rows.withColumn("gc", stripe(gc)).withColumn("ga", F.explode(F.sequence(F.lit(0), F.lit(ga - 1)))).withColumn("is_candidate", F.lit(1))
    for c in extra:
        right = right.withColumn(c, F.array().cast("array<long>"))
    both = left.withColumn("null_id", F.col("id").isNull().cast("int")).select(columns).union(
        right.withColumn("null_id", F.col("id").isNull().cast("int")).select(columns)
    )
    return both.repartition(ga * gc, "ga", "gc").sortWithinPartitions("ga", "gc", "is_candidate", "null_id", "id", "row")


def _first(heaps: DataFrame, k: int, by: list[str]) -> DataFrame:
    """The first ``k`` of each anchor's merged heaps, with their rank from 1."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    stripe: int = STRIPE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` are (id long, label int, v array<long>, is_anchor boolean). An anchor's positives are
    its best ``positives`` other rows of its label; the negatives of a positive of score p are the
    best ``negatives`` rows of other labels whose score s fits low * p <= 100 * s <= high * p. Higher
    scores come first, then lesser ids, null ids last.

    Rows with a null label, a null vector or a null component take no part. Shorter vectors are padded with
    zeros. Rows count one by one: rows that share an id are candidates each, and anchors each. A
    null ``is_anchor`` is no anchor. No anchors or no rows of other labels give no rows. Components
    of which 128 times a product might not fit a long raise ArithmeticError.
    """
    if not 1 <= low <= high:
        raise ValueError("a window needs 1 <= low <= high")
    rows = written(
        vectors.where("label is not null and v is not null and not exists(v, x -> x is null)")
        .select(F.monotonically_increasing_id().alias("row"), F.col("id").cast("long"), F.col("label").cast("long"), "v", "is_anchor"),
        "vectors",
    )
    n, n_anchors, width = rows.agg(F.count(F.lit(1)), F.count_if("is_anchor"), F.max(F.size("v"))).first()
    anchors, rows = rows.where("is_anchor").drop("is_anchor"), rows.drop("is_anchor")
    width, cores = width or 0, rows.sparkSession.sparkContext.defaultParallelism
    stripes = (max(1, -(-n_anchors // stripe)), max(cores, -(-n // stripe)))

    def same(tile, cand, scores, slot):
        return (tile["label"][:, None] == cand["label"]) & (tile["row"][:, None] != cand["row"])

    heaps = _tiles(_met(anchors, rows, stripes), width, 1, positives, same)
    best = written(_first(heaps, positives, ["anchor"]).select("anchor", (F.col("rank") - 1).alias("slot"), "id", "score"), "positives")
    known = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("slot", "score"))).alias("p")).select(
        F.col("anchor").alias("row"), F.transform("p", lambda x: x["score"]).alias("known")
    )

    def window(tile, cand, scores, slot):
        p, there = tile["known"][:, slot, None], tile["n_known"][:, None] > slot
        return there & (tile["label"][:, None] != cand["label"]) & (low * p <= 100 * scores) & (100 * scores <= high * p)

    found = _tiles(_met(anchors.join(known, "row"), rows, stripes), width, positives, negatives, window)
    first = _first(found, negatives, ["anchor", "slot"])
    return (
        first.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
        .join(best.withColumnRenamed("id", "positive_id").withColumnRenamed("score", "positive_score"), ["anchor", "slot"])
        .join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
    )
