from __future__ import annotations

import random

import numpy as np
import pytest

from weatherloom.llm import negatives


@pytest.mark.parametrize("shape", [(1, 1, 1), (7, 64, 5), (33, 64, 70), (100, 17, 130), (64, 64, 64), (0, 64, 9), (40, 0, 40)])
def test_strassen_is_the_product(shape):
    rng = np.random.default_rng(sum(shape))
    a, b = rng.integers(-(1 << 20), 1 << 20, shape[:2]), rng.integers(-(1 << 20), 1 << 20, shape[1:])
    assert (negatives.strassen(a, b) == a @ b).all()
    assert (negatives.strassen(a, b, leaf=2) == a @ b).all()


def test_strassen_where_only_the_result_fits():
    a = np.full((40, 40), 1 << 30)
    b = np.full((40, 40), 1 << 27)
    assert (negatives.strassen(a, b, leaf=2) == 40 * (1 << 57)).all()  # its inner sums go beyond a long


def plain(rows, positives=5, take=3, low=50, high=95):
    kept = [r for r in rows if r[1] is not None and r[2] is not None and None not in r[2]]
    dot = lambda x, y: sum(a * b for a, b in zip(x, y, strict=False))
    key = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, a in enumerate(kept):
        if not a[3]:
            continue
        scored = [(dot(a[2], c[2]), c[0], c[1] == a[1]) for j, c in enumerate(kept) if j != i]
        for p, positive, _ in sorted((s for s in scored if s[2]), key=key)[:positives]:
            window = [s for s in scored if not s[2] and low * p <= 100 * s[0] <= high * p]
            for rank, (s, negative, _) in enumerate(sorted(window, key=key)[:take], 1):
                out.append((a[0], positive, rank, negative, p, s))
    return sorted(map(repr, out))


SCHEMA = "id long, label int, v array<long>, is_anchor boolean, row int, gc int, anchor int, score int, known int"


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], SCHEMA)
    return sorted(repr(tuple(r)) for r in negatives.mine(frame, **options).collect())


@pytest.mark.parametrize("stripe", [25, 1 << 14])
def test_against_all_pairs(spark, stripe):
    rng = random.Random(11)
    rows = [(i, rng.randrange(3), [rng.randrange(-3, 9) for _ in range(6)], i % 7 == 0) for i in range(120)]
    rows += [(7, 1, rows[7][2], True), (7, 1, rows[7][2], True), (35, 0, [1, 2], None), (None, 2, [4] * 6, True), (None, 1, [3] * 6, False)]
    rows += [(200, None, [1] * 6, True), (201, 1, None, True), (202, 1, [1, None], True), (203, 1, [], True), (204, 2, [0] * 6, True)]
    rows += [(300 + i, 2, [5] * 6, False) for i in range(40)] + [(400, 9, [8] * 6, True), (-3, 0, [2] * 8, True)]
    want = plain(rows)
    assert want and mined(spark, rows, stripe=stripe) == want


def test_few_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(0, 1, [1, 2], True)]) == []
    assert mined(spark, [(0, 1, [1, 2], True), (1, 1, [1, 2], False)]) == []
    assert mined(spark, [(0, 1, [4], True), (1, 1, [4], False), (2, 2, [3], False)]) == ["(0, 1, 1, 2, 16, 12)"]
    assert mined(spark, [(0, 1, [4], False), (1, 2, [4], None)]) == []


def test_scores_that_do_not_fit(spark):
    with pytest.raises(Exception, match="components too large"):
        mined(spark, [(0, 1, [1 << 40], True), (1, 1, [1 << 40], False)])
