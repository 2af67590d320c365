from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from weatherloom.llm import periodic
from weatherloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_runs(w, least=6, times=4):
    """[(start, length, period)] by trying every period."""
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_kept(w, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("seed", range(4))
def test_runs_against_every_period(seed):
    rng = random.Random(seed)
    for _ in range(400):
        w = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randrange(90))]
        for _ in range(rng.randrange(3)):
            if w:
                a = rng.randrange(len(w))
                p = rng.randrange(1, max(2, (len(w) - a) // 3))
                for i in range(a, rng.randrange(a, len(w) + 1)):
                    w[i] = w[a + (i - a) % p]
        least, times = rng.choice([2, 6]), rng.choice([2, 3, 4, 5])
        assert [tuple(r) for r in periodic.runs(np.array([*w, 9]), least, times).tolist()] == plain_runs(w, least, times)


def test_runs_of_a_word_a_power_and_nothing():
    assert periodic.runs(np.array([7])).tolist() == []
    assert periodic.runs(np.array([1] * 5 + [9])).tolist() == []
    assert periodic.runs(np.array([1] * 6 + [9])).tolist() == [[0, 6, 1]]
    block = [1] * 5 + [2]  # runs of ones inside a run of six words
    assert [0, 240, 6] in periodic.runs(np.array(block * 40 + [9])).tolist()
    with pytest.raises(ValueError):
        periodic.runs(np.array([1]), min_exponent=1)


def test_wavelet_tree():
    rng = np.random.default_rng(3)
    for n in (1, 2, 63, 64, 65, 300):
        values = rng.permutation(n)
        tree = periodic.WaveletTree(values)
        lo = rng.integers(0, n, 50)
        hi = np.minimum(n, lo + 1 + rng.integers(0, n, 50))
        bound = rng.integers(0, 2 * n, 50)
        assert tree.below(lo, hi, bound).tolist() == [(values[a:b] < x).sum() for a, b, x in zip(lo, hi, bound, strict=True)]
        k = rng.integers(0, hi - lo)
        assert tree.smallest(lo, hi, k).tolist() == [sorted(values[a:b])[i] for a, b, i in zip(lo, hi, k, strict=True)]


def test_texts(documents):
    rng = random.Random(5)
    loop = "ab cd ef " * 30
    texts = [None, "", " \n\t", "one", loop, loop.upper(), f"x {loop} y\n{loop}", "é " * 50, "a b " * 20_000]
    texts += [" ".join(rng.choice("ab") for _ in range(rng.randrange(60))) for _ in range(40)]
    rows = list(enumerate(texts)) + [(4, loop), (None, loop), (-7, loop)]
    frame = documents(rows).selectExpr("*", "1 as runs", "2 as collapsed", "3 as n_words")
    found = sorted((repr(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic.periodic_runs(frame).collect())
    want = []
    for doc, text in rows:
        w = (text or "").split()
        runs = [(0, len(w), 2)] if len(w) == 40_000 else plain_runs(w)
        want.append((repr(doc), len(w), runs, plain_kept(w, runs)))
    assert found == sorted(want)
    assert periodic.periodic_runs(documents([])).collect() == []


def test_query_against_every_period(spark):
    want = {}
    for r in pq.read_table(f"{SF}/documents.parquet").to_pylist():
        w = [x.decode() for x in (r["text"] or "").encode().split()]
        h = zlib.crc32(str(r["doc_id"]).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        runs = plain_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want[r["doc_id"]] = (
            len(runs), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(plain_kept(w, runs).encode()).hexdigest(),
        )
    columns = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    found = {r.doc_id: tuple(r[c] for c in columns) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    assert found == want and any(x[0] for x in want.values())
