from __future__ import annotations

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from weatherloom.llm import simhash
from weatherloom.llm.components import components
from weatherloom.llm.queries import QUERIES

MASK = (1 << 64) - 1
SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        low = low.replace(space, " ")
    toks = [w for w in low.split(" ") if w]
    if not toks:
        return 0
    grams = [" ".join(toks[i : i + 4]) for i in range(max(1, len(toks) - 3))]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    """[(doc_id, text)] -> {(doc_id, hex, component)} by comparing all pairs."""
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((repr(d), f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows))


def got(df):
    return sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in df.collect())


def test_edge_rows(documents):
    rng = random.Random(1)
    base = " ".join(rng.choice("abcdefghij") * rng.randint(1, 5) for _ in range(300))
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, base), (7, base), (7, base),
        (8, base.replace("aa", "a", 1)), (9, "Äpfel und Birnen im Korb"), (10, "äpfel und Birnen im Korb"),
        (None, base), (None, "all alone here now"), (11, "x" * 300_000), (12, "w " * 70_000),
    ]
    df = documents(rows).selectExpr("*", "1 as fp", "2 as component_id", "3 as cell")
    assert got(simhash.near_duplicates(df)) == brute(rows)


def test_empty(documents):
    assert simhash.near_duplicates(documents([])).collect() == []
    assert simhash.keep_one(documents([])).collect() == []


@pytest.mark.parametrize("groups,limit", [(6, 16384), (8, 50)])
def test_links_against_all_pairs(spark, groups, limit):
    """Random prints, chains, and a dense ball larger than a block."""
    rng = np.random.default_rng(5)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 400)}
    for x in list(prints)[:60]:
        for _ in range(4):  # a chain of close prints
            for bit in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                x ^= 1 << int(bit)
            prints.add(x)
    centre = int(rng.integers(0, 1 << 63))
    prints |= {centre ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)}
    signed = [simhash._signed(x) for x in prints]
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), groups, limit)
    assert all(((r.u ^ r.v) & MASK).bit_count() <= 4 for r in found.collect())
    roots = {r.node: r.root for r in components(found).collect()}
    all_pairs = spark.createDataFrame(
        [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & MASK).bit_count() <= 4], "u long, v long"
    )
    assert roots == {r.node: r.root for r in components(all_pairs).collect()}


def test_every_close_pair_shares_a_cell():
    rng = np.random.default_rng(3)
    for groups in (6, 7, 9):
        masks = [m & MASK for m in simhash.cell_masks(groups)]
        for _ in range(200):
            a = int(rng.integers(0, 1 << 63))
            b = a
            for bit in rng.choice(64, 4, replace=False):
                b ^= 1 << int(bit)
            ca, cb = [((x ^ x >> 1) & 0x5555555555555555) | (x & x >> 1 & 0x5555555555555555) << 1 for x in (a, b)]
            assert any(ca & m == cb & m for m in masks)


def test_components_long_chain(spark):
    n = 300
    edges = [(i, i + 1) for i in range(n)] + [(1000, 1000), (None, 3), (5, 4)]
    out = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert sorted((r.node, r.root) for r in out) == [(i, 0) for i in range(n + 1)]


def test_keep_one(documents):
    text = " ".join(f"w{i}" for i in range(80))
    other = " ".join(f"v{i}" for i in range(80))
    rows = [(5, text), (3, text), (3, text), (9, other), (None, text), (None, None), (None, None)]
    kept = simhash.keep_one(documents(rows)).collect()
    assert sorted((repr(r.doc_id), repr(r.text)) for r in kept) == sorted((repr(a), repr(b)) for a, b in [(3, text), (9, other), (None, None)])
    assert simhash.keep_one(documents(rows)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    assert got(QUERIES["op1_simhash_near_dedup"](spark, SF)) == brute(rows)
