from __future__ import annotations

import hashlib
import random

import pytest

from weatherloom.llm import decontaminate as d


def words(text):
    out, word = [], ""
    for c in text or "":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if ord(c) > 127 or c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out + [word] * bool(word)


def plain(docs, items):
    wins = {}
    for item, text in items:
        ws = words(text)
        for i in range(max(1, len(ws) - 12)):
            if ws:
                wins.setdefault(tuple(ws[i : i + 13]), set()).add(str(item))
    rows = []
    for doc, text in docs:
        ws, hit, met = words(text), set(), set()
        for win, owners in wins.items():
            for i in range(len(ws) - len(win) + 1):
                if tuple(ws[i : i + len(win)]) == win:
                    hit |= set(range(i, i + len(win)))
                    met |= owners
        sha = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        rows.append(repr((doc, len(ws), len(hit), len(met), sha, bool(hit) and 20 * len(hit) >= len(ws))))
    return sorted(rows)


def got(df):
    return sorted(
        repr((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in df.collect()
    )


@pytest.fixture
def benchmark_table(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def text_of(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


def test_against_plain_search(spark, documents, benchmark_table):
    rng = random.Random(7)
    few, many = ["ab", "Cd", "éf", "g1"], [f"w{i}" for i in range(400)]
    items = [(i, text_of(rng, n, many)) for i, n in enumerate([13, 14, 30, 12, 5, 40, 13])]
    items += [(20, "ab cd"), (21, "Ab... CD!"), (22, text_of(rng, 15, few)), (23, None), (24, "?!"), (None, "w1 w2 w3")]
    items += [(25, "rare " + "same " * 14), (26, items[2][1])]
    docs = [(i, text_of(rng, 60, few if i % 3 else many)) for i in range(12)]
    docs += [(20 + i, f"{text_of(rng, 50, many)}, {items[i][1].upper()}\n{text_of(rng, i * 60, many)}") for i in range(7)]
    docs += [(40, None), (41, ""), (42, "..."), (43, "rare " + "same " * 30), (44, items[2][1]), (44, items[2][1]), (None, items[1][1])]
    docs += [(50, " ".join(items[5][1].split()[10:35])), (51, text_of(rng, 30_000, many) + " " + items[0][1]), (52, items[0][1][:-2])]
    frame = documents(docs).selectExpr("*", "1 as ta", "'x' as term", "2 as window")
    assert got(d.contamination(frame, benchmark_table(items))) == plain(docs, items)
    kept = d.remove_contaminated(frame, benchmark_table(items))
    assert kept.columns == frame.columns
    bad = {eval(r)[0] for r in plain(docs, items) if eval(r)[5]}
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(i) for i, _ in docs if i not in bad)


def test_empty(documents, benchmark_table):
    assert d.contamination(documents([]), benchmark_table([(1, "a b")])).collect() == []
    assert got(d.contamination(documents([(1, "a b")]), benchmark_table([]))) == plain([(1, "a b")], [])


def test_proximity(documents, benchmark_table):
    item = " ".join(f"t{i}" for i in range(13))
    near = "t0 t1 x y t2 t3 t4"
    docs = documents([(1, near), (2, item), (3, "t0 " + "x " * 20 + "t1"), (4, "x " * 50 + "t0")])
    rare = d.rare_terms(d.windows(benchmark_table([(1, item)])), d.term_counts(docs, docs.selectExpr("explode(split(text, ' ')) as term").distinct()))
    index = d.build_index(docs, d.anchor_terms(rare))
    found = d.proximity_matches(index, rare).join(docs.select("doc_id", *d.text_key(docs.text)), ["ta", "tb"])
    terms = {r.term for r in rare.collect()}
    expected = {i for i, t in ((1, near), (2, item), (3, "t0 t1 far"), (4, "")) if i in (1, 2) and terms <= set(t.split())}
    assert {r.doc_id for r in found.collect()} == expected | {2}
