"""The pipeline against a plain version of its stages, on whole small tables."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import test_decontaminate
import test_mixing
import test_quality
import test_simhash

import corpus_pipeline
from weatherloom.llm import pii, quality

SF = "/root/testdata/sf0.001"


def read(name):
    return pq.read_table(f"{SF}/{name}.parquet").to_pylist()


def plain_quality(docs):
    def normal(line):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else "0" if c in "123456789" else c for c in line)
        return " ".join(test_quality.words(low))

    seen = defaultdict(set)
    for d in docs:
        for line in (d["text"] or "").split("\n"):
            seen[d["source"], normal(line)].add(d["text"])
    for d in docs:
        words, *_, failed = test_quality.plain(d["text"])
        lines = [normal(x) for x in (d["text"] or "").split("\n")]
        gone = sum(len(x.split(" ")) for x in lines if x and len(x.split(" ")) <= 25 and len(seen[d["source"], x]) > 20)
        if not failed and 100 * (words - gone) >= 5 * words:
            yield d


def test_against_plain_stages(spark):
    docs = list(plain_quality(read("documents")))
    classes = {eval(i): c for i, _, c in test_simhash.brute([(d["doc_id"], d["text"]) for d in docs])}
    docs = [d for d in docs if classes[d["doc_id"]] == d["doc_id"]]
    items = [(b["item_id"], b["text"]) for b in read("benchmark")]
    judged = map(eval, test_decontaminate.plain([(d["doc_id"], d["text"]) for d in docs], items))
    bad = {r[0] for r in judged if r[5]}
    docs = [d for d in docs if d["doc_id"] not in bad]
    sizes = {d["doc_id"]: len(test_quality.words(pii.pseudonymise(d["text"])[0])) for d in docs}

    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.size for r in rows} == sizes and len(rows) == len(sizes)
    assert 0 < len(bad) and len(docs) < len(read("documents"))
    test_mixing.check(rows)


def test_stages_keep_columns_and_bear_edge_rows(spark, documents):
    prose = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(70))
    rows = [(1, None), (2, ""), (None, prose), (3, prose), (3, prose), (4, prose + " die.55@mail4.example.com", "en", "a")]
    for table in (documents(rows), documents([])):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == table.columns and out.dtypes == table.dtypes
            docs = out.checkpoint()
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert len(last) == docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == list(Counter(n for n, _ in corpus_pipeline.STAGES))


def test_stages_with_columns_of_any_name(spark, documents):
    """Names that the stages' own joins might use, as columns of the caller."""
    names = ["_id", "_hash", "_n", "_ta", "_tb", "_host", "_removed", "_mark0", "host", "ta", "tb", "n", "hash", "removed", "fp", "root", "copies", "item_id"]
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(7))
    text = " ".join(word() for _ in range(80))
    rows = [(1, text, "en", "s"), (2, text, "en", "s"), (2, text, "en", None), (3, " ".join(word() for _ in range(80)), "en", "s"), (4, None, None, None), (None, "", None, None)]
    frame = documents(rows).selectExpr("*", *[f"'{x}' as `{x}`" for x in names])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF)
        assert set(frame.columns) <= set(out.columns), name
        for r in out.collect():
            assert all(r[x] == x for x in names), name
    assert sorted(r.doc_id for r in corpus_pipeline.quality_rules(spark, frame, SF).collect()) == [1, 2, 2, 3]
    kept = corpus_pipeline.near_dedup(spark, frame, SF).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 4]
    cleaned = quality.apply_rules(frame, clean=True)
    assert cleaned.columns == frame.columns and cleaned.count() == 4
    assert corpus_pipeline.mixed(spark, frame, SF).count() == len(rows)
