from __future__ import annotations

import itertools
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from weatherloom.llm import language
from weatherloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_tokens():
    packed, starts, ends = language.tokens("Ab, é1x\n_Ωψ 漢字")
    assert ["".join(map(chr, packed[a:b])) for a, b in zip(starts, ends, strict=True)] == ["ab", "é", "x", "ωψ", "漢字"]
    assert not packed[starts - 1].any() and packed[-1] == 0
    for empty in ("", "12 ?!", " "):
        assert language.tokens(empty)[1].size == 0


@pytest.mark.parametrize("seed", range(8))
def test_path_against_all_paths(seed):
    rng = np.random.default_rng(seed)
    scores = rng.normal(0, [1, 3, 8][seed % 3], (7, 3))
    penalty = 4.0

    def value(path):
        return sum(scores[i, k] for i, k in enumerate(path)) - penalty * sum(a != b for a, b in itertools.pairwise(path))

    best = max(itertools.product(range(3), repeat=7), key=value)
    assert value(language.best_path(scores, penalty)) == pytest.approx(value(best))


def model_of(spark, texts):
    rows = [(i, t, lang) for i, (lang, t) in enumerate(texts)]
    return language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


GERMAN = "der schnelle braune fuchs springt über den faulen hund und die katze sitzt auf der mauer im garten"
ENGLISH = "the quick brown fox jumps over the lazy dog while the cat is sitting on the wall of the garden"
RUSSIAN = "быстрая коричневая лиса прыгает через ленивую собаку а кошка сидит на стене"


def test_mixed_text_and_scripts(spark):
    texts = [("de", GERMAN), ("en", ENGLISH), ("ru", RUSSIAN)]
    model = model_of(spark, texts * 40)
    assert model.langs == ["de", "en", "ru"]
    for lang, text in texts:
        assert language.judge(text, model)[:2] == (lang, 1.0)
    lang, score, spans = language.judge(f"{ENGLISH} {GERMAN} {GERMAN}. {RUSSIAN}!", model)
    assert lang == "de" and 0.3 < score < 0.7 and [s[2] for s in spans] == ["en", "de", "ru"]
    assert spans[0][1] == len(ENGLISH.split()) - 1
    assert language.judge("Ωψ χαρά", model)[0] in model.langs  # a script of no language narrows nothing
    assert [language.judge(t, model)[0] for t in (None, "", "123 ...")] == ["und"] * 3


def test_rows(spark):
    schema = "doc_id long, text string, lang string"
    rows = [(i, GERMAN if i % 2 else ENGLISH, "de" if i % 2 else "en") for i in range(60)]
    rows += [(None, ENGLISH, None), (100, None, "en"), (101, "", "en"), (102, "7", None), (103, "wort " * 60_000, None), (3, GERMAN, "de")]
    frame = spark.createDataFrame(rows, schema).selectExpr("*", "'a' as key", "1 as nth", "'x' as spans")
    out = language.identify(frame, language.train(frame)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out if r.doc_id is not None)
    by = {r.doc_id: r.lang_pred for r in out}
    assert [by[i] for i in (None, 100, 101, 102)] == ["en", "und", "und", "und"] and by[1] == "de"
    empty = spark.createDataFrame([], schema)
    assert language.identify(empty, language.train(empty)).collect() == []
    assert language.identify(frame.limit(1), language.train(empty)).first().lang_pred == "und"


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = [(i, GERMAN, "xx") for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2] + [(1, ENGLISH, "en"), (5, GERMAN, None)]
    rows = [r for r in rows if r[0] not in (1, 5) or zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert "xx" not in model.langs


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    out = QUERIES["op8_language_id"](spark, SF).collect()
    assert len(out) == len(truth)
    tested = [r for r in out if r.held_out]
    assert len(tested) > 100 and sum(r.lang_pred == truth[r.doc_id] for r in tested) >= 0.98 * len(tested)
