from __future__ import annotations

import random
import unicodedata

import pyarrow.parquet as pq

from weatherloom.llm import repeats
from weatherloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(docs, min_words=25):
    """[(doc_id, text)] -> sorted spans, by walking the documents in rank order."""
    first, out = {}, []
    for doc, text in sorted({(d, t or "") for d, t in docs}, key=lambda r: (r[0] is None, r[0] or 0)):
        run = []
        for start, end, normal in [*repeats.split_units(text), (0, 0, None)]:
            if normal in first:
                run.append((start, end, len(normal.split(" ")), first[normal], normal))
                continue
            if sum(map(size, {x for *_, x in run})) >= min_words:
                owners = [o for *_, o, _ in run if o is not None]
                out.append(repr((doc, min(owners, default=None), run[0][0], run[-1][1], len(run), sum(w for *_, w, _, _ in run))))
            run = []
            if normal is not None:
                first[normal] = doc
    return sorted(out)


def size(unit):
    unspaced = sum(unicodedata.name(c, "").startswith(("CJK UNIFIED", "HIRAGANA", "KATAKANA", "THAI")) for c in unit)
    return max(len(unit.split(" ")), unspaced // 2)


def got(df):
    return sorted(repr((r.doc_id, r.first_doc_id, r.start, r.end, r.n_units, r.n_words)) for r in df.collect())


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(6)) for _ in range(n))


def test_against_plain_walk(documents):
    rng = random.Random(6)
    passage = prose(rng, 55)
    parts = f"{prose(rng, 20)}. {prose(rng, 15)}!\nYes.\n{prose(rng, 20)}"
    rows = [(i, f"{prose(rng, 30)}\n{passage.upper() if i % 2 else passage}  \n{prose(rng, 10)}") for i in range(0, 12)]
    rows += [(20 + i, f"{prose(rng, 12)}. {parts}. {prose(rng, 12)}") for i in range(5)]
    rows += [(40, "Stock phrase here. " * 200), (41, "Stock phrase here."), (42, f"{passage}\n{passage}"), (43, "a. b. c. " * 50)]
    rows += [(50, None), (51, ""), (52, " \n\t"), (3, rows[3][1]), (None, passage), (60, prose(rng, 40_000)), (-5, passage)]
    frame = documents(rows).selectExpr("*", "1 as n", "2 as first", "3 as length")
    assert got(repeats.repeats(frame)) == plain(rows)
    out = repeats.remove_repeats(frame).collect()
    assert len(out) == len(rows)
    for r in out:
        text = dict(rows)[r.doc_id]
        if r.text != text:
            left = "".join(text[a:b] for a, b in zip([0, *(s.end for s in r.removed)], [*(s.start for s in r.removed), len(text)], strict=True))
            assert left == r.text and r.removed
    assert sum(passage in (r.text or "").lower() for r in out) == 1


def test_short_units_and_unspaced_scripts(documents):
    rng = random.Random(7)
    short = "\n".join(prose(rng, 3) for _ in range(200))
    verse = "\n".join("".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(30)) for _ in range(60))
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(60))
    say = "Read more here.\n" * 300
    rows = [(i, f"{prose(rng, 9)}\n{x}\n{prose(rng, 9)}") for i, x in enumerate([short, short, verse, verse, thai, thai, say, say])]
    rows += [(20, f"{short}\n{prose(rng, 5)}\n{short}")]  # the passage also stands twice in one text
    found = repeats.repeats(documents(rows))
    assert got(found) == plain(rows)
    assert sorted((r.doc_id, r.n_words) for r in found.collect()) == [(1, 600), (3, 60), (5, 1), (20, 600), (20, 600)]


def test_columns_of_any_name(documents):
    passage = prose(random.Random(1), 30)
    frame = documents([(1, passage), (2, passage), (3, None)]).selectExpr(
        "*", "1 as _id", "2 as _hash", "3 as _spans", "4 as spans", "5 as text_hash", "6 as row", "7 as cut", "8 as removed", "9 as n"
    )
    out = {r.doc_id: r for r in repeats.remove_repeats(frame).collect()}
    assert (out[2].text, out[1].text, out[3].text) == ("", passage, None)
    assert (out[2]._id, out[2]._hash, out[2]._spans, out[2].spans, out[2].text_hash, out[2].row, out[2].cut, out[2].n) == (1, 2, 3, 4, 5, 6, 7, 9)


def test_empty(documents):
    assert repeats.repeats(documents([])).collect() == []
    assert repeats.remove_repeats(documents([])).collect() == []


def test_query_against_plain_walk(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]
    found = got(QUERIES["op6_substring_dedup"](spark, SF))
    assert found and found == plain(docs)
