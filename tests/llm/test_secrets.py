from __future__ import annotations

import hashlib
import random
import re
import string

import pyarrow.parquet as pq

from weatherloom.llm import secrets
from weatherloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RULES = [
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 12),
    ("access", r"AKIA[A-Z0-9]+", 0, 0, 18),
    ("hex", r"[0-9a-f]+", 0, 0, 16),
]


def plain(text):
    spans, counts = [], []
    for order, (kind, pattern, flags, group, least) in enumerate(RULES):
        found = [m for m in re.finditer(pattern, text or "", flags) if len(m[group]) >= least]
        counts.append(len(found))
        spans += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in found]
    named = ",".join(s for *_, s in sorted(spans))
    return *counts, named, hashlib.sha256(named.encode()).hexdigest()


def agree(row, text):
    *counts, named, digest = plain(text)
    own = [s for s in row.spans.split(",") if s and not s.startswith("markov")]
    return [row.n_assign, row.n_access, row.n_hex] == counts and row.base_sha256 == digest and own == [s for s in named.split(",") if s]


def test_base_against_plain_matching(documents):
    rng = random.Random(4)
    bits = ["password", "Token", "API_KEY", "apikey", "secret", "passwd", ":", "=", " ", '"', "'", "AKIA", "AKIA" + "X7" * 9, "deadbeef" * 3, "abc", "=b", "0123456789", "é𝄞", "\n", "K", "ſecret", "x" * 13, ".", "AKIAAKIA"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(1, 25))) for _ in range(400)]
    texts += [None, "", "password: token: abcdefghijklmnop", "token=" + "a1" * 50_000, "𝄞 token='abcdefabcdefabcdef' x" * 1500, "f" * 15, "f" * 16]
    texts += texts[:3]
    frame = documents([(i if i % 50 else None, t) for i, t in enumerate(texts)]).selectExpr("*", "'q' as token", "1 as spans")
    got = sorted((r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.scan(frame).collect())
    assert got == sorted((a, b, c, d) for a, b, c, _, d in map(plain, texts))


def test_empty(documents):
    assert secrets.scan(documents([])).collect() == []


def test_query_against_plain_matching(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    rows = QUERIES["op7_secret_scan"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and all(agree(r, texts[r.doc_id]) for r in rows)


def identifier(rng):
    parts = "get set user name count index total value order item list table parse read write file path config load save error handler buffer size max min node tree key map process request response session".split()
    words = [rng.choice(parts) for _ in range(rng.randint(4, 7))]
    return rng.choice(["_".join(words), words[0] + "".join(w.title() for w in words[1:]), "-".join(words)])


def test_models_on_held_out_tokens(spark):
    rng = random.Random(9)
    alphabet = string.ascii_letters + string.digits + "+/"
    random_of = lambda n: ["".join(rng.choice(alphabet) for _ in range(rng.randint(20, 44))) for _ in range(n)]
    train = [(t, True) for t in random_of(400)] + [(identifier(rng), False) for _ in range(400)]
    model = secrets.train(spark.createDataFrame(train, "token string, random boolean"))
    test = {t: True for t in random_of(200)} | {t: False for t in (identifier(rng) for _ in range(200)) if len(t) >= 20}
    scored = secrets.score(spark.createDataFrame([(t,) for t in test], "token string"), model).collect()
    right = sum((r.total >= secrets.MIN_SUM and r.mean >= secrets.MIN_MEAN) == test[r.token] for r in scored)
    assert len(scored) == len(test) and right >= 0.97 * len(test)


def test_method_adds_and_keeps_base_spans(documents):
    rng = random.Random(3)
    alphabet = string.ascii_letters + string.digits
    blob = "".join(rng.choice(alphabet) for _ in range(40))
    known = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(60)]
    rows = [(i, f"the {identifier(rng)} and {identifier(rng)} password={k}") for i, k in enumerate(known)]
    rows += [(100, f"é {blob} token = '{blob}'"), (101, identifier(rng)), (101, blob), (None, blob)]
    out = {}
    for r in secrets.scan(documents(rows)).collect():
        out.setdefault(r.doc_id, []).append(r.spans)
        assert agree(r, dict(rows).get(r.doc_id)) or r.doc_id in (101, None)
    assert out[100] == [f"markov:2:42,assign:43:{52 + 40}"]
    assert sorted(out[101]) == ["", "markov:0:40"] and out[None] == ["markov:0:40"]
    assert all("markov" not in s for i in range(60) for s in out[i])


def test_free_spans_against_all_pairs(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    rows = []
    for i in range(60):
        taken = []
        for order in range(len(secrets.PATTERNS)):
            at = 0
            for _ in range(rng.choice([0, 0, 1, 2, 5, 40])):
                at += rng.randrange(0, 30)
                end = at + rng.randrange(1, 9)
                taken.append((at, order, end, "v"))
                at = end
        spans = [(s, 3, s + rng.randrange(1, 12), "c") for s in rng.sample(range(900), rng.choice([0, 1, 30]))]
        rows.append((i, sorted(spans), sorted(taken)))
    span = "array<struct<start:int,order:int,end:int,value:string>>"
    df = spark.createDataFrame(rows, f"i int, spans {span}, taken {span}")
    got = {r.i: [tuple(s) for s in r.free] for r in df.select("i", secrets._free(F.col("spans"), F.col("taken")).alias("free")).collect()}
    assert got == {i: [c for c in spans if not any(s[0] < c[2] and c[0] < s[2] for s in taken)] for i, spans, taken in rows}
    assert sum(map(len, got.values())) > 100
