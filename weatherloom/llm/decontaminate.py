"""Benchmark contamination by a positional inverted index of the training texts.

The index holds postings (term, document, position, words around it) of the terms that benchmark
windows are looked up by: the rarest ones of each window, by their frequency in the training
texts. A lookup joins windows with the postings of their rare terms, shifts each posting by the
term's place in the window, and keeps the starts on which the shifted lists agree. The words kept
with a posting then decide exactly, so no text is read or shuffled again. The benchmark is the
small side by nature, but nothing relies on it: sides are broadcast only below Spark's size check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherloom.llm.scratch import written
from weatherloom.llm.text import UPPER, meet, sha256_hex, text_key

WINDOW = 13
#: Rare terms of a window whose shifted posting lists are intersected.
RARE_TERMS = 2
#: Postings are made from pieces of so many words, which carry the words around them.
PIECE = 24
#: One word in so many must be hit for a document to count as contaminated.
ONE_IN = 20

#: A word: digits, letters and all characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# The characters that end a word.
_BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def terms(text: Column) -> Column:
    """The :data:`TERM` words, A-Z lower-cased; none for null."""
    plain = F.translate(F.coalesce(text, F.lit("")), UPPER + _BREAKS, UPPER.lower() + " " * len(_BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, window, words): every run of ``width`` words; a shorter text is one window.

    Windows are numbered over the distinct texts they have, so equal windows share a number.
    """
    w = F.col("w")
    last = F.greatest(F.size(w) - width, F.lit(0))
    return (
        items.select(F.col("item_id").cast("string").alias("item_id"), terms(F.col("text")).alias("w"))
        .where(F.size(w) > 0)
        .select("item_id", "w", F.explode(F.sequence(F.lit(0), last)).alias("at"))
        .select("item_id", F.slice(w, F.col("at") + 1, F.lit(width)).alias("words"))
        .distinct()
        .withColumn("window", F.xxhash64("words"))
    )


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, n): occurrences in the training texts of the terms of ``vocabulary`` (term)."""
    found = docs.select(F.explode(terms(F.col("text"))).alias("term")).join(vocabulary, "term", "left_semi")
    counted = found.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary.join(counted, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"))


def rare_terms(probes: DataFrame, counts: DataFrame, k: int = RARE_TERMS) -> DataFrame:
    """(window, words, term, offset, rank, n_terms): of each window the ``k`` places of rarest terms."""
    placed = probes.select("window", "words").distinct().select(
        "window", "words", F.posexplode("words").alias("offset", "term")
    )
    order = Window.partitionBy("window", "words").orderBy("n", "offset")
    return (
        placed.join(counts, "term")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("window", "words", "term", "offset", "rank", F.least(F.size("words"), F.lit(k)).alias("n_terms"))
    )


def anchor_terms(rare: DataFrame) -> DataFrame:
    """(term, back, ahead): the terms to index, and how many words around them lookups may need."""
    return rare.groupBy("term").agg(
        F.max("offset").alias("back"), F.max(F.size("words") - F.col("offset")).alias("ahead")
    )


def build_index(docs: DataFrame, anchors: DataFrame, reach: int = WINDOW - 1) -> DataFrame:
    """Postings (term, ta, tb, pos, around, before) of the terms of ``anchors``.

    ``around`` has the words from ``back`` before the posting to ``ahead`` from it on, within
    ``reach`` and the text; ``before`` of them come before the posting.
    """
    start = F.col("piece") * PIECE
    low = F.greatest(start - reach, F.lit(0))
    pieces = (
        docs.select(*text_key(F.col("text")), terms(F.col("text")).alias("w")).where(F.size("w") > 0)
        .select("ta", "tb", "w", F.explode(F.sequence(F.lit(0), F.floor((F.size("w") - 1) / PIECE).cast("int"))).alias("piece"))
        .select(
            "ta", "tb", start.alias("start"), low.alias("low"),
            F.slice("w", low + 1, start - low + PIECE + reach).alias("piece_words"),
        )
    )
    core = F.slice("piece_words", F.col("start") - F.col("low") + 1, F.lit(PIECE))
    at = F.col("start") - F.col("low") + F.col("k")
    before = F.least("back", at)
    return (
        pieces.select("*", F.posexplode(core).alias("k", "term")).join(anchors, "term")
        .select(
            "term", "ta", "tb", (F.col("start") + F.col("k")).alias("pos"),
            F.slice("piece_words", at - before + 1, before + F.col("ahead")).alias("around"), before.alias("before"),
        )
    )


def phrase_matches(index: DataFrame, rare: DataFrame) -> DataFrame:
    """(window, ta, tb, start, length): every exact occurrence of a window.

    The shifted posting lists of a window's rare terms meet on (text, window, start); where all of
    them agree, the words around the posting are compared with the window's.
    """
    at = F.col("before") - F.col("offset")
    same = F.slice("around", at + 1, F.size("words")) == F.col("words")
    return (
        index.join(rare, "term")
        .where((F.col("pos") >= F.col("offset")) & (at >= 0))
        .select(
            "window", F.size("words").alias("length"), "ta", "tb", (F.col("pos") - F.col("offset")).alias("start"),
            F.expr("shiftleft(1, rank - 1)").alias("bit"), "n_terms", same.alias("same"),
        )
        .groupBy("window", "length", "ta", "tb", "start")
        .agg(F.max("n_terms").alias("n_terms"), F.bit_or("bit").alias("agree"), F.max("same").alias("same"))
        .where("agree = shiftleft(1, n_terms) - 1 and same").select("window", "ta", "tb", "start", "length")
    )


def proximity_matches(index: DataFrame, rare: DataFrame, slop: int = 3) -> DataFrame:
    """(window, ta, tb, start): texts in which the two rarest terms of a window stand as in the
    window, give or take ``slop`` words. Exact for windows whose two rarest terms differ."""
    placed = index.join(rare, "term").select(
        "window", "term", "offset", "ta", "tb", (F.col("pos") - F.col("offset")).alias("start")
    )
    # two starts at most slop apart share a bucket of slop + 1 starts or touch neighbouring ones
    bucket = F.floor(F.col("start") / (slop + 1))
    first = placed.withColumn("bucket", F.explode(F.array(bucket - 1, bucket, bucket + 1)))
    other = placed.select(
        "window", "ta", "tb", F.col("offset").alias("o"), F.col("start").alias("s"), bucket.alias("bucket")
    )
    return (
        first.join(other, ["window", "ta", "tb", "bucket"])
        .where((F.col("offset") < F.col("o")) & (F.abs(F.col("start") - F.col("s")) <= slop))
        .select("window", "ta", "tb", "start").distinct()
    )


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): its words inside occurrences of windows of
    ``items`` (item_id, text), the items met, and whether it is contaminated.

    Null and empty texts have no words and are clean; null and empty items have no windows. Rows
    meet their hits by their text, so repeated rows and null or repeated ids come back as they are.
    Extra columns are ignored; an empty table on either side gives no hits.
    """
    keys = ["ta", "tb"]
    probes = written(windows(items), "windows")
    vocabulary = written(probes.select(F.explode("words").alias("term")).distinct(), "vocabulary")
    counts = term_counts(docs, vocabulary)
    rare = written(rare_terms(probes, counts), "rare-terms")
    anchors = written(anchor_terms(rare), "anchors")
    index = written(build_index(docs, anchors), "index")
    matches = written(phrase_matches(index, rare), "matches")
    # words covered: each span adds what lies beyond the spans before it
    covered = F.aggregate(
        F.sort_array("spans"),
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(x["start"] + x["length"] - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("n"),
            F.greatest(acc["end"], x["start"] + x["length"]).alias("end"),
        ),
        lambda acc: acc["n"],
    )
    hits = matches.groupBy(*keys).agg(F.collect_set(F.struct("start", "length")).alias("spans")).select(
        *keys, covered.cast("long").alias("n_hit")
    )
    met = (
        matches.select("window", *keys).distinct().join(probes.select("window", "item_id"), "window")
        .groupBy(*keys).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .select(*keys, F.size("items").cast("long").alias("n_items"), F.array_join("items", ",").alias("ids"))
    )
    rows = docs.select(
        "doc_id", *text_key(F.col("text")),
        F.coalesce(F.regexp_count("text", F.lit(TERM)), F.lit(0)).cast("long").alias("n_words"),
    )
    n_hit = F.coalesce("n_hit", F.lit(0))
    found = written(hits.join(met, keys), "hits")  # texts with a hit only, so that its size decides the join
    return rows.join(found, keys, "left").select(
        "doc_id", *keys, "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        sha256_hex(F.coalesce("ids", F.lit(""))).alias("items_sha256"),
        ((n_hit > 0) & (ONE_IN * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows. Their texts' names are written first, so that their
    size decides the join.

    Rows are told apart by their text: repeated rows and rows with null or equal ids stay or go by it.
    Null and empty texts stay. All columns stay, whatever their names.
    """
    bad = written(contamination(docs, items).where("contaminated").select("ta", "tb").distinct(), "contaminated")
    return meet(docs, text_key(F.col("text")), bad, "left_anti")
