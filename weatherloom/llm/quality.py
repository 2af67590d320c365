"""Quality rules: base measures of every text, and lines that are too frequent on their host.

Lines are normalised and hashed; for each host (``source``) and hash the distinct documents are
counted, copies of one text as one document, so that a group of copies does not turn its own lines
into boilerplate. Lines above the limit are removed, and documents of which too little remains are
rejected. Two-step aggregates keep a line that every document has from meeting in one task: first
(host, text, line), then (host, line).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.scratch import written
from weatherloom.llm.text import UPPER, WORD_CHAR, free_name, meet, text_key, words

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
#: Percent of words in repeated three-word windows above which a text fails.
MAX_REPEAT_PERCENT = 50
#: Distinct documents of one host that may share a line before it is removed.
MAX_LINE_DOCS = 20
#: Longer lines are often passages, repeated by near copies of documents, of which deduplication
#: keeps one. Only texts that are no near copies count for them: most of their words stand in lines
#: that at most half of MAX_LINE_DOCS distinct texts of the host have.
MAX_LINE_WORDS = 25
#: Percent of a document's words that must remain after the removal.
MIN_LEFT_PERCENT = 5


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once, also where ``fn`` uses it inside lambdas."""
    return F.transform(F.array(value), fn)[0]


def _repeat_words(w: Column) -> Column:
    """Words within three-word windows that occur twice or more."""

    def covered(starts: Column) -> Column:
        second, third = F.transform(starts, lambda x: x + 1), F.transform(starts, lambda x: x + 2)
        return F.size(F.array_distinct(F.concat(starts, second, third)))

    def repeated(grams: Column) -> Column:
        same = lambda x, i: (x["h"] == F.get(grams, i - 1)["h"]) | (x["h"] == F.get(grams, i + 1)["h"])
        return _let(F.transform(F.filter(grams, same), lambda x: x["i"]), covered)

    def gram(i: Column) -> Column:
        return F.struct(F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i"))

    grams = F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), gram))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(_let(grams, repeated))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD_CHAR))


def base_measures(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, source) -> doc_id, host, the text's two hashes, the measures."""
    text = F.coalesce("text", F.lit(""))
    lines = _lines(text)
    measured = docs.select(
        "doc_id",
        F.xxhash64("source").alias("host"),
        *text_key(F.col("text")),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _let(
            words(text),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n"),
                F.length(F.array_join(w, "")).cast("long").alias("chars"),
                _repeat_words(w).cast("long").alias("r"),
            ),
        ).alias("w"),
    )
    n, r = F.col("w.n"), F.col("w.r")
    return measured.select(
        "doc_id", "host", "ta", "tb", n.alias("n_words"), F.col("w.chars").alias("word_chars"), "n_symbols", "n_dup_lines",
        r.alias("n_repeat_words"),
        _failed(n, r).alias("base_failed"),
    )


def normal_lines(text: Column) -> Column:
    """The form in which a text's lines are counted: words with one space between, A-Z lower-cased,
    digits alike. One entry per line, empty where it has no word."""
    other_spaces = "\t\x0b\x0c\r"
    plain = F.translate(text, UPPER + "123456789" + other_spaces, UPPER.lower() + "0" * 9 + " " * len(other_spaces))
    return F.transform(F.split(F.regexp_replace(plain, " {2,}", " "), "\n", -1), lambda x: F.trim(x))


def frequent_lines(docs: DataFrame, max_docs: int = MAX_LINE_DOCS) -> DataFrame:
    """(host, ta, tb, all_words, removed_words, removed): for every distinct text with lines above
    the limit, the number of its words, of those in them, and the lines' hashes."""
    text = F.coalesce("text", F.lit(""))
    line = F.transform(
        F.filter(normal_lines(text), lambda x: x != ""),
        lambda x: F.struct(
            F.xxhash64(x).alias("h"), (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1).alias("w")
        ),
    )

    def marked(lines: Column) -> Column:
        """A row without hash goes ahead: it counts the copies and has the text's words."""
        total = F.aggregate(lines, F.lit(0), lambda n, x: n + x["w"])
        return F.concat(F.array(F.struct(F.lit(None).cast("long").alias("h"), total.alias("w"))), lines)

    units = (
        docs.select(
            F.xxhash64("source").alias("host"),
            *text_key(F.col("text")),
            F.explode(_let(line, marked)).alias("line"),
        )
        .groupBy("host", "ta", "tb", F.col("line.h").alias("h"))
        .agg(F.max("line.w").alias("w"), F.count(F.lit(1)).alias("n"))
    )
    units = written(units, "lines")
    lines = units.where("h is not null")
    counts = lines.groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs"), F.max("w").alias("w"))
    counts = written(counts.where(F.col("docs") > max_docs // 2), "line-counts")
    often = counts.where(F.col("docs") > max_docs)
    long = written(often.where(F.col("w") > MAX_LINE_WORDS).select("host", "h"), "long-lines")
    # texts that have a long frequent line, with the words in all lines that others have too
    text = ["host", "ta", "tb"]
    met = written(lines.join(long, ["host", "h"], "left_semi").select(*text, "h"), "long-line-texts")
    of_met = units.join(met.select(*text).distinct(), text, "left_semi")
    shared = of_met.join(counts.select("host", "h", F.lit(True).alias("shared")), ["host", "h"], "left")
    words_of = shared.groupBy(*text).agg(
        F.sum(F.when(F.col("h").isNotNull(), F.col("w") * F.col("n"))).alias("all"),
        F.sum(F.when(F.col("shared"), F.col("w") * F.col("n"))).alias("shared"),
    )
    own = words_of.where(2 * F.coalesce("shared", F.lit(0)) < F.col("all")).select(*text)
    voted = met.join(own, text, "left_semi").groupBy("host", "h").agg(F.count(F.lit(1)).alias("docs"))
    frequent = often.where(F.col("w") <= MAX_LINE_WORDS).select("host", "h").union(
        voted.where(F.col("docs") > max_docs).select("host", "h")
    )
    hit = units.join(frequent, ["host", "h"], "left_semi").select(units.columns)
    is_mark = F.col("h").isNull()
    return (
        hit.union(units.where(is_mark).select(units.columns))
        .groupBy("host", "ta", "tb")
        .agg(
            F.sum(F.when(~is_mark, F.col("w") * F.col("n"))).alias("all_removed"),
            F.max(F.when(is_mark, F.col("n"))).alias("copies"),
            F.max(F.when(is_mark, F.col("w"))).cast("long").alias("all_words"),
            F.collect_list("h").alias("removed"),
        )
        .where("all_removed > 0")
        .withColumn("removed_words", (F.col("all_removed") / F.col("copies")).cast("long"))
        .select("host", "ta", "tb", "all_words", "removed_words", "removed")
    )


def _failed(n: Column, repeated: Column) -> Column:
    return (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)


def _depleted(n: Column, removed: Column, min_left: int) -> Column:
    return 100 * (n - removed) < min_left * n


def verdicts(docs: DataFrame, max_docs: int = MAX_LINE_DOCS, min_left: int = MIN_LEFT_PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source, ...): measures, base_failed, kept.

    Null text counts as empty and fails. Null sources are one host. Null or repeated ids do not
    matter: rows are told apart by host and text, and equal rows get equal verdicts. Extra columns
    are ignored.
    """
    keys = ["host", "ta", "tb"]
    joined = base_measures(docs).join(frequent_lines(docs, max_docs).select(*keys, "removed_words"), keys, "left")
    removed = F.coalesce("removed_words", F.lit(0))
    return joined.select(
        "doc_id", *keys, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & ~_depleted(F.col("n_words"), removed, min_left)).alias("kept"),
        removed.alias("removed_words"),
    )


def apply_rules(
    docs: DataFrame, clean: bool = False, max_docs: int = MAX_LINE_DOCS, min_left: int = MIN_LEFT_PERCENT
) -> DataFrame:
    """``docs`` without the rejected rows; with ``clean``, texts without the frequent lines too.

    Null, empty and short texts fail the base rules. Null sources are one host. Rows are told apart by
    host and text, so repeated rows and rows with null or equal ids stay or go together. All columns
    stay, whatever their names. The base rules are a filter on the row itself. Depleted texts, few among all, are met by their
    hashes, whatever their ids; their table is written first, so that its size decides the join.
    """
    keys = ["host", "ta", "tb"]
    marks = (F.xxhash64("source"), *text_key(F.col("text")))

    def failed(w: Column) -> Column:
        return _failed(F.size(w), _repeat_words(w))

    lines = frequent_lines(docs, max_docs)
    lines = written(lines, "frequent-lines") if clean else lines
    depleted = written(lines.where(_depleted(F.col("all_words"), F.col("removed_words"), min_left)).select(*keys), "depleted")
    kept = meet(docs.where(~_let(words(F.col("text")), failed)), marks, depleted, "left_anti")
    if not clean:
        return kept
    gone = free_name(docs, "removed")
    rest = _let(normal_lines(F.col("text")), lambda n: F.filter(
        F.split("text", "\n", -1), lambda x, i: (n[i] == "") | ~F.array_contains(gone, F.xxhash64(n[i]))
    ))
    text = F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(rest, "\n"))
    removed = lines.select(*keys, F.col("removed").alias(gone))
    return meet(kept, marks, removed, "left").withColumn("text", text).select(docs.columns)
