"""Secrets in texts: fixed patterns, and tokens that look random to two character models.

The models are first-order Markov chains over the characters of a token, one of random strings and
one of ordinary identifiers, both counted on labelled samples: values that the patterns found, and
the other tokens of the same texts. A long token outside the patterns' spans is a secret if its
log-likelihood ratio is high enough. Distinct tokens are scored once, by a join of their character
pairs with the models, whose size the alphabet bounds.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.scratch import written
from weatherloom.llm.text import sha256_hex, text_key

#: Pattern and least length, of group 2 for assign and of the match else, in the order of kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
PATTERNS = {
    "assign": (ASSIGN, 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}
KINDS = [*PATTERNS, "markov"]
#: Tokens that the models judge.
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
#: Tokens with a digit are unlabelled from this length on: they may be secrets no pattern knows.
DOUBTFUL = 20
#: Tokens that train the model of ordinary identifiers.
ORDINARY = r"[A-Za-z0-9+/_=-]{4,}"
ALPHABET = 67  # characters of TOKEN, and one for all others
#: Texts, in expectation, from which the models are trained.
SAMPLE = 4000
#: A token is a secret from this sum of log ratios on, and this mean per pair.
MIN_SUM, MIN_MEAN = 12.0, 0.4
#: Weight of a character's own frequency among the counts of its context.
PRIOR = 50.0
_CHUNK = 512
_HALVINGS = 30  # more than the spans of a text can need


def _let(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), fn)[0]


def _spans(text: Column, pattern: str, kind: str, group: int = 0, least: int = 0) -> Column:
    """(start, order, end, value) of the leftmost non-overlapping matches whose group has ``least``
    characters, in code points.

    The pieces between matches and the matches give the places as running sums, which are kept per
    chunk of matches, so that many matches in one text cost little more than few.
    """
    order = KINDS.index(kind)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)
    each = F.zip_with(
        F.arrays_zip(found.alias("m"), value.alias("v")), F.slice(gaps, F.lit(1), F.size(found)),
        lambda m, gap: F.struct(F.length(gap).alias("gap"), F.length(m["m"]).alias("n"), m["v"].alias("v")),
    )
    span = "struct<start:int,order:int,end:int,value:string>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        new = F.struct(start.alias("start"), F.lit(order).alias("order"), (start + x["n"]).alias("end"), x["v"].alias("value"))
        return F.struct((start + x["n"]).alias("at"), F.concat(acc["out"], F.array(new.cast(span))).alias("out"))

    def chunk(acc: Column, k: Column, rows: Column) -> Column:
        part = F.aggregate(
            F.slice(rows, k * _CHUNK + 1, F.lit(_CHUNK)),
            F.struct(acc["at"].alias("at"), F.array().cast(f"array<{span}>").alias("out")), step,
        )
        return F.transform(
            F.array(part),
            lambda p: F.struct(p["at"].alias("at"), F.concat(acc["out"], F.array(p["out"])).alias("out")),
        )[0]

    def placed(rows: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / _CHUNK).cast("int")),
            F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{span}>>").alias("out")),
            lambda acc, k: chunk(acc, k, rows), lambda acc: F.flatten(acc["out"]),
        )

    spans = F.transform(F.array(each), placed)[0]
    none = F.array().cast(f"array<{span}>")
    return F.when(F.regexp(text, F.lit(pattern)), F.filter(spans, lambda s: F.length(s["value"]) >= least)).otherwise(none)


def base_spans(text: Column) -> Column:
    """The patterns' spans of a text, by start, then kind."""
    # runs too short to count are not even looked at: no longer run can start inside one
    found = []
    for kind, (pattern, group, least) in PATTERNS.items():
        if not group:
            head, last = pattern[:-1].rsplit("[", 1)
            pattern = f"{head}[{last}{{{least - len(head)},}}"
        found.append(_spans(text, pattern, kind, group, least))
    return F.sort_array(F.concat(*found))


def _free(spans: Column, taken: Column) -> Column:
    """The spans that touch none of ``taken`` (sorted by start). Spans of one kind do not overlap, so of each kind
    the last one that starts before a span ends, found by halving, is the only one that can reach into it."""

    def clear(c: Column, kind: Column) -> Column:
        last = F.aggregate(
            F.array(*[F.lit(1 << b) for b in reversed(range(_HALVINGS))]),
            F.lit(0),
            lambda n, step: F.when((n + step <= F.size(kind)) & (F.get(kind, n + step - 1)["start"] < c["end"]), n + step).otherwise(n),
        )
        return _let(last, lambda n: (n == 0) | (F.get(kind, n - 1)["end"] <= c["start"]))

    def kept(kinds: Column) -> Column:
        return F.filter(spans, lambda c: F.forall(kinds, lambda kind: (F.size(kind) == 0) | clear(c, kind)))

    kinds = F.transform(F.array(*map(F.lit, range(len(PATTERNS)))), lambda k: F.filter(taken, lambda s: s["order"] == k))
    return F.when((F.size(spans) == 0) | (F.size(taken) == 0), spans).otherwise(_let(kinds, kept))


def _named(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"], s["end"])), ",")


def _pairs(tokens: DataFrame) -> DataFrame:
    """Tokens (token, ...) -> one row per neighbouring pair of characters (a, b)."""
    at = F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("at")
    return tokens.where(F.length("token") > 1).select("*", at).select(
        *tokens.columns, F.expr("substring(token, at, 1)").alias("a"), F.expr("substring(token, at + 1, 1)").alias("b")
    )


@dataclass(frozen=True)
class Models:
    """Counts of both chains: pairs (a, b, r, o), contexts (a, all_r, all_o), characters (b, p_r,
    p_o), and the probabilities of a character that no sample has. r: random, o: ordinary."""

    pairs: DataFrame
    contexts: DataFrame
    characters: DataFrame
    new_r: float
    new_o: float


def train(samples: DataFrame) -> Models:
    """Labelled tokens (token, random boolean) -> the models; no samples give models that agree."""
    r, o = F.sum("r").alias("r"), F.sum("o").alias("o")
    pairs = written(
        _pairs(samples).groupBy("a", "b").agg(
            F.sum(F.col("random").cast("long")).alias("r"), F.sum((~F.col("random")).cast("long")).alias("o")
        ),
        "pair-counts",
    )
    contexts = pairs.groupBy("a").agg(r, o).select("a", F.col("r").alias("all_r"), F.col("o").alias("all_o"))
    n_r, n_o = (x or 0 for x in pairs.agg(r, o).first())
    characters = pairs.groupBy("b").agg(r, o).select(
        "b", ((F.col("r") + 1) / (n_r + ALPHABET)).alias("p_r"), ((F.col("o") + 1) / (n_o + ALPHABET)).alias("p_o")
    )
    return Models(
        pairs, written(contexts, "contexts"), written(characters, "characters"),
        1 / (n_r + ALPHABET), 1 / (n_o + ALPHABET),
    )


def score(tokens: DataFrame, models: Models) -> DataFrame:
    """Distinct tokens (token) -> (token, total, mean) of the log ratios P(b|a, random) over
    P(b|a, ordinary) of their pairs. A chain falls back on the frequency of b by PRIOR counts."""

    def chance(seen: str, total: str, prior: str, new: float) -> Column:
        share = F.coalesce(prior, F.lit(new)) * PRIOR
        return F.log((F.coalesce(seen, F.lit(0)) + share) / (F.coalesce(total, F.lit(0)) + PRIOR))

    ratio = chance("r", "all_r", "p_r", models.new_r) - chance("o", "all_o", "p_o", models.new_o)
    return (
        _pairs(tokens.select("token")).join(models.pairs, ["a", "b"], "left")
        .join(models.contexts, "a", "left").join(models.characters, "b", "left")
        .groupBy("token").agg(F.sum(ratio).alias("total"), F.avg(ratio).alias("mean"))
    )


def labelled_tokens(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Distinct (token, random) from about ``sample`` texts, chosen by hash: the patterns' values are random,
    the other tokens ordinary, but for long ones with digits, which are neither."""
    one_in = max(1, ceil(docs.count() / sample))
    text = F.coalesce("text", F.lit(""))
    picked = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(one_in)) == 0).select(text.alias("t")).select(
        "t", base_spans(F.col("t")).alias("spans")
    )
    values = F.transform("spans", lambda s: F.struct(s["value"].alias("token"), F.lit(True).alias("random")))
    tokens = _free(_spans(F.col("t"), ORDINARY, "markov"), F.col("spans"))
    others = F.transform(
        F.filter(tokens, lambda s: (s["end"] - s["start"] < DOUBTFUL) | ~s["value"].rlike("[0-9]")),
        lambda s: F.struct(s["value"].alias("token"), F.lit(False).alias("random")),
    )
    return picked.select(F.inline(F.concat(values, others))).distinct()


def scan(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): counts per pattern, digest, all spans.

    Null texts are empty and have no spans. Equal texts have equal spans, so rows meet the models'
    verdicts by their text: repeated rows and null or repeated ids do no harm. Extra columns are
    ignored. No rows give no rows; without labelled tokens the models add nothing.
    """
    text = F.coalesce("text", F.lit(""))
    free = _free(_spans(text, TOKEN, "markov"), F.col("base"))
    rows = docs.select("doc_id", *text_key(F.col("text")), "text", base_spans(text).alias("base"))
    rows = written(rows.select("doc_id", "ta", "tb", "base", free.alias("free")), "spans")
    candidates = rows.where(F.size("free") > 0).select("ta", "tb", F.explode("free").alias("span"))
    tokens = candidates.select(F.col("span.value").alias("token")).distinct()
    scored = score(tokens, train(labelled_tokens(docs, sample)))
    secret = written(scored.where((F.col("total") >= MIN_SUM) & (F.col("mean") >= MIN_MEAN)).select("token"), "secrets")
    added = (
        candidates.join(secret, F.col("span.value") == F.col("token"), "left_semi")
        .groupBy("ta", "tb").agg(F.collect_set("span").alias("added"))
    )
    added = written(added, "added-spans")  # few, so that its size decides the join
    count = lambda kind: F.size(F.filter("base", lambda s: s["order"] == KINDS.index(kind))).cast("long")
    whole = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.sort_array(F.concat("base", "added")))
    return rows.join(added, ["ta", "tb"], "left").select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in PATTERNS],
        sha256_hex(_named(F.col("base"))).alias("base_sha256"), _named(whole).alias("spans"),
    )
