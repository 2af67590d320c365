"""Languages of whole texts, and of spans of mixed ones.

A word's score in a language is the log-likelihood of its characters by a trigram model of that
language. Scripts narrow the candidates: a language that its training texts never write in a
word's script is out for that word. Viterbi over the words, with a penalty for each switch,
labels spans. Most texts are in one language; where no other language gains more than half the
penalty on any stretch of words, one language throughout is the best path and no search is run.

The models are trained on labelled texts: a bounded sample per language, picked by hash from those
outside the held-out part. They are character counts, so their size is bounded by the alphabet of
the sample; the sample's documents are counted by a Spark job, and the table goes to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.llm.batches import sliced
from weatherloom.llm.scratch import written

#: Training texts per language, in expectation.
SAMPLE = 1000
#: Log-likelihood that a switch of language costs.
PENALTY = 20.0
#: Buckets of hashed trigrams.
BUCKETS = 1 << 16
#: What a word in a script foreign to a language scores, per character.
FOREIGN = -12.0
#: A language writes in a script if this share of its training letters is in it.
MIN_SCRIPT_SHARE = 0.001

# First code points of blocks, and the script of each up to the next.
SCRIPTS = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0700, "Other"), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Other"), (0x0B80, "Tamil"), (0x0C00, "Other"),
    (0x0E00, "Thai"), (0x0E80, "Other"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "Other"),
    (0x1C80, "Cyrillic"), (0x1C90, "Georgian"), (0x1CC0, "Other"), (0x1D00, "Latin"), (0x1F00, "Greek"), (0x2000, "Other"),
    (0x2C60, "Latin"), (0x2C80, "Other"), (0x2D00, "Georgian"), (0x2D30, "Other"), (0x3040, "Kana"), (0x3100, "Han"),
    (0x3130, "Hangul"), (0x3190, "Han"), (0x31F0, "Kana"), (0x3200, "Other"), (0x3400, "Han"), (0xA000, "Other"),
    (0xA640, "Cyrillic"), (0xA6A0, "Other"), (0xA720, "Latin"), (0xA800, "Other"), (0xAC00, "Hangul"), (0xD7B0, "Other"),
    (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, "Other"), (0xFE70, "Arabic"),
    (0xFF00, "Latin"), (0xFF60, "Kana"), (0xFFA0, "Hangul"), (0xFFE0, "Other"), (0x20000, "Han"), (0x32000, "Other"),
]
NAMES = sorted({s for _, s in SCRIPTS})
_FIRST = np.array([a for a, _ in SCRIPTS], np.uint32)
_SCRIPT = np.array([NAMES.index(s) for _, s in SCRIPTS], np.int8)


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def tokens(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words: (code points with one zero before each word and at the end, starts and
    ends of the words in it). A word is a run of letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = np.r_[False, _letters()[points], False]
    change = np.flatnonzero(letter[1:] != letter[:-1])
    starts, ends = change[::2], change[1::2]
    lengths = ends - starts
    at = np.cumsum(lengths + 1) - lengths
    packed = np.zeros(int(lengths.sum()) + lengths.size + 1, np.uint32)
    packed[np.repeat(at - np.r_[0, np.cumsum(lengths)[:-1]], lengths) + np.arange(lengths.sum())] = points[letter[1:-1]]
    return packed, at, at + lengths


def trigrams(packed: np.ndarray) -> np.ndarray:
    """Bucket of the trigram around each place; zeros are word borders."""
    x = packed.astype(np.uint64)
    before, after = np.r_[np.uint64(0), x[:-1]], np.r_[x[1:], np.uint64(0)]
    mixed = (before * np.uint64(0x1F123BB5) + x * np.uint64(0x9E3779B1) + after * np.uint64(0x85EBCA77)) & np.uint64(0xFFFFFFFF)
    return ((mixed ^ mixed >> np.uint64(15)) * np.uint64(0x2C1B3C6D) >> np.uint64(8)).astype(np.int64) & (BUCKETS - 1)


class Model:
    """Log-probabilities of trigram buckets per language, and the scripts each writes in."""

    def __init__(self, langs: list[str], counts: np.ndarray, letters: np.ndarray):
        """``counts`` (languages, BUCKETS) and ``letters`` (languages, scripts) of training texts."""
        self.langs = langs
        total = counts.sum(axis=1, keepdims=True)
        self.log_p = np.log((counts + 0.5) / (total + 0.5 * BUCKETS)).T.astype(np.float32)
        self.writes = letters > MIN_SCRIPT_SHARE * np.maximum(letters.sum(axis=1, keepdims=True), 1)

    def word_scores(self, packed: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(words, languages)"""
        scores = np.add.reduceat(self.log_p[trigrams(packed)], starts, axis=0) if starts.size else np.zeros((0, len(self.langs)))
        # reduceat runs up to the next start, and so takes in the border before it: one constant each
        script = _SCRIPT[np.searchsorted(_FIRST, packed[starts], "right") - 1]
        allowed = self.writes[:, script].T
        none = ~allowed.any(axis=1)
        allowed[none] = True  # a script that no language writes narrows nothing
        return np.where(allowed, scores, FOREIGN * (ends - starts + 1)[:, None])


def best_path(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Language index of each word: the path of the greatest sum, less the penalty per switch."""
    n, k = scores.shape
    if not n:
        return np.empty(0, np.int64)
    best = int(scores.sum(axis=0).argmax())
    if k == 1:
        return np.zeros(n, np.int64)
    gain = np.cumsum(scores - scores[:, [best]], axis=0, dtype=np.float64)
    low = np.minimum.accumulate(np.r_[np.zeros((1, k)), gain[:-1]], axis=0)
    if (gain - low).max() <= penalty / 2:
        return np.full(n, best)
    state, back = scores[0].astype(np.float64), np.empty((n, k), np.int64)
    own = np.arange(k)
    for t in range(1, n):
        top = int(state.argmax())
        back[t] = np.where(state >= state[top] - penalty, own, top)
        state = np.maximum(state, state[top] - penalty) + scores[t]
    path = np.empty(n, np.int64)
    path[-1] = int(state.argmax())
    for t in range(n - 1, 0, -1):
        path[t - 1] = back[t][path[t]]
    return path


def judge(text: str | None, model: Model) -> tuple[str, float, list[tuple[int, int, str]]]:
    """(language, score, spans): the language of most letters, its share of them, and the spans as
    (first word, last word, language). ``und`` and zero without letters or without a model."""
    packed, starts, ends = tokens(text or "")
    if not starts.size or not model.langs:
        return "und", 0.0, []
    path = best_path(model.word_scores(packed, starts, ends))
    letters = np.bincount(path, ends - starts, len(model.langs))
    top = int(letters.argmax())
    cuts = np.flatnonzero(np.r_[True, path[1:] != path[:-1]])
    spans = [(int(a), int(b) - 1, model.langs[path[a]]) for a, b in zip(cuts, [*cuts[1:], path.size], strict=True)]
    return model.langs[top], float(letters[top] / letters.sum()), spans


_COUNTS = "lang string, kind int, slot int, n long"


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> counts of this task's trigrams (kind 0) and letters per script (kind 1)."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in sliced(batches):
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            packed, _, _ = tokens(text or "")
            grams, scripts = totals.setdefault(lang, (np.zeros(BUCKETS, np.int64), np.zeros(len(NAMES), np.int64)))
            grams += np.bincount(trigrams(packed), minlength=BUCKETS)
            points = packed[packed > 0]
            scripts += np.bincount(_SCRIPT[np.searchsorted(_FIRST, points, "right") - 1], minlength=len(NAMES))
    for lang, kinds in totals.items():
        for kind, counts in enumerate(kinds):
            slots = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * slots.size, pa.string()), pa.array([kind] * slots.size, pa.int32()),
                 pa.array(slots, pa.int32()), pa.array(counts[slots], pa.int64())],
                ["lang", "kind", "slot", "n"],
            )


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def train(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Model of labelled texts (doc_id, text, lang) outside the held-out part.

    About ``sample`` texts per language, picked by hash, all where there are fewer. Rows without
    language or text do not count. Their counts, at most BUCKETS per language, are the only thing
    the driver receives.
    """
    fit = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "lang", F.xxhash64("doc_id", "text").alias("key"), "text"
    )
    sizes = written(fit.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / sample).alias("one_in")), "languages")
    texts = fit.join(sizes, "lang").where(F.pmod("key", "one_in") == 0).select("lang", "text").distinct()
    rows = texts.mapInArrow(_count, _COUNTS).groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique(), key=lambda s: s.encode())
    counts, letters = np.zeros((len(langs), BUCKETS)), np.zeros((len(langs), len(NAMES)))
    at = rows["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int)
    for kind, table in enumerate((counts, letters)):
        of = (rows["kind"] == kind).to_numpy()
        table[at[of], rows["slot"].to_numpy()[of]] = rows["n"].to_numpy()[of]
    return Model(list(langs), counts, letters)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_spans, spans) of every row of ``docs`` (doc_id, text, ...).

    Only the text is judged. Null and empty texts and texts without letters are ``und`` with score
    zero, as are all if there is no model. ``spans`` has first:last:language by words, comma-joined.
    Repeated rows get equal results; a null doc_id is not held out. Extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x BUCKETS floats

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [judge(t, shared.value) for t in batch.column(2).to_pylist()]
            spans = [",".join(f"{a}:{b}:{lang}" for a, b, lang in s) for *_, s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x for x, *_ in found], pa.string()),
                 pa.array([x for _, x, _ in found], pa.float64()), pa.array([len(s) for *_, s in found], pa.int64()),
                 pa.array(spans, pa.string())],
                ["doc_id", "held_out", "lang_pred", "score", "n_spans", "spans"],
            )

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, n_spans long, spans string"
    )
