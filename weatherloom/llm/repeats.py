"""Passages that stand in more than one place: the earliest stays, the others go.

Units are lines, cut further at the ends of sentences so that a passage inside a line is found.
They are normalised and hashed, digests are grouped over the whole corpus, and the occurrence of
the least rank (doc_id, text, place) is kept. Consecutive repeated units form a run; runs of enough
words are removed, with their offsets in the original text. Every unit counts, however short, but
once for each run, so a stock phrase said over and over is no passage. Scripts without spaces count
in characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weatherloom.llm.batches import sliced
from weatherloom.llm.scratch import written

#: Words of a run of repeated units from which on it is removed.
MIN_WORDS = 25
#: Characters of scripts without spaces that stand for a word.
WORD_CHARS = 2
# Thai and Lao, Tibetan, Burmese, Khmer, kana, and Chinese characters
UNSPACED = "\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0002fa1f"
_UNSPACED = re.compile(f"[{UNSPACED}]")
_LOW = (1 << 64) - 1
_CUT = re.compile(r"\n|(?<=[.!?])[ \t]+")
_UNITS = "doc_id long, text_hash long, n int, start int, end int, n_words int, size int, before int, da long, db long"


def split_units(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, normal form) of the units that have a word."""
    start = 0
    for m in [*_CUT.finditer(text), None]:
        end = m.start() if m else len(text)
        if normal := " ".join(text[start:end].lower().split()):
            yield start, end, normal
        start = m.end() if m else end


def unit_size(normal: str) -> int:
    """Words of a unit, or what its characters of unspaced scripts stand for, if that is more."""
    words = normal.count(" ") + 1
    return words if normal.isascii() else max(words, len(_UNSPACED.findall(normal)) // WORD_CHARS)


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _UNITS.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}
    types = [kinds[x.split()[1]] for x in _UNITS.split(", ")]
    for batch in sliced(batches):
        columns: list[list] = [[] for _ in names]
        for doc, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            seen: dict[int, int] = {}  # where the text had a unit last
            for n, (start, end, normal) in enumerate(split_units(text or "")):
                digest = xxhash.xxh3_128_intdigest(normal.encode())
                halves = (x - (x >> 63 << 64) for x in (digest >> 64, digest & _LOW))
                row = (doc, key, n, start, end, normal.count(" ") + 1, unit_size(normal), seen.get(digest, -1), *halves)
                seen[digest] = n
                for column, x in zip(columns, row, strict=True):
                    column.append(x)
            if len(columns[0]) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
                columns = [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def units(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text").mapInArrow(_units, _UNITS)


def _rank() -> Column:
    """doc_id (null last), then 24 bits of the text's hash, then the place, as one number: a fixed-width
    minimum, which needs no sort."""
    doc = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit("9223372036854775808").cast("decimal(20,0)"))
    place = F.shiftleft(F.col("text_hash").bitwiseAND(0xFFFFFF), 31) + F.col("n")
    return (doc * F.lit(1 << 55).cast("decimal(17,0)") + place).cast("decimal(38,0)")


def repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, first_doc_id, start, end, n_units, n_words, text_hash): the spans to remove, code
    points of the original text; first_doc_id is the least document in which a unit of the span stays.

    Rows alike in id and text are one document. Null and empty texts have no units. A null doc_id
    ranks after all others. Extra columns are ignored.
    """
    found = written(units(docs), "units")
    digest = ["da", "db"]
    seen = found.withColumn("rank", _rank()).groupBy(*digest).agg(
        F.min("rank").alias("first"), F.max("rank").alias("last"), F.min("doc_id").alias("first_doc_id")
    ).where("first < last").select(*digest, "first", "first_doc_id")
    # written, so that the join deals both sides out anew and can split a unit that every text has
    seen = written(seen, "repeated-units")
    again = (
        found.join(seen, digest).where(_rank() > F.col("first"))
        .select("doc_id", "text_hash", "n", "start", "end", "n_words", "size", "before", "first_doc_id").distinct()
    )
    text = ["doc_id", "text_hash"]
    in_order = Window.partitionBy(*text).orderBy("n")
    opens = F.when(F.coalesce(F.col("n") - F.lag("n").over(in_order), F.lit(0)) != 1, F.col("n"))
    # a unit counts where it stands for the first time in its run
    counted = F.when(F.col("before") < F.col("run"), F.col("size")).otherwise(0)
    return (
        again.withColumn("opens", opens).withColumn("run", F.max("opens").over(in_order)).groupBy(*text, "run")
        .agg(
            F.min("first_doc_id").alias("first_doc_id"), F.min("start").alias("start"), F.max("end").alias("end"),
            F.count(F.lit(1)).alias("n_units"), F.sum("n_words").alias("n_words"), F.sum(counted).alias("counted"),
        )
        .where(F.col("counted") >= min_words)
        .select("doc_id", "first_doc_id", "start", "end", "n_units", "n_words", "text_hash")
    )


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the spans cut out of ``text``, and ``removed``, their original offsets.

    Texts without repeats, null and empty ones included, stay as they are, with no offsets.
    """
    spans = repeats(docs, min_words).groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans")
    ).select("doc_id", "text_hash", "spans")
    # the row's columns in a struct: no name of theirs can clash
    row, text = F.col("row"), F.col("row.text")
    ends = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["end"]))
    starts = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.length(text)))
    kept = F.array_join(F.zip_with(ends, starts, lambda a, b: F.substring(text, a + 1, b - a)), "")
    no_spans = F.array().cast("array<struct<start:int,end:int>>")
    docs = docs.drop("removed")
    return (
        docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
        .join(spans, row["doc_id"].eqNullSafe(F.col("doc_id")) & (F.xxhash64(text) == F.col("text_hash")), "left")
        .withColumn("cut", F.when(F.col("spans").isNull(), text).otherwise(kept))
        .select(
            *[(F.col("cut") if c == "text" else row[c]).alias(c) for c in docs.columns],
            F.coalesce("spans", no_spans).alias("removed"),
        )
    )
