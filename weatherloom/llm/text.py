"""Column helpers on whole texts, all on built-in functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters between words: space and \x09 to \x0D; and all others.
SPACE, WORD_CHAR = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(text: Column) -> Column:
    """The runs of characters other than :data:`SPACE`, in order; an empty array for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{SPACE}+"), "")


def n_words(text: Column) -> Column:
    """Number of :func:`words`; zero for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{WORD_CHAR}+")), F.lit(0)).cast("long")


def text_key(text: Column) -> tuple[Column, Column]:
    """Two hashes that name a text; null and empty have names of their own."""
    return F.xxhash64(text, F.lit(0)).alias("ta"), F.xxhash64(F.lit(1), text).alias("tb")


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "utf-8"), 256)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name, that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def meet(df: DataFrame, marks: Sequence[Column], table: DataFrame, how: str) -> DataFrame:
    """Join ``df`` to ``table`` where its first columns equal ``marks``, nulls included; of ``table`` only
    the columns behind them come along. No name in ``df`` can clash with those of the keys."""
    names = [free_name(df, f"_mark{i}") for i in range(len(marks))]
    named = table.withColumnsRenamed(dict(zip(table.columns, names, strict=False)))
    joined = df.join(named, [m.eqNullSafe(F.col(n)) for m, n in zip(marks, names, strict=True)], how)
    return joined if how.startswith("left_") else joined.drop(*names)
