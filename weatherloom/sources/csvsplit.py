"""Quoted CSV read by several tasks a file, line breaks inside quotes included.

Whether a line break ends a record depends on how many quotes stand before it in its file. A first pass
counts the quotes of every split, running sums over the splits of a file tell whether a split begins
inside a field, and each split then numbers its own records. What a split cuts off of a record is joined
to the split in which that record began.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom.sources.sink import materialize

_SPLIT = ["__file", "__start"]


def _quotes() -> F.Column:
    text = F.col("value")
    return F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their split. Only a line feed ends one, so other breaks inside a field stay as they are.
    ``__at`` orders the lines of a split, which one task reads from front to back."""
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__start"),
        F.monotonically_increasing_id().alias("__at"),
    )


def _openings(lines: DataFrame) -> DataFrame:
    """Splits with ``__open``: 1 where a split begins inside a quoted field. One row a split."""
    splits = materialize(lines.groupBy(*_SPLIT).agg(F.sum(_quotes()).alias("__quotes")), "csv_splits")
    odd = splits.groupBy("__file").agg(F.sum("__quotes").alias("n")).filter("n % 2 = 1").select("__file").limit(1).collect()
    if odd:
        raise ValueError(f"{odd[0][0]}: a quote is not closed, or stands inside a field without quotes")
    before = Window.partitionBy("__file").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(*_SPLIT, (F.coalesce(F.sum("__quotes").over(before), F.lit(0)) % 2).alias("__open"))


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row a record: ``value``, its text, and ``is_first`` for the first record of its file.

    Quotes are doubled inside quoted fields and stand nowhere else. A split sorts its lines, so no task
    holds more than a split and a record; a record may span any number of splits. Texts go once to the
    scratch folder, by split; only the first and last record of each split meet those of other splits.
    """
    opening = _openings(_lines(spark, path))
    split = Window.partitionBy(*_SPLIT)
    sofar = split.orderBy("__at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = split.orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    lines = _lines(spark, path).join(opening, _SPLIT)
    inside = (F.col("__open") + F.coalesce(F.sum(_quotes()).over(earlier), F.lit(0))) % 2
    lines = lines.withColumn("__begins", (inside == 0).cast("int"))
    lines = lines.withColumn("__record", F.sum("__begins").over(sofar))
    parts = F.array_sort(F.collect_list(F.struct("__at", "value")))
    text = F.array_join(F.transform(parts, lambda p: p["value"]), "\n")
    ended = Window.partitionBy(*_SPLIT)
    pieces = lines.groupBy(*_SPLIT, "__record").agg(text.alias("value"))
    pieces = pieces.withColumn("__edge", (F.col("__record") == 0) | (F.col("__record") == F.max("__record").over(ended)))
    pieces = materialize(pieces, "csv_pieces")

    of_file = Window.partitionBy("__file").orderBy("__start", "__record")
    edges = pieces.filter("__edge").withColumn("__owner", F.sum((F.col("__record") > 0).cast("int")).over(of_file))
    parts = F.array_sort(F.collect_list(F.struct("__start", "__record", "value")))
    joined = edges.groupBy("__file", "__owner").agg(parts.alias("p"))
    joined = joined.select(
        F.array_join(F.transform("p", lambda p: p["value"]), "\n").alias("value"),
        ((F.col("p")[0]["__start"] == 0) & (F.col("p")[0]["__record"] == 1)).alias("is_first"),
    )
    whole = pieces.filter("not __edge").select("value", ((F.col("__start") == 0) & (F.col("__record") == 1)).alias("is_first"))
    records = whole.unionByName(joined)
    # Windows files end their records with a carriage return, and some begin with a byte order mark
    bare = F.regexp_replace("value", r"\r$", "")
    bare = F.when(F.col("is_first"), F.regexp_replace(bare, r"^\x{FEFF}", "")).otherwise(bare)
    return records.select(bare.alias("value"), "is_first")


def scan_csv_split(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """Quoted CSV as strings, columns by the names in the header, each file read in splits.

    The rows are those of ``scan_csv(quoted=True)``: empty lines are no rows, short rows end in nulls, and an
    empty field is null, quoted or not. All files must have one header, read from their first records. Empty
    files add nothing; if there is no header at all, or it lacks one of ``columns`` or has it twice,
    ``ValueError``.
    """
    records = csv_records(spark, path)
    headers = [r.value for r in records.filter("is_first").select("value").distinct().limit(2).collect()]
    if len(headers) != 1:
        raise ValueError(f"{path}: {'no header' if not headers else f'different headers: {headers}'}")
    names = next(csv.reader([headers[0]]), [])
    wrong = [c for c in columns if names.count(c) != 1]
    if wrong:
        raise ValueError(f"header of {path} must have {wrong} once; it has {names}")
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    options = {"escape": '"', "multiLine": "true"}
    row = F.from_csv("value", schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), options)
    rows = records.filter("not is_first and value <> ''").select(row.alias("r"))
    return rows.select(*[F.col("r")[f"c{names.index(c)}"].alias(c) for c in columns])
