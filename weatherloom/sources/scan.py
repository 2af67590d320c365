"""Readers: Parquet, CSV dialects, text lines with provenance from the path."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# CSV dialects of the inputs. A doubled quote escapes a quote inside a field.
CSV_QUOTED = {"header": "true", "multiLine": "true", "escape": '"'}
CSV_PLAIN = {"header": "true"}


def scan(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    **options: str,
) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def scan_csv(
    spark: SparkSession, path: str | list[str], columns: list[str], quoted: bool = False, **options: str
) -> DataFrame:
    """CSV as strings, columns by the names in the header, in whatever order it has them.

    Files read together must share one header. ``quoted`` accepts line breaks inside quotes, at the
    price of one task per file (``csvsplit.scan_csv_split`` has none); plain files are split.
    """
    dialect = CSV_QUOTED if quoted else CSV_PLAIN
    found = scan(spark, path, "csv", **{**dialect, "enforceSchema": "false", **options})
    missing = [c for c in columns if c not in found.columns]
    if missing:
        raise ValueError(f"header of {path} lacks {missing}; it has {found.columns}")
    return found.select(*[F.col(f"`{c}`") for c in columns])


def scan_text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of (gzipped) text with the file they came from.

    Directory names stay plain text in the path (no partition columns are inferred), so a key
    such as 007 is not turned into a number.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("source_file_uri"))


def path_part(uri: Column | str, key: str, dtype: str = "string") -> Column:
    """Value of a ``key=value`` directory in a path; null when absent."""
    c = F.col(uri) if isinstance(uri, str) else uri
    value = F.nullif(F.regexp_extract(c, f"/{key}=([^/]+)/", 1), F.lit(""))
    return value if dtype == "string" else value.try_cast(dtype)


def with_path_parts(
    df: DataFrame, parts: Mapping[str, str], uri: str = "source_file_uri", names: Mapping[str, str] | None = None
) -> DataFrame:
    """Add one column per ``key=value`` directory: ``{key: type}``, optionally renamed."""
    names = names or {}
    return df.withColumns({names.get(k, k): path_part(uri, k, t) for k, t in parts.items()})
