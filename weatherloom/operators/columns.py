"""Schema-level operators: conform, rename, stamp, fill, literal dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom.functions.cleaning import UNKNOWN


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the contract's columns, order and types.

    Extra columns are dropped, absent ones become typed nulls, unreadable values become null.
    """
    have = set(df.columns)

    def column(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in have else F.lit(None)
        return source.try_cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def unique_columns(df: DataFrame) -> DataFrame:
    """Rename repeated column names to name__dup1, name__dup2, ..."""
    seen: dict[str, int] = {}
    names = []
    for name in df.columns:
        n = seen.get(name, 0)
        names.append(name if n == 0 else f"{name}__dup{n}")
        seen[name] = n + 1
    return df.toDF(*names)


def rename_prefix(df: DataFrame, cols: Iterable[str], prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in cols})


def stamp(df: DataFrame, **constants: object) -> DataFrame:
    """Constant provenance columns; run stamps are arguments, never read from the clock here."""
    return df.withColumns({k: F.lit(v) for k, v in constants.items()})


def fill_unknown(df: DataFrame, cols: Sequence[str], value: str = UNKNOWN) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})


# Zone ids found in venue data that are not zone names, and their zone.
ZONE_ALIASES = {"Europe/Frankfurt": "Europe/Berlin", "Europe/Munich": "Europe/Berlin"}


def zone_dimension(spark: SparkSession) -> DataFrame:
    """Zone names Spark's own time functions accept, about 600 rows."""
    rows = sorted((str(z),) for z in spark._jvm.java.time.ZoneId.getAvailableZoneIds())
    if not rows:
        raise RuntimeError("the Java runtime has no time zones")
    return spark.createDataFrame(rows, "zone string")


def normalize_timezone(
    df: DataFrame,
    tz: str,
    out: str,
    valid: DataFrame,
    aliases: Mapping[str, str] = ZONE_ALIASES,
) -> DataFrame:
    """Replace zone aliases, and null zone ids not listed in ``valid(zone)``.

    A left join against the zone list; no zone value travels to the driver. The list is the fixed
    set of zone names (see ``zone_dimension``), so it may be broadcast.
    """
    named = F.col(tz)
    if aliases:
        lookup = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
        named = F.coalesce(F.try_element_at(lookup, F.col(tz)), F.col(tz))
    zones = F.broadcast(valid.select(F.col("zone").alias(out)))
    return (
        df.withColumn("__zone", named)
        .join(zones, F.col("__zone") == F.col(out), "left")
        .drop("__zone")
    )


def literal_dimension(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
