"""Weather text lines to typed observations, driven by layout tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import (
    PRESSURE_BOUNDS,
    TENTHS_BOUNDS,
    decode_direction,
    decode_scaled,
)


@dataclass(frozen=True)
class Field:
    """Where a field sits: (first character, length), 1-based, or a token number from 0."""

    name: str
    start: int
    width: int = 0


# Positions in the fixed-width hourly format.
FIXED_WIDTH_LAYOUT = [
    Field("year", 16, 4),
    Field("month", 20, 2),
    Field("day", 22, 2),
    Field("hour", 24, 2),
    Field("minute", 26, 2),
    Field("wind_dir", 61, 3),
    Field("wind_speed", 66, 4),
    Field("air_temp", 88, 5),
    Field("dew_point", 94, 5),
    Field("pressure", 100, 5),
]
# Token numbers in the space-delimited hourly format.
DELIMITED_LAYOUT = [
    Field("year", 0),
    Field("month", 1),
    Field("day", 2),
    Field("hour", 3),
    Field("air_temp", 4),
    Field("dew_point", 5),
    Field("pressure", 6),
    Field("wind_dir", 7),
    Field("wind_speed", 8),
]
DELIMITED_MIN_TOKENS = 12

# output measure -> raw field of the layout
MEASURES = {
    "air_temp_c": "air_temp",
    "dew_point_c": "dew_point",
    "sea_level_pressure_hpa": "pressure",
    "wind_dir_deg": "wind_dir",
    "wind_speed_mps": "wind_speed",
}


def fixed_width_fields(value: Column, layout: list[Field]) -> dict[str, Column]:
    """Integer fields by character position; blanks, signs and junk are handled by the cast."""
    return {f.name: F.substring(value, f.start, f.width).try_cast("int") for f in layout}


def delimited_tokens(value: Column) -> Column:
    return F.split(F.trim(value), r"\s+")


def delimited_fields(tokens: Column, layout: list[Field]) -> dict[str, Column]:
    """Integer fields by token number; a missing token is null, and the minute is the full hour."""
    fields = {f.name: F.get(tokens, F.lit(f.start)).try_cast("int") for f in layout}
    return {"minute": F.lit(0), **fields}


def observation_time(raw: dict[str, Column]) -> Column:
    """Timestamp of the raw date fields; null for impossible or missing parts."""
    parts = [raw[n] for n in ("year", "month", "day", "hour", "minute")]
    return F.try_make_timestamp(*parts, F.lit(0))


def decode_measure(name: str, raw: Column, parity: bool) -> Column:
    if name == "wind_dir_deg":
        return decode_direction(raw)
    # parity: one pair of bounds for every field, which also nulls pressures from 999.0 hPa up
    bounds = PRESSURE_BOUNDS if name == "sea_level_pressure_hpa" and not parity else TENTHS_BOUNDS
    return decode_scaled(raw, bounds=bounds)


TOKENS = "__tokens"


def _observations(df: DataFrame, raw: dict[str, Column], parity: bool) -> DataFrame:
    """Typed rows from the raw fields; rows without a readable time are dropped."""
    passthrough = [c for c in df.columns if c not in ("value", TOKENS)]
    # a projection of their own, so that a field is cut out once for all its uses
    cut = df.withColumns({f"__{n}": c for n, c in raw.items()})
    fields = {n: F.col(f"__{n}") for n in raw}
    measures = [decode_measure(out, fields[src], parity).alias(out) for out, src in MEASURES.items()]
    return cut.select(
        *passthrough,
        observation_time(fields).alias("obs_utc_ts"),
        fields["minute"].alias("obs_minute"),
        *measures,
    ).filter(F.col("obs_utc_ts").isNotNull())


def parse_fixed_width(
    df: DataFrame, layout: list[Field] = FIXED_WIDTH_LAYOUT, parity: bool = False
) -> DataFrame:
    """Observations from fixed-width lines in ``value``; other columns pass through."""
    return _observations(df, fixed_width_fields(F.col("value"), layout), parity)


def parse_delimited(
    df: DataFrame,
    layout: list[Field] = DELIMITED_LAYOUT,
    min_tokens: int = DELIMITED_MIN_TOKENS,
    parity: bool = False,
) -> DataFrame:
    """Observations from space-delimited lines with at least ``min_tokens`` tokens."""
    split = df.withColumn(TOKENS, delimited_tokens(F.col("value")))
    long_enough = split.filter(F.size(TOKENS) >= min_tokens)
    return _observations(long_enough, delimited_fields(F.col(TOKENS), layout), parity)


def parse_by_source(
    df: DataFrame, source: str, fixed: str = "isd", delimited: str = "isd_lite", parity: bool = False
) -> DataFrame:
    """Lines of both formats, told apart by the ``source`` column, in one pass over the files."""
    is_fixed = F.col(source) == fixed
    # tokens exist for delimited lines only
    split = df.withColumn(
        TOKENS, F.when(F.col(source) == delimited, delimited_tokens(F.col("value")))
    )
    known = split.filter(is_fixed | (F.size(TOKENS) >= DELIMITED_MIN_TOKENS))
    wide = fixed_width_fields(F.col("value"), FIXED_WIDTH_LAYOUT)
    short = delimited_fields(F.col(TOKENS), DELIMITED_LAYOUT)
    raw = {n: F.when(is_fixed, c).otherwise(short[n]) for n, c in wide.items()}
    return _observations(known, raw, parity)
