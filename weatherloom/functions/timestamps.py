"""Text to UTC timestamps: format chains, local times, source priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import as_column, first_match

# Accepted text formats. Offsets written as +00:00 need the XXX pattern.
UTC_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ssX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSX",
    "yyyy-MM-dd'T'HH:mm:ssXXX",
    "yyyy-MM-dd'T'HH:mm:ss.SSSXXX",
]
LOCAL_FORMATS = [
    "M/d/yy, H:mm:ss",
    "M/d/yyyy, H:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
]
CLOCK_PATTERN = r"^(\d{1,2}:\d{2}:\d{2})$"
DATED_CLOCK_FORMAT = "yyyy-MM-dd H:mm:ss"
PLAUSIBLE_YEARS = (1990, 2030)


def _literals(fmt: str) -> set[str]:
    """Characters any text of the format must hold: quoted ones and punctuation."""
    if "[" in fmt:  # optional parts
        return set()
    quoted = fmt.split("'")[1::2]
    plain = "".join(fmt.split("'")[0::2])
    return {ch for ch in plain if not ch.isalpha()} | set("".join(quoted))


def _could_read(text: Column, fmt: str) -> Column:
    """False for texts the format cannot read; far cheaper than trying."""
    out = F.lit(True)
    for ch in sorted(_literals(fmt)):
        out = out & text.contains(ch)
    return out


def parse_ts(c: Column | str, formats: Sequence[str]) -> Column:
    """First format that reads the text; null when none does."""
    text = as_column(c)
    return F.coalesce(
        *[F.when(_could_read(text, f), F.try_to_timestamp(text, F.lit(f))) for f in formats]
    )


def compose_ts(date: Column | str, clock: Column | str) -> Column:
    """A bare H:mm:ss clock text on the given date; null for any other text."""
    hms = F.nullif(F.regexp_extract(as_column(clock), CLOCK_PATTERN, 1), F.lit(""))
    day = F.date_format(as_column(date), "yyyy-MM-dd")
    # concat, unlike concat_ws, is null when either part is
    return F.try_to_timestamp(F.concat(day, F.lit(" "), hms), F.lit(DATED_CLOCK_FORMAT))


def to_utc(local: Column | str, tz: Column | str) -> Column:
    """Wall-clock time in zone ``tz`` to UTC; null when either is missing."""
    return F.to_utc_timestamp(as_column(local), as_column(tz))


def clamp_year(c: Column | str, low: int = PLAUSIBLE_YEARS[0], high: int = PLAUSIBLE_YEARS[1]) -> Column:
    value = as_column(c)
    return F.when(F.year(value).between(low, high), value)


def text_to_utc(text: Column | str, date: Column | str, tz: Column | str) -> Column:
    """UTC time of a free-form time text: explicit UTC forms win over local forms."""
    trimmed = F.trim(as_column(text).cast("string"))
    local = F.coalesce(parse_ts(trimmed, LOCAL_FORMATS), compose_ts(date, trimmed))
    return clamp_year(F.coalesce(parse_ts(trimmed, UTC_FORMATS), to_utc(local, tz)))


def first_ts(labelled: Sequence[tuple[str, Column]], default: str = "none") -> tuple[Column, Column]:
    """(timestamp, label) of the first filled candidate."""
    ts = F.coalesce(*[c for _, c in labelled])
    label = first_match([(c.isNotNull(), F.lit(name)) for name, c in labelled], F.lit(default))
    return ts, label
