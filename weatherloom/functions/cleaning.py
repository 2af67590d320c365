"""Column helpers for cleaning, keying, flagging and binning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_match(branches: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """Value of the first true branch; ``default`` when none holds."""
    out = None
    for condition, value in branches:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return default if out is None else out.otherwise(default)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(as_column(c)), F.lit(""))


def composite_key(parts: Sequence[tuple[Column | str, int]], sep: str = "-") -> Column:
    """Zero-padded, fixed-width parts joined by ``sep``."""
    padded = [F.lpad(F.trim(as_column(c).cast("string")), width, "0") for c, width in parts]
    return F.concat_ws(sep, *padded)


def yyyymmdd_year(c: Column | str) -> Column:
    return F.floor(as_column(c) / F.lit(10000)).cast("int")


def repair_sign(c: Column | str, applies: Column | None = None) -> Column:
    """Negate positive values where ``applies`` holds (western longitudes typed as eastern)."""
    value = as_column(c)
    wrong = value > 0
    if applies is not None:
        wrong = wrong & applies
    return F.when(wrong, -value).otherwise(value)


# Ordered text rules for venue roofs, (how, text, result).
ROOF_RULES = [
    ("contains", "retract", "retractable"),
    ("contains", "dome", "dome"),
    ("equals", "closed", "closed"),
    ("equals", "open", "open"),
    ("contains", "out", "outdoors"),
]


def normalize_category(
    c: Column | str,
    rules: Sequence[tuple[str, str, str]] = ROOF_RULES,
    default: str = "unknown",
) -> Column:
    """First rule that fits the lower-cased text decides; blanks and the rest get ``default``."""
    text = F.lower(F.trim(as_column(c)))
    branches = [
        (text.contains(needle) if how == "contains" else text == needle, F.lit(result))
        for how, needle, result in rules
    ]
    return first_match(branches, F.lit(default))


# Roof text to environment bin. ``contains`` rules come before the exact sets.
ROOF_ENV_CONTAINS = {"retract": "RETRACTABLE"}
ROOF_ENV_EQUALS = {
    "INDOOR": ["dome", "indoors", "indoor", "closed"],
    "OUTDOOR": ["outdoors", "outdoor", "open"],
}


def bin_category(
    c: Column | str,
    contains: Mapping[str, str] = ROOF_ENV_CONTAINS,
    equals: Mapping[str, Sequence[str]] = ROOF_ENV_EQUALS,
    default: str = UNKNOWN,
) -> Column:
    text = F.lower(as_column(c))
    branches = [(text.contains(needle), F.lit(label)) for needle, label in contains.items()]
    branches += [(text.isin(*values), F.lit(label)) for label, values in equals.items()]
    return first_match(branches, F.lit(default))


def bin_numeric(
    c: Column | str, edges: Sequence[float], labels: Sequence[str], unknown: str = UNKNOWN
) -> Column:
    """Lower-inclusive bins; ``len(labels) == len(edges) + 1``; null gives ``unknown``."""
    if len(labels) != len(edges) + 1:
        raise ValueError("bin_numeric needs one label more than edges")
    value = as_column(c)
    branches = [(value.isNull(), F.lit(unknown))]
    branches += [(value < F.lit(edge), F.lit(label)) for edge, label in zip(edges, labels)]
    return first_match(branches, F.lit(labels[-1]))


def flag(c: Column | str, value: object = 1) -> Column:
    """1 where the column equals ``value``, else 0 (null gives 0)."""
    return F.when(as_column(c).try_cast("int") == F.lit(value), 1).otherwise(0)


def present_flag(*cols: Column | str) -> Column:
    """1 where at least one of the columns is filled."""
    return F.when(any_present(*cols), 1).otherwise(0)


def any_present(*cols: Column | str) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | as_column(c).isNotNull()
    return out


def all_present(*cols: Column | str) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & as_column(c).isNotNull()
    return out


def side_value(
    side: Column | str, home: Column | str, away: Column | str,
    home_value: Column | str, away_value: Column | str,
) -> Column:
    """Value of the side a row belongs to; null for neither."""
    return F.when(as_column(side) == as_column(home), as_column(home_value)).when(
        as_column(side) == as_column(away), as_column(away_value)
    )


# Missing-value bounds of the integer-tenths weather fields. The pressure field is
# five digits wide, so its own missing mark is 99999 and 9990..10999 are ordinary readings.
TENTHS_BOUNDS = (-9990, 9990)
PRESSURE_BOUNDS = (-9990, 99990)
DIRECTION_LIMIT = 999


def decode_scaled(
    c: Column | str, scale: float = 10.0, bounds: tuple[int, int] = TENTHS_BOUNDS
) -> Column:
    """Scaled integer to double; values at or beyond either bound mean missing."""
    raw = as_column(c)
    low, high = bounds
    return F.when((raw > F.lit(low)) & (raw < F.lit(high)), raw.cast("double") / F.lit(scale))


def decode_direction(c: Column | str) -> Column:
    raw = as_column(c)
    return F.when((raw >= 0) & (raw < F.lit(DIRECTION_LIMIT)), raw.cast("double"))


def safe_ratio(numer: Column | str, denom: Column | str) -> Column:
    """Quotient as double; null unless the denominator is positive."""
    n, d = as_column(numer), as_column(denom)
    return F.when(d > 0, n.cast("double") / d.cast("double"))


def in_range(c: Column | str, low: float, high: float) -> Column:
    return as_column(c).between(F.lit(low), F.lit(high))


def covers(begin: Column | str, end: Column | str, low: int, high: int) -> Column:
    """The [begin, end] span includes [low, high]."""
    return (as_column(begin) <= F.lit(low)) & (as_column(end) >= F.lit(high))


def in_domain(c: Column | str, values: Sequence[object]) -> Column:
    return as_column(c).isin(*values)


def outside(c: Column | str, low: float, high: float) -> Column:
    """True for a filled value beyond the bounds; false (never null) for the rest."""
    value = as_column(c)
    return F.coalesce((value < F.lit(low)) | (value > F.lit(high)), F.lit(False))


def ones(condition: Column) -> Column:
    """0/1 of a predicate, null counted as 0; summable."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
