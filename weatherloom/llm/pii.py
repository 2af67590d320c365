"""Pseudonyms for personal numbers, dates and addresses that keep their format.

A value found by its pattern and passed by its check (Luhn, mod 97, calendar, ranges) is ranked
among all values of its format and moved by a keyed Feistel permutation of those ranks, so the
pseudonym is a valid value of the same format, equal values get equal pseudonyms in all documents,
and the key's holder can reverse it. Separators stay as they were written.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import warnings
from calendar import monthrange
from collections.abc import Callable, Iterable, Iterator
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from weatherloom.llm.batches import sliced

#: Session setting that holds the key; whoever knows the key can undo the pseudonyms.
KEY_CONF = "spark.weatherloom.pii.key"
#: Stands in where no key is set, for tests and checks. Everybody knows it: it protects nothing.
KEY = b"example key"
ROUNDS = 8
FIRST_DAY, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def permute(rank: int, size: int, key: bytes, tweak: bytes, reverse: bool = False) -> int:
    """A keyed permutation of range(size): balanced Feistel rounds, walked until inside."""
    if size < 2:
        return rank
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    width = (half + 7) // 8
    rounds = range(ROUNDS - 1, -1, -1) if reverse else range(ROUNDS)
    while True:
        left, right = rank >> half, rank & mask
        for i in rounds:
            if reverse:
                left, right = right, left
            block = hashlib.blake2b(
                right.to_bytes(width, "big"), digest_size=width, key=key, salt=b"%d" % i, person=tweak
            ).digest()
            left ^= int.from_bytes(block, "big") & mask
            if not reverse:
                left, right = right, left
        rank = left << half | right
        if rank < size:
            return rank


def _digits(value: str) -> str:
    return "".join(c for c in value if c.isascii() and c.isdigit())


def _refill(value: str, digits: str) -> str:
    """``value`` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(next(rest) if c.isascii() and c.isdigit() else c for c in value)


def _luhn(digits: str) -> int:
    """Luhn sum modulo 10; zero for a valid number."""
    twice = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(twice) + sum(map(int, digits[-1::-2]))) % 10


def _card(value, key, reverse):
    digits = _digits(value)
    if not 13 <= len(digits) <= 19 or _luhn(digits) or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    body = f"{permute(int(digits[:-1]), 10**n, key, b'card', reverse):0{n}d}"
    return _refill(value, body + str(-_luhn(body + "0") % 10))


#: Characters of an IBAN without its spaces, by country.
_IBAN_LENGTHS = {
    country: n
    for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def _mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _iban_end(value):
    """Where the account number at the start of ``value`` ends; the pattern may have taken in words
    behind it. The country's length goes first, then every end of a group, the longest first; zero
    if none passes mod 97."""
    ends = [m.start() for m in re.finditer(r"\x20|\Z", value)][::-1]
    size = {end: end - value.count(" ", 0, end) for end in ends}
    own = _IBAN_LENGTHS.get(value[:2])
    for end in sorted(ends, key=lambda e: size[e] != own):  # stable
        plain = value[:end].replace(" ", "")
        if 15 <= len(plain) <= 34 and _mod97(plain[4:] + plain[:4]) == 1:
            return end
    return 0


def _iban(value, key, reverse):
    """The pseudonym of the number at the start, without the words behind it."""
    end = _iban_end(value)
    if not end:
        return None
    plain, rest = value[:end].replace(" ", ""), value[end:]
    country, account = plain[:2], plain[4:]
    size, rank = 1, 0
    kinds = [(10, "0123456789") if c.isdigit() else (26, "ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in account]
    for c, (n, letters) in zip(account, kinds, strict=True):
        size, rank = size * n, rank * n + letters.index(c)
    while True:  # walked until the pseudonym ends at the same place
        rank, out = permute(rank, size, key, b"iban", reverse), ""
        at = rank
        for n, letters in reversed(kinds):
            at, k = divmod(at, n)
            out = letters[k] + out
        fresh = iter(country + f"{98 - _mod97(out + country + '00'):02d}" + out)
        moved = "".join(c if c == " " else next(fresh) for c in value[:end])
        if _iban_end(moved + rest) == end:
            return moved


def _phone(value, key, reverse):
    """The country code after + stays, all other digits move."""
    lead = re.match(r"\+\d{1,3}(?=\D)|", value)[0]
    digits = _digits(value[len(lead) :])
    if not 7 <= len(digits) <= 14:
        return None
    n = len(digits)
    return lead + _refill(value[len(lead) :], f"{permute(int(digits), 10**n, key, b'phone', reverse):0{n}d}")


def _ssn(value, key, reverse):
    area, group, serial = map(int, value.split("-"))
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rank, serial = divmod(permute(rank, 898 * 99 * 9999, key, b"ssn", reverse), 9999)
    area, group = divmod(rank, 99)
    return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


def _address(value, key, reverse):
    """An IPv4 address; one of a host on the net stays such a one, a local or reserved one likewise."""
    try:
        rank = int(ipaddress.IPv4Address(value))
    except ValueError:
        return None
    while True:  # walked until the pseudonym is of the same kind
        rank = permute(rank, 1 << 32, key, b"ipv4", reverse)
        if ipaddress.IPv4Address(rank).is_global == ipaddress.IPv4Address(value).is_global:
            return str(ipaddress.IPv4Address(rank))


def _day(y: int, m: int, d: int) -> date | None:
    return date(y, m, d) if 1900 <= y < 2100 and 1 <= m <= 12 and 1 <= d <= monthrange(y, m)[1] else None


def _moved(day: date, key: bytes, reverse: bool, least: int = 1) -> date:
    """Another date, walked until its day of the month is ``least`` or more, as that of ``day`` must be."""
    while True:
        day = FIRST_DAY + timedelta(permute((day - FIRST_DAY).days, DAYS, key, b"date", reverse))
        if day.day >= least:
            return day


def _date(parts: str, least: int = 1) -> Callable:
    """Dates whose three numbers come in the order of ``parts``, from "ymd", with days from ``least`` on."""

    def move(value, key, reverse):
        numbers = dict(zip(parts, map(int, re.findall(r"\d+", value)), strict=True))
        day = _day(*(numbers[p] for p in "ymd"))
        if day is None or day.day < least:
            return None
        day = _moved(day, key, reverse, least)
        fresh = {"y": f"{day.year:04d}", "m": f"{day.month:02d}", "d": f"{day.day:02d}"}
        gaps = re.split(r"\d+", value)
        return gaps[0] + "".join(fresh[p] + gap for p, gap in zip(parts, gaps[1:], strict=True))

    return move


_MONTHS = "January February March April May June July August September October November December".split()
_MONTH = "|".join(_MONTHS) + "|" + "|".join(m[:3] for m in _MONTHS if m != "May")


def _named_date(value, key, reverse):
    """A date with the month's name; a name in full stays in full, a short one short, and May is either."""
    name = re.search(_MONTH, value)[0]
    month = next(i for i, m in enumerate(_MONTHS) if m.startswith(name))
    d, y = map(int, re.findall(r"\d+", value))
    day = _day(y, month + 1, d)
    if day is None:
        return None
    day = _moved(day, key, reverse)
    fresh = _MONTHS[day.month - 1]
    if name != "May":  # the pseudonym of May is written in full
        fresh = fresh if name in _MONTHS else fresh[:3]
    out = iter((f"{day.day:02d}" if re.search(r"(?<!\d)0\d(?!\d)", value) else str(day.day), f"{day.year:04d}"))
    return re.sub(r"\d+", lambda _: next(out), value.replace(name, fresh))


def _email(value, key, reverse):
    """Letters and digits of the local part move, case and punctuation stay."""
    local, at, domain = value.rpartition("@")
    kinds = [
        "0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        for c in local if c.isalnum()
    ]
    size, rank = 1, 0
    for c, letters in zip((c for c in local if c.isalnum()), kinds, strict=True):
        size, rank = size * len(letters), rank * len(letters) + letters.index(c)
    rank, out = permute(rank, size, key, b"email", reverse), []
    for letters in reversed(kinds):
        rank, k = divmod(rank, len(letters))
        out.append(letters[k])
    fresh = iter(reversed(out))
    return "".join(next(fresh) if c.isalnum() else c for c in local) + at + domain


# Patterns in the order in which they are tried at a place.
_KINDS: list[tuple[str, str, Callable]] = [
    ("email", r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])", _email),
    ("iban", r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", _iban),
    ("ipv4", r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])", _address),
    ("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])", _ssn),
    ("date", r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}(?![0-9]|[-/.][0-9])", _date("ymd")),
    ("date", r"[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}(?![0-9]|\.[0-9])", _date("dmy")),
    ("date", r"[0-9]{1,2}([-/])[0-9]{1,2}\1[0-9]{4}(?![0-9]|[-/][0-9])", _date("mdy")),
    # no month-first date: the day comes first, and is above 12, as that of the pseudonym
    ("date", r"[0-9]{1,2}([-/])[0-9]{1,2}\1[0-9]{4}(?![0-9]|[-/][0-9])", _date("dmy", 13)),
    ("date", rf"[0-9]{{1,2}}(?:st|nd|rd|th)?\x20(?:of\x20)?(?:{_MONTH})\.?,?\x20[0-9]{{4}}(?![0-9A-Za-z])", _named_date),
    ("date", rf"(?:{_MONTH})\.?\x20[0-9]{{1,2}}(?:st|nd|rd|th)?,?\x20[0-9]{{4}}(?![0-9A-Za-z])", _named_date),
    ("card", r"[0-9]{13,19}(?![0-9A-Za-z]|-[0-9])", _card),
    ("card", r"[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}(?![0-9])", _card),
    ("card", r"[0-9]{4}([\x20-])[0-9]{6}\1[0-9]{4,5}(?![0-9])", _card),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,4}(?![0-9])", _phone),
    ("phone", r"\([0-9]{3}\)\x20?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])", _phone),
    ("phone", r"[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])", _phone),
]
_TRIED = [(kind, re.compile(pattern), move) for kind, pattern, move in _KINDS]
# Where a value may start: no letter, digit or sign of a longer token stands before it.
_PLACE = re.compile(rf"(?<![A-Za-z0-9_@.+-])(?=[0-9(+]|[A-Z]{{2}}[0-9]{{2}}|(?:{_MONTH})\b)|(?<=[A-Za-z0-9])@")
_LOCAL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}\Z")


def find(text: str, key: bytes = KEY, reverse: bool = False) -> Iterator[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of every checked value, left to right."""
    done = 0
    for place in _PLACE.finditer(text):
        start = place.start()
        if place[0] == "@":
            local = _LOCAL.search(text, max(done, start - 64), start)
            if not local:
                continue
            start = local.start()
        if start < done:
            continue
        for kind, pattern, move in _TRIED:
            if (kind == "email") != (place[0] == "@"):
                continue
            if (m := pattern.match(text, start)) and (fresh := move(m[0], key, reverse)) is not None:
                done = start + len(fresh) if kind == "iban" else m.end()
                yield start, done, kind, fresh
                break


def pseudonymise(text: str, key: bytes = KEY, reverse: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with all checked values replaced, and where they stood in it before."""
    out, spans, at = [], [], 0
    for start, end, kind, fresh in find(text, key, reverse):
        out += [text[at:start], fresh]
        spans.append((start, end, kind))
        at = end
    return "".join([*out, text[at:]]), spans


def session_key(spark: SparkSession) -> bytes:
    """The key of the session; without one the example key, with a warning."""
    text = spark.conf.get(KEY_CONF, None)
    if not text:
        warnings.warn(f"{KEY_CONF} is not set: pseudonyms by the example key can be undone by anybody", stacklevel=3)
    return text.encode() if text else KEY


def pseudonyms(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """``docs`` with ``text`` pseudonymised, n_found and ``spans`` (kind:start:end of the original).

    Narrow work, row by row: null stays null, empty stays empty, repeated rows get equal results.
    Columns of ``docs`` other than the text come back unchanged; one named like a column made here
    is replaced by it. Without ``key`` the session's is taken, see :data:`KEY_CONF`.
    """
    key = key or session_key(docs.sparkSession)
    made = ("n_found", "spans")
    base = docs.drop(*made)
    schema = StructType([*base.schema.fields, StructField("n_found", LongType()), StructField("spans", StringType())])
    at = base.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [(None, []) if t is None else pseudonymise(t, key) for t in batch.column(at).to_pylist()]
            columns = [batch.column(i) for i in range(batch.num_columns)]
            columns[at] = pa.array([t for t, _ in found], pa.string())
            columns.append(pa.array([len(s) for _, s in found], pa.int64()))
            columns.append(pa.array([",".join(f"{k}:{a}:{b}" for a, b, k in s) for _, s in found], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *made])

    return base.mapInArrow(run, schema)


def replace_pii(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """``docs`` with its columns as they were, texts pseudonymised and ``n_chars`` kept true."""
    return pseudonyms(docs, key).select(
        *[F.length("text").cast(t).alias(c) if c == "n_chars" else c for c, t in docs.dtypes]
    )
