from __future__ import annotations

import re
from datetime import date

import pyarrow.parquet as pq
import pytest

from weatherloom.llm import pii
from weatherloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VALID = {
    "email": ["die.55@mail4.example.com", "A_b+c@x-y.org"],
    "phone": ["+1 (132) 555-1352", "(202) 555-0141", "202-555-0141", "+49 30 1234567"],
    "card": ["4417744280351547", "4417 7442 8035 1547", "4417-7442-8035-1547", "3782 822463 10005"],
    "ipv4": ["97.51.17.173", "10.0.0.1"],
    "date": ["2024-02-29", "31.12.1999", "12/31/1999", "1900-1-1", "25/12/1990", "25-12-1990", "25 December 1990", "Dec 25, 1990", "March 3rd, 2001", "7th of August 2011"],
    "ssn": ["123-45-6789"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"],
}


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


@pytest.mark.parametrize("kind,value", [(k, v) for k, vs in VALID.items() for v in vs])
def test_values_move_within_their_format_and_back(kind, value):
    text = f"é {value}, and ({value}) {value}\n12"
    out, spans = pii.pseudonymise(text)
    assert [text[a:b] for a, b, k in spans if k == kind] == [value] * 3 == [text[a:b] for a, b, _ in spans]
    assert value not in out and len(set(re.findall(r"\S.*?(?=,)|(?<=\().+(?=\))", out))) >= 1
    if kind not in ("ipv4", "date"):
        assert shape(out) == shape(text)
    assert out == text.replace(value, pii.pseudonymise(value)[0])  # equal values stay linked
    if value != "1900-1-1":  # written without zeros; its pseudonym has them
        assert pii.pseudonymise(out, reverse=True)[0] == text
    assert pii.pseudonymise(value, b"other key")[0] != pii.pseudonymise(value)[0]
    assert [k for *_, k in pii.pseudonymise(pii.pseudonymise(value)[0])[1]] == [kind]  # still passes its check


@pytest.mark.parametrize("text", [
    "4417744280351548", "0000000000000000", "300.1.2.3", "1.2.3.4.5", "v1.2.3.4", "2023-02-29", "32.01.2000", "000-12-3456",
    "666-12-3456", "DE88 3704 0044 0532 0130 00", "token=4417744280351547x", "a@b", "@x.org", "12345", "", "٣٣٣-٣٣-٣٣٣٣",
])
def test_what_fails_its_check_stays(text):
    assert pii.pseudonymise(text) == (text, [])


@pytest.mark.parametrize("size", [1, 2, 3, 10, 257, 1000])
def test_permutation(size):
    moved = [pii.permute(i, size, b"k", b"t") for i in range(size)]
    assert sorted(moved) == list(range(size))
    assert [pii.permute(i, size, b"k", b"t", reverse=True) for i in moved] == list(range(size))


def test_one_date_in_all_its_forms():
    named = re.fullmatch(r"(\d+) ([A-Z][a-z]+) (\d+)", pii.pseudonymise("29 February 2024")[0])
    month = "January February March April May June July August September October November December".split().index(named[2]) + 1
    days = {date(int(named[3]), month, int(named[1]))}
    for text, order in (("2024-02-29", "ymd"), ("29.02.2024", "dmy"), ("02/29/2024", "mdy")):
        numbers = dict(zip(order, map(int, re.findall(r"\d+", pii.pseudonymise(text)[0])), strict=True))
        days.add(date(numbers["y"], numbers["m"], numbers["d"]))
    assert len(days) == 1


def test_neighbours_do_not_hide_a_value():
    text = "4417744280351547 97.51.17.173 123-45-6789 4417744280351547@mail.example.com.x@y.org"
    _, spans = pii.pseudonymise(text)
    assert [k for *_, k in spans][:3] == ["card", "ipv4", "ssn"]


@pytest.mark.parametrize("behind", ["BIC", "EUR", "2024", "X", "BANK 1234", "4417744280351547", "AT611904300234573201", "12 Main", "Bank"])
@pytest.mark.parametrize("iban", [
    "ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "AT611904300234573201", "BE68539007547034", "BE68 5390 0754 7034",
    "PL61 1090 1014 0000 0712 1981 2874", "HU42 1177 3016 1111 1018 0000 0000", "CY17 0020 0128 0000 0012 0052 7600",
    "NO93 8601 1117 947", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "MT84MALT011000012345MTLCAST001S",
    "XX83 1234 5678 9012 3456",
])
def test_iban_before_another_token(iban, behind):
    text = f"to {iban} {behind}."
    out, spans = pii.pseudonymise(text)
    assert text[slice(*spans[0][:2])] == iban and spans[0][2] == "iban"
    assert iban not in out and pii.pseudonymise(iban)[0] in out
    assert [k for *_, k in spans[1:]] == {"4417744280351547": ["card"], "AT611904300234573201": ["iban"]}.get(behind, [])
    assert pii.pseudonymise(out, reverse=True)[0] == text


def test_the_session_names_the_key(spark, documents):
    frame = documents([(1, "97.51.17.173")])
    with pytest.warns(UserWarning, match="example key"):
        assert pii.pseudonyms(frame).first().text == pii.pseudonymise("97.51.17.173")[0]
    spark.conf.set(pii.KEY_CONF, "a secret")
    try:
        assert pii.pseudonyms(frame).first().text == pii.pseudonymise("97.51.17.173", b"a secret")[0]
    finally:
        spark.conf.unset(pii.KEY_CONF)


def test_rows(documents):
    long = "word " * 50_000 + "97.51.17.173" + "9" * 100_000 + "a" * 100_000 + "@x.org"
    rows = [(1, None), (2, ""), (None, "mail die.55@mail4.example.com"), (3, "none"), (3, "none"), (4, long)]
    frame = documents(rows).selectExpr("'x' as spans", "*", "1 as n_found", "2 as key")
    out = pii.pseudonyms(frame).collect()
    assert sorted((repr(r.doc_id), r.n_found) for r in out) == [("1", 0), ("2", 0), ("3", 0), ("3", 0), ("4", 1), ("None", 1)][:6]
    assert {r.doc_id: r.text for r in out}[1] is None and {r.doc_id: r.text for r in out}[2] == ""
    assert pii.pseudonyms(documents([])).collect() == []
    plain = documents(rows)
    kept = pii.replace_pii(plain)
    assert kept.dtypes == plain.dtypes and all(r.n_chars == (None if r.text is None else len(r.text)) for r in kept.collect())


def test_query_on_whole_table(spark):
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}
    out = {r.doc_id: r for r in QUERIES["op10_pii_pseudonyms"](spark, SF).collect()}
    assert out.keys() == texts.keys()
    for doc, text in texts.items():
        spans = [s.split(":") for s in out[doc].spans.split(",") if s]
        assert len(spans) == out[doc].n_found
        for kind, a, b in spans:
            value = text[int(a) : int(b)]
            assert value not in out[doc].text or kind == "date"
            assert pii.pseudonymise(value)[0] in out[doc].text
        assert set(re.findall(r"[a-z]+\.\d\d@mail\d\.example\.com", text)) <= {text[int(a) : int(b)] for _, a, b in spans}
