"""Quoted CSV in splits against Python's reader, at split sizes down to a few bytes."""

from __future__ import annotations

import csv
import io
import random

import pytest

from weatherloom.sources.csvsplit import csv_records, scan_csv_split
from weatherloom.sources.scan import scan_csv

FIELDS = ["", "a", "plain words", 'say "so"', "two\nlines", "\n", '"', '""', "a,b", "é\n\n漢", 'x"\n"y', "\r\nz", " pad ", "last\r"]
CONF = {"spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}


@pytest.fixture
def split_bytes(spark):
    def use(n: int) -> None:
        for k, v in {**CONF, "spark.sql.files.maxPartitionBytes": str(n)}.items():
            spark.conf.set(k, v)

    yield use
    for k in [*CONF, "spark.sql.files.maxPartitionBytes"]:
        spark.conf.unset(k)


def write(path, rows, end="\n", quoting=csv.QUOTE_MINIMAL, last=True, bom=""):
    out = io.StringIO()
    csv.writer(out, lineterminator=end, quoting=quoting).writerows(rows)
    text = bom + (out.getvalue() if last else out.getvalue().removesuffix(end))
    path.write_bytes(text.encode())
    return str(path)


def got(df):
    return sorted(map(repr, map(tuple, df.collect())))


def plain(rows):
    return sorted(repr(tuple(f or None for f in r)) for r in rows)


@pytest.mark.parametrize("size", [11, 90, 1 << 20])
@pytest.mark.parametrize("quoting", [csv.QUOTE_ALL, csv.QUOTE_MINIMAL])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_against_the_plain_reader(spark, tmp_path, split_bytes, size, quoting, end):
    rng = random.Random(size)
    rows = [[str(i), rng.choice(FIELDS), rng.choice(FIELDS)] for i in range(25)]
    rows.append(["long", "\n".join(["line"] * 30), "z"])
    write(tmp_path / "a.csv", [["k", "the\nfirst", "b"], *rows[:10]], end, quoting, bom="\ufeff")
    write(tmp_path / "b.csv", [["k", "the\nfirst", "b"], *rows[10:]], end, quoting, last=False)
    split_bytes(size)
    df = scan_csv_split(spark, str(tmp_path), ["k", "the\nfirst", "b"])
    assert got(df) == plain(rows)


def test_same_rows_as_the_whole_file_reader(spark, tmp_path, split_bytes):
    rng = random.Random(3)
    rows = [[rng.choice(FIELDS[:12]), str(i), rng.choice(FIELDS[:12])] for i in range(60)]
    path = write(tmp_path / "x.csv", [["a", "b", "c"], *rows])
    split_bytes(64)
    assert got(scan_csv_split(spark, path, ["c", "b"])) == got(scan_csv(spark, path, ["c", "b"], quoted=True))
    lines = spark.read.option("lineSep", "\n").text(path)
    assert lines.rdd.getNumPartitions() > 5  # several tasks read the one file


def test_empty_lines_short_and_long_rows(spark, tmp_path, split_bytes):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n\n1\n\n2,3,4\n"",\n')
    split_bytes(5)
    assert got(scan_csv_split(spark, str(path), ["a", "b"])) == sorted(map(repr, [("1", None), ("2", "3"), (None, None)]))


def test_header_alone_and_no_header(spark, tmp_path, split_bytes):
    path = write(tmp_path / "x.csv", [["a", "b"]])
    split_bytes(1 << 20)
    assert scan_csv_split(spark, path, ["b"]).collect() == []
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        scan_csv_split(spark, str(tmp_path / "empty"), ["a"])


def test_what_is_refused(spark, tmp_path, split_bytes):
    split_bytes(1 << 20)
    (tmp_path / "d").mkdir()
    write(tmp_path / "d" / "x.csv", [["a", "b"], ["1", "2"]])
    write(tmp_path / "d" / "y.csv", [["b", "a"], ["1", "2"]])
    with pytest.raises(ValueError, match="different headers"):
        scan_csv_split(spark, str(tmp_path / "d"), ["a"])
    twice = write(tmp_path / "t.csv", [["a", "a", "b"]])
    with pytest.raises(ValueError, match="once"):
        scan_csv_split(spark, twice, ["a"])
    open_ = tmp_path / "o.csv"
    open_.write_text('a,b\n1,"never closed\n2,3\n')
    with pytest.raises(ValueError, match="not closed"):
        csv_records(spark, str(open_))
