"""Curve layout: rows kept, files skipped, skewed keys."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from weatherloom.sources import zorder
from weatherloom.sources.sink import path_exists
from weatherloom.sources.zorder import curve_position, file_extents, files_in_ranges, scan_ranges, write_zordered


def table(spark, n=20_000):
    h = F.pmod(F.xxhash64("id"), F.lit(1000))
    return spark.range(n).select(
        "id",
        F.when(h % 97 == 0, None).otherwise(h.cast("int")).alias("a"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.hash("id"), F.lit(700))).alias("d"),
        F.concat(F.lit("k"), F.lpad(h.cast("string"), 4, "0")).alias("s"),
    )


RANGES = [
    {"a": (100, 250), "d": (dt.date(2020, 2, 1), dt.date(2020, 5, 1))},
    {"a": (100, 120)},
    {"d": (None, dt.date(2020, 1, 20))},
    {"a": (5000, None)},
    {"a": (None, None)},
]


@pytest.mark.parametrize("ranges", RANGES)
def test_rows_equal_to_a_plain_filter(spark, ranges):
    root = f"{spark.conf.get('spark.checkpoint.dir')}/zordered"
    df = table(spark)
    if not path_exists(spark, root):
        write_zordered(df, root, ["a", "d"], files=64)
    for k, (low, high) in ranges.items():
        df = df if low is None else df.filter(F.col(k) >= F.lit(low))
        df = df if high is None else df.filter(F.col(k) <= F.lit(high))
    assert sorted(scan_ranges(spark, root, ranges).collect()) == sorted(df.collect())
    opened, total = files_in_ranges(spark, root, ranges).count(), file_extents(spark, root).count()
    assert total > 50
    if len(ranges) == 2:
        assert opened <= total / 4
    elif ranges != {"a": (None, None)}:
        assert opened <= total / 2


def test_a_hot_key_is_spread(spark, tmp_path):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    write_zordered(df, str(tmp_path / "t"), ["k"], files=30)
    sizes = [r.n_rows for r in file_extents(spark, str(tmp_path / "t")).collect()]
    assert sum(sizes) == 9000 and max(sizes) < 3 * 9000 / 30
    assert scan_ranges(spark, str(tmp_path / "t"), {"k": (7, 7)}).count() == df.filter("k = 7").count()


def test_cells_keep_the_order_of_a_key(spark):
    df = table(spark, 3000)
    for k in ("a", "d", "s"):
        rows = df.select(F.col(k).alias("k"), curve_position(df, [k]).alias("z")).orderBy("k").collect()
        assert [r.z for r in rows] == sorted(r.z for r in rows)
        assert {r.z for r in rows if r.k is None} <= {0} and len({r.z for r in rows}) > 100


def test_empty_table_nulls_and_refusals(spark, tmp_path):
    empty = table(spark, 0)
    write_zordered(empty, str(tmp_path / "e"), ["a", "d"])
    assert scan_ranges(spark, str(tmp_path / "e"), {"a": (1, 2)}).collect() == []
    nulls = spark.createDataFrame([(None, float("nan")), (None, 1.0), (None, None)], "a int, x double")
    write_zordered(nulls, str(tmp_path / "n"), ["a", "x"], files=2)
    assert scan_ranges(spark, str(tmp_path / "n"), {"a": (0, 9)}).collect() == []
    assert scan_ranges(spark, str(tmp_path / "n"), {"x": (0.5, None)}).count() == 2  # NaN is the greatest
    with pytest.raises(ValueError, match="no extents of id"):
        files_in_ranges(spark, str(tmp_path / "n"), {"id": (1, 2)})
    with pytest.raises(TypeError, match="no order"):
        write_zordered(nulls.withColumn("m", F.array("a")), str(tmp_path / "m"), ["m"])
    with pytest.raises(ValueError, match="keys"):
        write_zordered(nulls, str(tmp_path / "m"), [])
    assert zorder.BITS * 7 < 63
