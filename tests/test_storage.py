"""Writers, scratch space and publishing."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from weatherloom.contracts import Contract, schema
from weatherloom.operators.gates import GateError
from weatherloom.sources import publish, sink
from weatherloom.sources.scan import path_part

TABLE = Contract(
    "t", schema(int=["season"], string=["team"], double=["rate"]), ["season", "team"], ratios=["rate"],
    not_null=["team"], partitions=["season"],
)


def rows(spark, rate=0.5):
    df = spark.range(400).select(
        (F.col("id") % 4 + 2000).cast("int").alias("season"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("team"),
        F.lit(rate).alias("rate"),
    )
    return df.repartition(8)


def test_clustered_write_bounds_the_file_count(spark, tmp_path):
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    sink.write_partitioned(rows(spark), plain, ["season"])
    sink.write_partitioned(rows(spark), clustered, ["season"], clustered=True)
    count = lambda p: sink.data_file_count(spark.read.parquet(p)).first().n_files
    assert count(clustered) == 4 < count(plain)
    assert spark.read.parquet(clustered).count() == 400


def test_static_overwrite_drops_other_partitions(spark, tmp_path):
    path = str(tmp_path / "p")
    sink.write_partitioned(rows(spark), path, ["season"])
    sink.write_partitioned(rows(spark).filter("season = 2001"), path, ["season"])
    assert spark.read.parquet(path).select("season").distinct().count() == 1


def test_scratch_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = sink.scratch_path(spark, "x"), sink.scratch_path(spark, "x")
    assert first.startswith(base) and first != second


def test_release_scratch_removes_what_was_written(spark):
    path = sink.scratch_path(spark, "gone")
    rows(spark).write.parquet(path)
    assert sink.path_exists(spark, path)
    sink.release_scratch(spark)
    assert not sink.path_exists(spark, path)


def test_materialize_keeps_order_types_and_rows(spark):
    df = rows(spark)
    back = sink.materialize(df, "m", ["season"])
    assert back.dtypes == df.dtypes and back.count() == 400


def test_publish_switches_versions(spark, tmp_path):
    target = str(tmp_path / "pub")
    publish.publish_swap(rows(spark, 0.1), target, TABLE, "v1", 400)
    publish.publish_swap(rows(spark, 0.9), target, TABLE, "v2", 400)
    live = publish.read_published(spark, target, TABLE)
    assert live.dtypes == [("season", "int"), ("team", "string"), ("rate", "double")]
    assert live.agg(F.min("rate")).first()[0] == 0.9
    assert publish.drop_old_versions(spark, target) == 1
    assert publish.read_published(spark, target, TABLE).count() == 400


@pytest.mark.parametrize(
    "spoil, message",
    [
        (lambda df: df.withColumn("rate", F.lit(1.5)), "metric_range_rate"),
        (lambda df: df.unionByName(df.limit(1)), "duplicate_grain_rows"),
        (lambda df: df.withColumn("team", F.when(F.col("season") != 2001, F.col("team"))), "not_null_team"),
        (lambda df: df.filter("season <> 2001"), "row_count"),
        (lambda df: df.withColumn("season", F.when(F.col("season") != 2001, F.col("season"))), "null_partition_keys"),
    ],
)
def test_failed_gate_leaves_the_old_version(spark, tmp_path, spoil, message):
    target = str(tmp_path / "pub")
    publish.publish_swap(rows(spark), target, TABLE, "v1", 400)
    with pytest.raises(GateError, match=message):
        publish.publish_swap(spoil(rows(spark)), target, TABLE, "v2", 400)
    assert publish.current_version(spark, target) == "v1"
    assert publish.read_published(spark, target, TABLE).count() == 400


@pytest.mark.parametrize(
    "spoil",
    [
        lambda df: df.drop("rate"),
        lambda df: df.withColumnRenamed("team", "club"),
        lambda df: df.withColumn("rate", F.col("rate").cast("string")),
        lambda df: df.select("rate", "team", "season"),
        lambda df: df.withColumn("more", F.lit(1)),
    ],
)
def test_schema_gate_sees_the_files(spark, tmp_path, spoil):
    target = str(tmp_path / "pub")
    with pytest.raises(GateError, match="schema expected=matches contract"):
        publish.publish_swap(spoil(rows(spark)), target, TABLE, "v1")
    assert publish.current_version(spark, target) is None


def test_failed_publish_can_be_repeated_and_the_current_version_stays(spark, tmp_path):
    target = str(tmp_path / "pub")
    with pytest.raises(GateError, match="metric_range_rate"):
        publish.publish_swap(rows(spark, 1.5), target, TABLE, "v1", 400)
    report = publish.publish_swap(rows(spark), target, TABLE, "v1", 400)
    assert {r.status for r in report.collect()} == {"PASS"}
    with pytest.raises(GateError, match="is current"):
        publish.publish_swap(rows(spark, 0.7), target, TABLE, "v1", 400)
    assert publish.read_published(spark, target, TABLE).agg(F.max("rate")).first()[0] == 0.5


def test_csv_columns_come_by_name(spark, tmp_path):
    from weatherloom.sources.scan import scan_csv

    path = str(tmp_path / "c")
    spark.createDataFrame([("7", "x", "007")], "c string, b string, a string").write.option("header", "true").csv(path)
    assert [tuple(r) for r in scan_csv(spark, path, ["a", "c"]).collect()] == [("007", "7")]
    with pytest.raises(ValueError, match="lacks"):
        scan_csv(spark, path, ["a", "d"])


def test_markers(spark, tmp_path):
    path = str(tmp_path / "d")
    rows(spark).write.parquet(path)
    assert sink.commit_marker_exists(spark, path) and not sink.commit_marker_exists(spark, str(tmp_path / "e"))


def test_path_part(spark):
    df = spark.createDataFrame([("file:/b/source=isd/year=2023/station_key=007-1/x.gz",), ("file:/b/x",)], "u string")
    out = df.select(path_part("u", "station_key").alias("k"), path_part("u", "year", "int").alias("y")).collect()
    assert [tuple(r) for r in out] == [("007-1", 2023), (None, None)]


def test_of_two_publishes_at_once_one_learns_of_the_other(spark, tmp_path):
    """The second publish starts and ends while the first one is still at its gates."""
    target = str(tmp_path / "pub")
    publish.publish_swap(rows(spark, 0.1), target, TABLE, "v1", 400)

    class Meanwhile:
        """A gate that is looked at between staging and switching."""

        def select(self, *columns):
            publish.publish_swap(rows(spark, 0.2), target, TABLE, "v2", 400)
            return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))

    with pytest.raises(publish.PublishConflict, match="v3 was made on top of entry 1, but entry 2, version v2"):
        publish.publish_swap(rows(spark, 0.3), target, TABLE, "v3", 400, [Meanwhile()])
    live = publish.read_published(spark, target, TABLE)
    assert (live.agg(F.max("rate")).first()[0], live.count()) == (0.2, 400)
    assert [(e.number, e.version, e.rows) for e in publish.history(spark, target)] == [(1, "v1", 400), (2, "v2", 400)]


def test_a_version_that_stands_alone_is_retried(spark, tmp_path):
    target = str(tmp_path / "pub")

    class Meanwhile:
        def select(self, *columns):
            publish.publish_swap(rows(spark, 0.2), target, TABLE, "v1", 400)
            return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))

    publish.publish_swap(rows(spark, 0.3), target, TABLE, "v2", 400, [Meanwhile()], retry=True)
    assert [e.version for e in publish.history(spark, target)] == ["v1", "v2"]
    assert publish.read_published(spark, target, TABLE).agg(F.max("rate")).first()[0] == 0.3


def test_two_publishes_under_one_id_do_not_mix(spark, tmp_path):
    target = str(tmp_path / "pub")

    class Meanwhile:
        def select(self, *columns):
            publish.publish_swap(rows(spark, 0.2), target, TABLE, "v1", 400)
            return spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))

    with pytest.raises(publish.PublishConflict):
        publish.publish_swap(rows(spark, 0.3), target, TABLE, "v1", 400, [Meanwhile()])
    live = publish.read_published(spark, target, TABLE)
    assert live.count() == 400 and live.agg(F.max("rate")).first()[0] == 0.2


def test_entries_are_created_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    path = str(tmp_path / "log" / "000000000001")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: publish.create_if_absent(spark, path, f"writer {i}\n"), range(8)))
    assert sum(won) == 1
    assert spark.read.text(path).first().value == f"writer {won.index(True)}"
    assert [p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")] == ["000000000001"]
    plain = str(tmp_path / "log2" / "1")  # the way of stores without rename
    _, fs = sink._hadoop_path(spark, plain)
    first = sink._hadoop_path(spark, plain)[0]
    assert publish._create(spark, fs, first, "a\n") and not publish._create(spark, fs, first, "b\n")
    assert spark.read.text(plain).first().value == "a"


def test_old_versions_go_and_staged_ones_stay(spark, tmp_path):
    target = str(tmp_path / "pub")
    for v in ("v1", "v2", "v3"):
        publish.publish_swap(rows(spark), target, TABLE, v, 400)
    staging = tmp_path / "pub" / "version=v4" / "someone"
    rows(spark).write.parquet(str(staging))
    assert publish.drop_old_versions(spark, target) == 2 and staging.exists()
    assert [e.version for e in publish.history(spark, target)] == ["v3"]
    assert publish.read_published(spark, target, TABLE).count() == 400
    assert publish.drop_old_versions(spark, str(tmp_path / "none")) == 0


def test_checks_measured_while_writing(spark, tmp_path):
    from weatherloom.operators import gates
    from weatherloom.operators.observed import ObservedChecks

    df = rows(spark, 0.5)
    checks = [
        gates.range_check("rate", 0.0, 0.4), gates.not_null_check("team"), gates.domain_check("season", [2000, 2001]), gates.filled_check("rate"),
        gates.non_empty_check(), gates.span_check("season", 2000, 2003), gates.single_value_check("rate", "0.5"),
        gates.zero_denominator_check("rate", F.col("season") - 2000), gates.rate_check("share", F.col("season") > 2000, 0.7),
        gates.formula_check("f", "season", "season", "rate"), gates.agreement_check("team", "team"),
    ]
    for frame, name in ((df, "full"), (df.where("season < 0"), "empty"), (spark.createDataFrame([], df.schema), "none")):
        measured = ObservedChecks(checks, "t")
        sink.write_partitioned(frame, str(tmp_path / name), ["season"], clustered=True, measured=measured)
        want = gates.column_checks(frame, "t", checks).collect()
        assert measured.report(spark).collect() == want and measured.rows == frame.count()
    with pytest.raises(ValueError, match="already"):
        measured.attach(df)
    with pytest.raises(ValueError, match="nothing"):
        ObservedChecks(checks, "t").report(spark)


def test_publish_reads_the_staged_files_once(spark, tmp_path):
    """Only the check for repeated keys reads them, and only the key columns."""
    import weatherloom.sources.publish as module

    seen = []
    original = module.run_gates
    module.run_gates = lambda gates: seen.append(original(gates)) or seen[-1]
    try:
        publish.publish_swap(rows(spark), str(tmp_path / "pub"), TABLE, "v1", 400)
    finally:
        module.run_gates = original
    plan = seen[-1]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<team:string>" in plan
