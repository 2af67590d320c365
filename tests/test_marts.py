"""The marts' plans, and run stamps of several builds in one table."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom import session
from weatherloom.bindings import io
from weatherloom.bindings.registry import Tables
from weatherloom.bindings.star import A_TS, star_base
from weatherloom.operators import aggregate, joins
from weatherloom.plans import gold

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("build", [gold.mart_team_season, gold.mart_play_calling, gold.mart_env_compare])
def test_marts_never_sort_to_aggregate(spark, build):
    plan = build(star_base(Tables(spark, SF)), "b", [A_TS])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_units_take_one_shuffle_of_the_facts(spark):
    """Base rows to unit totals: the exchange of the aggregation comes on top of those of the star join."""
    base = star_base(Tables(spark, SF))
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert shuffles(gold.mart_units(base, [A_TS])) == shuffles(base) + 1


def test_the_largest_stamp_of_a_group(spark):
    base = star_base(Tables(spark, SF)).withColumn(
        aggregate.RUN_STAMP,
        F.when(F.col("play_id") % 3 == 0, "run 2").when(F.col("play_id") % 3 == 1, "a much longer stamp than any run has é"),
    )
    grain = gold.ENV_KEYS
    got = {tuple(r) for r in gold.mart_env_compare(base, "b").select(*grain, "weather_sample", "n_games", aggregate.RUN_STAMP).collect()}
    samples = base.withColumn("weather_sample", F.lit("ALL_PLAYS")).union(
        base.where("weather_observed_flag = 1").withColumn("weather_sample", F.lit("OBSERVED_ONLY"))
    )
    want = samples.groupBy(*grain, "weather_sample").agg(F.count_distinct("game_id").alias("n_games"), F.max(aggregate.RUN_STAMP))
    assert got == {tuple(r) for r in want.collect()}
    assert aggregate.run_stamps(base) == ["a much longer stamp than any run has é", "run 2"]
    none = gold.mart_env_compare(base.withColumn(aggregate.RUN_STAMP, F.lit(None).cast("string")), "b")
    assert none.where(f"{aggregate.RUN_STAMP} is not null").isEmpty() and not none.isEmpty()


def test_too_many_stamps(spark):
    df = spark.range(aggregate.MAX_STAMPS + 1).select(F.col("id").cast("string").alias(aggregate.RUN_STAMP))
    with pytest.raises(ValueError, match="stamps"):
        aggregate.run_stamps(df)


def test_a_task_takes_a_bounded_share_of_a_shuffle(spark):
    """However few cores there are, more rows make more tasks, not larger sorts and hash tables in each."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionNum", "1")
    try:
        keys = spark.range(1_000_000).select(F.xxhash64("id").alias("k"))
        values = [F.max(F.xxhash64("k", F.lit(i))).alias(f"v{i}") for i in range(10)]
        out = keys.groupBy("k").agg(*values).groupBy(F.spark_partition_id()).agg(*[F.max(f"v{i}") for i in range(10)])
        assert len(out.collect()) >= 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionNum")


def test_tasks_stay_small_with_few_shuffle_partitions_and_large_files(spark, tmp_path):
    """What one task sorts or totals is bounded by bytes, even if the cluster names few partitions."""
    session.configure(spark)
    settings = {"spark.sql.adaptive.coalescePartitions.minPartitionNum": "1", "spark.sql.files.minPartitionNum": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        keys = spark.range(1_000_000).select(F.xxhash64("id").alias("k"))
        rows = keys.select("k", *[F.xxhash64("k", F.lit(i)).alias(f"v{i}") for i in range(5)])
        sums = rows.groupBy("k").agg(*[F.max(f"v{i}").alias(f"v{i}") for i in range(5)])
        assert len(sums.groupBy(F.spark_partition_id()).agg(*[F.max(f"v{i}") for i in range(5)]).collect()) >= 5
        rows.coalesce(1).write.parquet(str(tmp_path / "rows"))
        assert spark.read.parquet(str(tmp_path / "rows")).rdd.getNumPartitions() >= 3
    finally:
        for key in settings:
            spark.conf.unset(key)


def _star(spark, lines):
    """Order lines, four an order, with the tables they refer to."""
    k = F.col("id")
    orders = spark.range(lines // 4 + 1).select(
        k.alias("o_orderkey"), (k % 50).alias("o_custkey"), (k % 9000 / 7).alias("o_totalprice"),
        F.timestamp_add("DAY", (k % 2000).cast("int"), F.lit("1995-01-01").cast("timestamp_ntz")).alias("o_orderdate"),
    )
    lineitem = spark.range(lines).select(
        F.floor(k / 4).alias("l_orderkey"), (k % 199).alias("l_partkey"), (k % 7 + 1).cast("int").alias("l_linenumber"),
        (k % 50 + 1.0).alias("l_quantity"), (k % 1000 / 8).alias("l_extendedprice"), (k % 11 / 100).alias("l_discount"),
        (k % 9 / 100).alias("l_tax"), F.substring(F.lit("ARN"), (k % 3 + 1).cast("int"), F.lit(1)).alias("l_returnflag"),
        F.substring(F.lit("FO"), (k % 2 + 1).cast("int"), F.lit(1)).alias("l_linestatus"),
    )
    customer = spark.range(50).select(k.alias("c_custkey"), (k % 5).cast("int").alias("c_nationkey"))
    nation = spark.range(5).select(k.cast("int").alias("n_nationkey"), F.concat(F.lit("n"), k).alias("n_name"), (k % 2).cast("int").alias("n_regionkey"))
    region = spark.range(2).select(k.cast("int").alias("r_regionkey"), F.concat(F.lit("r"), k).alias("r_name"))
    return SimpleNamespace(lineitem=lineitem, orders=orders, customer=customer, nation=nation, region=region)


def _rows_per_task(df):
    return [r[1] for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).collect()]


def test_star_tasks_follow_from_the_rows_whatever_the_settings(spark):
    """A session that joins shuffle partitions up to 1 GB still spreads the join and the totals per game."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1g", "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1",
        "spark.sql.adaptive.coalescePartitions.minPartitionNum": "1", "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        units = gold.mart_units(star_base(_star(spark, 600_000)), [A_TS])
        tasks = _rows_per_task(units)
        assert len(tasks) >= 3 and max(tasks) < 0.6 * sum(tasks)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_marts_of_dealt_units(spark, monkeypatch):
    t = _star(spark, 20_000)

    def build():
        marts = gold.marts(star_base(t), "b", [A_TS])
        return {x: sorted(map(repr, df.collect())) for x, df in marts.items()}

    plain = build()
    monkeypatch.setattr(joins, "TASK_ROWS", 1000)
    assert build() == plain and len(plain["playcall"]) > 100


def test_published_audits_read_written_marts(spark, monkeypatch):
    """Several aggregates read each mart; none may shuffle its units again."""
    plans, audit = [], io.serving.table_audit

    def spy(pairs, **meta):
        plans.extend(df._jdf.queryExecution().executedPlan().toString() for pair in pairs.values() for df in pair)
        return audit(pairs, **meta)

    monkeypatch.setattr(io.serving, "table_audit", spy)
    t = _star(spark, 2000)
    t.spark = spark
    out = io.publish_metadata_query(t).collect()
    assert len(plans) == 6 and not any("Exchange" in p for p in plans)
    rows = {C.SERVING[x].name: df.count() for x, df in gold.marts(star_base(t), "b", [A_TS]).items()}
    assert {r.table_name: r.serving_row_count for r in out} == rows and {r.serving_run_id for r in out} == {io.RUN_ID}


def test_teams_are_listed_before_the_units_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 1000)
    indoor = gold.marts(star_base(_star(spark, 4000)), "b", [A_TS])["indoor"]
    plan = indoor._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1


def test_dealt_join_with_hot_missing_and_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(joins, "TASK_ROWS", 1000)
    k = F.col("id")
    # half of the rows have one key; others have none, one that the right lacks, or one that it has twice
    key = F.when(k % 2 == 0, 7).when(k % 10 == 1, None).when(k % 10 == 3, -1).otherwise(k % 300)
    left = spark.range(20_000).select(key.alias("a"), "id")
    right = spark.range(310).select((k % 300).alias("b"), k.alias("r"))
    out = joins.join_dealt(left, right, "a", "b", 310)
    want = left.join(right, F.col("a") == F.col("b"))
    assert out.columns == want.columns
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect()))
    assert max(_rows_per_task(out)) < 5000
    none = joins.join_dealt(left.where("a is null"), right, "a", "b", 310)
    assert none.isEmpty()
