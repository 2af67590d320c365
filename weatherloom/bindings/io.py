"""Queries that write the given tables in another form and read them back, and publishing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.bindings.cleaning import VALIDATED_SQL, _validated
from weatherloom.bindings.registry import Tables, query
from weatherloom.bindings.star import A_TS, B_TS, C_TS, MARTS_SQL, RUN_ID, star_base, star_marts, station_number
from weatherloom.operators.aggregate import row_count
from weatherloom.operators.rows import split_rejects, union_named
from weatherloom.operators.textparse import parse_delimited, parse_fixed_width
from weatherloom.plans import gold, serving
from weatherloom.sources.inputs import pending
from weatherloom.sources.publish import (
    PublishConflict,
    commit_version,
    current_entry,
    history,
    publish_metadata,
    publish_swap,
    read_published,
)
from weatherloom.sources.csvsplit import scan_csv_split
from weatherloom.sources.scan import scan, scan_csv, scan_text_lines, with_path_parts
from weatherloom.sources.sink import (
    append_audit,
    commit_marker_exists,
    drop_partitions,
    materialize,
    replace_slices,
    scratch_path,
    write_partitioned,
)
from weatherloom.sources.zorder import file_extents, files_in_ranges, scan_ranges, write_zordered


def season_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", F.year("o_orderdate").alias("season")
    )


_SEASON_SQL = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders"


@query(
    "scan_csv_quoted",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || ' "' || p_brand || '", ' || chr(10) || p_type AS note, nullif(p_type, 'SMALL') AS p_type FROM part""",
)
def scan_csv_quoted(t: Tables):
    """Quotes, commas and line breaks inside fields survive; all values are text."""
    path = scratch_path(t.spark, "csv_quoted")
    note = F.concat("p_name", F.lit(' "'), "p_brand", F.lit('", \n'), "p_type")
    rows = t.part.select(
        F.col("p_partkey").cast("string").alias("p_partkey"),
        note.alias("note"),
        F.nullif(F.col("p_type"), F.lit("SMALL")).alias("p_type"),
    )
    rows.write.options(header="true", escape='"').csv(path)
    return scan_csv(t.spark, path, ["p_partkey", "note", "p_type"], quoted=True)


@query(
    "scan_csv_split",
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, 'status "' || o_orderstatus || '", ' || CASE WHEN o_orderkey % 5 = 0 THEN chr(13) || chr(10) || chr(10) ELSE '' END || o_orderpriority AS "order
note", CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS o_orderstatus FROM orders""",
)
def scan_csv_split_query(t: Tables):
    """As before, with a line break in the header too, and each file read by several tasks."""
    path = scratch_path(t.spark, "csv_split")
    key = F.col("o_orderkey")
    breaks = F.when(key % 5 == 0, "\r\n\n").otherwise("")
    note = F.concat(F.lit('status "'), "o_orderstatus", F.lit('", '), breaks, "o_orderpriority")
    rows = t.orders.select(
        F.when(key % 4 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
        key.cast("string").alias("o_orderkey"),
        note.alias("order\nnote"),
    )
    rows.write.options(header="true", escape='"', emptyValue="").csv(path)
    return scan_csv_split(t.spark, path, ["o_orderkey", "order\nnote", "o_orderstatus"])


@query(
    "scan_csv_typed",
    "SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS usaf, c_mktsegment AS station_name, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal END AS lat FROM customer",
)
def scan_csv_typed(t: Tables):
    """Columns come by name, whatever their order. Ids keep their zeros because no type is inferred;
    measures are cast afterwards."""
    path = scratch_path(t.spark, "csv_typed")
    lat = F.when(F.col("c_custkey") % 6 == 0, "bad").otherwise(F.col("c_acctbal").cast("string"))
    t.customer.select(
        lat.alias("LAT"), "c_name", F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("USAF"),
        F.col("c_mktsegment").alias("NAME"),
    ).write.option("header", "true").csv(path)
    raw = scan_csv(t.spark, path, ["USAF", "NAME", "LAT"])
    return raw.select(
        F.col("USAF").alias("usaf"), F.col("NAME").alias("station_name"), F.col("LAT").try_cast("double").alias("lat")
    )


def _write_lines(df: DataFrame, path: str) -> None:
    """Gzipped lines under source=/year=/station_key= directories."""
    keys = ["source", "year", "station_key"]
    df.select("value", *keys).hint("rebalance", *[F.col(k) for k in keys]).write.partitionBy(*keys).option(
        "compression", "gzip"
    ).text(path)


def _readings(t: Tables) -> DataFrame:
    """Raw integer readings of every event, as a weather station would code them."""
    n = F.col("event_id")
    return t.events.select(
        "event_id",
        "ts",
        F.concat(F.lit("72"), F.lpad(station_number(), 4, "0"), F.lit("-00001")).alias("station_key"),
        F.year("ts").alias("year"),
        F.when(n % 13 == 0, -9999).otherwise((n % 700 - 300).cast("int")).alias("temp"),
        F.when(n % 13 == 0, -9999).otherwise((n % 700 - 300 - n % 100).cast("int")).alias("dew"),
        F.when(n % 17 == 0, 99999).otherwise((n % 700 + 9700).cast("int")).alias("slp"),
        F.when(n % 19 == 0, 999).otherwise((n % 361).cast("int")).alias("dir"),
        F.when(n % 23 == 0, 9999).otherwise((n % 300).cast("int")).alias("speed"),
    )


def _reading_sql(minute: str, keep: str = "") -> str:
    return f"""SELECT event_id, '72' || lpad(CAST(user_id // 10 AS VARCHAR), 4, '0') || '-00001' AS station_key, date_trunc('{minute}', ts) AS obs_utc_ts,
    CAST({"minute(ts)" if minute == "minute" else "0"} AS INTEGER) AS obs_minute,
    CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 700 - 300 AS DOUBLE) / 10 END AS air_temp_c,
    CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 700 - 300 - event_id % 100 AS DOUBLE) / 10 END AS dew_point_c,
    CASE WHEN event_id % 17 <> 0 THEN CAST(event_id % 700 + 9700 AS DOUBLE) / 10 END AS sea_level_pressure_hpa,
    CASE WHEN event_id % 19 <> 0 THEN CAST(event_id % 361 AS DOUBLE) END AS wind_dir_deg,
    CASE WHEN event_id % 23 <> 0 THEN CAST(event_id % 300 AS DOUBLE) / 10 END AS wind_speed_mps FROM events {keep}"""


@query(
    "scan_text_lines",
    """SELECT event_type || ',' || event_id AS value, 'isd' AS source_dataset, CAST(year(ts) AS INTEGER) AS year, lpad(CAST(user_id // 10 AS VARCHAR), 4, '0') AS station_key FROM events""",
)
def scan_text_lines_query(t: Tables):
    """Lines with the facts their path carries; the station key keeps its zeros."""
    path = scratch_path(t.spark, "lines")
    lines = t.events.select(
        F.concat_ws(",", "event_type", F.col("event_id").cast("string")).alias("value"),
        F.lit("isd").alias("source"),
        F.year("ts").alias("year"),
        F.lpad(station_number(), 4, "0").alias("station_key"),
    )
    _write_lines(lines, path)
    parts = {"source": "string", "year": "int", "station_key": "string"}
    out = with_path_parts(scan_text_lines(t.spark, path), parts, names={"source": "source_dataset"})
    return out.drop("source_file_uri")


@query(
    "path_partition_extract",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS season, o_orderstatus AS weather_sample FROM orders",
)
def path_partition_extract(t: Tables):
    """Partition values taken from the file path instead of partition discovery."""
    path = scratch_path(t.spark, "path_parts")
    rows = season_orders(t).select("o_orderkey", "season", F.col("o_orderstatus").alias("weather_sample"))
    write_partitioned(rows, path, ["season", "weather_sample"], clustered=True)
    files = t.spark.read.option("recursiveFileLookup", "true").parquet(path)
    files = files.withColumn("source_file_uri", F.col("_metadata.file_path"))
    return with_path_parts(files, {"season": "int", "weather_sample": "string"}).drop("source_file_uri")


@query("parse_delimited", _reading_sql("hour", "WHERE event_id % 29 <> 0 AND event_id % 31 <> 0"))
def parse_delimited_query(t: Tables):
    """Space-delimited lines written and read back; short lines and impossible months drop out."""
    path = scratch_path(t.spark, "delimited")
    n = F.col("event_id")
    month = F.when(n % 31 == 0, F.lit("13")).otherwise(F.date_format("ts", "MM"))
    fields = [F.date_format("ts", "yyyy"), month, F.date_format("ts", "dd"), F.date_format("ts", "HH")]
    fields += [F.lpad(F.col(c).cast("string"), 5, " ") for c in ("temp", "dew", "slp", "dir", "speed")]
    line = F.concat_ws(" ", *fields, F.when(n % 29 != 0, "0 -9999"), n.cast("string"))
    rows = _readings(t).select(line.alias("value"), F.lit("isd_lite").alias("source"), "year", "station_key")
    _write_lines(rows, path)
    tagged = with_path_parts(scan_text_lines(t.spark, path), {"station_key": "string"})
    tagged = tagged.withColumn("event_id", F.element_at(F.split("value", r"\s+"), -1).cast("bigint"))
    obs = parse_delimited(tagged.drop("source_file_uri"))
    return obs.withColumn("obs_utc_ts", F.col("obs_utc_ts").cast("timestamp_ntz"))


@query("parse_fixed_width", _reading_sql("minute", "WHERE event_id % 29 <> 0"))
def parse_fixed_width_query(t: Tables):
    """Fixed-width lines written and read back; lines with junk in the date drop out."""
    path = scratch_path(t.spark, "fixed")
    stamp = F.date_format("ts", "yyyyMMddHHmm")
    stamp = F.when(F.col("event_id") % 29 == 0, F.regexp_replace(stamp, "^....", "20x4")).otherwise(stamp)
    line = F.concat(
        F.lpad(F.col("event_id").cast("string"), 15, "0"),
        stamp,
        F.repeat(F.lit("-"), 33),
        F.lpad(F.col("dir").cast("string"), 3, "0"),
        F.lit("1N"),
        F.lpad(F.col("speed").cast("string"), 4, "0"),
        F.repeat(F.lit("-"), 18),
        F.format_string("%+05d", "temp"),
        F.lit("1"),
        F.format_string("%+05d", "dew"),
        F.lit("1"),
        F.lpad(F.col("slp").cast("string"), 5, "0"),
        F.lit("1"),
    )
    rows = _readings(t).select(line.alias("value"), F.lit("isd").alias("source"), "year", "station_key")
    _write_lines(rows, path)
    tagged = with_path_parts(scan_text_lines(t.spark, path), {"station_key": "string"})
    tagged = tagged.withColumn("event_id", F.substring("value", 1, 15).cast("bigint"))
    obs = parse_fixed_width(tagged.drop("source_file_uri"))
    return obs.withColumn("obs_utc_ts", F.col("obs_utc_ts").cast("timestamp_ntz"))


@query("sink_partitioned", _SEASON_SQL)
def sink_partitioned(t: Tables):
    path = scratch_path(t.spark, "partitioned")
    write_partitioned(season_orders(t), path, ["season"])
    return scan(t.spark, path)


@query(
    "sink_clustered",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS season, o_orderstatus, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(o_custkey % 1000) AS BIGINT) AS sum_keys FROM orders GROUP BY 1, 2",
)
def sink_clustered(t: Tables):
    path = scratch_path(t.spark, "clustered")
    write_partitioned(season_orders(t), path, ["season", "o_orderstatus"], clustered=True)
    back = scan(t.spark, path)
    return back.groupBy("season", "o_orderstatus").agg(row_count().alias("n_rows"), F.sum(F.col("o_custkey") % 1000).alias("sum_keys"))


@query(
    "sink_zordered",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, true AS few_files FROM lineitem,
    (SELECT max(p_partkey) AS n FROM part) WHERE l_partkey BETWEEN n // 4 AND n // 2 AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-06-30'""",
)
def sink_zordered(t: Tables):
    """A range of parts and days from lines laid out over both, and whether a minority of the files held it."""
    root = scratch_path(t.spark, "zordered")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    write_zordered(lines, root, ["l_partkey", "l_shipdate"], files=64)
    n = t.part.agg(F.max("p_partkey")).first()[0] or 0
    ranges = {"l_partkey": (n // 4, n // 2), "l_shipdate": (dt.datetime(1996, 1, 1), dt.datetime(1997, 6, 30))}
    few = 2 * files_in_ranges(t.spark, root, ranges).count() < file_extents(t.spark, root).count()
    return scan_ranges(t.spark, root, ranges).withColumn("few_files", F.lit(few))


@query(
    "sink_dynamic_overwrite",
    "SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) IN (1996, 1999) THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS season FROM orders",
)
def sink_dynamic_overwrite(t: Tables):
    """Two seasons are rebuilt; the others stay as first written."""
    path = scratch_path(t.spark, "slices")
    rows = season_orders(t)
    write_partitioned(rows, path, ["season"], clustered=True)
    redo = rows.filter(F.col("season").isin(1996, 1999)).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    write_partitioned(redo, path, ["season"], clustered=True, dynamic=True)
    return scan(t.spark, path)


@query(
    "sink_audit_append",
    """SELECT o_orderstatus AS table_name, CAST(count(*) AS BIGINT) AS n_rows, run_id FROM orders CROSS JOIN (VALUES ('run_1'), ('run_2')) r(run_id) GROUP BY o_orderstatus, run_id""",
)
def sink_audit_append(t: Tables):
    path = scratch_path(t.spark, "audit")
    counts = t.orders.groupBy(F.col("o_orderstatus").alias("table_name")).agg(row_count().alias("n_rows"))
    for run in ("run_1", "run_2"):
        append_audit(counts.withColumn("run_id", F.lit(run)), path)
    return scan(t.spark, path)


@query("reject_split", VALIDATED_SQL + " SELECT * FROM r WHERE failure_reason <> ''")
def reject_split(t: Tables):
    """Rejected rows with their reasons, from the side table they were written to."""
    _, bad = split_rejects(_validated(t))
    path = scratch_path(t.spark, "rejects")
    bad.write.parquet(path)
    return scan(t.spark, path)


@query(
    "commit_marker_check",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS season, CAST(count(*) AS BIGINT) AS n_rows, true AS committed, false AS absent_committed FROM orders GROUP BY 1",
)
def commit_marker_check(t: Tables):
    path = scratch_path(t.spark, "marked")
    write_partitioned(season_orders(t), path, ["season"], clustered=True)
    back = scan(t.spark, path).groupBy("season").agg(row_count().alias("n_rows"))
    return back.withColumns(
        {
            "committed": F.lit(commit_marker_exists(t.spark, path)),
            "absent_committed": F.lit(commit_marker_exists(t.spark, path + "-none")),
        }
    )


@query("publish_swap", MARTS_SQL + f" SELECT * REPLACE ('{C_TS}' AS batch_b_build_run_ts) FROM indoor_mart")
def publish_swap_query(t: Tables):
    """Two versions published one after the other; readers get the second."""
    target = scratch_path(t.spark, "published")
    mart = materialize(star_marts(t)["indoor"], "indoor")
    for version, run_ts in (("v1", B_TS), ("v2", C_TS)):
        publish_swap(mart.withColumn("batch_b_build_run_ts", F.lit(run_ts)), target, C.ENV_MART, version)
    return read_published(t.spark, target, C.ENV_MART)


META = {"a_ts": A_TS, "b_ts": B_TS, "run_ts": C_TS, "run_id": RUN_ID}


@query(
    "publish_metadata",
    MARTS_SQL
    + f""" SELECT '{RUN_ID}' AS serving_run_id, table_name, n AS source_row_count, n AS serving_row_count, lo AS min_season, hi AS max_season, s AS n_weather_samples, p AS sum_n_plays, CAST(0 AS BIGINT) AS duplicate_grain_rows FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{C.SERVING[x].name}' AS table_name, CAST(count(*) AS BIGINT) AS n, min(season) AS lo, max(season) AS hi, CAST(count(DISTINCT weather_sample) AS BIGINT) AS s, CAST(sum(n_plays) AS BIGINT) AS p FROM {x}_mart"
        for x in C.SERVING
    )
    + ")",
)
def publish_metadata_query(t: Tables):
    """Table audits of two runs appended, then only the current run's rows published."""
    root = scratch_path(t.spark, "metadata")
    # several aggregates read each mart, and each would shuffle its units again
    marts = {x: materialize(df, x) for x, df in star_marts(t).items()}
    pairs = {x: (df, serving.serve(df, C_TS, RUN_ID)) for x, df in marts.items()}
    audit = materialize(serving.table_audit(pairs, **META), "audit")
    older = audit.withColumn("serving_run_id", F.lit("c1_20230101T000000Z"))
    appended = f"{root}/appended"
    for rows in (older, audit):
        append_audit(rows, appended)
    publish_metadata({"table": scan(t.spark, appended)}, root, C.AUDITS, RUN_ID, C.AUDIT_ROWS)
    live = read_published(t.spark, f"{root}/{C.TABLE_AUDIT.name}", C.TABLE_AUDIT)
    return live.drop(*[c for c in C.SERVING_METADATA if c != "serving_run_id"])


@query(
    "rebuild_changed",
    """SELECT o_orderkey, o_custkey, CASE WHEN year(o_orderdate) = 1996 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderstatus,
      CAST(year(o_orderdate) AS INTEGER) AS season, year(o_orderdate) IN (1996, 1997) AS rebuilt, '1996,1997,1999' AS stale FROM orders WHERE year(o_orderdate) <> 1999
    UNION ALL SELECT o_orderkey + 100000000, o_custkey, o_totalprice, o_orderstatus, 1997, true, '1996,1997,1999' FROM orders WHERE year(o_orderdate) = 1995 AND o_orderkey % 7 = 0""",
)
def rebuild_changed(t: Tables):
    """A table of season slices after its input files changed: one was replaced, one added, one removed.
    Only the seasons these files hold, or held, are made again."""
    root = scratch_path(t.spark, "inputs")
    files, target, manifest = f"{root}/in", f"{root}/table", f"{root}/manifest"
    rows = season_orders(t).withColumn("part", F.col("season"))
    write_partitioned(rows, files, ["part"], clustered=True)

    def build(run: int) -> list:
        changes = pending(t.spark, files, manifest, "season")
        parts = [df.filter(changes.holds(F.col("season"))).withColumn("run", F.lit(run)) for _, df in changes.read(t.spark)]
        replace_slices(union_named(*parts), target, ["season"], changes.slices)
        changes.commit(t.spark)
        return sorted(changes.slices)

    build(1)
    redo = rows.filter("season = 1996").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    write_partitioned(redo, files, ["part"], clustered=True, dynamic=True)
    more = rows.filter("season = 1995 and o_orderkey % 7 = 0").withColumns(
        {"o_orderkey": F.col("o_orderkey") + 100000000, "season": F.lit(1997), "part": F.lit(0)}
    )
    write_partitioned(more, files, ["part"], clustered=True, dynamic=True)
    drop_partitions(t.spark, files, "part", [1999])
    stale = build(2)
    if pending(t.spark, files, manifest, "season"):
        raise RuntimeError("a second look at unchanged files finds work")
    out = scan(t.spark, target).withColumns({"rebuilt": F.col("run") == 2, "stale": F.lit(",".join(map(str, stale)))})
    return out.drop("part", "run")


@query(
    "publish_log",
    f"""SELECT number, version, rows_published, winner FROM (VALUES (1, 'v1', 0), (2, 'v2', 1)) v(number, version, winner),
    (SELECT CAST(count(*) AS BIGINT) AS rows_published FROM ({MARTS_SQL} SELECT * FROM indoor_mart))""",
)
def publish_log(t: Tables):
    """The log after two publishers met: both began on version 1, the one that ended first is version 2
    and the other was refused."""
    target = scratch_path(t.spark, "competing")
    mart = materialize(star_marts(t)["indoor"], "indoor")
    publish_swap(mart, target, C.ENV_MART, "v1")
    base = current_entry(t.spark, target).number
    publish_swap(mart, target, C.ENV_MART, "v2")
    try:
        commit_version(t.spark, target, "v3", "version=v3/late", 0, base)
        raise RuntimeError("a late publisher was not refused")
    except PublishConflict:
        pass
    rows = [(e.number, e.version, e.rows, int(e.number == current_entry(t.spark, target).number)) for e in history(t.spark, target)]
    return t.spark.createDataFrame(rows, "number int, version string, rows_published long, winner int")
