"""Queries: projections, cleaning, filters, timestamps, deterministic picks, sorts."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from weatherloom.bindings.registry import Tables, query
from weatherloom.bindings.star import A_TS, FACT_SQL, star_fact
from weatherloom.contracts import TEMP_LABELS, WIND_LABELS
from weatherloom.functions.cleaning import (
    bin_category,
    bin_numeric,
    blank_to_null,
    composite_key,
    covers,
    decode_direction,
    decode_scaled,
    flag,
    in_range,
    normalize_category,
    repair_sign,
    side_value,
    yyyymmdd_year,
)
from weatherloom.functions.timestamps import LOCAL_FORMATS, UTC_FORMATS, clamp_year, compose_ts, first_ts, parse_ts, to_utc
from weatherloom.operators.columns import conform, fill_unknown, normalize_timezone, rename_prefix, stamp, unique_columns, zone_dimension
from weatherloom.operators.rows import distinct_values, keep, pick_first, split_rejects, validate_rows
from weatherloom.plans.serving import latest


@query(
    "scan_parquet",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01 00:00:00' AND l_quantity < 10",
)
def scan_parquet(t: Tables):
    recent = (F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") < 10)
    return t.lineitem.filter(recent).select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


CONFORM = T.StructType(
    [
        T.StructField("o_orderkey", T.IntegerType()),
        T.StructField("o_orderstatus", T.IntegerType()),
        T.StructField("o_totalprice", T.StringType()),
        T.StructField("surface", T.StringType()),
        T.StructField("wpa", T.DoubleType()),
    ]
)


@query(
    "conform_schema",
    "SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(NULL AS INTEGER) AS o_orderstatus, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS o_totalprice, CAST(NULL AS VARCHAR) AS surface, CAST(NULL AS DOUBLE) AS wpa FROM orders",
)
def conform_schema(t: Tables):
    """Known columns cast (unreadable text becomes null), absent ones added, others dropped."""
    return conform(t.orders.withColumn("o_totalprice", F.floor("o_totalprice")), CONFORM)


@query("clean_blank", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS priority FROM orders")
def clean_blank(t: Tables):
    padded = F.concat(F.lit("  "), F.when(F.col("o_orderkey") % 3 == 0, " ").otherwise(F.col("o_orderpriority")), F.lit(" "))
    return t.orders.select("o_orderkey", blank_to_null(padded).alias("priority"))


_ROOFS = ["Retractable Roof", " Domed", "dome", "CLOSED", "open", "Outdoors", "", "other", "indoors", "Outdoor"]


def _roof():
    texts = F.array(*[F.lit(r) for r in _ROOFS], F.lit(None).cast("string"))
    return F.get(texts, (F.col("p_partkey") % (len(_ROOFS) + 1)).cast("int"))


_ROOF_SQL = "list_extract([" + ", ".join(f"'{r}'" for r in _ROOFS) + f", NULL], CAST(p_partkey % {len(_ROOFS) + 1} AS INTEGER) + 1)"


@query(
    "normalize_category",
    f"""SELECT p_partkey, CASE WHEN c IS NULL OR c = '' THEN 'unknown' WHEN c LIKE '%retract%' THEN 'retractable' WHEN c LIKE '%dome%' THEN 'dome'
    WHEN c = 'closed' THEN 'closed' WHEN c = 'open' THEN 'open' WHEN c LIKE '%out%' THEN 'outdoors' ELSE 'unknown' END AS roof_type
    FROM (SELECT p_partkey, lower(trim({_ROOF_SQL})) AS c FROM part)""",
)
def normalize_category_query(t: Tables):
    return t.part.select("p_partkey", normalize_category(_roof()).alias("roof_type"))


@query(
    "bin_category",
    f"""SELECT p_partkey, CASE WHEN c IS NULL THEN 'UNKNOWN' WHEN c LIKE '%retract%' THEN 'RETRACTABLE' WHEN c IN ('dome','indoors','indoor','closed') THEN 'INDOOR'
    WHEN c IN ('outdoors','outdoor','open') THEN 'OUTDOOR' ELSE 'UNKNOWN' END AS roof_env_bin FROM (SELECT p_partkey, lower({_ROOF_SQL}) AS c FROM part)""",
)
def bin_category_query(t: Tables):
    return t.part.select("p_partkey", bin_category(_roof()).alias("roof_env_bin"))


@query(
    "composite_key",
    "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '-' || lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS station_key FROM customer",
)
def composite_key_query(t: Tables):
    key = composite_key([(F.concat(F.lit(" "), F.col("c_custkey").cast("string")), 6), ("c_nationkey", 5)])
    return t.customer.select("c_custkey", key.alias("station_key"))


@query(
    "typed_projection",
    """SELECT c_custkey, upper(c_mktsegment) AS country, CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS station_lat,
    CASE WHEN c_custkey % 7 <> 0 THEN CAST(19900000 + c_custkey % 300000 AS INTEGER) END AS begin_yyyymmdd FROM customer""",
)
def typed_projection(t: Tables):
    """Padded, partly blank or unreadable texts to trimmed, upper-cased, typed columns."""
    n = F.col("c_custkey")
    lat = F.when(n % 5 == 0, "").otherwise(F.concat(F.lit(" "), F.col("c_acctbal").cast("string")))
    begin = F.when(n % 7 == 0, "n/a").otherwise((n % 300000 + 19900000).cast("string"))
    return t.customer.select(
        "c_custkey",
        F.upper(F.trim(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")))).alias("country"),
        F.trim(lat).try_cast("double").alias("station_lat"),
        F.trim(begin).try_cast("int").alias("begin_yyyymmdd"),
    )


@query("yyyymmdd_year", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS begin_year FROM orders")
def yyyymmdd_year_query(t: Tables):
    digits = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    return t.orders.select("o_orderkey", yyyymmdd_year(digits).alias("begin_year"))


@query(
    "repair_sign",
    """SELECT c_custkey, c_acctbal AS lon_raw, CASE WHEN c_acctbal > 0 AND c_nationkey < 12 THEN -c_acctbal ELSE c_acctbal END AS venue_lon FROM customer""",
)
def repair_sign_query(t: Tables):
    fixed = repair_sign("c_acctbal", F.col("c_nationkey") < 12)
    return t.customer.select("c_custkey", F.col("c_acctbal").alias("lon_raw"), fixed.alias("venue_lon"))


_ZONES = ["America/New_York", "Europe/Frankfurt", "Europe/Munich", "Not/AZone", "UTC"]


def _zone(n):
    return F.get(F.array(*[F.lit(z) for z in _ZONES], F.lit(None).cast("string")), (n % 6).cast("int"))


@query(
    "normalize_timezone",
    """SELECT c_custkey, tz, CASE WHEN tz IN ('Europe/Frankfurt','Europe/Munich') THEN 'Europe/Berlin' WHEN tz = 'Not/AZone' THEN NULL ELSE tz END AS venue_tz_norm
    FROM (SELECT c_custkey, list_extract(['America/New_York','Europe/Frankfurt','Europe/Munich','Not/AZone','UTC',NULL], CAST(c_custkey % 6 AS INTEGER) + 1) AS tz FROM customer)""",
)
def normalize_timezone_query(t: Tables):
    venues = t.customer.select("c_custkey", _zone(F.col("c_custkey")).alias("tz"))
    return normalize_timezone(venues, "tz", "venue_tz_norm", zone_dimension(t.spark))


@query("unique_columns", "SELECT o_orderkey, o_custkey AS o_orderkey__dup1, o_totalprice FROM orders")
def unique_columns_query(t: Tables):
    twice = t.orders.select("o_orderkey", F.col("o_custkey").alias("o_orderkey"), "o_totalprice")
    return unique_columns(twice)


@query(
    "fill_unknown",
    "SELECT p_partkey, coalesce(nullif(p_brand, 'Brand#2'), 'UNKNOWN') AS p_brand, coalesce(nullif(p_type, 'ECONOMY'), 'UNKNOWN') AS p_type FROM part",
)
def fill_unknown_query(t: Tables):
    holes = t.part.select(
        "p_partkey",
        F.nullif(F.col("p_brand"), F.lit("Brand#2")).alias("p_brand"),
        F.nullif(F.col("p_type"), F.lit("ECONOMY")).alias("p_type"),
    )
    return fill_unknown(holes, ["p_brand", "p_type"])


@query(
    "flag_normalize",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity = 1 THEN 1 ELSE 0 END AS from_value, CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS from_text FROM lineitem",
)
def flag_normalize(t: Tables):
    text = F.when(F.col("l_linenumber") == 1, "1").when(F.col("l_linenumber") == 2, "x")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", flag("l_quantity").alias("from_value"), flag(text).alias("from_text")
    )


@query(
    "bin_numeric",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 7 THEN 'UNKNOWN' WHEN l_quantity - 10 < 0 THEN 'FREEZING_LT_0C' WHEN l_quantity - 10 < 10 THEN 'COLD_0_10C'
      WHEN l_quantity - 10 < 20 THEN 'COOL_10_20C' WHEN l_quantity - 10 < 30 THEN 'MILD_20_30C' ELSE 'HOT_GE_30C' END AS temp_bin,
    CASE WHEN l_quantity / 4 < 3 THEN 'CALM_LT_3_MPS' WHEN l_quantity / 4 < 6 THEN 'BREEZY_3_6_MPS' WHEN l_quantity / 4 < 10 THEN 'WINDY_6_10_MPS' ELSE 'STRONG_GE_10_MPS' END AS wind_bin,
    'UNKNOWN' AS precip_bin FROM lineitem""",
)
def bin_numeric_query(t: Tables):
    temp = F.when(F.col("l_linenumber") != 7, F.col("l_quantity") - 10)
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        bin_numeric(temp, [0.0, 10.0, 20.0, 30.0], TEMP_LABELS).alias("temp_bin"),
        bin_numeric(F.col("l_quantity") / 4, [3.0, 6.0, 10.0], WIND_LABELS).alias("wind_bin"),
        F.lit("UNKNOWN").alias("precip_bin"),
    )


@query(
    "decode_tenths",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN raw > -9990 AND raw < 9990 THEN raw / CAST(10 AS DOUBLE) END AS air_temp_c,
    CASE WHEN raw > -9990 AND raw < 99990 THEN raw / CAST(10 AS DOUBLE) END AS sea_level_pressure_hpa
    FROM (SELECT *, CASE WHEN l_linenumber = 7 THEN -9999 ELSE CAST(floor(l_extendedprice) AS BIGINT) % 12000 END AS raw FROM lineitem)""",
)
def decode_tenths(t: Tables):
    raw = F.when(F.col("l_linenumber") == 7, F.lit(-9999)).otherwise(F.floor("l_extendedprice") % 12000)
    return t.lineitem.withColumn("raw", raw).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        decode_scaled("raw").alias("air_temp_c"),
        decode_scaled("raw", bounds=(-9990, 99990)).alias("sea_level_pressure_hpa"),
    )


@query(
    "decode_direction",
    "SELECT event_id, CASE WHEN d >= 0 AND d < 999 THEN CAST(d AS DOUBLE) END AS wind_dir_deg FROM (SELECT event_id, event_id % 1010 - 5 AS d FROM events)",
)
def decode_direction_query(t: Tables):
    return t.events.select("event_id", decode_direction(F.col("event_id") % 1010 - 5).alias("wind_dir_deg"))


@query("stamp_provenance", f"SELECT o_orderkey, '{A_TS}' AS build_run_ts, 'v1' AS feature_version FROM orders")
def stamp_provenance(t: Tables):
    return stamp(t.orders.select("o_orderkey"), build_run_ts=A_TS, feature_version="v1")


def _validated(t: Tables):
    n = F.col("c_custkey")
    rows = t.customer.select(
        "c_custkey",
        F.when(n % 10 != 0, F.col("c_name")).alias("stadium_id"),
        F.when(n % 9 != 0, F.col("c_acctbal") / 100).alias("lat"),
        F.when(n % 4 != 0, F.col("c_mktsegment")).alias("tz"),
    )
    return validate_rows(
        rows,
        {
            "missing_stadium_id": F.col("stadium_id").isNull(),
            "missing_lat": F.col("lat").isNull(),
            "lat_out_of_range": ~in_range("lat", -90.0, 90.0),
            "missing_tz": F.col("tz").isNull(),
        },
    )


VALIDATED_SQL = """WITH v AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS stadium_id, CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal / 100 END AS lat,
    CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS tz FROM customer),
  r AS (SELECT *, concat_ws(';', CASE WHEN stadium_id IS NULL THEN 'missing_stadium_id' END, CASE WHEN lat IS NULL THEN 'missing_lat' END,
    CASE WHEN lat < -90 OR lat > 90 THEN 'lat_out_of_range' END, CASE WHEN tz IS NULL THEN 'missing_tz' END) AS failure_reason FROM v)"""


@query("validate_rows", VALIDATED_SQL + " SELECT * FROM r")
def validate_rows_query(t: Tables):
    return _validated(t)


@query("good_rows", VALIDATED_SQL + " SELECT c_custkey, stadium_id, lat, tz FROM r WHERE failure_reason = ''")
def good_rows(t: Tables):
    return split_rejects(_validated(t))[0]


@query("rename_prefix", "SELECT n_nationkey, n_name AS venue_n_name, n_regionkey AS venue_n_regionkey, c_custkey FROM nation JOIN customer ON n_nationkey = c_nationkey")
def rename_prefix_query(t: Tables):
    nation = rename_prefix(t.nation, ["n_name", "n_regionkey"], "venue_")
    return nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey")).select(*nation.columns, "c_custkey")


@query(
    "side_attribution",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice AS DOUBLE) WHEN o_orderkey % 3 = 1 THEN CAST(o_custkey AS DOUBLE) END AS team_points_final FROM orders""",
)
def side_attribution(t: Tables):
    sides = t.orders.select(
        "o_orderkey",
        (F.col("o_orderkey") % 3).cast("string").alias("team"),
        F.lit("0").alias("home"),
        F.lit("1").alias("away"),
        F.col("o_totalprice").alias("h"),
        F.col("o_custkey").cast("double").alias("a"),
    )
    return sides.select("o_orderkey", side_value("team", "home", "away", "h", "a").alias("team_points_final"))


@query(
    "filter_membership",
    "SELECT event_id, event_type, user_id FROM events WHERE event_type IN ('click','view') AND event_id % 10 <> 0",
)
def filter_membership(t: Tables):
    events = t.events.select(
        "event_id", "event_type", F.when(F.col("event_id") % 10 != 0, F.col("user_id")).alias("user_id")
    )
    return keep(events, F.col("event_type").isin("click", "view"), F.col("user_id").isNotNull())


@query(
    "filter_range",
    "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal BETWEEN 1500 AND 7200 AND c_nationkey BETWEEN 6 AND 17 AND c_mktsegment = 'BUILDING'",
)
def filter_range(t: Tables):
    return keep(
        t.customer.select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment"),
        in_range("c_acctbal", 1500.0, 7200.0),
        in_range("c_nationkey", 6, 17),
        F.col("c_mktsegment") == "BUILDING",
    ).select("c_custkey", "c_acctbal")


@query(
    "filter_coverage",
    "SELECT c_custkey, CAST(1995 + c_custkey % 8 AS BIGINT) AS begin_year, CAST(2020 + c_custkey % 11 AS BIGINT) AS end_year FROM customer WHERE 1995 + c_custkey % 8 <= 2000 AND 2020 + c_custkey % 11 >= 2025",
)
def filter_coverage(t: Tables):
    n = F.col("c_custkey")
    spans = t.customer.select("c_custkey", (n % 8 + 1995).alias("begin_year"), (n % 11 + 2020).alias("end_year"))
    return keep(spans, covers("begin_year", "end_year", 2000, 2025))


# --- timestamps ----------------------------------------------------------------------------

_UTC_TEXT = {0: "yyyy-MM-dd'T'HH:mm:ss'Z'", 1: "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", 2: "yyyy-MM-dd'T'HH:mm:ss'+00:00'"}
_LOCAL_TEXT = {3: "M/d/yy, H:mm:ss", 4: "M/d/yyyy, H:mm:ss", 5: "yyyy-MM-dd HH:mm:ss", 6: "yyyy-MM-dd'T'HH:mm:ss"}


def _texts(t: Tables):
    n = F.col("event_id") % 8
    text = None
    for k, f in {**_UTC_TEXT, **_LOCAL_TEXT}.items():
        made = F.date_format("ts", f)
        text = F.when(n == k, made) if text is None else text.when(n == k, made)
    return t.events.select("event_id", "ts", text.otherwise("kickoff").alias("text"))


_TEXT_SQL = """WITH texts AS (SELECT event_id, CASE event_id % 8 WHEN 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') WHEN 2 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')
    WHEN 3 THEN strftime(ts, '%-m/%-d/%y, %-H:%M:%S') WHEN 4 THEN strftime(ts, '%-m/%-d/%Y, %-H:%M:%S') WHEN 5 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 6 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
    ELSE 'kickoff' END AS text FROM events)"""


@query(
    "parse_timestamp_chain",
    _TEXT_SQL
    + """ SELECT event_id, text, try_strptime(text, ['%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%dT%H:%M:%S.%gZ', '%Y-%m-%dT%H:%M:%S+00:00']) AS utc_ts,
    try_strptime(text, ['%m/%d/%y, %H:%M:%S', '%m/%d/%Y, %H:%M:%S', '%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S']) AS local_ts FROM texts""",
)
def parse_timestamp_chain(t: Tables):
    return _texts(t).select(
        "event_id",
        "text",
        parse_ts("text", UTC_FORMATS).cast("timestamp_ntz").alias("utc_ts"),
        parse_ts("text", LOCAL_FORMATS).cast("timestamp_ntz").alias("local_ts"),
    )


@query(
    "compose_datetime",
    """SELECT o_orderkey, CASE WHEN regexp_matches(clock, '^[0-9]{1,2}:[0-9]{2}:[0-9]{2}$') AND o_orderkey % 19 <> 0
       THEN try_strptime(strftime(o_orderdate, '%Y-%m-%d') || ' ' || clock, '%Y-%m-%d %H:%M:%S') END AS local_ts
    FROM (SELECT *, CASE WHEN o_orderkey % 10 = 0 THEN '13:05' ELSE (o_orderkey % 26) || ':' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(o_orderkey * 7 % 60 AS VARCHAR), 2, '0') END AS clock FROM orders)""",
)
def compose_datetime(t: Tables):
    """Clock texts on the order date: hours above 23, texts without seconds and missing dates give
    null."""
    n = F.col("o_orderkey")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    clock = F.when(n % 10 == 0, "13:05").otherwise(
        F.concat_ws(":", (n % 26).cast("string"), two(n % 60), two(n * 7 % 60))
    )
    date = F.when(n % 19 != 0, F.col("o_orderdate").cast("date"))
    return t.orders.select("o_orderkey", compose_ts(date, clock).cast("timestamp_ntz").alias("local_ts"))


@query(
    "local_to_utc",
    """SELECT event_id, tz, CASE WHEN tz IS NOT NULL THEN (ts AT TIME ZONE tz) AT TIME ZONE 'UTC' END AS utc_ts
    FROM (SELECT *, list_extract(['America/New_York','America/Los_Angeles','Europe/Berlin',NULL], CAST(event_id % 4 AS INTEGER) + 1) AS tz FROM events)""",
)
def local_to_utc(t: Tables):
    zones = F.array(*[F.lit(z) for z in ("America/New_York", "America/Los_Angeles", "Europe/Berlin", None)])
    local = t.events.select("event_id", "ts", F.get(zones, (F.col("event_id") % 4).cast("int")).alias("tz"))
    utc = to_utc(F.col("ts").cast("timestamp"), "tz").cast("timestamp_ntz")
    return local.select("event_id", "tz", utc.alias("utc_ts"))


@query(
    "timestamp_priority",
    """SELECT event_id, coalesce(a, b) AS play_ts_utc, CASE WHEN a IS NOT NULL THEN 'time_of_day' WHEN b IS NOT NULL THEN 'start_time' ELSE 'none' END AS play_ts_source
    FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN ts END AS a, CASE WHEN event_id % 5 < 3 THEN date_trunc('day', ts) END AS b FROM events)""",
)
def timestamp_priority(t: Tables):
    n = F.col("event_id")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    ts, label = first_ts([("time_of_day", F.when(n % 3 == 0, F.col("ts"))), ("start_time", F.when(n % 5 < 3, day))])
    return t.events.select("event_id", ts.alias("play_ts_utc"), label.alias("play_ts_source"))


@query(
    "clamp_timestamp",
    """SELECT o_orderkey, CASE WHEN year(ts) BETWEEN 1990 AND 2030 THEN ts END AS ts FROM (SELECT o_orderkey, o_orderdate + to_years(CAST(o_orderkey % 50 - 10 AS INTEGER)) AS ts FROM orders)""",
)
def clamp_timestamp(t: Tables):
    moved = F.col("o_orderdate") + F.make_ym_interval((F.col("o_orderkey") % 50 - 10).cast("int"), F.lit(0))
    return t.orders.select("o_orderkey", clamp_year(moved).alias("ts"))


# --- picks, sorts --------------------------------------------------------------------------


@query(
    "dedup_latest",
    """SELECT o_custkey, o_orderkey, last_day, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY last_day DESC NULLS LAST, o_orderpriority IS NULL, o_orderpriority NULLS LAST, o_orderkey) AS rn
      FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS last_day, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)) WHERE rn = 1""",
)
def dedup_latest(t: Tables):
    versions = t.orders.select(
        "o_custkey",
        "o_orderkey",
        F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderdate").cast("date")).alias("last_day"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
    )
    order = [
        F.col("last_day").desc_nulls_last(),
        F.col("o_orderpriority").isNull().asc(),
        F.col("o_orderpriority").asc_nulls_last(),
        F.col("o_orderkey").asc(),
    ]
    return pick_first(versions, ["o_custkey"], order)


@query(
    "dedup_station",
    """SELECT p_brand, p_partkey, p_size, p_name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, length(p_type) DESC, length(p_name) DESC, p_name, p_partkey) AS rn FROM part) WHERE rn = 1""",
)
def dedup_station(t: Tables):
    order = [
        F.col("p_size").desc(),
        F.length("p_type").desc(),
        F.length("p_name").desc(),
        F.col("p_name").asc(),
        F.col("p_partkey").asc(),
    ]
    best = pick_first(t.part.select("p_brand", "p_partkey", "p_size", "p_name", "p_type"), ["p_brand"], order)
    return best.drop("p_type")


@query(
    "dedup_subset",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""",
)
def dedup_subset(t: Tables):
    """One line per key; the key is repeated in the data, so the pick must not depend on order."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    order = [F.col(c).asc() for c in columns[2:]]
    return pick_first(t.lineitem.select(*columns), columns[:2], order).select(*columns[:4])


@query("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_values_query(t: Tables):
    return distinct_values(t.orders, "o_orderpriority")


@query(
    "sort_report",
    FACT_SQL + """ SELECT season, posteam, CAST(count(*) AS BIGINT) AS n_rows FROM fact GROUP BY season, posteam ORDER BY n_rows DESC, season, posteam""",
)
def sort_report(t: Tables):
    counts = star_fact(t).groupBy("season", "posteam").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), "season", "posteam")


@query(
    "latest_run",
    "SELECT o_orderkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1",
)
def latest_run(t: Tables):
    runs = t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    newest = runs.withColumn("__at", F.struct("o_orderdate", "o_orderkey"))
    return latest(newest, "__at", F.col("o_orderstatus") == "F").drop("__at")
