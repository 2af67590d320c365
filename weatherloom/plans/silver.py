"""Silver tables: plays, games, venues, stations, the venue-station map, hourly weather, features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.functions.cleaning import (
    blank_to_null,
    composite_key,
    covers,
    in_range,
    normalize_category,
    repair_sign,
    safe_ratio,
    yyyymmdd_year,
)
from weatherloom.functions.weather import (
    PRESSURE_GUARDS,
    apparent_temp,
    humidity,
    trend,
    valid_flag,
    vector_uv,
    wet_bulb,
)
from weatherloom.operators.aggregate import missing_by_group, null_rate, row_count, summarize
from weatherloom.operators.columns import conform, stamp
from weatherloom.operators.hourly import complete_grid, hour_grid, lag_delta
from weatherloom.operators.nearby import nearest
from weatherloom.operators.rows import keep, pick_first, split_rejects, unmatched, validate_rows
from weatherloom.operators.textparse import parse_by_source
from weatherloom.sources.scan import with_path_parts

OFFENSE_PLAYS = ["pass", "run"]


def plays_core(raw: DataFrame) -> DataFrame:
    """Offensive plays in the frozen column set; all seasons in one job."""
    return conform(raw, C.PLAYS.schema).filter(
        F.col("play_type").isin(*OFFENSE_PLAYS) & F.col("posteam").isNotNull()
    )


GAME_ATTRIBUTES = [
    "season", "week", "game_date", "home_team", "away_team", "roof", "stadium_id", "start_time",
]


# counts and sums of a game, and the scores carried as maxima
GAME_SUMS = ["pass_attempts", "rush_attempts", "completions", "total_yards", "total_epa", "n_epa"]
GAME_SCORES = {"home_score_final": "home_score", "away_score_final": "away_score"}


def games(raw: DataFrame, parity: bool = False, attributes: list[str] = GAME_ATTRIBUTES) -> DataFrame:
    """Per-game totals.

    One row per game, described by the largest value of each attribute; ``parity`` stops at one
    row per game and description, which splits a game whose description varies between plays. The
    plays are always reduced with the (nearly constant) descriptions as keys: taking the largest
    text of millions of plays would force a sort of them.
    """
    offense = raw.filter(F.col("play_type").isin(*OFFENSE_PLAYS))
    totals = {
        "pass_attempts": F.sum(F.col("pass_attempt").try_cast("int")),
        "rush_attempts": F.sum(F.col("rush_attempt").try_cast("int")),
        "completions": F.sum(F.col("complete_pass").try_cast("int")),
        "total_yards": F.sum("yards_gained"),
        "total_epa": F.sum("epa"),
        "n_epa": F.count("epa"),
        **{n: F.max(c) for n, c in GAME_SCORES.items()},
    }
    out = summarize(offense, totals, ["game_id", *attributes])
    if not parity:
        merged = {c: F.max(c) for c in [*attributes, *GAME_SCORES]} | {c: F.sum(c) for c in GAME_SUMS}
        out = summarize(out, merged, ["game_id"])
    plays = F.col("pass_attempts") + F.col("rush_attempts")
    return out.withColumns(
        {
            "avg_epa_play": safe_ratio("total_epa", "n_epa"),
            "total_points": F.col("home_score_final") + F.col("away_score_final"),
            "plays": plays,
            "pass_rate": safe_ratio("pass_attempts", plays),
            "completion_pct": safe_ratio("completions", "pass_attempts"),
        }
    ).drop("n_epa")


VENUE_COLUMNS = C.VENUES.columns


def venues(raw: DataFrame, tz_required: bool = True) -> tuple[DataFrame, DataFrame]:
    """(dimension, rejected rows) from all-string stadium rows."""
    texts = ["stadium_id", "stadium_name", "tz", "roof_type", "city", "state", "country"]
    clean = raw.select(
        *[blank_to_null(c).alias(c) for c in texts],
        *[F.trim(c).try_cast("double").alias(c) for c in ("lat", "lon")],
        *[F.trim(c).try_cast("date").alias(c) for c in ("first_game_date", "last_game_date")],
    ).withColumn("roof_type_std", normalize_category("roof_type"))
    rules = {
        "missing_stadium_id": F.col("stadium_id").isNull(),
        "missing_lat": F.col("lat").isNull(),
        "missing_lon": F.col("lon").isNull(),
        "lat_out_of_range": ~in_range("lat", -90.0, 90.0),
        "lon_out_of_range": ~in_range("lon", -180.0, 180.0),
    }
    if tz_required:
        rules["missing_tz"] = F.col("tz").isNull()
    good, bad = split_rejects(validate_rows(clean, rules))
    dim = pick_first(good, ["stadium_id"], venue_preference()).drop("roof_type")
    return dim.withColumnRenamed("roof_type_std", "roof_type").select(*VENUE_COLUMNS), bad


def venue_preference() -> list[Column]:
    """Latest version first; every remaining column breaks ties, so the pick never varies."""
    rest = ["stadium_name", "tz", "lat", "lon", "roof_type", "city", "state", "country"]
    return [
        F.col("last_game_date").desc_nulls_last(),
        F.col("first_game_date").desc_nulls_last(),
        F.col("tz").isNull().asc(),
        F.col("stadium_name").isNull().asc(),
        *[F.col(c).asc_nulls_last() for c in rest],
    ]


def station_preference() -> list[Column]:
    return [
        F.col("end_year").desc_nulls_last(),
        F.length("icao").desc_nulls_last(),
        F.length("station_name").desc_nulls_last(),
        F.col("station_name").asc_nulls_last(),
        F.col("begin_yyyymmdd").asc_nulls_last(),
        F.col("end_yyyymmdd").desc_nulls_last(),
        F.col("icao").asc_nulls_last(),
        F.col("station_lat").asc_nulls_last(),
        F.col("station_lon").asc_nulls_last(),
    ]


def stations(raw: DataFrame, country: str = "US", span: tuple[int, int] = (2000, 2025)) -> DataFrame:
    """Station dimension from the all-string station history."""
    typed = raw.select(
        F.lpad(F.trim("USAF"), 6, "0").alias("usaf"),
        F.lpad(F.trim("WBAN"), 5, "0").alias("wban"),
        composite_key([("USAF", 6), ("WBAN", 5)]).alias("station_key"),
        F.trim("STATION NAME").alias("station_name"),
        *[F.upper(F.trim(src)).alias(out) for src, out in (("CTRY", "country"), ("STATE", "state"), ("ICAO", "icao"))],
        *[
            F.trim(F.col(f"`{src}`")).try_cast("double").alias(out)
            for src, out in (("LAT", "station_lat"), ("LON", "station_lon"), ("ELEV(M)", "elev_m"))
        ],
        *[
            F.trim(src).try_cast("int").alias(out)
            for src, out in (("BEGIN", "begin_yyyymmdd"), ("END", "end_yyyymmdd"))
        ],
    ).withColumns({"begin_year": yyyymmdd_year("begin_yyyymmdd"), "end_year": yyyymmdd_year("end_yyyymmdd")})
    usable = keep(
        typed,
        F.col("country") == country,
        in_range("station_lat", -90.0, 90.0),
        in_range("station_lon", -180.0, 180.0),
        covers("begin_year", "end_year", *span),
    )
    return pick_first(usable, ["station_key"], station_preference()).select(*C.STATIONS.columns)


# Cutoff and the box around the mapped venues.
MAX_KM = 200.0
VENUE_LAT, VENUE_LON = (15.0, 72.0), (-170.0, -60.0)
VENUE_COUNTRY, STATION_COUNTRY = "United States", "US"


def mappable_venues(dim_venue: DataFrame) -> DataFrame:
    """Venues in the box, with eastern longitudes typed for western ones repaired."""
    home = dim_venue.filter(F.col("country") == VENUE_COUNTRY)
    placed = home.withColumnsRenamed({"state": "venue_state", "lat": "venue_lat", "lon": "lon_raw"})
    placed = placed.withColumn("venue_lon", repair_sign("lon_raw"))
    return keep(placed, in_range("venue_lat", *VENUE_LAT), in_range("venue_lon", *VENUE_LON))


def mappable_stations(dim_station: DataFrame) -> DataFrame:
    return dim_station.filter(F.col("country") == STATION_COUNTRY).select(
        "station_key", "station_name", F.col("state").alias("station_state"), "station_lat", "station_lon",
        "begin_year", "end_year",
    )


def venue_station_map(dim_venue: DataFrame, dim_station: DataFrame, max_km: float = MAX_KM) -> DataFrame:
    venue, station = mappable_venues(dim_venue), mappable_stations(dim_station)
    best = nearest(
        venue, station, ("venue_lat", "venue_lon"), ("station_lat", "station_lon"), "station_key", max_km
    )
    return stamp(best, selection_reason="nearest_within_max_km").select(*C.VENUE_STATION_MAP.columns)


# Columns of the two reports on venues without a near station.
UNMAPPED_COLUMNS = [
    "stadium_id", "stadium_name", "city", "venue_state", "country", "tz", "venue_lat", "venue_lon", "lon_raw",
]
NEAREST_ANY_COLUMNS = [
    "stadium_id", "stadium_name", "city", "venue_state", "venue_lat", "venue_lon", "station_key", "station_name",
    "station_state", "station_lat", "station_lon", "distance_km",
]


def unmapped_venues(dim_venue: DataFrame, mapped: DataFrame) -> DataFrame:
    return unmatched(mappable_venues(dim_venue), mapped, ["stadium_id"]).select(*UNMAPPED_COLUMNS)


def nearest_for_unmapped(unmapped: DataFrame, dim_station: DataFrame) -> DataFrame:
    """Closest station at any distance, to tell a bad coordinate from a remote venue."""
    found = nearest(
        unmapped,
        mappable_stations(dim_station),
        ("venue_lat", "venue_lon"),
        ("station_lat", "station_lon"),
        "station_key",
    )
    return found.select(*NEAREST_ANY_COLUMNS)


def hourly_preference() -> list[Column]:
    """The fixed-width source first, then the report closest to the hour, then the file name; the
    measures settle two reports with equal time in one file."""
    return [
        F.when(F.col("source_dataset") == "isd", 0).otherwise(1).asc(),
        F.abs("obs_minute").asc(),
        F.col("source_file_uri").asc(),
        *[F.col(c).asc_nulls_last() for c in C.MEASURES],
    ]


def parse_lines(lines: DataFrame, parity: bool = False) -> DataFrame:
    """Observations of both text formats; the directory names tell format and station."""
    tagged = with_path_parts(
        lines, {"source": "string", "station_key": "string"}, names={"source": "source_dataset"}
    )
    return parse_by_source(tagged, "source_dataset", parity=parity)


def hourly_observations(lines: DataFrame, manifest: DataFrame, run_ts: str, parity: bool = False) -> DataFrame:
    """Complete hourly grid of every station-year in the manifest."""
    obs = parse_lines(lines, parity).withColumn("obs_hour_utc", F.date_trunc("hour", "obs_utc_ts"))
    hourly = pick_first(obs, C.HOURLY.grain, hourly_preference())
    key_years = manifest.select(F.col("effective_station_key").alias("station_key"), "year_utc")
    measures = ["source_dataset", "source_file_uri", *C.MEASURES]
    full = complete_grid(hour_grid(key_years, "year_utc"), hourly, C.HOURLY.grain, measures)
    full = full.withColumns({"obs_year": F.year("obs_hour_utc"), "obs_month": F.month("obs_hour_utc")})
    return stamp(full, build_run_ts=run_ts).select(*C.HOURLY.columns)


def hourly_summary(obs: DataFrame) -> DataFrame:
    seen = F.sum("obs_present_flag").cast("long")
    return summarize(
        obs,
        {
            "n_rows": row_count(),
            "n_observed_rows": seen,
            "n_missing_rows": row_count() - seen,
            "n_station_keys": F.count_distinct("station_key"),
            "min_obs_hour_utc": F.min("obs_hour_utc"),
            "max_obs_hour_utc": F.max("obs_hour_utc"),
        },
    )


def hourly_missing(obs: DataFrame) -> DataFrame:
    keyed = obs.withColumnRenamed("obs_year", "year_utc")
    return missing_by_group(keyed, "obs_present_flag", ["station_key", "year_utc"]).orderBy(
        F.desc("n_missing_hours"), "station_key", "year_utc"
    )


def weather_measures() -> dict[str, Column]:
    """Formula columns over the hourly measures."""
    rh = humidity("air_temp_c", "dew_point_c")
    u, v = vector_uv("wind_speed_mps", "wind_dir_deg")
    return {
        "relative_humidity_pct": rh,
        "wet_bulb_temp_c": wet_bulb("air_temp_c", rh),
        "apparent_temp_c": apparent_temp("air_temp_c", "dew_point_c", "wind_speed_mps"),
        "wind_u_mps": u,
        "wind_v_mps": v,
    }


def weather_features(
    obs: DataFrame, run_ts: str, source_run_ts: str, parity: bool = False
) -> DataFrame:
    """Feature table on the same keys as the observations."""
    lagged = lag_delta(
        obs, "station_key", "obs_hour_utc", "sea_level_pressure_hpa", PRESSURE_GUARDS, C.DELTAS, parity
    )
    return (
        lagged.withColumns(weather_measures())
        .withColumns(
            {
                "pressure_tendency_3h": trend(C.DELTAS[3]),
                **{out: valid_flag(*cols) for out, cols in C.VALID_FLAGS.items()},
                "source_build_run_ts": F.lit(source_run_ts),
                "feature_build_run_ts": F.lit(run_ts),
                "feature_version": F.lit(C.FEATURE_VERSION),
            }
        )
        .select(*C.FEATURES.columns)
    )


def feature_summary(features: DataFrame) -> DataFrame:
    return summarize(
        features,
        {
            "n_rows": row_count(),
            "n_station_keys": F.count_distinct("station_key"),
            "min_obs_hour_utc": F.min("obs_hour_utc"),
            "max_obs_hour_utc": F.max("obs_hour_utc"),
            **{f"null_rate_{c}": null_rate(c) for c in C.FEATURE_MEASURES},
            **{c: F.max(c) for c in ("source_build_run_ts", "feature_build_run_ts", "feature_version")},
        },
    )
