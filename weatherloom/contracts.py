"""Table contracts: columns and types, grain, metric ranges and column texts."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def schema(**groups: Iterable[str]) -> T.StructType:
    """Schema from runs of equally typed columns; a trailing number keeps run names apart."""
    fields = []
    for kind, names in groups.items():
        dtype = _TYPES[kind.rstrip("0123456789")]
        fields += [T.StructField(n, dtype) for n in names]
    return T.StructType(fields)


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    grain: list[str]
    ratios: list[str] = field(default_factory=list)  # must lie in 0..1
    not_null: list[str] = field(default_factory=list)
    partitions: list[str] = field(default_factory=list)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


# Raw play columns kept, in the order of the play table.
PLAY_COLUMNS = [
    "play_id", "game_id", "season", "season_type", "week", "game_date", "home_team", "away_team", "posteam", "defteam",
    "stadium_id", "stadium", "roof", "surface", "location", "start_time", "time_of_day", "drive", "qtr", "down", "ydstogo",
    "yardline_100", "goal_to_go", "quarter_seconds_remaining", "game_seconds_remaining", "score_differential", "home_score",
    "away_score", "total_home_score", "total_away_score", "play_type", "pass_attempt", "rush_attempt", "shotgun", "no_huddle",
    "pass_length", "air_yards", "yards_after_catch", "complete_pass", "yards_gained", "epa", "wp", "wpa",
]
# Whole-number and measured play columns; the others are text, play_id is double.
PLAY_INTS = {
    "season", "week", "drive", "qtr", "down", "ydstogo", "yardline_100", "goal_to_go", "quarter_seconds_remaining",
    "game_seconds_remaining", "score_differential", "home_score", "away_score", "total_home_score", "total_away_score",
    "pass_attempt", "rush_attempt", "complete_pass", "shotgun", "no_huddle",
}
PLAY_DOUBLES = {"play_id", "epa", "wp", "wpa", "air_yards", "yards_after_catch", "yards_gained"}
# First and last year of the hourly weather.
YEAR_SPAN = (2000, 2025)


def _play_type(name: str) -> T.DataType:
    if name in PLAY_INTS:
        return T.IntegerType()
    return T.DoubleType() if name in PLAY_DOUBLES else T.StringType()


PLAYS = Contract(
    "pbp_play_level_core",
    T.StructType([T.StructField(n, _play_type(n)) for n in PLAY_COLUMNS]),
    ["game_id", "play_id"],
    partitions=["season"],
)

VENUES = Contract(
    "dim_venue",
    schema(
        string=["stadium_id", "stadium_name"],
        double=["lat", "lon"],
        string2=["tz", "roof_type", "city", "state", "country"],
        date=["first_game_date", "last_game_date"],
    ),
    ["stadium_id"],
)

STATIONS = Contract(
    "dim_station_hourly",
    schema(
        string=["usaf", "wban", "station_key", "station_name", "country", "state", "icao"],
        double=["station_lat", "station_lon", "elev_m"],
        int=["begin_yyyymmdd", "end_yyyymmdd", "begin_year", "end_year"],
    ),
    ["station_key"],
)
# Header of the station history file.
STATION_HEADER = [
    "USAF", "WBAN", "STATION NAME", "CTRY", "STATE", "ICAO", "LAT", "LON", "ELEV(M)", "BEGIN", "END",
]

VENUE_STATION_MAP = Contract(
    "venue_station_map_hourly",
    schema(
        string=["stadium_id", "stadium_name", "city", "venue_state", "tz"],
        double=["venue_lat", "venue_lon"],
        string2=["station_key", "station_name", "station_state"],
        double2=["station_lat", "station_lon", "distance_km"],
        int=["begin_year", "end_year"],
        string3=["selection_reason"],
    ),
    ["stadium_id"],
)

MEASURES = [
    "air_temp_c", "dew_point_c", "sea_level_pressure_hpa", "wind_speed_mps", "wind_dir_deg",
]
HOURLY = Contract(
    "noaa_hourly_observations",
    schema(
        string=["station_key"],
        timestamp=["obs_hour_utc"],
        int=["obs_year", "obs_month"],
        string2=["source_dataset", "source_file_uri"],
        double=MEASURES,
        int2=["obs_present_flag"],
        string3=["build_run_ts"],
    ),
    ["station_key", "obs_hour_utc"],
    partitions=["obs_year"],
)

DELTAS = {1: "pressure_delta_1h_hpa", 3: "pressure_delta_3h_hpa", 6: "pressure_delta_6h_hpa"}
FEATURE_MEASURES = [
    "relative_humidity_pct", "wet_bulb_temp_c", "apparent_temp_c", "wind_u_mps", "wind_v_mps",
    *DELTAS.values(),
]
VALID_FLAGS = {
    "rh_valid_flag": ["relative_humidity_pct"],
    "wet_bulb_valid_flag": ["wet_bulb_temp_c"],
    "apparent_temp_valid_flag": ["apparent_temp_c"],
    "wind_components_valid_flag": ["wind_u_mps", "wind_v_mps"],
    "pressure_delta_valid_1h_flag": ["pressure_delta_1h_hpa"],
    "pressure_delta_valid_3h_flag": ["pressure_delta_3h_hpa"],
    "pressure_delta_valid_6h_flag": ["pressure_delta_6h_hpa"],
}
FEATURES = Contract(
    "noaa_hourly_features_extended",
    schema(
        string=["station_key"],
        timestamp=["obs_hour_utc"],
        int=["obs_year", "obs_month"],
        string2=["source_dataset"],
        int2=["obs_present_flag"],
        double=FEATURE_MEASURES,
        int3=["pressure_tendency_3h", *VALID_FLAGS],
        string3=["source_build_run_ts", "feature_build_run_ts", "feature_version"],
    ),
    ["station_key", "obs_hour_utc"],
    partitions=["obs_year"],
)
FEATURE_VERSION = "v1"

BINS = ["temp_bin", "wind_bin", "precip_bin", "roof_env_bin"]
# Numeric bin edges and labels.
TEMP_EDGES = [0.0, 10.0, 20.0, 30.0]
TEMP_LABELS = ["FREEZING_LT_0C", "COLD_0_10C", "COOL_10_20C", "MILD_20_30C", "HOT_GE_30C"]
WIND_EDGES = [3.0, 6.0, 10.0]
WIND_LABELS = ["CALM_LT_3_MPS", "BREEZY_3_6_MPS", "WINDY_6_10_MPS", "STRONG_GE_10_MPS"]
BIN_TEXTS = {
    "UNKNOWN": "Unknown",
    "FREEZING_LT_0C": "< 0C",
    "COLD_0_10C": "0-10C",
    "COOL_10_20C": "10-20C",
    "MILD_20_30C": "20-30C",
    "HOT_GE_30C": ">= 30C",
    "CALM_LT_3_MPS": "< 3 m/s",
    "BREEZY_3_6_MPS": "3-6 m/s",
    "WINDY_6_10_MPS": "6-10 m/s",
    "STRONG_GE_10_MPS": ">= 10 m/s",
    "INDOOR": "Indoor",
    "OUTDOOR": "Outdoor",
    "RETRACTABLE": "Retractable",
}
ROOF_LABELS = ["INDOOR", "OUTDOOR", "RETRACTABLE"]
BIN_DIMENSION = Contract(
    "dim_weather_bins_v1",
    schema(
        string=["bin_type", "bin_value", "bin_label"],
        double=["lower_inclusive", "upper_exclusive"],
        bigint=["sort_order"],
    ),
    ["bin_type", "bin_value"],
)


def _bin_rows() -> list[tuple]:
    def family(name: str, labels: list[str], edges: list[float] | None) -> list[tuple]:
        lows = [None, *edges] if edges else [None] * len(labels)
        highs = [*edges, None] if edges else [None] * len(labels)
        rows = [(name, "UNKNOWN", BIN_TEXTS["UNKNOWN"], None, None, 0)]
        return rows + [
            (name, label, BIN_TEXTS[label], lo, hi, i)
            for i, (label, lo, hi) in enumerate(zip(labels, lows, highs), start=1)
        ]

    return (
        family("temp_bin", TEMP_LABELS, TEMP_EDGES)
        + family("wind_bin", WIND_LABELS, WIND_EDGES)
        + family("precip_bin", [], None)
        + family("roof_env_bin", ROOF_LABELS, None)
    )


BIN_ROWS = _bin_rows()

STAMPS = ["batch_a_build_run_ts", "batch_b_build_run_ts"]
TEAM_GRAIN = ["season", "team", *BINS, "weather_sample"]
PLAYCALL_GRAIN = ["season", "team", "temp_bin", "wind_bin", "precip_bin", "weather_sample"]
ENV_GRAIN = ["season", "roof_env_bin", "weather_sample"]
_COUNTS = [
    "n_plays", "n_pass_attempts", "n_rush_attempts", "n_completions", "n_epa_plays", "n_games",
    "n_games_points", "n_team_games_points",
]
_RATES = ["pass_rate", "completion_pct", "epa_per_play", "points_per_game"]

TEAM_MART = Contract(
    "mart_team_season_weather_v1",
    schema(int=["season"], string=TEAM_GRAIN[1:], bigint=_COUNTS, double=_RATES, string2=STAMPS),
    TEAM_GRAIN,
    ratios=["pass_rate", "completion_pct"],
    partitions=["season", "weather_sample"],
)
PLAYCALL_MART = Contract(
    "mart_play_calling_weather_v1",
    schema(
        int=["season"],
        string=PLAYCALL_GRAIN[1:],
        bigint=["n_plays", "n_pass_attempts", "n_rush_attempts", "n_games"],
        double=[
            "pass_rate", "rush_rate", "pass_rate_baseline", "rush_rate_baseline",
            "pass_rate_shift_vs_team_season", "rush_rate_shift_vs_team_season",
        ],
        string2=STAMPS,
    ),
    PLAYCALL_GRAIN,
    ratios=["pass_rate", "rush_rate", "pass_rate_baseline", "rush_rate_baseline"],
    partitions=["season", "weather_sample"],
)
ENV_MART = Contract(
    "mart_indoor_outdoor_compare_v1",
    schema(
        int=["season"], string=ENV_GRAIN[1:], bigint=[*_COUNTS, "n_teams"], double=_RATES, string2=STAMPS
    ),
    ENV_GRAIN,
    ratios=["pass_rate", "completion_pct"],
    partitions=["season", "weather_sample"],
)
MARTS = {"team": TEAM_MART, "playcall": PLAYCALL_MART, "indoor": ENV_MART}

SERVING_VERSION = "v1"
SERVING_METADATA = [
    "source_batch_a_build_run_ts", "source_batch_b_build_run_ts", "serving_build_run_ts",
    "serving_version", "serving_run_id",
]

# the run id is checked through the audit tables, not per column
SERVING_NOT_NULL = SERVING_METADATA[:4]


def serving_contract(name: str, source: Contract) -> Contract:
    extra = [T.StructField(c, T.StringType()) for c in SERVING_METADATA]
    return Contract(
        name,
        T.StructType([*source.schema.fields, *extra]),
        source.grain,
        ratios=source.ratios,
        not_null=SERVING_NOT_NULL,
        partitions=source.partitions,
    )


SERVING = {
    "team": serving_contract("serv_team_season_weather_v1", TEAM_MART),
    "playcall": serving_contract("serv_play_calling_weather_v1", PLAYCALL_MART),
    "indoor": serving_contract("serv_indoor_outdoor_compare_v1", ENV_MART),
}

RUN_AUDIT = Contract(
    "run_audit_v1",
    schema(
        string=[
            "serving_run_id", "serving_version", "serving_build_run_ts", "source_batch_a_build_run_ts",
            "source_batch_b_build_run_ts", "status", "started_at_utc", "completed_at_utc",
        ],
        bigint=[
            "source_team_rows", "source_playcall_rows", "source_indoor_rows", "serving_team_rows",
            "serving_playcall_rows", "serving_indoor_rows", "dq_fail_count",
        ],
    ),
    ["serving_run_id"],
    not_null=["serving_run_id", "serving_build_run_ts", "status"],
)
TABLE_AUDIT = Contract(
    "table_audit_v1",
    schema(
        string=["table_name"],
        bigint=["source_row_count", "serving_row_count"],
        int=["min_season", "max_season"],
        bigint2=["n_weather_samples", "sum_n_plays", "duplicate_grain_rows"],
        string2=SERVING_METADATA,
    ),
    ["serving_run_id", "table_name"],
    not_null=["serving_run_id", "table_name", "serving_row_count"],
)
DQ_AUDIT = Contract(
    "dq_audit_v1",
    schema(
        string=[
            "check_name", "table_name", "expected_value", "actual_value", "status", "severity",
            *SERVING_METADATA,
        ]
    ),
    ["serving_run_id", "table_name", "check_name"],
    not_null=["serving_run_id", "table_name", "check_name", "status"],
)
DICTIONARY = Contract(
    "data_dictionary_v1",
    schema(
        string=["table_name", "column_name", "data_type"],
        int=["ordinal_position", "is_grain_key"],
        string2=["column_description", "serving_build_run_ts", "serving_version", "serving_run_id"],
    ),
    ["serving_run_id", "table_name", "column_name"],
    not_null=["serving_run_id", "table_name", "column_name", "ordinal_position"],
)
AUDITS = {"run": RUN_AUDIT, "table": TABLE_AUDIT, "dq": DQ_AUDIT, "dictionary": DICTIONARY}
# Audit rows one run must leave behind (three tables, nine checks each, 72 columns).
AUDIT_ROWS = {"run": 1, "table": 3, "dq": 27, "dictionary": 72}

RECON_TABLE = Contract(
    "batch_c2_table_recon_v1",
    schema(
        string=["run_id", "table_name"],
        bigint=[
            "expected_rows", "actual_rows", "duplicate_key_rows", "null_partition_key_rows",
            "metric_range_violations",
        ],
        int=["min_season", "max_season"],
        string2=["status", "details"],
    ),
    ["run_id", "table_name"],
)

# Column texts of the data dictionary.
COLUMN_TEXTS = {
    "season": "NFL season year.",
    "team": "Offense team abbreviation.",
    "temp_bin": "Temperature bin label from dim_weather_bins_v1.",
    "wind_bin": "Wind bin label from dim_weather_bins_v1.",
    "precip_bin": "Precipitation bin label from dim_weather_bins_v1.",
    "roof_env_bin": "Roof environment category.",
    "weather_sample": "Weather sampling scope: ALL_PLAYS or OBSERVED_ONLY.",
    "n_plays": "Number of offensive plays in the grain.",
    "n_pass_attempts": "Pass attempts count.",
    "n_rush_attempts": "Rush attempts count.",
    "n_completions": "Completions count.",
    "n_epa_plays": "EPA-valid play count.",
    "n_games": "Distinct games count.",
    "pass_rate": "Pass attempts divided by offensive attempts.",
    "rush_rate": "Rush attempts divided by offensive attempts.",
    "completion_pct": "Completions divided by pass attempts.",
    "epa_per_play": "EPA sum divided by EPA-valid plays.",
    "points_per_game": "Average final points per team-game in grain.",
    "source_batch_a_build_run_ts": "Upstream Batch A run timestamp.",
    "source_batch_b_build_run_ts": "Upstream Batch B run timestamp.",
    "serving_build_run_ts": "Batch C1 serving build timestamp.",
    "serving_version": "Serving contract version.",
    "serving_run_id": "Unique Batch C1 run identifier.",
}
DEFAULT_COLUMN_TEXT = "Serving column mirrored from Batch B mart."
