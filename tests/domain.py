"""Small hand-made football and weather inputs covering the odd cases of each source."""

from __future__ import annotations

import csv
import gzip
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

PLAY_FIELDS = {
    "play_id": "double", "game_id": "string", "season": "double", "season_type": "string", "week": "int",
    "game_date": "string", "home_team": "string", "away_team": "string", "posteam": "string", "defteam": "string",
    "stadium_id": "string", "stadium": "string", "roof": "string", "surface": "string", "location": "string",
    "start_time": "string", "time_of_day": "string", "play_type": "string", "pass_attempt": "double",
    "rush_attempt": "double", "complete_pass": "double", "yards_gained": "double", "epa": "double",
    "home_score": "double", "away_score": "double", "extra": "string",
}
DEFAULTS = {
    "season_type": "REG", "week": 1, "home_team": "BUF", "away_team": "MIA", "posteam": "BUF", "defteam": "MIA",
    "stadium_id": "BUF00", "stadium": "Field", "roof": "outdoors", "start_time": "9/10/2023, 13:00:00",
    "play_type": "pass", "pass_attempt": 1.0, "rush_attempt": 0.0, "complete_pass": 1.0, "yards_gained": 5.0,
    "epa": 0.5, "home_score": 24.0, "away_score": 17.0, "extra": "x", "game_id": "2023_01_MIA_BUF",
    "season": 2023.0, "game_date": "2023-09-10",
}

# time_of_day text -> expected UTC hour of the play in the New York zone
TIMES = {
    "2023-09-10T17:02:13Z": 17,
    "2023-09-10T18:02:13.123Z": 18,
    "2023-09-10T19:02:13+00:00": 19,
    "9/10/23, 13:02:13": 17,
    "9/10/2023, 14:02:13": 18,
    "2023-09-10 15:02:13": 19,
    "2023-09-10T13:02:13": 17,
    "14:02:13": 18,
    "12/31/69, 19:00:00": 17,  # implausible year: falls back to the kickoff
    " ": 17,
    "garbage": 17,
}


def _play(i: int, **changes):
    row = {**DEFAULTS, "play_id": float(i), **changes}
    return tuple(row.get(f) for f in PLAY_FIELDS)


def write_plays(spark: SparkSession, root: Path) -> None:
    rows = [_play(i, time_of_day=text) for i, text in enumerate(TIMES, start=1)]
    n = len(rows)
    rows += [
        _play(n + 1, time_of_day=None, play_type="run", pass_attempt=0.0, rush_attempt=1.0, complete_pass=0.0),
        _play(n + 2, time_of_day=None, start_time=None, epa=None),
        _play(n + 3, time_of_day="2023-09-10T17:00:00Z", posteam=" MIA "),
        _play(n + 4, time_of_day="2023-09-10T17:00:00Z", play_type="punt"),
        _play(n + 5, time_of_day="2023-09-10T17:00:00Z", posteam=None),
        _play(n + 6, time_of_day="2023-09-10T17:00:00Z", pass_attempt=0.0),
        _play(n + 7, time_of_day="2023-09-10T17:00:00Z", stadium_id="LON00"),
        _play(n + 8, time_of_day="2023-09-10T17:00:00Z", stadium_id=None),
        _play(n + 9, time_of_day="2023-09-10T21:30:00Z"),  # hour without an observation
    ]
    schema = ", ".join(f"{k} {v}" for k, v in PLAY_FIELDS.items())
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(root / "plays/raw_2023"))
    older = [
        _play(1, season=2022.0, game_id="2022_01_MIA_BUF", game_date="2022-12-31", time_of_day="2022-12-31T23:10:00Z",
              start_time=None, home_score=3.0, away_score=0.0),
        _play(2, season=2022.0, game_id="2022_01_MIA_BUF", game_date="2022-12-31", time_of_day="2022-12-31T23:20:00Z",
              start_time=None, home_score=3.0, away_score=0.0, posteam="MIA"),
    ]
    # another year, another type for season, and two columns fewer
    spark.createDataFrame(older, schema).withColumn("season", F.col("season").cast("int")).drop(
        "surface", "location"
    ).coalesce(1).write.parquet(str(root / "plays/raw_2022"))
    for year in (2022, 2023):
        part = next((root / f"plays/raw_{year}").glob("part-*.parquet"))
        target = root / "play_files" / f"play_by_play_{year}.parquet"
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(part.read_bytes())


STADIUM_HEADER = [
    "stadium_id", "stadium_name", "lat", "lon", "tz", "roof_type", "city", "state", "country", "first_game_date",
    "last_game_date", "extra",
]
US = "United States"
STADIUMS = [
    ["BUF00", 'The "Big"\nField', "42.77", "-78.79", "America/New_York", "Outdoors", "Orchard Park", "NY", US, "1973-01-01", "2024-01-01", "e"],
    ["BUF00", "Old name", "42.77", "-78.79", "America/New_York", "open", "Orchard Park", "NY", US, "1973-01-01", "2001-01-01", "e"],
    ["BUF00", "No dates", "42.77", "-78.79", "America/New_York", "open", "Orchard Park", "NY", US, "", "", "e"],
    ["DET00", "Dome", "42.34", "83.05", "America/Detroit", "Domed", "Detroit", "MI", US, "2002-01-01", "2024-01-01", "e"],
    ["HON00", "Island", "21.37", "-157.93", "Pacific/Honolulu", " ", "Honolulu", "HI", US, "1975-01-01", "2016-01-01", "e"],
    ["LON00", "Wembley", "51.55", "-0.28", "Europe/Frankfurt", "Retractable Roof", "London", "", "United Kingdom", "2007-01-01", "2024-01-01", "e"],
    ["BAD01", "Tz", "40", "-80", "", "closed", "X", "PA", US, "", "", "e"],
    ["BAD02", "Lat", "95", "200", "UTC", "closed", "X", "PA", US, "", "", "e"],
    ["BAD03", "Text", "north", "", "UTC", "closed", "X", "PA", US, "", "", "e"],
    [" ", "No id", "40", "-80", "UTC", "closed", "X", "PA", US, "", "", "e"],
]


def write_stadiums(root: Path) -> None:
    with open(root / "stadiums.csv", "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(STADIUM_HEADER)
        writer.writerows(STADIUMS)


STATIONS = [
    ["725280", "14733", "BUFFALO", "US", "NY", "KBUF", "+42.941", "-078.736", "+0218.2", "19420201", "20250801"],
    ["725280", "14733", "BUF", "US", "NY", "KBUF", "+42.941", "-078.736", "+0218.2", "19730101", "20250801"],
    ["1", "99", "TINY ID", "US", "NY", "", "+43.100", "-078.900", "+0001.0", "19900101", "20251231"],
    ["725370", "94847", "DETROIT", "us", "MI", "KDTW", "+42.231", "-083.331", "+0192.0", "19580101", "20250801"],
    ["A00001", "12345", "LATE", "US", "NY", "KLAT", "+42.770", "-078.790", "+0192.0", "20010101", "20250801"],
    ["A00002", "12345", "EARLY END", "US", "NY", "KEND", "+42.770", "-078.790", "+0192.0", "19580101", "20240801"],
    ["A00003", "12345", "NO LAT", "US", "NY", "KNOL", "", "-078.790", "+0192.0", "19580101", "20250801"],
    ["A00004", "12345", "ABROAD", "CA", "", "CYYZ", "+43.600", "-079.600", "+0192.0", "19580101", "20250801"],
]
STATION_HEADER = ["USAF", "WBAN", "STATION NAME", "CTRY", "STATE", "ICAO", "LAT", "LON", "ELEV(M)", "BEGIN", "END"]


def write_stations(root: Path) -> None:
    with open(root / "isd-history.csv", "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(STATION_HEADER)
        writer.writerows(STATIONS)


def isd_line(stamp: str, direction: str, speed: str, temp: str, dew: str, slp: str) -> str:
    line = list("0" * 15 + stamp + "." * 33 + direction + "1N" + speed + "." * 18 + temp + "1" + dew + "1" + slp + "1")
    return "".join(line)


def write_weather(root: Path) -> None:
    def put(source: str, year: int, station: str, lines: list[str]) -> None:
        folder = root / f"isd/source={source}/year={year}/station_key={station}"
        folder.mkdir(parents=True)
        with gzip.open(folder / "x.gz", "wt") as f:
            f.write("\n".join(lines) + "\n")

    buf = "725280-14733"
    put("isd", 2023, buf, [
        isd_line("202309101653", "360", "0050", "+0210", "+0150", "10132"),
        isd_line("202309101700", "360", "0050", "+0215", "+0150", "10130"),  # minute 00 wins its hour
        isd_line("202309101753", "999", "9999", "+9999", "+9999", "99999"),
        isd_line("202309101800", "090", "0120", "+0050", "-0010", "09985"),
        isd_line("202309101900", "180", "0000", "-0050", "-0100", "10151"),
        isd_line("2023091", "180", "0000", "-0050", "-0100", "10151"),
        isd_line("20X309102000", "180", "0000", "-0050", "-0100", "10151"),
        "short",
    ])
    put("isd_lite", 2023, buf, [
        "2023 09 10 17 999 999 999 10 999 0 0 0",  # the fixed-width report is preferred
        "2023 09 10 20 100 50 10140 -1 30 0 0 0",
        "2023 13 10 20 100 50 10140 90 30 0 0 0",
        "2023 09 10 22 100 50 10140 90 30 0 0",
    ])
    put("isd", 2022, buf, [isd_line("202212312300", "270", "0100", "-0150", "-0200", "10200")])
    put("isd", 2022, "725370-94847", [isd_line("202207040000", "270", "0100", "+0300", "+0250", "10100")])


MANIFEST = [("725280-14733", 2023), ("725280-14733", 2022), ("725280-14733", 2023), ("725370-94847", 2022), ("725370-94847", 2020)]


def write_all(spark: SparkSession, root: Path) -> None:
    write_plays(spark, root)
    write_stadiums(root)
    write_stations(root)
    write_weather(root)
    spark.createDataFrame(MANIFEST, "effective_station_key string, year_utc int").write.parquet(str(root / "manifest"))
