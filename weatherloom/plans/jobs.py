"""The layered build from raw inputs to served tables, as an ordered list of plain functions.

Every table is written once and then gated, summarised and joined from its written form; nothing
is recomputed per gate. Large intermediates live in files, so a lost executor costs its tasks only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weatherloom import contracts as C
from weatherloom.operators.aggregate import category_distribution, null_rates, qc_metrics, row_count, run_stamps
from weatherloom.operators.columns import conform, stamp, unique_columns
from weatherloom.operators.gates import GateError, duplicate_check, enforce, failures, required_columns_check, run_gates
from weatherloom.operators.observed import ObservedChecks
from weatherloom.operators.rows import union_named
from weatherloom.plans import gold, serving, silver
from weatherloom.plans.validators import (
    column_copies_agree,
    stamps_agree,
    validate_fact,
    validate_features,
    validate_marts,
    validate_serving,
)
from weatherloom.sources.inputs import Changes, file_schemas, is_one_of, list_files, pending, read_by_schema
from weatherloom.sources.publish import contract_checks, publish_metadata, publish_swap, published_path, read_published, schema_gate
from weatherloom.sources.scan import scan, scan_csv, scan_text_lines
from weatherloom.sources.sink import append_audit, commit_marker_exists, replace_slices, write_partitioned

Clock = Callable[[], dt.datetime]


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def run_stamp(at: dt.datetime) -> str:
    return at.strftime("%Y%m%dT%H%M%SZ")


@dataclass
class Workspace:
    """Layered folders under one root, and the inputs to build from."""

    spark: SparkSession
    root: str
    plays: str
    stadiums: str
    station_history: str
    weather_text: str
    manifest: str
    clock: Clock = utc_now
    year_span: tuple[int, int] = C.YEAR_SPAN  # years the hourly weather must start and end with
    catalog: str = "serving"  # database in which published tables are registered
    asof_hours: int | None = None  # how old an observation may be that stands in for a missing one; None: no stand-ins

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def save(
        self, df: DataFrame, layer: str, table: str, keys: list[str] | None = None, dynamic: bool = False,
        measured: ObservedChecks | None = None,
    ) -> None:
        path = self.path(layer, table)
        if keys:
            write_partitioned(df, path, keys, clustered=True, dynamic=dynamic, measured=measured)
        else:
            (measured.attach(df) if measured else df).write.mode("overwrite").parquet(path)

    def load(self, layer: str, table: str, contract: C.Contract | None = None) -> DataFrame:
        df = scan(self.spark, self.path(layer, table))
        return conform(df, contract.schema) if contract else df

    def load_files(self, layer: str, contracts: dict[str, C.Contract]) -> dict[str, DataFrame]:
        """Tables as their files have them, for the checks of columns and types."""
        return {x: self.load(layer, c.name) for x, c in contracts.items()}

    def save_contract(
        self, df: DataFrame, layer: str, contract: C.Contract, dynamic: bool = False, measured: ObservedChecks | None = None
    ) -> DataFrame:
        self.save(df, layer, contract.name, contract.partitions, dynamic, measured)
        return self.load(layer, contract.name, contract)


PLAY_SLICE = "season"


def play_changes(ws: Workspace) -> Changes:
    """Play files that are new, changed or gone since the last recorded build, and their seasons."""
    return pending(ws.spark, ws.plays, ws.path("qc", "play_files"), PLAY_SLICE)


def raw_plays(ws: Workspace, changes: Changes | None = None) -> DataFrame:
    """Plays of all files, or those of the changed seasons. Files of different years differ in columns
    and types, so the files of each schema are read together and conformed before the union."""
    if changes is None:
        names = [r.path for r in list_files(ws.spark, ws.plays).select("path").collect()]
        parts = read_by_schema(ws.spark, file_schemas(ws.spark, names))
    else:
        parts = changes.read(ws.spark)
    empty = ws.spark.createDataFrame([], C.PLAYS.schema)
    plays = union_named(empty, *[conform(df, C.PLAYS.schema) for _, df in parts])
    return plays if changes is None else plays.filter(changes.holds(F.col(PLAY_SLICE)))


def _save_seasons(ws: Workspace, df: DataFrame, layer: str, table: str, keys: list[str], seasons: list | None) -> None:
    """Write all of a table, or replace the given seasons; those without a row any more disappear."""
    if seasons is None:
        ws.save(df, layer, table, keys)
    else:
        replace_slices(df, ws.path(layer, table), keys, seasons)


def build_plays(ws: Workspace, seasons: list[int] | None = None, changes: Changes | None = None) -> DataFrame:
    """Offensive plays of all seasons, of the given ones, or of those whose files changed; other seasons
    on disk stay."""
    plays = silver.plays_core(raw_plays(ws, changes))
    if changes is not None:
        _save_seasons(ws, plays, "silver", C.PLAYS.name, C.PLAYS.partitions, changes.slices)
        return ws.load("silver", C.PLAYS.name, C.PLAYS)
    if seasons:
        plays = plays.filter(F.col("season").isin(*seasons))
    return ws.save_contract(plays, "silver", C.PLAYS, dynamic=True)


def build_games(ws: Workspace, changes: Changes | None = None) -> DataFrame:
    """Game totals from all plays, before the filter on the team with the ball. A game has one season."""
    games = silver.games(raw_plays(ws, changes))
    _save_seasons(ws, games, "silver", "pbp_game_level", [PLAY_SLICE], None if changes is None else changes.slices)
    return ws.load("silver", "pbp_game_level")


def build_venues(ws: Workspace) -> DataFrame:
    header = ws.spark.read.options(header="true", multiLine="true", escape='"').csv(ws.stadiums)
    missing = [c for c in C.VENUES.columns if c not in header.columns]
    if missing:
        raise GateError(f"stadium file lacks columns {missing}")
    dim, bad = silver.venues(header)
    ws.save(bad, "qc", "dim_venue_bad_rows")
    out = ws.save_contract(dim, "silver", C.VENUES)
    ws.save(qc_metrics(out, {"final_rows": row_count(), "unknown_roof_rows": F.count_if(F.col("roof_type") == "unknown")}), "qc", "dim_venue_summary")
    ws.save(category_distribution(out, "roof_type"), "qc", "dim_venue_roofs")
    return out


def build_stations(ws: Workspace) -> DataFrame:
    dim = silver.stations(scan_csv(ws.spark, ws.station_history, C.STATION_HEADER))
    out = ws.save_contract(dim, "silver", C.STATIONS)
    metrics = {
        "dim_station_rows": row_count(),
        "min_begin_year": F.min("begin_year"),
        "max_end_year": F.max("end_year"),
        "distinct_states": F.count_distinct("state"),
    }
    ws.save(qc_metrics(out, metrics), "qc", "dim_station_summary")
    return out


def build_station_map(ws: Workspace, venues: DataFrame, stations: DataFrame) -> DataFrame:
    mapped = ws.save_contract(silver.venue_station_map(venues, stations), "silver", C.VENUE_STATION_MAP)
    ws.save(silver.unmapped_venues(venues, mapped), "qc", "venue_station_unmapped")
    unmapped = ws.load("qc", "venue_station_unmapped")
    # an empty remainder writes an empty table with the right columns
    ws.save(silver.nearest_for_unmapped(unmapped, stations), "qc", "venue_station_nearest_any")
    counts = stamp(
        mapped.agg(row_count().alias("mapped_venues")), max_km=silver.MAX_KM
    )
    ws.save(counts, "qc", "venue_station_summary")
    return mapped


def build_hourly(ws: Workspace, run_ts: str, parity: bool = False) -> DataFrame:
    lines = scan_text_lines(ws.spark, ws.weather_text)
    manifest = scan(ws.spark, ws.manifest)
    measured = ObservedChecks(contract_checks(C.HOURLY), C.HOURLY.name)
    obs = ws.save_contract(silver.hourly_observations(lines, manifest, run_ts, parity), "silver", C.HOURLY, measured=measured)
    schema, repeats = schema_gate(ws.load("silver", C.HOURLY.name), C.HOURLY), duplicate_check(obs, C.HOURLY.name, C.HOURLY.grain, surplus=True)
    enforce(run_gates([schema, measured.report(ws.spark), repeats]), C.HOURLY.name)
    ws.save(silver.hourly_summary(obs), "qc", "noaa_hourly_summary")
    ws.save(silver.hourly_missing(obs), "qc", "noaa_hourly_missing")
    return obs


def build_features(ws: Workspace, obs: DataFrame, run_ts: str, parity: bool = False) -> DataFrame:
    source_ts = obs.agg(F.max("build_run_ts")).first()[0]
    if source_ts is None:
        raise GateError("hourly observations carry no build stamp")
    built = ws.save_contract(silver.weather_features(obs, run_ts, source_ts, parity), "silver", C.FEATURES)
    ws.save(silver.feature_summary(built), "qc", "features_summary")
    for name, by in (("features_nulls_by_year", ["obs_year"]), ("features_nulls_by_station_year", ["station_key", "obs_year"])):
        ws.save(null_rates(built, C.FEATURE_MEASURES, by), "qc", name)
    report = validate_features(obs, built, ws.load("qc", "features_summary"), ws.year_span)
    enforce(report, C.FEATURES.name)
    return built


FACT = "fact_play_weather_hourly_v1"


def build_fact(
    ws: Workspace, run_ts: str, rates: dict[str, float] | None = None, seasons: list | None = None
) -> DataFrame:
    """The fact of all seasons, or of the given ones beside the others on disk; gates look at what was built."""
    plays = ws.load("silver", C.PLAYS.name, C.PLAYS)
    if seasons is not None:
        plays = plays.filter(is_one_of(F.col(PLAY_SLICE), seasons))
    weather = gold.weather_wide(
        ws.load("silver", C.HOURLY.name, C.HOURLY), ws.load("silver", C.FEATURES.name, C.FEATURES)
    )
    fact = gold.play_weather_fact(
        plays,
        ws.load("silver", "pbp_game_level"),
        ws.load("silver", C.VENUES.name, C.VENUES),
        ws.load("silver", C.VENUE_STATION_MAP.name, C.VENUE_STATION_MAP),
        weather,
        run_ts,
        ws.asof_hours,
    )
    _save_seasons(ws, fact, "gold", FACT, [PLAY_SLICE], seasons)
    ws.save(gold.bin_dimension(ws.spark), "gold", C.BIN_DIMENSION.name)
    built = ws.load("gold", FACT)
    ws.save(gold.fact_summary(built), "qc", "fact_summary")
    ws.save(gold.season_coverage(built), "qc", "fact_coverage_season")
    ws.save(gold.stadium_coverage(built), "qc", "fact_coverage_stadium")
    ws.save(gold.fact_null_rates(built), "qc", "fact_null_rates")
    summary = ws.load("qc", "fact_summary")
    if seasons is not None:
        part = built.filter(is_one_of(F.col(PLAY_SLICE).try_cast("int"), seasons))
        if part.isEmpty():  # the seasons are gone; what is left was gated when it was built
            return built
        built, summary = part, gold.fact_summary(part)
    report = validate_fact(
        plays, built, ws.load("gold", C.BIN_DIMENSION.name), summary,
        gold.REQUIRED_FACT_COLUMNS, **(rates or {}),
    )
    enforce(report, FACT)
    return built


def build_marts(ws: Workspace, run_ts: str, seasons: list | None = None) -> dict[str, DataFrame]:
    """The marts, from unit totals that are kept by season: of all seasons, or the given ones made anew
    beside the others on disk. Every mart has the season in its grain."""
    fact = unique_columns(ws.load("gold", FACT))
    if seasons is not None:
        fact = fact.filter(is_one_of(F.col(PLAY_SLICE).try_cast("int"), seasons))
    gone = seasons is not None and fact.isEmpty()  # the seasons lost their last play
    if not gone:
        enforce(column_copies_agree(fact, FACT), FACT)
    base = gold.base_rows(fact)
    _save_seasons(ws, gold.mart_units(base, run_stamps(fact)), "gold", "mart_units", [PLAY_SLICE], seasons)
    units = ws.load("gold", "mart_units")
    if seasons is not None:
        units = units.filter(is_one_of(F.col(PLAY_SLICE), seasons))
    for x, df in gold.marts_of_units(units, run_ts).items():
        _save_seasons(ws, df, "gold", C.MARTS[x].name, C.MARTS[x].partitions, seasons)
    built = {x: ws.load("gold", c.name, c) for x, c in C.MARTS.items()}
    for x, df in built.items():
        ws.save(gold.mart_summary(df, C.MARTS[x].name), "qc", f"{C.MARTS[x].name}_summary")
        ws.save(gold.sample_totals(df), "qc", f"{C.MARTS[x].name}_samples")
    if seasons is not None:  # gates look at what was built, against summaries of the same
        if not gone:
            part = {x: df.filter(is_one_of(F.col(PLAY_SLICE), seasons)) for x, df in built.items()}
            summaries = {x: gold.mart_summary(df, C.MARTS[x].name) for x, df in part.items()}
            enforce(validate_marts(base, part, summaries, ws.load_files("gold", C.MARTS)), "marts")
        return built
    summaries = {x: ws.load("qc", f"{C.MARTS[x].name}_summary") for x in built}
    enforce(validate_marts(base, built, summaries, ws.load_files("gold", C.MARTS)), "marts")
    return built


def refresh(ws: Workspace, rates: dict[str, float] | None = None) -> list:
    """Bring plays, games, fact, units and marts in line with the play files; returns the seasons rebuilt.

    Only files that changed are opened, and only their seasons, of now and of before, are built again.
    Without a change nothing is written. The rebuilt seasons carry the stamps of the build they complete, so
    the marts equal those of a full build. If another refresh was recorded meanwhile, raises
    PublishConflict, and the seasons are due again. Serving and publishing are steps of their own.
    """
    changes = play_changes(ws)
    if not changes:
        return []
    team = ws.load("gold", C.TEAM_MART.name, C.TEAM_MART)
    a_ts, b_ts = team.agg(*[F.max(c) for c in C.STAMPS]).first()
    if a_ts is None or b_ts is None:
        raise GateError("nothing to refresh: the marts hold no build")
    seasons = sorted(changes.slices, key=lambda s: (s is None, s))
    if seasons:
        build_plays(ws, changes=changes)
        build_games(ws, changes)
        build_fact(ws, a_ts, rates, seasons)
        build_marts(ws, b_ts, seasons)
    changes.commit(ws.spark)
    return seasons


def build_serving(ws: Workspace) -> dict[str, DataFrame]:
    """Serving tables and audits. A failed gate leaves a FAIL row in the run audit before raising."""
    started = ws.clock()
    run_ts = run_stamp(started)
    run_id = f"c1_{run_ts}"
    marts = {x: ws.load("gold", c.name, c) for x, c in C.MARTS.items()}
    # marts of different builds, or without a column the contract names, are not served
    files = ws.load_files("gold", C.MARTS)
    present = [required_columns_check(files[x], c.name, c.columns) for x, c in C.MARTS.items()]
    enforce(run_gates([*present, stamps_agree(marts)]), "serving sources")
    a_ts, b_ts = marts["team"].agg(*[F.max(c) for c in C.STAMPS]).first()
    meta = {"a_ts": a_ts, "b_ts": b_ts, "run_ts": run_ts, "run_id": run_id}
    planned = {x: serving.serve(df, run_ts, run_id) for x, df in marts.items()}
    report = serving.dq_audit([serving.serving_gates(x, marts[x], planned[x]) for x in marts], **meta)
    ws.save(report, "scratch", "dq_report")
    report = ws.load("scratch", "dq_report", C.DQ_AUDIT)

    def audit_run(tables: DataFrame, status: str) -> DataFrame:
        times = {"started_at": started, "completed_at": ws.clock()}
        texts = {k: v.strftime("%Y-%m-%dT%H:%M:%SZ") for k, v in times.items()}
        run = serving.run_audit(tables, report, status, **texts, **meta)
        append_audit(run, ws.path("serving", C.RUN_AUDIT.name))
        return run

    if not failures(report).isEmpty():
        audit_run(serving.table_audit({x: (marts[x], planned[x]) for x in marts}, **meta), "FAIL")
        enforce(report, "serving")
    served = {x: ws.save_contract(df, "serving", C.SERVING[x]) for x, df in planned.items()}
    for x, c in C.SERVING.items():
        if not commit_marker_exists(ws.spark, ws.path("serving", c.name)):
            raise GateError(f"{c.name} has no commit marker")
    tables = serving.table_audit({x: (marts[x], served[x]) for x in marts}, **meta)
    append_audit(tables, ws.path("serving", C.TABLE_AUDIT.name))
    append_audit(report, ws.path("serving", C.DQ_AUDIT.name))
    ws.save(serving.data_dictionary(served, run_ts, run_id).coalesce(1), "serving", C.DICTIONARY.name)
    audit_run(tables, "SUCCESS")
    enforce(validate_serving(marts, served, load_audits(ws), ws.load_files("serving", C.SERVING)), "serving")
    return served


def load_audits(ws: Workspace) -> dict[str, DataFrame]:
    return {x: ws.load("serving", c.name, c) for x, c in C.AUDITS.items()}


def publish(ws: Workspace) -> DataFrame:
    """Publish serving and audit tables of the latest good run, reconcile, and return the readiness
    checklist."""
    audits = load_audits(ws)
    last = serving.latest(audits["run"], "serving_build_run_ts", F.col("status") == "SUCCESS").first()
    expected = {x: last[f"serving_{x}_rows"] for x in C.SERVING}
    root = ws.path("published", "")
    for x, c in C.SERVING.items():
        publish_swap(ws.load("serving", c.name, c), f"{root}{c.name}", c, last.serving_run_id, expected[x])
    publish_metadata(audits, root, C.AUDITS, last.serving_run_id, C.AUDIT_ROWS)
    live = {x: read_published(ws.spark, f"{root}{c.name}", c) for x, c in C.SERVING.items()}
    recon = serving.reconcile(live, expected, f"c2_recon_{run_stamp(ws.clock())}")
    append_audit(recon, ws.path("audit", C.RECON_TABLE.name))
    append_audit(serving.reconcile_run(recon), ws.path("audit", "batch_c2_run_audit_v1"))
    published = {x: read_published(ws.spark, f"{root}{c.name}", c) for x, c in C.AUDITS.items()}
    for c in C.SERVING.values():
        register(ws, c, published_path(ws.spark, f"{root}{c.name}"))
    catalog = serving.catalog_tables(ws.spark)
    return serving.readiness(ws.load("audit", C.RECON_TABLE.name), published, catalog, serving_schema=ws.catalog)


def register(ws: Workspace, contract: C.Contract, path: str) -> None:
    """Name a published version in the catalog. A view over its files takes the place of an earlier one
    in one step of the catalog, so readers find the old version or the new one at any time."""
    ws.spark.sql(f"CREATE DATABASE IF NOT EXISTS {ws.catalog} LOCATION '{ws.path('published', 'catalog')}'")
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in contract.schema.fields)
    ws.spark.sql(f"CREATE OR REPLACE VIEW {ws.catalog}.{contract.name} AS SELECT {columns} FROM parquet.`{path}`")


def run_all(ws: Workspace, fact_rates: dict[str, float] | None = None, parity: bool = False) -> DataFrame:
    run_ts = run_stamp(ws.clock())
    inputs = play_changes(ws)  # as they are before the build; recorded when the marts stand
    build_plays(ws)
    build_games(ws)
    venues, stations = build_venues(ws), build_stations(ws)
    build_station_map(ws, venues, stations)
    obs = build_hourly(ws, run_ts, parity)
    build_features(ws, obs, run_ts, parity)
    build_fact(ws, run_ts, fact_rates)
    build_marts(ws, run_ts)
    inputs.commit(ws.spark)
    build_serving(ws)
    return publish(ws)
