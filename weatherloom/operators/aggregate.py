"""Aggregates: summaries, null-rate profiles, QC metrics, and multi-sample marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weatherloom.functions.cleaning import ones, safe_ratio


def summarize(df: DataFrame, aggs: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    columns = [c.alias(n) for n, c in aggs.items()]
    return df.groupBy(*by).agg(*columns) if by else df.agg(*columns)


def summarize_distinct(
    df: DataFrame,
    distinct: Mapping[str, str],
    sums: Mapping[str, str] | None = None,
    spans: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row: ``n_rows``, distinct counts ``{column: output}``, sums, and min_/max_ of ``spans``.

    Several distinct counts in one aggregate make Spark repeat every input row per count. Reducing
    to the combinations of the counted columns first leaves that to a far smaller table.
    """
    sums, spans = sums or {}, spans or {}
    combined = df.groupBy(*distinct).agg(
        row_count().alias("__n"),
        *[F.sum(c).alias(f"__sum_{c}") for c in sums],
        *[fn(c).alias(f"__{name}_{c}") for c in spans for name, fn in (("min", F.min), ("max", F.max))],
    )
    return combined.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).cast("long").alias("n_rows"),
        *[F.count_distinct(c).alias(out) for c, out in distinct.items()],
        *[F.sum(f"__sum_{c}").cast("long").alias(out) for c, out in sums.items()],
        *[F.min(f"__min_{c}").alias(f"min_{out}") for c, out in spans.items()],
        *[F.max(f"__max_{c}").alias(f"max_{out}") for c, out in spans.items()],
    )


def row_count() -> Column:
    return F.count(F.lit(1))


def null_rate(c: str) -> Column:
    return F.avg(ones(F.col(c).isNull()))


def share(condition: Column) -> Column:
    return F.avg(ones(condition))


def null_rates(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count and share of nulls per column, overall or per group, in one pass."""
    return summarize(df, {"n_rows": row_count(), **{f"null_rate_{c}": null_rate(c) for c in cols}}, by)


def coverage(df: DataFrame, flags: Mapping[str, str], by: Sequence[str] = (), rate_of: Sequence[str] = ()) -> DataFrame:
    """Row count, sums of 0/1 flags ``{flag: output}``, and the mean of the flags in ``rate_of``."""
    aggs = {"n_rows": row_count()}
    aggs |= {out: F.sum(f).cast("long") for f, out in flags.items()}
    aggs |= {f"rate_{f}": F.avg(f) for f in rate_of}
    return summarize(df, aggs, by)


def missing_by_group(df: DataFrame, present: str, by: Sequence[str]) -> DataFrame:
    """Expected, observed and missing slots per group."""
    seen = F.sum(present).cast("long")
    return summarize(
        df,
        {"n_expected_hours": row_count(), "n_observed_hours": seen, "n_missing_hours": row_count() - seen},
        by,
    )


def to_rows(one_row: DataFrame, metrics: Sequence[str], dtype: str = "string") -> DataFrame:
    """Turn the columns of a one-row DataFrame into (metric, value) rows."""
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).cast(dtype).alias("value")) for m in metrics]
    return one_row.select(F.inline(F.array(*pairs)))


def qc_metrics(df: DataFrame, aggs: Mapping[str, Column], dtype: str = "string") -> DataFrame:
    """(metric, value) table; every metric comes from the same single pass."""
    return to_rows(summarize(df, aggs), list(aggs), dtype)


def category_distribution(df: DataFrame, c: str, out: str = "count") -> DataFrame:
    return df.groupBy(c).agg(row_count().alias(out)).orderBy(F.desc(out), F.asc(c))


def distinct_then(
    df: DataFrame, distinct_keys: Sequence[str], grain: Sequence[str], value: str, aggs: Mapping[str, Column]
) -> DataFrame:
    """Reduce to one row per ``distinct_keys`` (largest ``value``), then aggregate to the grain."""
    once = df.groupBy(*distinct_keys).agg(F.max(value).alias(value))
    return summarize(once, aggs, grain)


def table_stats(df: DataFrame, name: str, season: str = "season", sample: str = "weather_sample", plays: str = "n_plays") -> DataFrame:
    return summarize(
        df,
        {
            "serving_row_count": row_count(),
            "min_season": F.min(season).cast("int"),
            "max_season": F.max(season).cast("int"),
            "n_weather_samples": F.count_distinct(sample),
            "sum_n_plays": F.sum(plays).cast("long"),
        },
    ).withColumn("table_name", F.lit(name))


SAMPLE = "weather_sample"
# Sample names and the base flag that selects each (None = every row).
SAMPLES = {"ALL_PLAYS": None, "OBSERVED_ONLY": "weather_observed_flag"}


RUN_STAMP = "batch_a_build_run_ts"
STAMP_NUMBER = "__stamp"
#: Build stamps a table may hold; there is one for each build whose rows it keeps.
MAX_STAMPS = 1000
# how the totals of units add up: counts and sums by sum, the rest by max
SUMMED = ["n_plays", "n_pass_attempts", "n_rush_attempts", "n_completions", "n_epa_plays", "epa_sum"]
LARGEST = ["points", STAMP_NUMBER]


def run_stamps(df: DataFrame) -> list[str]:
    """The distinct run stamps of a table, in order. One job over one column."""
    found = [r[0] for r in df.select(RUN_STAMP).distinct().limit(MAX_STAMPS + 2).collect() if r[0] is not None]
    if len(found) > MAX_STAMPS:
        raise ValueError(f"more than {MAX_STAMPS} run stamps in one table")
    return sorted(found)


def number_stamps(df: DataFrame, stamps: Sequence[str]) -> DataFrame:
    """The run stamp, any text, as its place among ``stamps``: Spark can take the largest number of a
    group in a hash table, but must sort for the largest text."""
    listed = F.array(*[F.lit(s) for s in stamps]) if stamps else F.array().cast("array<string>")
    place = F.nullif(F.array_position(listed, F.col(RUN_STAMP)), F.lit(0)).cast("int")
    return df.withColumn(STAMP_NUMBER, place).drop(RUN_STAMP)


def name_stamps(df: DataFrame, stamps: Sequence[str]) -> DataFrame:
    """Undo :func:`number_stamps`."""
    listed = F.array(*[F.lit(s) for s in stamps]) if stamps else F.array().cast("array<string>")
    return df.withColumn(RUN_STAMP, F.get(listed, F.col(STAMP_NUMBER) - 1)).drop(STAMP_NUMBER)


def unit_totals(
    base: DataFrame, grain: Sequence[str], unit: Sequence[str], samples: Mapping[str, str | None] = SAMPLES,
    stamps: Sequence[str] | None = None,
) -> DataFrame:
    """Totals per grain, unit (a game, or a team's game) and sample.

    The facts are read and shuffled once: each sample is a set of conditional sums, and rows are
    repeated per sample only after this reduction. All buffers are numbers, so tasks combine rows
    in hash tables before the shuffle. ``stamps`` are the run stamps that ``base`` holds, if the caller
    knows them; otherwise they are looked up first.
    """
    stamps = run_stamps(base) if stamps is None else stamps
    return name_stamps(_unit_totals(number_stamps(base, stamps), grain, unit, samples), stamps)


def _unit_totals(
    base: DataFrame, grain: Sequence[str], unit: Sequence[str], samples: Mapping[str, str | None] = SAMPLES
) -> DataFrame:
    def totals(member: str | None) -> Column:
        def when_in(c: Column) -> Column:
            return c if member is None else F.when(F.col(member) == 1, c)

        return F.struct(
            F.count(when_in(F.lit(1))).alias("n_plays"),
            F.sum(when_in(F.col("is_pass"))).alias("n_pass_attempts"),
            F.sum(when_in(F.col("is_rush"))).alias("n_rush_attempts"),
            F.sum(when_in(F.col("is_complete"))).alias("n_completions"),
            F.count(when_in(F.col("epa"))).alias("n_epa_plays"),
            F.sum(when_in(F.col("epa"))).alias("epa_sum"),
            F.max(when_in(F.col("team_points_final"))).alias("points"),
            F.max(when_in(F.col(STAMP_NUMBER))).alias(STAMP_NUMBER),
        )

    per_unit = base.groupBy(*grain, *unit).agg(*[totals(m).alias(s) for s, m in samples.items()])
    repeated = per_unit.select(
        *grain, *unit, F.explode(F.array(*[F.struct(F.lit(s).alias("name"), F.col(s).alias("t")) for s in samples])).alias("__s")
    )
    return repeated.select(*grain, *unit, F.col("__s.name").alias(SAMPLE), "__s.t.*").filter(F.col("n_plays") > 0)


def collapse_units(
    units: DataFrame, keys: Sequence[str], tasks: int | None = None, deal_by: Sequence[str] | None = None
) -> DataFrame:
    """Unit totals, with numbered stamps, at fewer keys; counts, sums and maxima all combine.

    With ``tasks``, the units are dealt to so many by ``deal_by`` (some of the keys; default: all), and are
    combined there without another shuffle.
    """
    if tasks is not None:
        units = units.repartition(tasks, *(deal_by or keys))
    return units.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in SUMMED], *[F.max(c).alias(c) for c in LARGEST]
    )


def mart(
    base: DataFrame,
    grain: Sequence[str],
    samples: Mapping[str, str | None] = SAMPLES,
    team: str = "team",
    game: str = "game_id",
    stamps: Sequence[str] | None = None,
) -> DataFrame:
    """All mart measures at ``grain`` + sample; callers select the columns their contract has."""
    stamps = run_stamps(base) if stamps is None else stamps
    unit = [game] if team in grain else [team, game]
    units = _unit_totals(number_stamps(base, stamps), grain, unit, samples)
    return name_stamps(mart_of_units(units, grain, team, game), stamps)


def mart_of_units(
    units: DataFrame, grain: Sequence[str], team: str = "team", game: str = "game_id", members: DataFrame | None = None
) -> DataFrame:
    """A mart from unit totals at its own grain, both with numbered stamps.

    Games are counted, and points averaged, over one row per team and game, so no second pass over
    the facts and no join of two aggregates is needed. Units that were shuffled to get to the grain are
    shuffled once more to list the teams; ``members``, finer units of the same facts, spare that.
    """
    keys = [*grain, SAMPLE]
    if team in grain:
        # with the team in the grain every unit row is a different game
        rows = units.withColumns(
            {
                "n_games": F.lit(1),
                "n_games_points": ones(F.col("points").isNotNull()),
                "n_team_games_points": ones(F.col("points").isNotNull()),
                "points_sum": F.col("points"),
                "n_teams": F.lit(0),
            }
        )
    else:
        # rows per game, and rows per team that only count it: several distinct counts in one
        # aggregate would repeat every unit row instead
        games = units.groupBy(*keys, game).agg(
            *[F.sum(c).alias(c) for c in SUMMED],
            F.max(STAMP_NUMBER).alias(STAMP_NUMBER),
            F.lit(1).alias("n_games"),
            F.max(ones(F.col("points").isNotNull())).alias("n_games_points"),
            F.count("points").alias("n_team_games_points"),
            F.sum("points").alias("points_sum"),
        )
        listed = units if members is None else members
        teams = listed.select(*keys, team).distinct().filter(F.col(team).isNotNull()).select(*keys, F.lit(1).alias("n_teams"))
        rows = games.unionByName(teams, allowMissingColumns=True)
    counts = [*[c for c in SUMMED if c != "epa_sum"], "n_games", "n_games_points", "n_team_games_points", "n_teams"]
    aggs = {c: F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in counts}
    aggs |= {"epa_sum": F.sum("epa_sum"), "points_sum": F.sum("points_sum"), STAMP_NUMBER: F.max(STAMP_NUMBER)}
    attempts = F.col("n_pass_attempts") + F.col("n_rush_attempts")
    out = summarize(rows, aggs, keys).withColumns(
        {
            "pass_rate": safe_ratio("n_pass_attempts", attempts),
            "rush_rate": safe_ratio("n_rush_attempts", attempts),
            "completion_pct": safe_ratio("n_completions", "n_pass_attempts"),
            "epa_per_play": safe_ratio("epa_sum", "n_epa_plays"),
            "points_per_game": safe_ratio("points_sum", "n_team_games_points"),
        }
    )
    # a group whose games all lack points has no point counts at all
    no_points = {
        c: F.nullif(F.col(c), F.lit(0)) for c in ("n_games_points", "n_team_games_points")
    }
    return out.withColumns(no_points)
