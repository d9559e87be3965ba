"""Landing raw documents: envelope, refresh scopes, season bootstrap, load windows, table manifest."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import codes
from .storage import replace_scope

ENVELOPE = "id bigint, raw_json string, _season_id int, _fixture_date date, _ingested_at timestamp"
DATE_CHUNK_DAYS, DAYS_BACK, DAYS_FORWARD = 90, 7, 30
WARN_HOURS, ERROR_HOURS = 25, 49


def to_documents(df: DataFrame, id_col: str, body: Column, season: Column | None = None, date_text: Column | None = None,
                 loaded_at: Column | None = None) -> DataFrame:
    """Rows as landed documents. The date key is the first ten characters of a text, or NULL."""
    none = lambda kind: F.lit(None).cast(kind)
    day = none("date") if date_text is None else F.nullif(F.left(F.coalesce(date_text, F.lit("")), F.lit(10)),
                                                          F.lit("")).cast("date")
    return df.select(F.col(id_col).cast("bigint").alias("id"), F.to_json(body).alias("raw_json"),
                     (none("int") if season is None else season.cast("int")).alias("_season_id"),
                     day.alias("_fixture_date"),
                     (F.current_timestamp() if loaded_at is None else loaded_at).alias("_ingested_at"))


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed files, one JSON document per line."""
    return spark.read.text(path).withColumnRenamed("value", "raw_json")


def read_seed(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A typed CSV seed; column types are declared, never inferred."""
    return spark.read.schema(ddl).option("header", True).csv(path)


def of_league(docs: DataFrame, league_id: int | str | None) -> DataFrame:
    """Keep the documents of one league; None keeps all."""
    if league_id is None:
        return docs
    return docs.filter(F.get_json_object("raw_json", "$.league_id") == str(league_id))


def bootstrap_seasons(league_docs: DataFrame, first_year: int = codes.FIRST_SEASON_YEAR) -> DataFrame:
    """Seasons nested in league documents, from ``first_year`` on. ``current`` marks the running season, or the newest
    one of a league that has none running."""
    shape = "seasons array<struct<id: bigint, name: string, starting_at: date, ending_at: date, is_current: boolean>>"
    s = league_docs.select(F.col("id").alias("league_id"), F.inline(F.from_json("raw_json", shape)["seasons"]))
    s = s.filter(F.left("name", F.lit(4)).try_cast("int") >= first_year)
    per_league = s.groupBy("league_id").agg(F.max(F.coalesce("is_current", F.lit(False))).alias("_any"),
                                            F.max(F.struct("starting_at", "id"))["id"].alias("_newest"))
    running = F.coalesce("is_current", F.lit(False))
    chosen = F.when(F.col("_any"), running).otherwise(F.col("id") == F.col("_newest"))
    return s.join(per_league, "league_id").select("league_id", "id", "name", "starting_at", "ending_at",
                                                  chosen.alias("current"))


def load_window(mode: str, day: Column, as_of: str | None = None, days_back: int = DAYS_BACK,
                days_forward: int = DAYS_FORWARD) -> Column:
    """Rows a load covers: everything, or a rolling window around ``as_of``."""
    if mode == "full":
        return F.lit(True)
    if mode != "incremental":
        raise ValueError(f"mode must be full or incremental, not {mode!r}")
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return day.between(F.date_sub(today, days_back), F.date_add(today, days_forward))


@dataclass(frozen=True)
class Entry:
    """One landed table: how it is refreshed and what addresses a request for it."""
    table: str
    path: str
    strategy: str
    scope: str


STRATEGIES = {"static", "seasons_from_league", "season_based", "stage_based", "round_based", "team_based", "date_based"}
SCOPES = {"global", "season", "date"}
# table, path template, iteration, refresh scope. Fixed values of the feed.
MANIFEST = (
    Entry("core_continents", "/continents", "static", "global"),
    Entry("core_countries", "/countries", "static", "global"),
    Entry("core_regions", "/regions", "static", "global"),
    Entry("types", "/types", "static", "global"),
    Entry("states", "/states", "static", "global"),
    Entry("tv_stations", "/tv-stations", "static", "global"),
    Entry("league", "/leagues/{league_id}", "static", "global"),
    Entry("seasons", "/leagues/{league_id}", "seasons_from_league", "global"),
    Entry("players", "/players", "static", "global"),
    Entry("stages", "/stages/seasons/{season_id}", "season_based", "season"),
    Entry("rounds", "/rounds/seasons/{season_id}", "season_based", "season"),
    Entry("teams", "/teams/seasons/{season_id}", "season_based", "season"),
    Entry("venues", "/venues/seasons/{season_id}", "season_based", "season"),
    Entry("referees", "/referees/seasons/{season_id}", "season_based", "season"),
    Entry("standings", "/standings/seasons/{season_id}", "season_based", "season"),
    Entry("topscorers", "/topscorers/seasons/{season_id}", "season_based", "season"),
    Entry("stage_topscorers", "/topscorers/stages/{stage_id}", "stage_based", "season"),
    Entry("stage_statistics", "/statistics/stages/{stage_id}", "stage_based", "season"),
    Entry("round_statistics", "/statistics/rounds/{round_id}", "round_based", "season"),
    Entry("rivals", "/rivals/teams/{team_id}", "team_based", "global"),
    Entry("fixtures", "/fixtures/between/{from_date}/{to_date}", "date_based", "date"),
)


def validate_manifest(entries=MANIFEST) -> None:
    problems = [f"{e.table or '?'}: {what}" for e in entries for what, wrong in (
        ("missing table or path", not e.table or not e.path), (f"unknown strategy {e.strategy}", e.strategy not in STRATEGIES),
        (f"unknown scope {e.scope}", e.scope not in SCOPES)) if wrong]
    if problems:
        raise ValueError("; ".join(problems))


def load(spark: SparkSession, landed: Mapping[str, DataFrame], root: str, mode: str, *, seasons: Sequence[int] = (),
         running: Sequence[int] = (), first: date | None = None, last: date | None = None, as_of: date | None = None,
         chunk_days: int = DATE_CHUNK_DAYS, entries: Sequence[Entry] = MANIFEST) -> list[str]:
    """Refresh the bronze tables of the manifest from landed documents (``ENVELOPE`` columns); returns the scopes replaced.

    ``full`` reloads global tables, all ``seasons`` and the days from ``first`` to ``last`` in pieces of ``chunk_days``.
    ``incremental`` reloads global tables, the ``running`` seasons and the rolling window around ``as_of``. A season or a
    window for which nothing landed is emptied. Tables of the manifest that nothing was landed for are left alone.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"mode must be full or incremental, not {mode!r}")
    validate_manifest(entries)
    done = []
    for entry in entries:
        if entry.table not in landed:
            continue
        docs, path = landed[entry.table], f"{root.rstrip('/')}/{entry.table}"
        if entry.scope == "global":
            replace_scope(spark, path, docs, "global")
            done.append(f"{entry.table}: all")
        elif entry.scope == "season":
            wanted = list(seasons if mode == "full" else running)
            replace_scope(spark, path, docs.filter(F.col("_season_id").isin(*wanted) if wanted else F.lit(False)), "season", seasons=wanted)
            done.append(f"{entry.table}: seasons {wanted}")
        else:
            for lo, hi in _windows(mode, first, last, as_of, chunk_days):
                inside = F.col("_fixture_date").between(F.lit(str(lo)).cast("date"), F.lit(str(hi)).cast("date"))
                replace_scope(spark, path, docs.filter(inside), "date", lo, hi)
                done.append(f"{entry.table}: {lo} to {hi}")
    return done


def _windows(mode: str, first: date | None, last: date | None, as_of: date | None, chunk_days: int) -> list[tuple[date, date]]:
    """Closed windows of days that a load of a dated table replaces."""
    if mode == "incremental":
        today = as_of or date.today()
        return [(today - timedelta(days=DAYS_BACK), today + timedelta(days=DAYS_FORWARD))]
    out = []
    while first <= last:
        out.append((first, min(first + timedelta(days=chunk_days - 1), last)))
        first += timedelta(days=chunk_days)
    return out


def freshness(docs: DataFrame, now: Column, ts: str = "_ingested_at") -> DataFrame:
    """Age of the newest row in hours and the severity it means."""
    age = (F.unix_timestamp(now) - F.unix_timestamp(F.max(ts))) / 3600
    return docs.agg(F.max(ts).alias("newest"), age.alias("age_hours")).withColumn(
        "severity", F.when(F.col("age_hours").isNull() | (F.col("age_hours") > ERROR_HOURS), "error")
        .when(F.col("age_hours") > WARN_HOURS, "warn").otherwise("pass"))
