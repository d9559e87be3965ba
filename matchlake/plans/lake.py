"""Landed documents to silver to gold in one run, and again for what has come since.

Every table notes, in the swap that puts it in place, up to which load time it has taken documents in, how often it has changed,
and which versions of its inputs it was made from. A refresh visits a table only if its inputs are ahead of it. Documents are
parsed once for all their silver tables; matches are replaced whole, in the partitions they are in; dimensions keep their keys;
facts are computed again for the matches that something has changed in, and rewritten by month.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.flatten import flatten_parsed, parse_documents
from ..operators.upsert import delete_insert
from ..sources import journal
from ..sources.storage import configure, drop_folder, fit_partitions, folder_state, replace_table, upsert_partitions, workspace, write_table
from . import dims as D, facts, marts, silver as S
from .adapter import Silver, match_tables
from .feed import Feed

#: What the gold layer reads: silver model, columns and types. Types are those of the star.
_DOC = "_ingested_at timestamp_ntz"
VIEWS = {
    "fixtures": ("fixtures", "id bigint, league_id bigint, season_id int, stage_id int, round_name string, venue_id bigint, venue_name string, "
                 "venue_city string, venue_surface string, venue_capacity int, starting_at timestamp_ntz, state_developer_name string, "
                 f"state_name string, {_DOC}"),
    "participants": ("fixture_participants", f"fixture_id bigint, team_id bigint, team_name string, team_short_code string, location string, {_DOC}"),
    "scores": ("fixture_scores", "fixture_id bigint, team_id bigint, side string, description string, goals bigint"),
    "statistics": ("fixture_statistics", "fixture_id bigint, team_id bigint, type_id int, value double"),
    "match_referees": ("fixture_referees", "fixture_id bigint, referee_id bigint, type_id int, referee_common_name string, referee_firstname string, "
                       f"referee_lastname string, referee_display_name string, referee_image_path string, {_DOC}"),
    "coaches": ("fixture_coaches", "fixture_id bigint, team_id bigint, coach_id bigint, common_name string, display_name string, firstname string, "
                f"lastname string, nationality_id bigint, image_path string, {_DOC}"),
    "formations": ("fixture_formations", f"fixture_id bigint, team_id bigint, formation string, location string, {_DOC}"),
    "lineups": ("fixture_lineups", "fixture_id bigint, player_id bigint, team_id bigint, position_id bigint, type_id int, player_name string, "
                f"position_name string, detailed_position_name string, {_DOC}"),
    "lineup_details": ("fixture_lineup_details", "fixture_id bigint, player_id bigint, type_id int, value double"),
    "events": ("fixture_events", "fixture_id bigint, team_id bigint, player_id bigint, type_developer_name string, minute bigint, extra_minute bigint"),
    "players": ("players", "id bigint, display_name string, firstname string, lastname string, nationality_name string, date_of_birth date, "
                "city_name string, country_name string, height int, weight int, image_path string, position_name string, "
                f"detailed_position_name string, {_DOC}"),
    "seasons": ("seasons", "id int, name string, starting_at date, ending_at date, is_current boolean"),
    "stages": ("stages", "id int, season_id int, name string, type_developer_name string"),
    "teams": ("teams", f"id bigint, _season_id int, {_DOC}, name string, country_name string, founded int, image_path string, venue_name string, "
              "venue_city string, venue_capacity int, last_played_at date"),
    "countries": ("core_countries", "id bigint, name string, iso2 string, flag_image_path string"),
    "leagues": ("league", "id bigint, name string, country_id bigint, type string, sub_type string, short_code string, image_path string, active boolean"),
    "referees": ("referees", "id bigint, common_name string, firstname string, lastname string, display_name string, country_name string, "
                 f"image_path string, {_DOC}"),
    "venues": ("venues", "id bigint, name string, address string, city_name string, country_name string, surface string, capacity int, "
               f"latitude double, longitude double, image_path string, {_DOC}"),
}
MODELS = {model: S.MODELS[model] for model, _ in VIEWS.values()}
MATCH = "fixtures"
SEASON = "_season_id"

#: Silver views (and seeds) behind each dimension.
DIMENSIONS: dict[str, tuple[tuple[str, ...], Callable]] = {
    "dim_date": (("seasons",), lambda spark, s, target: D.dim_date(spark, s.seasons())),
    "dim_team": (("teams", "team_names"), lambda spark, s, target: D.dim_team(s.teams(), s.team_names(), target)),
    "dim_match": (("fixtures", "stages", "participants", "scores", "team_names"), lambda spark, s, target: D.dim_match(
        s.fixtures(), s.stages(), s.participants(), s.scores(), s.team_names(), target)),
    "dim_player": (("players", "lineups"), lambda spark, s, target: D.dim_player(s.players(), s.lineups(), target)),
    "dim_referee": (("referees", "match_referees"), lambda spark, s, target: D.dim_referee(s.referees(), s.match_referees(), target)),
    "dim_coach": (("coaches", "countries"), lambda spark, s, target: D.dim_coach(s.coaches(), s.countries(), target)),
    "dim_stadium": (("venues", "fixtures"), lambda spark, s, target: D.dim_stadium(s.venues(), s.fixtures(), target)),
    "dim_league": (("leagues", "countries"), lambda spark, s, target: D.dim_league(s.leagues(), s.countries(), target)),
    "dim_formation": (("formations",), lambda spark, s, target: D.dim_formation(s.formations(), target)),
    "dim_position": (("lineups",), lambda spark, s, target: D.dim_position(s.lineups(), target)),
}
FIXED = {"dim_time": D.dim_time, "dim_match_result": D.dim_match_result, "dim_team_side": D.dim_team_side,
         "dim_appearance_type": D.dim_appearance_type}
FACTS = ("fct_team_matches", "fct_player_appearances")


def _side_by_side(work: Callable, items: Iterable) -> list:
    """Independent tables are written by jobs that run side by side; their order does not matter."""
    with ThreadPoolExecutor(4) as pool:
        return list(pool.map(work, items))


class StoredSilver:
    """The silver tables of a lake under the names and types that the gold layer reads, of all matches or of some."""

    def __init__(self, lake: "Lake", matches: DataFrame | None = None, seasons: Iterable[int] = ()):
        self.lake, self._matches, self._seasons = lake, matches, list(seasons)

    def view(self, name: str) -> DataFrame:
        model, ddl = VIEWS[name]
        df = self.lake.silver(model)
        if self._matches is not None and MODELS[model].doc == MATCH:
            key = "id" if model == MATCH else "fixture_id"
            known = [s for s in self._seasons if s is not None]
            inside = F.col(SEASON).isin(*known) if known else F.lit(False)
            if None in self._seasons:
                inside = inside | F.col(SEASON).isNull()
            df = df.filter(inside).join(self._matches.select(F.col("fixture_id").alias(key)), key, "left_semi")
        return df.select(*[F.col(c).cast(t).alias(c) for c, t in (x.split() for x in ddl.split(", "))])

    def __getattr__(self, name: str):
        if name in VIEWS:
            return lambda: self.view(name)
        if name in ("team_names", "referee_overrides"):
            return getattr(self.lake.seeds, name)
        raise AttributeError(name)

    def score_corrections(self) -> DataFrame:
        rows = self.lake.seeds.score_corrections()
        return rows if self._matches is None else rows.join(self._matches.select("fixture_id"), "fixture_id", "left_semi")


class Lake:
    """Bronze, silver and gold tables below one folder. ``seeds`` gives names, corrections and identities that people keep."""

    def __init__(self, spark: SparkSession, root: str, seeds):
        self.spark, self.root, self.seeds = spark, root, seeds

    # tables ------------------------------------------------------------------------------------------------------

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame | None:
        """A stored table with the schema that it was written with; None if there is none. A cut short swap is finished first."""
        path = self.path(layer, name)
        journal.recover(self.spark, path)
        text = journal.notes(self.spark, path).get("schema")
        return None if text is None else self.spark.read.schema(text).parquet(path)

    def notes(self, layer: str, name: str) -> dict:
        return journal.notes(self.spark, self.path(layer, name))

    def _noted(self, layer: str, name: str, df: DataFrame, **more) -> dict:
        """Notes of the next version of a table."""
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
        return {"version": self.notes(layer, name).get("version", 0) + 1, "schema": ddl, **more}

    def silver(self, model: str) -> DataFrame:
        found = self.read("silver", model)
        if found is None:
            raise LookupError(f"no documents for {model} have been loaded")
        return found

    def get(self, name: str) -> DataFrame:
        """A gold table."""
        if name in FIXED:
            return FIXED[name](self.spark)
        if name == "dim_opponent_team":
            return D.dim_opponent_team(self.get("dim_team"))
        df = self.read("gold", name)
        return df.drop("month") if name in FACTS else df

    def dims(self) -> dict[str, DataFrame]:
        return {name: self.get(name) for name in (*DIMENSIONS, *FIXED, "dim_opponent_team")}

    # bronze ------------------------------------------------------------------------------------------------------

    def land(self, kind: str, docs: DataFrame) -> None:
        """Documents of a kind as they come. A match has one document, the latest; other kinds keep every load."""
        path, current = self.path("bronze", kind), self.read("bronze", kind)
        notes = self._noted("bronze", kind, docs)
        if current is None:
            replace_table(self.spark, path, docs, [SEASON] if kind == MATCH else (), notes, rebalance=False)
        elif kind == MATCH:
            upsert_partitions(self.spark, path, docs, ["id"], SEASON, moving=True, notes=notes)
        else:
            replace_table(self.spark, path, delete_insert(current, docs, ["id", SEASON, "_ingested_at"]), notes=notes)

    # silver ------------------------------------------------------------------------------------------------------

    def load(self, kind: str) -> list[str]:
        """Bring the silver tables of a kind up to its documents; returns the names of those that had to be."""
        models = {n: m for n, m in MODELS.items() if m.doc == kind}
        landed = self.notes("bronze", kind).get("version", 0)
        behind = {n: self.notes("silver", n) for n in models if self.notes("silver", n).get("landed") != landed}
        if not behind:
            return []
        docs = self.read("bronze", kind)
        marks = [note.get("mark") for note in behind.values()]
        if all(marks):
            docs = docs.filter(F.col("_ingested_at") > F.lit(min(marks)).cast("timestamp_ntz"))
        if kind == MATCH:
            models = {n: replace(m, parent=f"{m.parent} {SEASON}=@{SEASON}:int".strip()) for n, m in models.items()}
        parsed_path = f"{workspace(self.spark)}/parsed"
        write_table(parse_documents(docs, [models[n] for n in behind]), parsed_path)
        parsed = self.spark.read.parquet(parsed_path)
        mark = parsed.agg(F.max("_ingested_at").cast("string")).first()[0]
        aliases = self.seeds.referee_overrides()

        def store(name: str) -> None:
            since = behind[name].get("mark")
            fresh = parsed if since is None else parsed.filter(F.col("_ingested_at") > F.lit(since).cast("timestamp_ntz"))
            flat = S._finish(name, flatten_parsed(fresh, models[name]), aliases)
            self._store(kind, name, flat, fresh.select("id", SEASON), {"landed": landed, "mark": max(filter(None, (mark, since)), default=None)})

        _side_by_side(store, [n for n in behind if n != MATCH])
        _side_by_side(store, [n for n in behind if n == MATCH])  # last: the others find there the season a match was in before
        drop_folder(self.spark, parsed_path)
        return list(behind)

    def _store(self, kind: str, name: str, flat: DataFrame, docs: DataFrame, more: dict) -> None:
        path, current = self.path("silver", name), self.read("silver", name)
        notes = self._noted("silver", name, flat, **more)
        if current is None:
            replace_table(self.spark, path, flat, [SEASON] if kind == MATCH else (), notes, rebalance=False)
        elif kind == MATCH:
            key = "id" if name == MATCH else "fixture_id"
            before = self.silver(MATCH).select("id", SEASON).join(docs.select("id"), "id", "left_semi")
            keys = docs.unionByName(before).distinct().withColumnRenamed("id", key)
            upsert_partitions(self.spark, path, flat, [key], SEASON, notes=notes, keys=keys)
        else:
            parent = {c for c, at, _ in MODELS[name].columns(f"{MODELS[name].parent} {MODELS[name].fields}") if at == "@id"}.pop()
            kept = current.join(docs.select(F.col("id").alias(parent)).distinct(), parent, "left_anti")
            replace_table(self.spark, path, kept.select(*flat.columns).unionByName(flat), notes=notes)

    # gold --------------------------------------------------------------------------------------------------------

    def _inputs(self, names: Iterable[str]) -> dict:
        return {n: self.notes("silver", VIEWS[n][0]).get("version") if n in VIEWS else "seed" for n in names}

    def _gold_behind(self, name: str, inputs: dict) -> bool:
        return self.notes("gold", name).get("inputs") != inputs

    def build_dimension(self, name: str) -> bool:
        """A dimension out of silver and of what is stored of it, which is the registry of its keys."""
        views, make = DIMENSIONS[name]
        inputs = self._inputs(views)
        if not self._gold_behind(name, inputs):
            return False
        df = make(self.spark, StoredSilver(self), self.read("gold", name))
        replace_table(self.spark, self.path("gold", name), df, notes=self._noted("gold", name, df, inputs=inputs))
        return True

    def changed_matches(self, fact: str) -> DataFrame | None:
        """Matches that a stored fact has to take in again: those with newer documents (so with late goals, substitutions or
        line-ups), with other corrections, or with players whose own documents are newer. None: all of them."""
        note = self.notes("gold", fact)
        if "mark" not in note:
            return None
        newer = F.col("_ingested_at") > F.lit(note["mark"]).cast("timestamp_ntz")
        played = self.silver("fixtures").filter(newer).select(F.col("id").alias("fixture_id"))
        was, now = self.read("gold", "corrections_used"), self.seeds.score_corrections()
        corrected = was.exceptAll(now).union(now.exceptAll(was)).select("fixture_id")
        renewed = self.silver("players").filter(newer).select(F.col("id").cast("int").alias("player_id")).distinct()
        listed = self.silver("fixture_lineups").join(renewed, "player_id", "left_semi").select("fixture_id")
        return played.union(corrected).union(listed).distinct()

    def build_facts(self) -> list[str]:
        """Both facts, of the matches that something has changed in. Their keepers, and all others, are computed anew together."""
        inputs = self._inputs(("fixtures", "stages", "participants", "scores", "statistics", "match_referees", "coaches", "formations", "lineups",
                               "lineup_details", "events", "players"))
        corrections = self.seeds.score_corrections()
        was = self.read("gold", "corrections_used")
        same = was is not None and was.exceptAll(corrections).isEmpty() and corrections.exceptAll(was).isEmpty()
        if same and not any(self._gold_behind(f, inputs) for f in FACTS):
            return []
        changed = [self.changed_matches(f) for f in FACTS]
        space, seasons, matches = workspace(self.spark), (), None
        if None not in changed:
            changed[0].union(changed[1]).distinct().write.parquet(f"{space}/changed")
            matches = self.spark.read.parquet(f"{space}/changed")
            at = self.silver("fixtures").join(matches.select(F.col("fixture_id").alias("id")), "id", "left_semi")
            seasons = [r[0] for r in at.select(SEASON).distinct().collect()]  # no more than there are seasons
        s, dims = StoredSilver(self, matches, seasons), self.dims()
        _side_by_side(lambda part: part[0].write.parquet(f"{space}/{part[1]}"), [
            (facts.match_sheet(s.fixtures(), s.stages(), s.participants(), s.scores(), s.score_corrections(), s.statistics(), s.match_referees(),
                               s.coaches(), s.formations()), "sheet"), (facts.listed(s.lineups(), s.lineup_details()), "listed")])
        sheet, listed = self.spark.read.parquet(f"{space}/sheet"), self.spark.read.parquet(f"{space}/listed")
        made = {"fct_team_matches": facts.fct_team_matches(sheet, dims),
                "fct_player_appearances": facts.fct_player_appearances(sheet, listed, s.events(), StoredSilver(self).players(), dims,
                                                                       facts.player_statistics(s.lineup_details()))}
        mark = self.silver("fixtures").select("_ingested_at").union(self.silver("players").select("_ingested_at")) \
            .agg(F.max("_ingested_at").cast("string")).first()[0]

        def store(name: str) -> None:
            df = made[name].withColumn("month", facts.month_of(F.col("date_sk")))
            path, notes = self.path("gold", name), self._noted("gold", name, df, inputs=inputs, mark=mark)
            if matches is None:
                return replace_table(self.spark, path, df, ["month"], notes)
            # a match is replaced with all its rows, wherever they were: somebody may have left its line-ups
            keys = matches.join(dims["dim_match"].select(F.col("match_id").alias("fixture_id"), "match_sk"), "fixture_id").select("match_sk")
            held = self.read("gold", name).select("match_sk", "month").join(keys, "match_sk", "left_semi").distinct()
            upsert_partitions(self.spark, path, df, ["match_sk"], "month", notes=notes, keys=held.unionByName(df.select("match_sk", "month")))

        _side_by_side(store, list(made))
        replace_table(self.spark, self.path("gold", "corrections_used"), corrections,
                      notes=self._noted("gold", "corrections_used", corrections))
        return list(made)

    def build_extract(self, name: str) -> bool:
        sources = ("fct_team_matches", "fct_player_appearances") if name == "mart_match_facts" else ("fct_player_appearances",)
        inputs = {n: self.notes("gold", n).get("version") for n in (*sources, *DIMENSIONS)}
        if not self._gold_behind(name, inputs):
            return False
        make = marts.mart_match_facts if name == "mart_match_facts" else marts.mart_player_facts
        df = make(*[self.get(n) for n in sources], self.dims())
        replace_table(self.spark, self.path("gold", name), df, ["season"], self._noted("gold", name, df, inputs=inputs), rebalance=False)
        return True

    def refresh(self, extracts: bool = True) -> list[str]:
        """Everything that is behind its inputs, in the order of the graph; returns what was visited."""
        done = [n for found in _side_by_side(self.load, Feed.KINDS) for n in found]
        done += [n for n, was in zip(DIMENSIONS, _side_by_side(self.build_dimension, DIMENSIONS)) if was]
        done += self.build_facts()
        marts_ = ("mart_match_facts", "mart_player_facts") if extracts else ()
        return done + [n for n, was in zip(marts_, _side_by_side(self.build_extract, marts_)) if was]

    def plan(self, name: str) -> DataFrame:
        return self.get(name)


_LOCK = threading.RLock()
_OPEN: dict[tuple, Lake] = {}


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The lake of this session for one data folder: its tables as documents, landed, loaded and built."""
    configure(spark)
    fit_partitions(spark, *match_tables(sf_dir))
    sf_dir = sf_dir.rstrip("/")
    key = (spark.sparkContext.applicationId, sf_dir, folder_state(spark, sf_dir))
    with _LOCK:
        if key not in _OPEN:
            tables = Silver(spark, sf_dir)
            built, feed = Lake(spark, workspace(spark), tables), Feed(tables)
            _side_by_side(lambda kind: built.land(kind, feed.documents(kind)), Feed.KINDS)
            built.refresh()
            _OPEN[key] = built
        return _OPEN[key]
