"""The gold star and its extracts, built once per data folder and session and kept as parquet."""

from __future__ import annotations

import threading
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..sources.storage import configure, fit_partitions, folder_state, workspace, write_table
from . import dims as D, facts, marts
from .adapter import Silver, match_tables

_LOCK = threading.RLock()
_OPEN: dict[tuple, "Warehouse"] = {}

PARTITIONS = {"mart_match_facts": ["season"], "mart_player_facts": ["season"]}
STATIC = ("dim_time", "dim_match_result", "dim_team_side", "dim_appearance_type", "dim_opponent_team")
DIMS = ("dim_date", "dim_time", "dim_team", "dim_opponent_team", "dim_match", "dim_player", "dim_referee", "dim_coach",
        "dim_stadium", "dim_league", "dim_formation", "dim_position", "dim_match_result", "dim_team_side",
        "dim_appearance_type")


class Warehouse:
    """``plan(name)`` is the lazy definition of a table, ``get(name)`` reads its stored copy (writing it if needed)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.silver = spark, Silver(spark, sf_dir)
        self.root = workspace(spark)
        self._stored: dict[str, DataFrame] = {}
        self._locks: dict[str, threading.RLock] = defaultdict(threading.RLock)

    def get(self, name: str) -> DataFrame:
        if name in STATIC:
            return self.plan(name)
        path = f"{self.root}/{name}"
        with self._locks[name]:
            if name not in self._stored:
                write_table(self.plan(name), path, PARTITIONS.get(name, ()), rebalance=False)
                self._stored[name] = self.spark.read.parquet(path)
        return self._stored[name]

    def prepare(self, *names: str) -> None:
        """Store several independent tables; their jobs run side by side."""
        missing = [n for n in names if n not in STATIC and n not in self._stored]
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(self.get, missing))

    def dims(self) -> dict[str, DataFrame]:
        self.prepare(*DIMS)
        return {name: self.get(name) for name in DIMS}

    def plan(self, name: str) -> DataFrame:
        s, spark = self.silver, self.spark
        match name:
            case "dim_date": return D.dim_date(spark, s.seasons())
            case "stages": return s.stages()  # stored, so that joins know how few they are
            case "dim_time": return D.dim_time(spark)
            case "dim_match_result": return D.dim_match_result(spark)
            case "dim_team_side": return D.dim_team_side(spark)
            case "dim_appearance_type": return D.dim_appearance_type(spark)
            case "dim_team": return D.dim_team(s.teams(), s.team_names())
            case "dim_opponent_team": return D.dim_opponent_team(self.get("dim_team"))
            case "dim_match":
                m = s.by_match()
                return D.dim_match(m.fixtures(), self.get("stages"), m.participants(), m.scores(), s.team_names())
            case "dim_player": return D.dim_player(s.players(), s.lineups())
            case "dim_referee": return D.dim_referee(s.referees(), s.match_referees())
            case "dim_coach": return D.dim_coach(s.coaches(), s.countries())
            case "dim_stadium": return D.dim_stadium(s.venues(), s.fixtures())
            case "dim_league": return D.dim_league(s.leagues(), s.countries())
            case "dim_formation": return D.dim_formation(s.formations())
            case "dim_position": return D.dim_position(s.lineups())
            case "match_sheet":
                m = s.by_match()
                return facts.match_sheet(m.fixtures(), self.get("stages"), m.participants(), m.scores(), m.score_corrections(),
                                         m.statistics(), m.match_referees(), m.coaches(), m.formations())
            case "fct_team_matches":
                self.prepare("match_sheet", *DIMS)
                return facts.fct_team_matches(self.get("match_sheet"), self.dims())
            case "fct_player_appearances":
                self.prepare("match_sheet", "listed", *DIMS)
                return facts.fct_player_appearances(self.get("match_sheet"), self.get("listed"), s.events(), s.players(), self.dims(),
                                                    facts.player_statistics(s.lineup_details()), dealt=True)
            case "appearances": return facts.appearances(s.lineups(), s.lineup_details())
            case "listed": return facts.listed(s.lineups(), s.lineup_details())
            case "mart_match_facts":
                self.prepare("fct_team_matches", "fct_player_appearances")
                return marts.mart_match_facts(self.get("fct_team_matches"), self.get("fct_player_appearances"),
                                              self.dims())
            case "mart_player_facts": return marts.mart_player_facts(self.get("fct_player_appearances"), self.dims())
        raise KeyError(name)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of this session for one data folder; a folder whose files have changed gets a new one."""
    configure(spark)
    fit_partitions(spark, *match_tables(sf_dir))
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), folder_state(spark, sf_dir.rstrip("/")))
    with _LOCK:
        if key not in _OPEN:
            _OPEN[key] = Warehouse(spark, sf_dir.rstrip("/"))
        return _OPEN[key]
