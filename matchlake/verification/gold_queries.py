"""Dimensions, facts and extracts (G-01 ... G-21)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import codes
from ..plans import dims, marts, silver
from ..plans.facts import TEAM_FACT_COLUMNS, PLAYER_FACT_KEYS
from ..plans.adapter import Silver
from ..plans.feed import Feed
from ..plans.lake import Lake, StoredSilver, lake
from ..plans.warehouse import warehouse
from ..sources import storage
from . import oracle as O
from .registry import query, register


def _plan(name):
    """A gold table at the end of documents, silver, gold."""
    return lambda spark, sf: lake(spark, sf).get(name)


def _members(name, sk, fact):
    """A fixed dimension with the number of fact rows of each member."""
    def run(spark, sf):
        w = lake(spark, sf)
        used = w.get(fact).groupBy(sk).agg(F.count("*").alias("n"))
        return w.get(name).join(used, sk, "left").withColumn("fact_rows", F.coalesce("n", F.lit(0))).drop("n")
    return run


register("g01_dim_date", _plan("dim_date"), "SELECT * FROM g_date", dates=["date"])
register("g02_dim_time", _members("dim_time", "time_sk", "fct_team_matches"), """
SELECT g_time.*, coalesce(n, 0) AS fact_rows FROM g_time LEFT JOIN (SELECT time_sk, count(*) AS n FROM g_teamfact GROUP BY ALL) USING (time_sk)""")
register("g03_dim_team", _plan("dim_team"), "SELECT * FROM g_team")
register("g04_dim_opponent_team", _plan("dim_opponent_team"), "SELECT " + ", ".join(
    f"{c} AS opponent_{c}" for c in ("team_sk", "team_id", "team_name", "team_code", "team_short_name", "team_country",
                                     "team_founded_year", "team_logo")) + " FROM g_team")
register("g05_dim_match", _plan("dim_match"), "SELECT * FROM g_match")
register("g06_dim_player", _plan("dim_player"), "SELECT * FROM g_player", dates=["player_birth_date"])
register("g07_dim_referee", _plan("dim_referee"), "SELECT * FROM g_referee")
register("g08_dim_coach", _plan("dim_coach"), "SELECT * FROM g_coach")
register("g09_dim_stadium", _plan("dim_stadium"), "SELECT * EXCLUDE (id), id AS stadium_id FROM g_stadium")
register("g10_dim_league", _plan("dim_league"), "SELECT * FROM g_league")
register("g11_dim_formation", _plan("dim_formation"), "SELECT * FROM g_formation")
register("g12_dim_position", _plan("dim_position"), "SELECT * FROM g_position")
for _id, _what, _facts, _cte in (("g13", "match_result", "fct_team_matches", "result"), ("g14", "team_side", "fct_team_matches", "side"),
                                 ("g15", "appearance_type", "fct_player_appearances", "apptype")):
    register(f"{_id}_dim_{_what}", _members(f"dim_{_what}", f"{_what}_sk", _facts), f"""
SELECT sk AS {_what}_sk, label AS {_what}, coalesce(n, 0) AS fact_rows FROM g_{_cte} LEFT JOIN
  (SELECT {_what}_sk AS sk, count(*) AS n FROM {"g_teamfact" if _facts == "fct_team_matches" else "g_playerfact"} GROUP BY ALL) USING (sk)""")
register("g16_fct_team_matches", _plan("fct_team_matches"), f"SELECT {', '.join(TEAM_FACT_COLUMNS)} FROM g_teamfact")
register("g17_fct_player_appearances", _plan("fct_player_appearances"), "SELECT * FROM g_playerfact")
register("g18_mart_match_facts", _plan("mart_match_facts"), "SELECT * FROM mm", dates=["match_date"])
register("g19_mart_player_facts", _plan("mart_player_facts"), "SELECT * FROM mp",
         dates=["match_date", "player_birth_date"])


def _documents(df, body, *envelope):
    """Rows as bronze documents."""
    return df.select(F.col("id").cast("bigint").alias("id"), F.to_json(F.expr(body)).alias("raw_json"), *envelope)


@query("g03_dim_team_from_documents", "SELECT * FROM g_team")
def dim_team_from_documents(spark, sf):
    """Documents, silver, gold: what the team model gives is what the dimension reads."""
    s = warehouse(spark, sf).silver
    docs = _documents(s.teams(), """named_struct('id', id, 'name', name, 'founded', founded, 'image_path', image_path,
        'last_played_at', date_format(last_played_at, 'yyyy-MM-dd HH:mm:ss'), 'country', named_struct('name', country_name),
        'venue', named_struct('name', venue_name, 'city_name', venue_city, 'capacity', venue_capacity))""", "_season_id", "_ingested_at")
    return dims.dim_team(silver.build("teams", docs), s.team_names())


@query("g07_dim_referee_from_documents", "SELECT * FROM g_referee")
def dim_referee_from_documents(spark, sf):
    s = warehouse(spark, sf).silver
    listed = _documents(s.referees(), """named_struct('id', id, 'common_name', common_name, 'firstname', firstname, 'lastname', lastname,
        'display_name', display_name, 'image_path', image_path, 'country', named_struct('name', country_name))""", "_ingested_at")
    calls = s.match_referees().withColumn("id", F.col("fixture_id"))
    matches = _documents(calls, """named_struct('id', id, 'referees', array(named_struct('id', type_id, 'referee_id', referee_id, 'type_id', type_id,
        'referee', named_struct('common_name', referee_common_name, 'firstname', referee_firstname, 'lastname', referee_lastname,
        'display_name', referee_display_name, 'image_path', referee_image_path))))""", "_ingested_at",
                         F.lit(None).cast("int").alias("_season_id"), F.lit(None).cast("date").alias("_fixture_date"))
    seed = s.referee_overrides()
    return dims.dim_referee(silver.build("referees", listed, seed), silver.build("fixture_referees", matches, seed))


@query("g20_league_info", "SELECT league_name, league_logo, league_country_flag FROM g_league WHERE league_id = 1")
def league_info(spark, sf):
    return marts.league_info(lake(spark, sf).get("dim_league"), 1)


@query("g21_last_updated",
       "SELECT strftime(max(ingested), '%d %b %Y %H:%M UTC') AS last_updated FROM z_fixture")
def last_updated(spark, sf):
    return marts.last_updated(StoredSilver(lake(spark, sf)).fixtures())


# the same lake, built in two steps ----------------------------------------------------------------------------------

CUT = "2025-07-01 00:00:00"


class Earlier(Silver):
    """The matches as they were known before the last ones were over: of those from ``CUT`` on, a third is not known yet, a third
    has not begun, and of a third the late substitutes and what they did are missing."""

    known_line = f"NOT coalesce(starting_at >= TIMESTAMP_NTZ'{CUT}', false) OR (l_orderkey % 3 = 2 AND l_linenumber < 4)"

    def _matches(self):
        late = f"coalesce(starting_at >= TIMESTAMP_NTZ'{CUT}', false)"
        known = super()._matches().filter(f"NOT ({late}) OR o_orderkey % 3 > 0")
        return known.withColumn("o_orderstatus", F.expr(f"CASE WHEN {late} AND o_orderkey % 3 = 1 THEN 'O' ELSE o_orderstatus END"))


_TWICE: dict = {}


def refreshed_lake(spark, sf) -> Lake:
    """A lake of the earlier matches that has then been given the documents of the last ones, and refreshed."""
    key = (spark.sparkContext.applicationId, sf, storage.folder_state(spark, sf))
    if key not in _TWICE:
        storage.configure(spark)
        now, feed = Silver(spark, sf), Feed(Silver(spark, sf))
        known, before = Lake(spark, storage.workspace(spark), now), Feed(Earlier(spark, sf))
        for kind in Feed.KINDS:
            docs = before.documents(kind)
            if kind == "fixtures":  # loaded before the cut
                docs = docs.withColumn("_ingested_at", F.least("_ingested_at", F.expr(f"TIMESTAMP_NTZ'{CUT}' - INTERVAL 1 HOUR")))
            known.land(kind, docs)
        known.refresh(extracts=False)
        known.land("fixtures", feed.documents("fixtures").filter(f"_ingested_at >= TIMESTAMP_NTZ'{CUT}'"))
        known.refresh()
        _TWICE[key] = known
    return _TWICE[key]


@query("pf10_match_facts_after_refresh", "SELECT * FROM mm", dates=["match_date"])
def match_facts_after_refresh(spark, sf):
    """Only documents past the marks are parsed, only their matches are replaced; the extract is that of a full build."""
    return refreshed_lake(spark, sf).get("mart_match_facts")


@query("u16_player_facts_after_refresh", "SELECT * FROM mp", dates=["match_date", "player_birth_date"])
def player_facts_after_refresh(spark, sf):
    """Late goals and substitutions change what keepers conceded: their matches are computed again, and no others."""
    return refreshed_lake(spark, sf).get("mart_player_facts")


@query("q06_standings_from_documents", "SELECT team_sk, season, sum(points_earned) AS points, count(*) AS played FROM g_teamfact"
       " JOIN (SELECT date_sk, season FROM g_date) USING (date_sk) WHERE points_earned IS NOT NULL GROUP BY ALL")
def standings_from_documents(spark, sf):
    built = lake(spark, sf)
    facts_ = built.get("fct_team_matches").filter("points_earned IS NOT NULL")
    return facts_.join(built.get("dim_date").select("date_sk", "season"), "date_sk").groupBy("team_sk", "season").agg(
        F.sum("points_earned").alias("points"), F.count("*").alias("played"))


class Some(Silver):
    """The tables without the members whose id is divisible by a number."""

    def __init__(self, spark, sf_dir, divisor):
        super().__init__(spark, sf_dir)
        self._divisor = divisor

    def _without(self, rows, key):
        return rows.filter(F.col(key).isNull() | (F.pmod(key, F.lit(self._divisor)) != 0))

    def teams(self): return self._without(super().teams(), "id")
    def players(self): return self._without(super().players(), "id")
    def lineups(self): return self._without(super().lineups(), "player_id")
    def referees(self): return self._without(super().referees(), "id")
    def match_referees(self): return self._without(super().match_referees(), "referee_id")
    def venues(self): return self._without(super().venues(), "id")
    def fixtures(self): return self._without(super().fixtures(), "venue_id")
    def coaches(self): return self._without(super().coaches(), "coach_id")


REGISTERED = {"dim_team": ("team_id", "team_sk", "g_team", "team_id"), "dim_player": ("player_id", "player_sk", "g_player", "player_id"),
              "dim_referee": ("referee_id", "referee_sk", "g_referee", "referee_id"), "dim_stadium": ("stadium_id", "stadium_sk", "g_stadium", "id"),
              "dim_coach": ("coach_id", "coach_sk", "g_coach", "coach_id")}


@query("u03_stable_keys_over_builds", " UNION ALL ".join(f"""
SELECT '{name}' AS dimension, count(*) FILTER (WHERE {key} % 5 <> 0) AS first_members, count(*) FILTER (WHERE {key} % 5 <> 0) AS kept_keys,
  count(*) FILTER (WHERE {key} % 5 <> 0 OR {key} % 7 <> 0) AS members, count(*) FILTER (WHERE {key} % 5 <> 0 OR {key} % 7 <> 0) AS keys
FROM {cte} WHERE {sk} > 0""" for name, (_, sk, cte, key) in REGISTERED.items()))
def stable_keys(spark, sf):
    """Two builds of the stored dimensions: members that come later get new keys, members that go and those that stay keep theirs."""
    from ..plans.lake import DIMENSIONS
    root, out = storage.workspace(spark), None
    for name, (key, sk, _, _) in REGISTERED.items():
        path, make = f"{root}/{name}", DIMENSIONS[name][1]
        first = make(spark, Some(spark, sf, 5), None)
        storage.replace_table(spark, path, first)
        before = storage.stored(spark, path, first.schema).filter(F.col(sk) > 0).select(key, F.col(sk).alias("was"))
        storage.write_table(before, f"{path}_before")
        storage.replace_table(spark, path, make(spark, Some(spark, sf, 7), storage.stored(spark, path, first.schema)))
        now = storage.stored(spark, path, first.schema).filter(F.col(sk) > 0).select(key, sk)
        one = now.join(spark.read.parquet(f"{path}_before"), key, "full").agg(
            F.count("was").alias("first_members"), F.count_if(F.col("was") == F.col(sk)).alias("kept_keys"),
            F.count_distinct(key).alias("members"), F.count_distinct(sk).alias("keys")).select(F.lit(name).alias("dimension"), "*")
        out = one if out is None else out.unionByName(one)
    return out
