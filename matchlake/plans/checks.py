"""The data-quality checks of the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import codes
from ..operators import quality as Q

PLAYED_SK = "match_result_sk IN (1, 2, 3)"
TEAM_COUNTS = ("goals_scored", "goals_conceded", "goals_ht_scored", "goals_ht_conceded", "corner_kicks", "yellow_cards",
               "red_cards", "ball_possession_pct")
PLAYER_COUNTS = (
    "goals_scored", "own_goals", "assists", "shots_total", "shots_on_target", "shots_off_target", "shots_blocked",
    "passes_total", "passes_accurate", "key_passes", "tackles", "clearances", "interceptions", "aerials_won",
    "aerials_lost", "blocks", "duels_total", "duels_won", "dribbles_attempts", "dribbles_completed", "fouls_committed",
    "fouls_drawn", "yellow_cards", "red_cards", "offsides", "minutes_played")
SENTINEL_DIMS = {"dim_team": "team_sk", "dim_match": "match_sk", "dim_league": "league_sk", "dim_stadium": "stadium_sk",
                 "dim_referee": "referee_sk", "dim_match_result": "match_result_sk", "dim_team_side": "team_side_sk",
                 "dim_player": "player_sk", "dim_coach": "coach_sk", "dim_formation": "formation_sk",
                 "dim_position": "position_sk"}
FLOORS = {"dim_team": ("team_sk > 0", 10), "dim_match": ("match_sk > 0", 1000), "dim_player": ("player_sk > 0", 500),
          "fct_team_matches": ("match_sk > 0", 2000), "fct_player_appearances": ("match_sk > 0", 20000)}


def completed_without_rows(dim_match: DataFrame, facts: DataFrame) -> DataFrame:
    done = dim_match.filter((F.col("match_sk") > 0) & F.col("match_status").isin(*codes.FINISHED_STATUS_NAMES))
    return Q.missing_in(done, facts.filter("match_sk > 0"), "match_sk").select("match_sk", "match_name")


def team_keys_resolved(facts: DataFrame) -> DataFrame:
    return Q.unresolved(facts, {k: PLAYED_SK for k in ("team_sk", "opponent_team_sk", "match_sk", "stadium_sk")},
                        ["match_sk"])


def player_keys_resolved(facts: DataFrame) -> DataFrame:
    return Q.unresolved(facts, {"player_sk": "match_sk > 0", "team_sk": "match_sk > 0", "match_sk": "player_sk > 0"},
                        ["match_sk", "player_sk"])


def halftime_above_fulltime(facts: DataFrame) -> DataFrame:
    return facts.filter(PLAYED_SK).filter(
        "goals_ht_scored > goals_scored OR goals_ht_conceded > goals_conceded").select(
        "match_sk", "team_sk", "goals_ht_scored", "goals_scored", "goals_ht_conceded", "goals_conceded")


def silver_halftime_above_fulltime(scores: DataFrame, fixtures: DataFrame) -> DataFrame:
    at = lambda text: F.max(F.when(F.col("description") == text, F.col("goals")))
    wide = scores.groupBy("fixture_id", "side").agg(at("1ST_HALF").alias("goals_ht"), at("CURRENT").alias("goals_ft"))
    done = fixtures.filter(F.col("state_developer_name").isin(*codes.FINISHED_STATES)).select(F.col("id").alias("fixture_id"))
    return wide.filter("goals_ht > goals_ft").join(done, "fixture_id", "left_semi")


def points_off(facts: DataFrame) -> DataFrame:
    due = F.when(F.col("goals_scored") > F.col("goals_conceded"), 3).when(
        F.col("goals_scored") == F.col("goals_conceded"), 1).when(F.col("goals_scored") < F.col("goals_conceded"), 0)
    return facts.filter(F.col("points_earned").isNotNull() & (F.col("points_earned") != due)).select(
        "match_sk", "team_side_sk", "goals_scored", "goals_conceded", "points_earned")


def possession_off(facts: DataFrame) -> DataFrame:
    shares = facts.filter("ball_possession_pct IS NOT NULL AND match_sk > 0").groupBy("match_sk").agg(
        F.sum("ball_possession_pct").alias("total_possession"), F.count("*").alias("n"))
    return shares.filter("n = 2 AND abs(total_possession - 100) > 1").drop("n")


def played_off(standings: DataFrame) -> DataFrame:
    """Played must be won + drawn + lost; rows with a missing part are not judged."""
    total = F.col("overall_won") + F.col("overall_draw") + F.col("overall_lost")
    return standings.withColumn("wdl_sum", total).filter("overall_played <> wdl_sum").select(
        "team_id", "team_name", "season_id", "overall_played", "overall_won", "overall_draw", "overall_lost", "wdl_sum")


def star_checks(get) -> list[Q.Check]:
    """All checks of the star; ``get`` maps a table name to its relation."""
    team, player, match = get("fct_team_matches"), get("fct_player_appearances"), get("dim_match")
    return [
        Q.Check("team_grain", Q.unique(team, ["match_sk", "team_side_sk"])),
        Q.Check("player_grain", Q.unique(player, ["match_sk", "player_sk", "team_sk"])),
        Q.Check("two_rows_per_match", Q.rows_per_key(team, "match_sk", 2, "match_sk > 0")),
        Q.Check("completed_have_rows", completed_without_rows(match, team)),
        Q.Check("sentinels", Q.sentinels_present({n: (get(n), sk) for n, sk in SENTINEL_DIMS.items()})),
        Q.Check("team_keys", team_keys_resolved(team)), Q.Check("player_keys", player_keys_resolved(player)),
        Q.Check("halftime", halftime_above_fulltime(team), "warn"),
        Q.Check("team_negative", Q.negative(team, ["match_sk", "team_sk"], TEAM_COUNTS)),
        Q.Check("player_negative", Q.negative(player, ["match_sk", "player_sk"], PLAYER_COUNTS)),
        Q.Check("minutes", Q.outside(player, "minutes_played", 0, 120)),
        Q.Check("points", points_off(team)), Q.Check("possession", possession_off(team))]
