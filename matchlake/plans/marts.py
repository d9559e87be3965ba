"""Wide extracts over the star."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import codes
from ..sources.storage import written

TEAM_SUMS = {
    "shots_on_goal": "shots_on_target", "shots_off_goal": "shots_off_target", "total_shots": "shots_total",
    "blocked_shots": "shots_blocked", "total_passes": "passes_total", "passes_accurate": "passes_accurate",
    "fouls": "fouls_committed", "saves": "saves", "offsides": "offsides", "tackles": "tackles",
    "key_passes": "key_passes", "big_chances_created": "big_chances_created", "woodwork_hits": "woodwork_hits",
    "crosses_total": "crosses_total", "crosses_accurate": "crosses_accurate"}


def season_progress(rows: DataFrame) -> DataFrame:
    """Cumulative points and goals per (team, season, round) and the final group of the team.

    Only the round matters for both, so the matches are summed to rounds before the window runs.
    """
    entered = lambda kind: F.max(F.when(F.col("match_round_type") == kind, 1).otherwise(0))
    rounds = rows.groupBy("team_sk", "season", "match_round_number").agg(
        F.sum("points_earned").alias("p"), F.sum(F.col("goals_scored") - F.col("goals_conceded")).alias("d"),
        F.sum("goals_scored").alias("g"), entered("Championship Round").alias("c"),
        entered("Relegation Round").alias("r"))
    team = Window.partitionBy("team_sk", "season")
    upto = team.orderBy("match_round_number").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return rounds.select(
        "team_sk", "season", "match_round_number",
        F.when(F.max("c").over(team) == 1, "Championship Group").when(F.max("r").over(team) == 1, "Relegation Group")
        .otherwise(codes.REGULAR_STAGE).alias("standings_type"),
        F.sum("p").over(upto).alias("cumulative_points"), F.sum("d").over(upto).alias("cumulative_gd"),
        F.sum("g").over(upto).alias("cumulative_gf"))


def mart_match_facts(facts: DataFrame, appearances: DataFrame, dims: dict[str, DataFrame],
                     first_season: str = codes.FIRST_SEASON) -> DataFrame:
    days = dims["dim_date"].filter(F.col("season") >= first_season).select(
        "date_sk", F.col("date").alias("match_date"), "season", "is_current_season")
    matches = dims["dim_match"].filter("match_round_number IS NOT NULL").withColumnRenamed("match_result", "score").drop(
        "match_type")
    rows = facts.filter("match_result_sk > 0").join(days, "date_sk").join(matches, "match_sk")
    # a row per team and round: joined as it is planned, all wide rows would be dealt by round to meet it
    progress = written(season_progress(rows), "progress")
    # the few teams of a match next to each other: wide rows are dealt by match once, and not again by team
    sums = appearances.filter("team_sk IS NOT NULL").groupBy("match_sk", "team_sk").agg(
        F.struct(*[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in TEAM_SUMS.items()]).alias("sums"))
    teams = sums.groupBy("match_sk").agg(F.map_from_entries(F.collect_list(F.struct("team_sk", "sums"))).alias("_by_team"))
    wide = (rows.join(progress, ["team_sk", "season", "match_round_number"]).join(teams, "match_sk", "left")
            .select("*", F.col("_by_team")[F.col("team_sk")].alias("_sums")).drop("_by_team")
            .join(dims["dim_team"].select("team_sk", "team_name", "team_short_name", "team_code", "team_logo"), "team_sk")
            .join(dims["dim_opponent_team"].select("opponent_team_sk", "opponent_team_name", "opponent_team_short_name",
                                                   "opponent_team_code"), "opponent_team_sk")
            .join(dims["dim_match_result"].withColumnRenamed("match_result", "result"), "match_result_sk")
            .join(dims["dim_team_side"], "team_side_sk")
            .join(dims["dim_referee"].select("referee_sk", F.col("referee_common_name").alias("referee_name")),
                  "referee_sk")
            .join(dims["dim_stadium"].select("stadium_sk", "stadium_name", "stadium_surface", "stadium_capacity",
                                             "stadium_latitude", "stadium_longitude"), "stadium_sk")
            .join(dims["dim_coach"].select("coach_sk", "coach_name"), "coach_sk", "left"))
    return wide.select(
        "match_date", "season", "is_current_season", "match_round_name", "match_round_type", "match_round_number",
        "match_id", "match_name", "match_short_name", "score", "match_status", "kick_off_time", "team_name",
        "team_short_name", "team_code", "team_logo", "team_sk", "opponent_team_name", "opponent_team_short_name",
        "opponent_team_code", "opponent_team_sk", "team_side", "result", "referee_name", "coach_name", "stadium_name",
        "stadium_surface", "stadium_capacity", "stadium_latitude", "stadium_longitude", "points_earned",
        "goals_scored", "goals_conceded", "goals_ht_scored", "goals_ht_conceded",
        F.col("ball_possession_pct").alias("possession_pct"), "corner_kicks", "yellow_cards", "red_cards",
        *[F.coalesce(f"_sums.{name}", F.lit(0)).alias(name) for name in TEAM_SUMS],
        "standings_type", "cumulative_points", "cumulative_gd", "cumulative_gf")


PLAYER_MEASURES = (
    "minutes_played", "goals_scored", "own_goals", "assists", "shots_total", "shots_on_target", "shots_off_target",
    "shots_blocked", "woodwork_hits", "big_chances_created", "big_chances_missed", "chances_created", "passes_total",
    "passes_accurate", "key_passes", "crosses_total", "crosses_accurate", "tackles", "tackles_won", "clearances",
    "interceptions", "aerials_won", "aerials_lost", "blocks", "duels_total", "duels_won", "dribbles_attempts",
    "dribbles_completed", "fouls_committed", "fouls_drawn", "yellow_cards", "yellow_red_cards", "red_cards",
    "offsides", "penalty_scored", "penalty_missed", "goals_conceded", "saves", "saves_inside_box",
    "errors_leading_to_goal", "rating")


def mart_player_facts(facts: DataFrame, dims: dict[str, DataFrame],
                      first_season: str = codes.FIRST_SEASON) -> DataFrame:
    days = dims["dim_date"].filter(F.col("season") >= first_season).select(
        "date_sk", F.col("date").alias("match_date"), "season", "is_current_season")
    matches = dims["dim_match"].filter("match_round_number IS NOT NULL").select(
        "match_sk", "match_id", "match_name", "match_short_name", "match_round_name", "match_round_number",
        "match_status")
    person = dims["dim_player"].select(
        "player_sk", "player_id", "player_name", "player_nationality", "player_birth_date", "player_height",
        "player_weight", "player_photo", "player_position", "player_detailed_position")
    wide = (facts.filter("player_sk > 0 AND match_result_sk > 0").join(days, "date_sk").join(matches, "match_sk")
            .join(person, "player_sk")
            .join(dims["dim_team"].select("team_sk", "team_name", "team_short_name", "team_logo"), "team_sk")
            .join(dims["dim_opponent_team"].select("opponent_team_sk", "opponent_team_name", "opponent_team_short_name"),
                  "opponent_team_sk")
            .join(dims["dim_match_result"].withColumnRenamed("match_result", "result"), "match_result_sk")
            .join(dims["dim_team_side"], "team_side_sk")
            .join(dims["dim_referee"].select("referee_sk", F.col("referee_common_name").alias("referee_name")),
                  "referee_sk")
            .join(dims["dim_stadium"].select("stadium_sk", "stadium_name"), "stadium_sk")
            .join(dims["dim_appearance_type"], "appearance_type_sk")
            .join(dims["dim_formation"], "formation_sk")
            .join(dims["dim_position"], "position_sk"))
    return wide.select(
        "match_date", "season", "is_current_season", "match_id", "match_name", "match_short_name", "match_round_name",
        "match_round_number", "match_status", "player_id", "player_name", "player_nationality", "player_birth_date",
        "player_height", "player_weight", "player_photo", "player_position", "player_detailed_position",
        "position_name", "position_short_code", "position_group", "formation", "team_name", "team_short_name",
        "team_logo", "opponent_team_name", "opponent_team_short_name", "result", "team_side", "referee_name",
        "stadium_name", "appearance_type", *PLAYER_MEASURES)


def league_info(dim_league: DataFrame, league_id: int) -> DataFrame:
    return dim_league.filter(F.col("league_id") == league_id).select(
        "league_name", "league_logo", "league_country_flag").limit(1)


def last_updated(docs: DataFrame, ts: str = "_ingested_at") -> DataFrame:
    """Freshness label of a bronze table."""
    return docs.agg(F.date_format(F.max(ts), "dd MMM yyyy HH:mm 'UTC'").alias("last_updated"))
