"""Team analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ...functions import codes
from ...functions.columns import per90, percent, played, ratio, rounded
from ...operators.literals import values
from ...operators.ranking import top_n
from .common import (draws, goal_difference, group_rank, in_season, losses, matches, per_match, previous_season, share,
                     side_by_side, total, wins)


def teams(mm: DataFrame, season: str) -> DataFrame:
    return in_season(mm, season).select("team_name", "team_logo").distinct().orderBy("team_name")


def header(mm: DataFrame, season: str, team: str) -> DataFrame:
    return in_season(mm, season, team).groupBy("team_name", "team_logo").agg(
        F.max("coach_name").alias("coach_name"), total("points_earned").alias("points"), matches().alias("matches"),
        wins().alias("wins"), draws().alias("draws"), losses().alias("losses"), total("goals_scored").alias("gf"),
        total("goals_conceded").alias("ga"), goal_difference().alias("gd"))


_METRICS = ("goals_per_match", "conceded_per_match", "pass_accuracy", "avg_possession", "shot_conv", "yc_per_match",
            "win_rate")
_RATIOS = {"goals_ratio": "goals_per_match", "conceded_ratio": "conceded_per_match", "pass_ratio": "pass_accuracy",
           "shot_conv_ratio": "shot_conv", "yc_ratio": "yc_per_match", "win_rate_ratio": "win_rate",
           "possession_ratio": "avg_possession"}


def kpis(mm: DataFrame, season: str, team: str) -> DataFrame:
    """Indicators and table place now and at the same round one season earlier."""
    last_round = in_season(mm, season, team).agg(F.max("match_round_number")).scalar()
    now = F.col("season") == season
    before = (F.col("season") == previous_season(mm, season, only_played=False)) & (
        F.col("match_round_number") <= last_round)
    per_team = mm.filter((now | before) & played()).groupBy("season", "team_name").agg(
        F.max("match_round_number").alias("max_round"),
        per_match("goals_scored", 2).alias("goals_per_match"), per_match("goals_conceded", 2).alias("conceded_per_match"),
        share("passes_accurate", "total_passes").alias("pass_accuracy"),
        per_match("possession_pct", 1).alias("avg_possession"), share("goals_scored", "total_shots").alias("shot_conv"),
        per_match("yellow_cards", 2).alias("yc_per_match"), percent(wins(), matches()).alias("win_rate"),
        total("points_earned").alias("pts"),
        F.sum(F.col("goals_scored") - F.col("goals_conceded")).alias("gd"), total("goals_scored").alias("gf"),
        group_rank(F.max("standings_type")).alias("grp"))
    # the window sees one row per team and season
    order = Window.partitionBy("season").orderBy("grp", F.col("pts").desc_nulls_last(), F.col("gd").desc_nulls_last(),
                                                 F.col("gf").desc_nulls_last(), "team_name")
    mine = per_team.withColumn("rank", F.row_number().over(order)).filter(F.col("team_name") == team)
    pair = side_by_side(mine, season, ["max_round", *_METRICS, "rank"], [*_METRICS, "rank"])
    return pair.withColumnRenamed("rank", "current_rank").withColumns(
        {name: ratio(F.col(c), F.col(f"prev_{c}"), 2) for name, c in _RATIOS.items()})


def all_teams_points(mm: DataFrame, season: str, team: str) -> DataFrame:
    mine = F.col("team_name") == team
    return in_season(mm, season).select(
        F.col("match_round_number").alias("round"), "team_name", "cumulative_points",
        F.when(mine, team).otherwise("Other Teams").alias("highlight")).orderBy(
        F.when(mine, 0).otherwise(1), "team_name", "round")


def match_log(mm: DataFrame, season: str, team: str) -> DataFrame:
    return in_season(mm, season, team).orderBy(F.col("match_date").desc(), "match_id").select(
        "match_date", F.col("match_round_name").alias("round"), F.col("team_side").alias("home_away"),
        F.col("opponent_team_name").alias("opponent"), F.col("goals_scored").alias("gf"),
        F.col("goals_conceded").alias("ga"), "result", F.col("points_earned").alias("pts"),
        F.col("possession_pct").alias("possession"), "shots_on_goal", "total_shots",
        percent(F.col("passes_accurate"), F.col("total_passes")).alias("pass_accuracy"),
        percent(F.col("goals_scored"), F.col("total_shots")).alias("shot_conv"), "yellow_cards")


def form(mm: DataFrame, season: str, team: str, n: int = 10) -> DataFrame:
    """The last n matches, oldest first."""
    newest = top_n(in_season(mm, season, team), n, [F.col("match_date").desc(), F.col("match_id").desc()])
    return newest.orderBy("match_date", "match_id").select(
        "match_date", "result", F.col("goals_scored").alias("gf"), F.col("goals_conceded").alias("ga"),
        F.col("opponent_team_name").alias("opponent"))


def home_away_split(mm: DataFrame, season: str, team: str) -> DataFrame:
    return in_season(mm, season, team).groupBy(F.col("team_side").alias("venue")).agg(
        matches().alias("matches"), wins().alias("wins"), draws().alias("draws"), losses().alias("losses"),
        total("points_earned").alias("points"), per_match("goals_scored", 2).alias("goals_per_match"),
        per_match("goals_conceded", 2).alias("conceded_per_match"),
        share("passes_accurate", "total_passes").alias("pass_accuracy"),
        per_match("possession_pct", 1).alias("avg_possession")).orderBy(F.col("venue").desc())


def _rate(c: str):
    return per90(F.sum(c), F.sum("minutes_played"))


def squad(mp: DataFrame, season: str, team: str, min_matches: int = 3) -> DataFrame:
    """Totals and per-90 rates of every player with enough matches."""
    contributions = F.sum("goals_scored") + F.sum("assists")
    return in_season(mp, season, team).groupBy("player_name", "player_photo", "player_position").agg(
        total("goals_scored").alias("goals"), total("assists").alias("assists"),
        contributions.alias("goal_contributions"), matches().alias("matches"),
        rounded(F.avg("rating"), 2).alias("avg_rating"), _rate("goals_scored").alias("goals_per90"),
        per90(contributions, F.sum("minutes_played")).alias("contributions_per90"),
        total("shots_total").alias("shots"), _rate("shots_total").alias("shots_per90"),
        total("shots_on_target").alias("shots_on_target"), total("big_chances_created").alias("big_chances_created"),
        total("key_passes").alias("key_passes"), _rate("key_passes").alias("key_passes_per90"),
        total("chances_created").alias("chances_created"), _rate("chances_created").alias("chances_created_per90"),
        total("passes_total").alias("passes"), share("passes_accurate", "passes_total").alias("pass_accuracy"),
        total("crosses_total").alias("crosses"), _rate("crosses_total").alias("crosses_per90"),
        share("crosses_accurate", "crosses_total").alias("cross_accuracy"),
        total("tackles").alias("tackles"), _rate("tackles").alias("tackles_per90"),
        total("interceptions").alias("interceptions"), _rate("interceptions").alias("interceptions_per90"),
        total("clearances").alias("clearances"), total("aerials_won").alias("aerials_won"),
        total("dribbles_completed").alias("dribbles"), _rate("dribbles_completed").alias("dribbles_per90"),
        share("dribbles_completed", "dribbles_attempts").alias("dribble_success_pct"),
        total("yellow_cards").alias("yellow_cards"), total("red_cards").alias("red_cards"),
        total("fouls_committed").alias("fouls"), total("fouls_drawn").alias("fouls_drawn"),
        total("minutes_played").alias("minutes")
    ).filter(F.col("matches") >= min_matches).orderBy(F.col("avg_rating").desc_nulls_last(), "player_name")


# metric pick-lists: value and label. Fixed values.
METRIC_LISTS = {
    "attack": [("goals", "Goals"), ("assists", "Assists"), ("goal_contributions", "G+A"), ("goals_per90", "G/90"),
               ("contributions_per90", "G+A/90"), ("shots", "Shots"), ("shots_per90", "Shots/90"),
               ("shots_on_target", "Shots on Target"), ("big_chances_created", "Big Chances")],
    "passing": [("key_passes", "Key Passes"), ("key_passes_per90", "Key Passes/90"),
                ("chances_created", "Chances Created"), ("chances_created_per90", "Chances/90"), ("passes", "Passes"),
                ("pass_accuracy", "Pass Acc %"), ("crosses", "Crosses"), ("crosses_per90", "Crosses/90"),
                ("cross_accuracy", "Cross Acc %")],
    "defense": [("tackles", "Tackles"), ("tackles_per90", "Tackles/90"), ("interceptions", "Interceptions"),
                ("interceptions_per90", "Interceptions/90"), ("clearances", "Clearances"),
                ("aerials_won", "Aerials Won")],
    "dribbling": [("dribbles", "Dribbles"), ("dribbles_per90", "Dribbles/90"),
                  ("dribble_success_pct", "Dribble Success %")],
    "discipline": [("yellow_cards", "Yellow Cards"), ("red_cards", "Red Cards"), ("fouls", "Fouls"),
                   ("fouls_drawn", "Fouls Drawn")],
}


def metric_list(spark: SparkSession, kind: str) -> DataFrame:
    return values(spark, "value string, label string", METRIC_LISTS[kind])


def metric_board(mp: DataFrame, season: str, team: str, kind: str) -> DataFrame:
    """Every metric of a pick-list with the squad ranked by it; a board is as long as the squad."""
    metrics = [m for m, _ in METRIC_LISTS[kind]]
    stats = squad(mp, season, team).select("player_name", "player_photo", *[F.col(m).cast("double") for m in metrics])
    long = stats.unpivot(["player_name", "player_photo"], metrics, "value", "amount").filter("amount IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("value").orderBy(F.col("amount").desc(), "player_name", "player_photo"))
    return (long.withColumn("place", place).join(metric_list(mp.sparkSession, kind), "value")
            .select("value", "label", "place", "player_name", "amount").orderBy("value", "place"))


def phase_performance(mm: DataFrame, season: str, team: str) -> DataFrame:
    phase = F.col("phase")
    order = F.when(phase == codes.REGULAR_STAGE, 1).when(phase.isin("Championship Group", "Relegation Group"), 2).otherwise(3)
    return in_season(mm, season, team).groupBy(F.col("match_round_type").alias("phase")).agg(
        matches().alias("matches"), total("points_earned").alias("points"),
        per_match("points_earned", 2).alias("points_per_match"), total("goals_scored").alias("gf"),
        total("goals_conceded").alias("ga"), per_match("goals_scored", 2).alias("goals_per_match")).orderBy(order, "phase")
