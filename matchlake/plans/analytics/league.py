"""Home page, standings and league analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ...functions import codes
from ...functions.columns import ALL, count_if, percent, played, ratio, rounded, weighted
from ...operators.ranking import top_n
from .common import (draws, goal_difference, group_rank, home_win_share, in_season, losses, matches, per_match,
                     previous_season, share, side_by_side, table_order, total, wins, with_all)


def home_kpis(mm: DataFrame) -> DataFrame:
    return mm.filter(F.col("is_current_season") & played()).agg(
        matches().alias("total_matches"), total("goals_scored").alias("total_goals"),
        F.countDistinct("team_name").alias("total_teams"), F.max("season").alias("season"))


def _table(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(
        matches().alias("gp"), wins().alias("w"), draws().alias("d"), losses().alias("l"),
        total("goals_scored").alias("gf"), total("goals_conceded").alias("ga"), goal_difference().alias("gd"),
        total("points_earned").alias("pts"))


def leader(mm: DataFrame) -> DataFrame:
    rows = mm.filter(F.col("is_current_season") & played())
    table = _table(rows, "team_name", "team_short_name", "standings_type")
    best = top_n(table, 1, [group_rank(F.col("standings_type")), *table_order("team_name")])
    return best.select("team_name", "team_short_name", "pts")


def standings(mm: DataFrame, season: str) -> DataFrame:
    """Table of the play-off groups, ranked inside each group."""
    table = _table(in_season(mm, season), "team_name", "team_short_name", "standings_type")
    table = table.filter(F.col("standings_type") != codes.REGULAR_STAGE)
    # one row per team is left, so a group is as long as a league table
    rank = F.row_number().over(Window.partitionBy("standings_type").orderBy(*table_order("team_name")))
    return (table.withColumn("rank", rank).orderBy("standings_type", "rank")
            .select("rank", F.col("team_name").alias("team"), F.col("team_short_name").alias("team_short"), "gp", "w", "d",
                    "l", "gf", "ga", "gd", "pts", F.col("standings_type").alias("round_group")))


def group_table(mm: DataFrame, season: str, group: str) -> DataFrame:
    return standings(mm, season).filter(F.col("round_group") == group).drop("round_group")


def regular_table(mm: DataFrame, season: str) -> DataFrame:
    rows = in_season(mm, season).filter(F.col("match_round_type") == codes.REGULAR_STAGE)
    table = _table(rows, "team_name", "team_short_name")
    rank = F.row_number().over(Window.orderBy(*table_order("team_name")))
    return table.withColumn("rank", rank).orderBy("rank").select(
        "rank", F.col("team_name").alias("team"), F.col("team_short_name").alias("team_short"), "gp", "w", "d", "l",
        "gf", "ga", "gd", "pts")


def all_teams(mm: DataFrame, season: str) -> DataFrame:
    table = _table(in_season(mm, season), "team_short_name", "standings_type")
    return table.orderBy(group_rank(F.col("standings_type")), F.col("pts").desc_nulls_last(), "team_short_name").select(
        F.col("team_short_name").alias("team"), "pts", "w", "d", "l", F.col("standings_type").alias("round_group"))


def team_filter(mm: DataFrame, season: str) -> DataFrame:
    return with_all(in_season(mm, season), "team_name")


_KPI_PREVIOUS = ("total_goals", "goals_per_match", "cross_accuracy", "shot_conversion", "pass_accuracy",
                 "yc_per_match", "rc_per_match", "sot_per_match")
_KPI_RATIOS = {"total_goals_ratio": "total_goals", "goals_ratio": "goals_per_match",
               "cross_accuracy_ratio": "cross_accuracy", "shot_conv_ratio": "shot_conversion",
               "pass_ratio": "pass_accuracy", "yc_ratio": "yc_per_match", "rc_ratio": "rc_per_match",
               "sot_ratio": "sot_per_match"}


def league_kpis(mm: DataFrame, season: str, team=ALL) -> DataFrame:
    """Season indicators next to those of the season before; both come from one grouped pass."""
    from ...functions.columns import any_of
    both = (F.col("season") == season) | (F.col("season") == previous_season(mm, season))
    rows = mm.filter(both & played() & any_of(F.col("team_name"), team))
    stats = rows.groupBy("season").agg(
        matches().alias("total_matches"), total("goals_scored").alias("total_goals"),
        per_match("goals_scored", 2).alias("goals_per_match"), home_win_share().alias("home_win_pct"),
        share("crosses_accurate", "crosses_total").alias("cross_accuracy"),
        share("goals_scored", "total_shots").alias("shot_conversion"),
        share("passes_accurate", "total_passes").alias("pass_accuracy"),
        per_match("yellow_cards", 2).alias("yc_per_match"), per_match("red_cards", 2).alias("rc_per_match"),
        per_match("shots_on_goal", 1).alias("sot_per_match"))
    current = [c for c in stats.columns if c != "season"]
    pair = side_by_side(stats, season, current, _KPI_PREVIOUS)
    return pair.withColumns({name: ratio(F.col(c), F.col(f"prev_{c}"), 2) for name, c in _KPI_RATIOS.items()})


def _top_players(mp: DataFrame, season: str, team, value, out: str, having, extra=()) -> DataFrame:
    people = in_season(mp, season, team).groupBy("player_name", "player_photo", "team_name").agg(
        value.alias("_v"), *extra).filter(having)
    best = top_n(people, 3, [F.col("_v").desc_nulls_last(), F.col("player_name"), F.col("team_name")], rank="rn")
    shown = rounded(F.col("_v"), 2) if out == "avg_rating" else F.col("_v")
    return best.select("player_name", "player_photo", "team_name", shown.alias(out),
                       *[c for c in best.columns if c == "matches"], "rn").orderBy("rn")


def top_scorers(mp: DataFrame, season: str, team=ALL) -> DataFrame:
    return _top_players(mp, season, team, F.sum("goals_scored"), "goals", F.col("_v") > 0)


def top_assisters(mp: DataFrame, season: str, team=ALL) -> DataFrame:
    return _top_players(mp, season, team, F.sum("assists"), "assists", F.col("_v") > 0)


def top_rated(mp: DataFrame, season: str, team=ALL, min_matches: int = 5) -> DataFrame:
    return _top_players(mp.filter("rating > 0"), season, team, F.avg("rating"), "avg_rating",
                        F.col("matches") >= min_matches, [matches().alias("matches")])


def current_standings(mm: DataFrame, season: str, team=ALL) -> DataFrame:
    table = _table(in_season(mm, season, team), "team_name", "team_short_name", "team_logo", "standings_type")
    return table.orderBy(group_rank(F.col("standings_type")), *table_order("team_name")).select(
        "team_name", "team_short_name", F.col("gp").alias("mp"), "pts", "gd", "gf",
        F.col("standings_type").alias("round_group"))


def clean_sheets():
    return F.countDistinct(F.when(F.col("goals_conceded") == 0, F.col("match_id")))


def team_landscape(mm: DataFrame, season: str, team=ALL) -> DataFrame:
    return in_season(mm, season, team).groupBy("team_name", "team_logo").agg(
        total("goals_scored").alias("goals_for"), total("goals_conceded").alias("goals_against"),
        total("points_earned").alias("points"),
        percent(count_if(F.col("result") == "Win"), F.count("*")).alias("win_pct"),
        share("goals_scored", "total_shots").alias("shot_conv"), clean_sheets().alias("clean_sheets"),
        share("passes_accurate", "total_passes").alias("pass_accuracy")).orderBy("team_name")


def team_landscape_bounds(mm: DataFrame, season: str) -> DataFrame:
    """Axis bounds with a margin of ten percent; decimal literals keep whole products whole."""
    teams = in_season(mm, season).groupBy("team_name").agg(
        total("goals_scored").alias("gf"), total("goals_conceded").alias("ga"))
    return teams.agg(*[F.expr(f"CAST({fn}({side}({c}) * {margin}) AS BIGINT)").alias(name) for name, c, fn, side, margin in (
        ("x_min", "gf", "floor", "min", "0.9"), ("x_max", "gf", "ceil", "max", "1.1"),
        ("y_min", "ga", "floor", "min", "0.9"), ("y_max", "ga", "ceil", "max", "1.1"))])


def points_progression(mm: DataFrame, season: str, team=ALL) -> DataFrame:
    """Cumulative series, best final total first. The total per team is aggregated and joined, not windowed."""
    rows = in_season(mm, season, team)
    finals = rows.groupBy("team_name").agg(F.max("cumulative_points").alias("_final"))
    return (rows.join(finals, "team_name").orderBy(F.col("_final").desc_nulls_last(), "team_name", "match_round_number")
            .select(F.col("match_round_number").alias("round"), "team_name", "cumulative_points", "cumulative_gd",
                    "cumulative_gf"))


def team_season_stats(mm: DataFrame, season: str, team=ALL) -> DataFrame:
    aggression = weighted([(F.sum("fouls"), 1), (F.sum("yellow_cards"), 5), (F.sum("red_cards"), 15)], matches(), 1)
    return in_season(mm, season, team).groupBy("team_name").agg(
        total("goals_scored").alias("goals_for"), total("goals_conceded").alias("goals_against"),
        share("goals_scored", "total_shots").alias("shot_conversion_pct"),
        share("goals_scored", "shots_on_goal").alias("on_target_conversion_pct"),
        clean_sheets().alias("clean_sheets"), per_match("saves", 1).alias("avg_saves"),
        per_match("goals_conceded", 2).alias("avg_goals_conceded"),
        per_match("possession_pct", 1).alias("avg_possession"),
        share("passes_accurate", "total_passes").alias("avg_pass_accuracy"),
        per_match("corner_kicks", 1).alias("avg_corners"), per_match("fouls", 1).alias("avg_fouls"),
        aggression.alias("aggression_index"), total("yellow_cards").alias("yellow_cards"),
        total("red_cards").alias("red_cards"))


RANKINGS = {
    "attack": (["goals_for", "shot_conversion_pct", "on_target_conversion_pct"], "goals_for"),
    "defence": (["goals_against", "clean_sheets", "avg_saves", "avg_goals_conceded"], "clean_sheets"),
    "possession": (["avg_possession", "avg_pass_accuracy", "avg_corners"], "avg_possession"),
    "discipline": (["yellow_cards", "red_cards", "avg_fouls", "aggression_index"], "aggression_index")}


def ranking(mm: DataFrame, season: str, kind: str, team=ALL) -> DataFrame:
    columns, order = RANKINGS[kind]
    return team_season_stats(mm, season, team).select("team_name", *columns).orderBy(
        F.col(order).desc_nulls_last(), "team_name")


def radar(mm: DataFrame, season: str, team=ALL) -> DataFrame:
    """Percentile of each team among all teams of the season; the team filter applies after ranking."""
    from ...functions.columns import any_of
    teams = in_season(mm, season).groupBy("team_name").agg(
        per_match("goals_scored", None).alias("goals_per_match"),
        per_match("goals_conceded", None).alias("conceded_per_match"),
        share("passes_accurate", "total_passes", None).alias("pass_accuracy"),
        per_match("possession_pct", None).alias("avg_possession"),
        share("goals_scored", "total_shots", None).alias("shot_conv"),
        percent(wins(), matches(), None).alias("win_rate"))
    # one row per team of one season meets in these windows
    rank = lambda c, desc=False: rounded(F.percent_rank().over(Window.orderBy(
        F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last())) * 100, 0)
    ranked = teams.select(
        "*", rank("goals_per_match").alias("attack_pct"), rank("conceded_per_match", True).alias("defense_pct"),
        rank("pass_accuracy").alias("passing_pct"), rank("avg_possession").alias("possession_pct"),
        rank("shot_conv").alias("efficiency_pct"), rank("win_rate").alias("wins_pct"))
    return ranked.filter(any_of(F.col("team_name"), team)).orderBy("team_name")
