"""Player analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ...functions.columns import ALL, any_of, per90, rounded
from ...operators.ranking import pct_rank, pct_rank_of
from .common import draws, in_season, losses, matches, share, total, wins, with_all


def team_filter(mp: DataFrame, season: str) -> DataFrame:
    return with_all(in_season(mp, season), "team_name")


def position_filter(mp: DataFrame, season: str, team=ALL) -> DataFrame:
    return with_all(in_season(mp, season, team).filter("player_position IS NOT NULL"), "player_position")


def players(mp: DataFrame, season: str, team=ALL, position=ALL) -> DataFrame:
    return in_season(mp, season, team).filter(any_of(F.col("player_position"), position)).select(
        "player_name").distinct().orderBy("player_name")


# category, ranked column, label; fixed values in display order
CATEGORIES = (("Top Scorer", "goals", "Goals"), ("Top Assister", "assists", "Assists"),
              ("Top Dribbler", "dribbles", "Dribbles"), ("Top Defender", "defensive_actions", "Tkl+Int"),
              ("Top Crosser", "crosses", "Crosses"), ("Top Passer", "passes", "Acc. Passes"))


def top_players(mp: DataFrame, season: str, team=ALL, min_matches: int = 3) -> DataFrame:
    """Best player of each category: the totals become rows and one combinable argmax picks the winner per category."""
    base = in_season(mp, season, team).groupBy("player_name", "player_photo", "player_position").agg(
        F.max("team_name").alias("team_name"), F.max("team_logo").alias("team_logo"), matches().alias("matches"),
        total("goals_scored").alias("goals"), total("assists").alias("assists"),
        total("dribbles_completed").alias("dribbles"), (total("tackles") + total("interceptions")).alias("defensive_actions"),
        total("crosses_total").alias("crosses"), total("passes_accurate").alias("passes")
    ).filter(F.col("matches") >= min_matches)
    who = ["player_name", "player_photo", "player_position", "team_name", "team_logo"]
    entries = F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(name).alias("category"), F.lit(label).alias("stat_label"),
                                 F.col(c).cast("bigint").alias("stat_value"))
                        for i, (name, c, label) in enumerate(CATEGORIES)])
    long = base.select(*who, F.inline(entries)).filter("stat_value IS NOT NULL")
    best = long.groupBy("ord", "category", "stat_label").agg(
        F.min_by(F.struct(*who, "stat_value"), F.struct(-F.col("stat_value"), "player_name", "player_photo")).alias("b"))
    return best.orderBy("ord").select("category", *[f"b.{c}" for c in who], "b.stat_value", "stat_label")


def profile(mp: DataFrame, season: str, player: str) -> DataFrame:
    minutes = F.sum("minutes_played")
    return in_season(mp, season).filter(F.col("player_name") == player).groupBy(
        "player_name", "player_photo", "team_name", "team_logo", "player_position").agg(
        matches().alias("matches"), minutes.alias("minutes"), total("goals_scored").alias("goals"),
        total("assists").alias("assists"), total("shots_total").alias("shots"),
        total("shots_on_target").alias("shots_on_target"), total("key_passes").alias("key_passes"),
        total("tackles").alias("tackles"), total("yellow_cards").alias("yellow_cards"),
        rounded(F.avg("rating"), 2).alias("avg_rating"), per90(F.sum("goals_scored"), minutes).alias("goals_per90"),
        per90(F.sum("assists"), minutes).alias("assists_per90"),
        per90(F.sum("goals_scored") + F.sum("assists"), minutes).alias("contributions_per90"),
        share("passes_accurate", "passes_total").alias("pass_accuracy"),
        share("goals_scored", "shots_total").alias("shot_conversion"),
        wins().alias("wins"), draws().alias("draws"), losses().alias("losses"))


def trend(mp: DataFrame, season: str, player: str) -> DataFrame:
    return in_season(mp, season).filter(F.col("player_name") == player).select(
        F.col("match_round_number").alias("round"), F.col("goals_scored").alias("goals"), "assists", "rating"
    ).orderBy("round")


def match_log(mp: DataFrame, season: str, player: str) -> DataFrame:
    return in_season(mp, season).filter(F.col("player_name") == player).orderBy(
        F.col("match_date").desc(), "match_id").select(
        F.date_format("match_date", "yyyy-MM-dd").alias("match_date"), F.col("match_round_name").alias("round"),
        F.col("opponent_team_name").alias("opponent"), F.col("team_side").alias("home_away"), "result",
        "minutes_played", F.col("goals_scored").alias("goals"), "assists", F.col("shots_total").alias("shots"),
        "shots_on_target", "key_passes", "tackles", "yellow_cards", "rating")


# output column -> ranked metric
_CONTEXT = {"goals_pct": "goals", "assists_pct": "assists", "rating_pct": "avg_rating", "goals_per90_pct": "goals_per90",
            "assists_per90_pct": "assists_per90", "pass_pct": "pass_accuracy", "shot_conv_pct": "shot_conversion",
            "defense_pct": "tackles_per90"}


def _context_base(mp: DataFrame, season: str, min_minutes: int) -> DataFrame:
    minutes = F.sum("minutes_played")
    rate = lambda c: per90(F.sum(c), minutes, None)
    return in_season(mp, season).groupBy("player_name").agg(
        total("goals_scored").alias("goals"), total("assists").alias("assists"), F.avg("rating").alias("avg_rating"),
        rate("goals_scored").alias("goals_per90"), rate("assists").alias("assists_per90"),
        share("passes_accurate", "passes_total", None).alias("pass_accuracy"),
        share("goals_scored", "shots_total", None).alias("shot_conversion"), rate("tackles").alias("tackles_per90"),
        minutes.alias("minutes")).filter(F.col("minutes") >= min_minutes)


def league_context(mp: DataFrame, season: str, player: str, min_minutes: int = 450) -> DataFrame:
    """Percentiles of one player among all players with enough minutes, by counting who ranks below."""
    base = _context_base(mp, season, min_minutes)
    one = base.filter(F.col("player_name") == player)
    ranks = pct_rank_of(base, one, {m: "asc" for m in _CONTEXT.values()})
    known = one.select("player_name").scalar()
    return ranks.select(known.alias("player_name"),
                        *[rounded(F.col(m) * 100, 0).alias(out) for out, m in _CONTEXT.items()]).filter(
        "player_name IS NOT NULL")


def percentile_board(mp: DataFrame, season: str, min_minutes: int = 450) -> DataFrame:
    """The same percentiles for every player, without a single-task sort."""
    ranks = pct_rank(_context_base(mp, season, min_minutes), "player_name", {m: "asc" for m in _CONTEXT.values()})
    return ranks.select("player_name", *[rounded(F.col(f"{m}_pct") * 100, 0).alias(out) for out, m in _CONTEXT.items()])
