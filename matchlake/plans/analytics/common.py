"""Filters, aggregates and row builders the analytic queries share. ``mm`` is the match extract, ``mp`` the player one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ...functions import codes
from ...functions.columns import ALL, any_of, count_if, percent, played, ratio, sum_if

GROUP_ORDER = {"Championship Group": 1, "Relegation Group": 2}


def in_season(df: DataFrame, season: str, team=ALL) -> DataFrame:
    """Played rows of one season, optionally of some teams. ``season`` is the partition column of both extracts."""
    return df.filter((F.col("season") == season) & played() & any_of(F.col("team_name"), team))


def group_rank(column: Column, rest: int = 3) -> Column:
    rank = F.lit(rest)
    for label, place in GROUP_ORDER.items():
        rank = F.when(column == label, place).otherwise(rank)
    return rank


def matches() -> Column:
    return F.countDistinct("match_id")


def total(c: str) -> Column:
    return F.sum(c)


def per_match(c: str | Column, digits: int | None) -> Column:
    return ratio(F.sum(c) if isinstance(c, str) else c, matches(), digits)


def share(num: str, den: str, digits: int | None = 1) -> Column:
    """100 * sum / sum."""
    return percent(F.sum(num), F.sum(den), digits)


def wins() -> Column:
    return sum_if(F.col("result") == "Win")


def draws() -> Column:
    return sum_if(F.col("result") == "Draw")


def losses() -> Column:
    return sum_if(F.col("result") == "Loss")


def goal_difference() -> Column:
    return F.sum("goals_scored") - F.sum("goals_conceded")


def home_win_share(digits: int = 1) -> Column:
    home = F.col("team_side") == "Home"
    return percent(count_if(home & (F.col("result") == "Win")), count_if(home), digits)


def severity() -> Column:
    """Yellow cards plus three per red card."""
    return F.sum("yellow_cards") + F.sum("red_cards") * 3


def both_sides(columns: Mapping[str, str], side: str = "team_side") -> list[Column]:
    """home_x / away_x pairs of a match, by conditional max."""
    return [F.max(F.when(F.col(side) == label.title(), F.col(c))).alias(f"{label}_{name}")
            for name, c in columns.items() for label in ("home", "away")]


def table_order(*last: str) -> list[Column]:
    """Points, goal difference, goals; the name decides what is still level."""
    return [F.col("pts").desc_nulls_last(), F.col("gd").desc_nulls_last(), F.col("gf").desc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in last]]


def season_list(df: DataFrame, only_played: bool = True, first: str | None = None) -> DataFrame:
    """Seasons, the running one first."""
    rows = df.filter(played()) if only_played else df
    if first:
        rows = rows.filter(F.col("season") >= first)
    marked = rows.groupBy("season").agg(F.max(F.col("is_current_season").cast("int")).alias("is_current"))
    return marked.orderBy(F.col("is_current").desc(), F.col("season").desc()).select("season")


def with_all(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with an 'All' entry pinned to the top."""
    distinct = df.select(column).distinct().select(column, F.lit(1).alias("ord"))
    head = df.sparkSession.range(1).select(F.lit(ALL).alias(column), F.lit(0).alias("ord"))
    return head.unionByName(distinct).orderBy("ord", column).select(column)


def previous_season(df: DataFrame, season: str, only_played: bool = True) -> Column:
    """Newest season before ``season``, as a scalar subquery."""
    earlier = df.filter(F.col("season") < season)
    return (earlier.filter(played()) if only_played else earlier).agg(F.max("season")).scalar()


def side_by_side(df: DataFrame, season: str, current: Sequence[str], previous: Sequence[str],
                 prefix: str = "prev_") -> DataFrame:
    """Two season rows (current, previous) as one row; the previous metrics get a prefix."""
    now = F.col("season") == season
    return df.agg(*[F.max(F.when(now, F.col(c))).alias(c) for c in current],
                  *[F.max(F.when(~now, F.col(c))).alias(prefix + c) for c in previous])
