"""Referee and stadium analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ...functions import codes
from ...functions.columns import count_if, percent, played, ratio, short_season, sum_if
from ...operators.ranking import top_n
from .common import home_win_share, in_season, matches, per_match, severity, share, total

# referees ----------------------------------------------------------------------------------------------------------


def referee_kpis_league(mm: DataFrame, season: str) -> DataFrame:
    return in_season(mm, season).agg(
        F.countDistinct("referee_name").alias("total_referees"), per_match("yellow_cards", 2).alias("league_avg_yellows"),
        per_match("red_cards", 3).alias("league_avg_reds"), per_match("fouls", 1).alias("league_avg_fouls"),
        ratio(severity(), matches(), 2).alias("league_severity_index"))


def referee_season(mm: DataFrame, season: str) -> DataFrame:
    side = lambda s: sum_if(F.col("team_side") == s, F.col("yellow_cards"))
    return in_season(mm, season).groupBy("referee_name").agg(
        matches().alias("matches_managed"), total("yellow_cards").alias("total_yellow_cards"),
        total("red_cards").alias("total_red_cards"), total("fouls").alias("total_fouls"),
        per_match("yellow_cards", 2).alias("avg_yellows_per_match"), per_match("red_cards", 3).alias("avg_reds_per_match"),
        per_match("fouls", 1).alias("avg_fouls_per_match"), ratio(severity(), matches(), 2).alias("card_severity_index"),
        per_match(side("Home"), 2).alias("home_yc_per_match"), per_match(side("Away"), 2).alias("away_yc_per_match"),
        percent(side("Home"), F.sum("yellow_cards")).alias("home_yc_pct"))


def referee_stats(mm: DataFrame, season: str) -> DataFrame:
    return referee_season(mm, season).orderBy(F.col("matches_managed").desc(), "referee_name")


def strictest(mm: DataFrame, season: str, n: int = 3, lenient: bool = False) -> DataFrame:
    rate = F.col("avg_yellows_per_match")
    return top_n(referee_season(mm, season), n,
                 [rate.asc_nulls_last() if lenient else rate.desc_nulls_last(), F.col("referee_name")])


def referee_of(mm: DataFrame, season: str, referee: str) -> DataFrame:
    return referee_season(mm.filter(F.col("referee_name") == referee), season)


def card_trend(mm: DataFrame, referee: str | None = None, first: str = codes.FIRST_SEASON) -> DataFrame:
    """Cards and fouls per season, of the league or of one referee."""
    rows = mm.filter(played() & (F.col("season") >= first))
    if referee is not None:
        rows = rows.filter(F.col("referee_name") == referee)
    return rows.groupBy("season").agg(
        per_match("yellow_cards", 2).alias("yc_per_match"), per_match("red_cards", 4).alias("rc_per_match"),
        per_match("fouls", 1).alias("fouls_per_match"), ratio(severity(), matches(), 2).alias("severity_index")
    ).orderBy("season").withColumn("season", short_season(F.col("season")))


def combined_trends(mm: DataFrame, referee: str) -> DataFrame:
    return card_trend(mm).withColumn("source", F.lit("League Avg")).unionByName(
        card_trend(mm, referee).withColumn("source", F.lit(referee)))


def referee_exposure(mm: DataFrame, season: str, referee: str) -> DataFrame:
    return in_season(mm, season).filter(F.col("referee_name") == referee).groupBy("team_name").agg(
        matches().alias("matches")).orderBy(F.col("matches").desc(), "team_name")


def referee_log(mm: DataFrame, season: str, referee: str) -> DataFrame:
    return in_season(mm, season).filter(F.col("referee_name") == referee).groupBy(
        "match_date", F.col("match_round_name").alias("round"), "match_name", "score").agg(
        total("yellow_cards").alias("yellow_cards"), total("red_cards").alias("red_cards"), total("fouls").alias("fouls")
    ).orderBy(F.col("match_date").desc(), "match_name")


# stadiums ----------------------------------------------------------------------------------------------------------

# bounding box of the league's country. Fixed values.
LATITUDE, LONGITUDE = (54.5, 57.8), (7.5, 15.5)


def _located(mm: DataFrame, season: str) -> DataFrame:
    return in_season(mm, season).filter(F.col("stadium_latitude").between(*LATITUDE)
                                        & F.col("stadium_longitude").between(*LONGITUDE))


def _named(*patterns: str) -> Column:
    keep = F.lit(True)
    for p in patterns:
        keep = keep & ~F.col("stadium_name").like(p)
    return keep


def is_grass(c: Column) -> Column:
    return c.ilike("%grass%") | c.ilike("%natural%")


def is_turf(c: Column) -> Column:
    return c.ilike("%artif%") | c.ilike("%turf%")


def surface_code(c: Column) -> Column:
    return F.when(is_grass(c), 1).when(is_turf(c), 2).otherwise(3)


def stadium_stats(mm: DataFrame, season: str, min_matches: int = 4) -> DataFrame:
    surface = F.max("stadium_surface")
    grouped = _located(mm, season).filter(_named("%Unknown%", "%Applicable%")).groupBy("stadium_name").agg(
        F.max("stadium_latitude").alias("lat"), F.max("stadium_longitude").alias("lon"),
        surface.alias("stadium_surface"), surface_code(surface).alias("surface_code"),
        F.max("stadium_capacity").alias("stadium_capacity"), matches().alias("total_matches"),
        total("goals_scored").alias("total_goals"), per_match("goals_scored", 2).alias("goals_per_match"),
        home_win_share().alias("home_win_pct"), percent(count_if(F.col("result") == "Draw"), F.count("*")).alias("draw_pct"),
        share("passes_accurate", "total_passes").alias("pass_accuracy"), per_match("yellow_cards", 2).alias("yc_per_match"),
        per_match("fouls", 1).alias("fouls_per_match"), per_match("corner_kicks", 1).alias("corners_per_match")
    ).filter(F.col("total_matches") >= min_matches)
    # the smallest total is taken over one row per stadium
    smallest = F.min("total_goals").over(Window.partitionBy())
    return grouped.withColumn("total_goals_scaled", F.col("total_goals") - (smallest - 1)).orderBy(
        F.col("home_win_pct").desc_nulls_last(), "stadium_name")


def surface_analysis(mm: DataFrame, season: str) -> DataFrame:
    rows = _located(mm, season).filter("stadium_surface IS NOT NULL AND stadium_surface <> ''")
    return rows.groupBy("stadium_surface").agg(
        matches().alias("matches"), per_match("goals_scored", 2).alias("goals_per_match"),
        home_win_share().alias("home_win_pct"), percent(count_if(F.col("result") == "Draw"), F.count("*")).alias("draw_pct"),
        share("passes_accurate", "total_passes").alias("pass_accuracy"), per_match("possession_pct", 1).alias("avg_possession"),
        per_match("shots_on_goal", 1).alias("shots_per_match"), per_match("yellow_cards", 2).alias("yc_per_match"),
        per_match("fouls", 1).alias("fouls_per_match"), per_match("corner_kicks", 1).alias("corners_per_match"),
        share("goals_scored", "total_shots").alias("shot_conversion"),
        share("crosses_accurate", "crosses_total").alias("cross_accuracy")
    ).orderBy(surface_code(F.col("stadium_surface")), "stadium_surface")


def fortress(mm: DataFrame, season: str, min_home: int = 4) -> DataFrame:
    """Home record per stadium with its most frequent home team.

    Teams are counted per stadium first, so the modal team is an argmax over a few counts.
    """
    rows = _located(mm, season).filter(_named("%Unknown%", "%Applicable%"))
    home = rows.filter("team_side = 'Home'")
    games = matches()
    facts = home.groupBy("stadium_name").agg(
        games.alias("home_matches"), F.sum(F.when(F.col("result") == "Win", 1).otherwise(0)).alias("home_wins"),
        sum_if(F.col("result") == "Draw").alias("home_draws"), sum_if(F.col("result") == "Loss").alias("home_losses"),
        percent(sum_if(F.col("result") == "Win"), games).alias("home_win_pct"),
        ratio(F.sum("goals_scored"), games, 2).alias("goals_scored_per_match"),
        ratio(F.sum("goals_conceded"), games, 2).alias("goals_conceded_per_match")
    ).filter(F.col("home_matches") >= min_home)
    venue = rows.groupBy("stadium_name").agg(F.max("stadium_surface").alias("stadium_surface"),
                                             F.max("stadium_capacity").alias("stadium_capacity"))
    mode = lambda c, out: (home.filter(F.col(c).isNotNull()).groupBy("stadium_name", c).agg(F.count("*").alias("n"))
                           .groupBy("stadium_name").agg(F.min_by(c, F.struct(-F.col("n"), F.col(c))).alias(out)))
    return (facts.join(venue, "stadium_name").join(mode("team_name", "home_team"), "stadium_name", "left")
            .join(mode("team_logo", "team_logo"), "stadium_name", "left")
            .orderBy(F.col("home_win_pct").desc_nulls_last(), "stadium_name"))


def fortress_podium(mm: DataFrame, season: str) -> DataFrame:
    return top_n(fortress(mm, season), 3, [F.col("home_win_pct").desc_nulls_last(), F.col("stadium_name")])


def stadium_kpis(mm: DataFrame, season: str, min_matches: int = 4) -> DataFrame:
    stadiums = _located(mm, season).filter(_named("%Unknown%")).groupBy("stadium_name").agg(
        F.max("stadium_surface").alias("s"), matches().alias("n")).filter(F.col("n") >= min_matches)
    return stadiums.agg(F.countDistinct("stadium_name").alias("total_stadiums"),
                        sum_if(is_grass(F.col("s"))).alias("grass_stadiums"),
                        sum_if(is_turf(F.col("s"))).alias("turf_stadiums"))
