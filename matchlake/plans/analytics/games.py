"""Match results, match centre, upcoming matches and head-to-head."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ...functions.columns import ALL, any_of, percent, played, ratio, rounded, sum_if
from ...operators.ranking import top_n
from .common import both_sides, in_season

KEY_SEPARATOR, PAIR_SEPARATOR = "|", "|||"


def _rounds(picks) -> Column:
    return any_of(F.col("match_round_number").cast("int"), picks)


def rounds(mm: DataFrame, season: str) -> DataFrame:
    return in_season(mm, season).select(F.col("match_round_number").cast("int").alias("round_number")).distinct().orderBy(
        F.col("round_number").desc())


def results(mm: DataFrame, season: str, picks=ALL) -> DataFrame:
    """One row per match with the totals of both sides."""
    keys = ["match_id", "match_date", F.col("match_round_name").alias("round"), "match_round_number", "match_name",
            "match_short_name", "score", F.col("referee_name").alias("referee"), "season"]
    sums = {"total_goals": "goals_scored", "total_shots_on_goal": "shots_on_goal", "total_shots": "total_shots",
            "total_big_chances": "big_chances_created", "total_yellow_cards": "yellow_cards",
            "total_red_cards": "red_cards"}
    return in_season(mm, season).filter(_rounds(picks)).groupBy(*keys).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()]).orderBy(F.col("match_date").desc(), "match_id")


def round_kpis(mm: DataFrame, season: str, picks=ALL) -> DataFrame:
    games = F.countDistinct("match_id")
    return results(mm, season, picks).agg(
        F.sum("total_goals").alias("total_goals"), ratio(F.sum("total_goals"), games, 2).alias("avg_goals_per_match"),
        ratio(F.sum("total_shots_on_goal"), games, 1).alias("avg_shots_on_goal"),
        ratio(F.sum("total_goals"), F.sum("total_big_chances"), 2).alias("goals_per_big_chance"))


def match_key() -> Column:
    return F.concat("match_name", F.lit(KEY_SEPARATOR), F.date_format("match_date", "yyyy-MM-dd"))


def match_options(mm: DataFrame, season: str, picks=ALL) -> DataFrame:
    rows = in_season(mm, season).filter(_rounds(picks)).select(
        "match_name", "match_short_name", "match_date", "score").distinct()
    return rows.select(
        match_key().alias("match_key"),
        F.concat("match_short_name", F.lit("  ("), "score", F.lit(")")).alias("match_label"), "match_date"
    ).orderBy(F.col("match_date").desc(), "match_key")


def _at(key: str | Column) -> Column:
    """The rows of one match option; the key is split once, so both parts reach the scan as plain predicates. A column (a
    scalar subquery) is split by Spark."""
    if isinstance(key, Column):
        part = lambda k: F.split_part(key, F.lit(KEY_SEPARATOR), F.lit(k))
        return (F.col("match_name") == part(1)) & (F.col("match_date") == part(2).cast("date"))
    name, _, rest = key.partition(KEY_SEPARATOR)
    return (F.col("match_name") == name) & (F.col("match_date") == F.lit(rest.split(KEY_SEPARATOR)[0]).cast("date"))


def match_centre(mm: DataFrame, season: str, key: str) -> DataFrame:
    shown = {"team": "team_name", "team_short": "team_short_name", "goals": "goals_scored", "sog": "shots_on_goal",
             "possession": "possession_pct", "corners": "corner_kicks", "fouls": "fouls", "offsides": "offsides",
             "yc": "yellow_cards", "rc": "red_cards", "saves": "saves", "total_shots": "total_shots",
             "big_chances": "big_chances_created", "tackles": "tackles", "woodwork": "woodwork_hits",
             "_pa": "passes_accurate", "_pt": "total_passes"}
    one = mm.filter((F.col("season") == season) & _at(key)).agg(F.max("score").alias("score"), *both_sides(shown))
    for side in ("home", "away"):
        # the share is scaled after the division, as a double
        raw = F.col(f"{side}__pa").cast("double") / F.nullif(F.col(f"{side}__pt").cast("double"), F.lit(0.0))
        one = one.withColumn(f"{side}_pass_accuracy", rounded(raw * 100, 1))
    return one.drop("home__pa", "home__pt", "away__pa", "away__pt")


_LINE = ["player_name", "player_photo", "team_name", "team_side", "position_group", "position_name",
         "position_short_code", "formation"]


def _squad(mp: DataFrame, key: str, kind: str, columns: list[str]) -> DataFrame:
    return mp.filter(_at(key) & played() & (F.col("appearance_type") == kind)).select(
        *columns, rounded(F.col("rating"), 2).alias("rating")).orderBy(
        F.col("team_side").desc(), "position_group", "position_name", "player_name")


def lineup(mp: DataFrame, key: str) -> DataFrame:
    stats = ["minutes_played", "goals_scored", "assists", "shots_total", "shots_on_target", "key_passes",
             "big_chances_created", "dribbles_completed", "tackles", "interceptions", "clearances", "aerials_won", "blocks",
             "fouls_committed", "saves", "yellow_cards", "red_cards"]
    return _squad(mp, key, "Starter", [*_LINE[:3], "team_logo", *_LINE[3:], *stats])


def substitutes(mp: DataFrame, key: str) -> DataFrame:
    return _squad(mp, key, "Substitute", _LINE)


# upcoming ----------------------------------------------------------------------------------------------------------

def pending_teams(mm: DataFrame) -> DataFrame:
    return mm.filter("result = 'Pending'").select("team_name").distinct().orderBy("team_name")


def upcoming(mm: DataFrame, teams=ALL) -> DataFrame:
    """One row per pending match. An unknown venue is shown as TBD."""
    rows = mm.filter("result = 'Pending'").groupBy(
        "match_name", F.col("match_round_name").alias("round"), "match_round_number", "match_date", "kick_off_time",
        "stadium_name", F.col("referee_name").alias("referee"), "season").agg(
        *both_sides({"team": "team_name", "team_short": "team_short_name"}))
    unknown = F.col("stadium_name").like("%Unknown%") | F.col("stadium_name").like("%Applicable%")
    picked = any_of(F.col("home_team"), teams) | any_of(F.col("away_team"), teams)
    return rows.filter(picked).select(
        F.concat("home_team", F.lit(PAIR_SEPARATOR), "away_team").alias("match_key"), "match_name", "round",
        "match_round_number", "home_team", "away_team", "home_team_short", "away_team_short",
        F.concat("home_team_short", F.lit(" - "), "away_team_short").alias("match_short_name"),
        F.date_format("match_date", "yyyy-MM-dd").alias("match_date"), "kick_off_time",
        F.when(unknown, "TBD").otherwise(F.col("stadium_name")).alias("stadium"), "referee", "season"
    ).orderBy("match_date", "kick_off_time", "match_name")


def match_info(mm: DataFrame, pair: str, teams=ALL) -> DataFrame:
    home, away = pair.split(PAIR_SEPARATOR)
    one = upcoming(mm.filter(F.col("team_name").isin(home, away)), teams).filter(F.col("match_key") == pair)
    order = [F.col(c).asc_nulls_last() for c in ("match_date", "kick_off_time", "match_round_number", "stadium")]
    return top_n(one, 1, order).select("home_team", "away_team", "home_team_short", "away_team_short", "match_date",
                                       "round", "kick_off_time", "stadium")


def _meetings(mm: DataFrame, pair: str) -> DataFrame:
    one, two = pair.split(PAIR_SEPARATOR)
    return mm.filter(played() & F.col("match_name").isin(f"{one} - {two}", f"{two} - {one}"))


def h2h_seasons(mm: DataFrame, pair: str) -> DataFrame:
    return _meetings(mm, pair).select("season").distinct().orderBy(F.col("season").desc())


def h2h(mm: DataFrame, pair: str, seasons) -> DataFrame:
    rows = _meetings(mm, pair).filter(any_of(F.col("season"), seasons)).groupBy(
        "season", "match_date", F.col("match_round_name").alias("round"), "score").agg(
        *both_sides({"code": "team_code"}), F.sum("goals_scored").alias("total_goals"),
        F.sum("shots_on_goal").alias("total_shots_on_goal"), F.sum("big_chances_created").alias("total_big_chances"))
    return rows.withColumn("match", F.concat("home_code", F.lit(" - "), "away_code")).drop(
        "home_code", "away_code").orderBy(F.col("match_date").desc())


def h2h_stats(mm: DataFrame, pair: str, seasons) -> DataFrame:
    one, two = pair.split(PAIR_SEPARATOR)
    team, other, result = F.col("team_name"), F.col("opponent_team_name"), F.col("result")
    met = ((team == one) & (other == two)) | ((team == two) & (other == one))
    won = lambda name, rival: sum_if(((team == name) & (result == "Win")) | ((team == rival) & (result == "Loss")))
    return mm.filter((F.col("team_side") == "Home") & played() & any_of(F.col("season"), seasons) & met).agg(
        won(one, two).alias("team1_wins"), sum_if(result == "Draw").alias("draws"), won(two, one).alias("team2_wins"))


def recent_form(mm: DataFrame, team: str, n: int = 5) -> DataFrame:
    rows = mm.filter(played() & (F.col("team_name") == team))
    return top_n(rows, n, [F.col("match_date").desc(), F.col("match_id").desc()]).select(
        F.date_format("match_date", "dd MMM").alias("match_date"), F.col("opponent_team_short_name").alias("opponent"),
        F.col("goals_scored").alias("gf"), F.col("goals_conceded").alias("ga"), "result")
