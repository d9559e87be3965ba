"""Gold dimensions. Each builder takes silver relations and, for an incremental run, the existing dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import codes
from ..functions.columns import date_key, int_from_text, is_finished, local_time, season_tag
from ..operators.intervals import tag_ranges
from ..operators.keys import latest_per_key, merge_scd1, overlay, with_fallback, with_sentinels
from ..operators.literals import values
from ..operators.shape import dominant_value, stack_by_key
from ..sources.storage import written


def _special(sk: str, unknown: dict, not_applicable: dict) -> list[dict]:
    return [{sk: -1, **unknown}, {sk: -2, **not_applicable}]


# Texts of the Unknown (-1) and Not Applicable (-2) members. Fixed values.
SENTINELS = {
    "dim_team": _special("team_sk", dict(
        team_name="Unknown Team", team_code="Unknown", team_short_name="Unknown Team",
        team_country="Unknown Team Country", team_venue_name="Unknown Team Venue", team_venue_city="Unknown Team City"),
        dict(team_name="Not Applicable Team", team_code="N/A", team_short_name="Not Applicable",
             team_country="Not Applicable Team Country", team_venue_name="Not Applicable Team Venue",
             team_venue_city="Not Applicable Team City")),
    "dim_match": _special("match_sk", dict(
        match_round_type="Unknown Match Round Type", match_round_name="Unknown Match Round Name",
        match_type="Unknown Match Type", match_name="Unknown Match", match_short_name="Unknown Match",
        match_result="Unknown Match Result", kick_off_time="Unknown", match_status="Unknown Match Status"),
        dict(match_round_type="Not Applicable Match Round Type", match_round_name="Not Applicable Match Round Name",
             match_type="Not Applicable Match Type", match_name="Not Applicable Match",
             match_short_name="Not Applicable Match", match_result="Not Applicable Match Result",
             kick_off_time="Not Applicable", match_status="Not Applicable Match Status")),
    "dim_player": _special("player_sk", dict(
        player_name="Unknown Player", player_firstname="Unknown", player_lastname="Unknown",
        player_nationality="Unknown Player Nationality", player_birth_place="Unknown Player Birth Place",
        player_birth_country="Unknown Player Birth Country", player_position="Unknown Player Position",
        player_detailed_position="Unknown Player Position"),
        dict(player_name="Not Applicable Player", player_firstname="Not Applicable", player_lastname="Not Applicable",
             player_nationality="Not Applicable Player Nationality",
             player_birth_place="Not Applicable Player Birth Place",
             player_birth_country="Not Applicable Player Birth Country",
             player_position="Not Applicable Player Position",
             player_detailed_position="Not Applicable Player Position")),
    "dim_referee": _special("referee_sk", dict(
        referee_common_name="Unknown Referee", referee_firstname="Unknown", referee_lastname="Unknown",
        referee_display_name="Unknown Referee", referee_nationality="Unknown Referee Nationality"),
        dict(referee_common_name="Not Applicable Referee", referee_firstname="Not Applicable",
             referee_lastname="Not Applicable", referee_display_name="Not Applicable Referee",
             referee_nationality="Not Applicable Referee Nationality")),
    "dim_coach": _special("coach_sk", dict(
        coach_name="Unknown Coach", coach_display_name="Unknown Coach", coach_firstname="Unknown",
        coach_lastname="Unknown", coach_nationality="Unknown Coach Nationality"),
        dict(coach_name="Not Applicable Coach", coach_display_name="Not Applicable Coach",
             coach_firstname="Not Applicable", coach_lastname="Not Applicable",
             coach_nationality="Not Applicable Coach Nationality")),
    "dim_stadium": _special("stadium_sk", dict(
        stadium_name="Unknown Stadium", stadium_address="Unknown Stadium Address", stadium_city="Unknown Stadium City",
        stadium_country="Unknown Stadium Country", stadium_surface="Unknown Stadium Surface"),
        dict(stadium_name="Not Applicable Stadium", stadium_address="Not Applicable Stadium Address",
             stadium_city="Not Applicable Stadium City", stadium_country="Not Applicable Stadium Country",
             stadium_surface="Not Applicable Stadium Surface")),
    "dim_league": _special("league_sk", dict(
        league_name="Unknown League", league_type="Unknown League Type", league_country="Unknown League Country",
        league_country_code="UNK", league_short_code="UNK", league_sub_type="Unknown League Sub Type"),
        dict(league_name="Not Applicable League", league_type="Not Applicable League Type",
             league_country="Not Applicable League Country", league_country_code="N/A", league_short_code="N/A",
             league_sub_type="Not Applicable League Sub Type")),
    "dim_formation": _special("formation_sk", dict(formation="Unknown"), dict(formation="Not Applicable")),
    "dim_position": _special("position_sk", dict(
        position_name="Unknown", position_short_code="UNK", position_group="Unknown Position Group"),
        dict(position_name="Not Applicable", position_short_code="N/A",
             position_group="Not Applicable Position Group")),
}


def _merge(name: str, source: DataFrame, target: DataFrame | None, key: str, dense: bool = False) -> DataFrame:
    sk = next(iter(SENTINELS[name][0]))
    update = [c for c in source.columns if c != key]
    merged = merge_scd1(target, source, key, sk, update, dense)
    if name == "dim_formation" and target is not None:
        merged = merged.unionByName(target.filter(F.col(sk) < 0).select(*merged.columns))
    return with_sentinels(merged, sk, SENTINELS[name], keep_existing=name == "dim_formation")


def dim_date(spark: SparkSession, seasons: DataFrame, start: str = codes.CALENDAR_START,
             end: str = codes.CALENDAR_END) -> DataFrame:
    days = spark.sql(f"SELECT explode(sequence(DATE '{start}', DATE '{end}')) AS date")
    spans = seasons.select(season_tag(F.col("name")).alias("season"), "is_current",
                           F.col("starting_at").cast("date").alias("lo"), F.col("ending_at").cast("date").alias("hi"))
    tagged = tag_ranges(days, spans.filter("lo <= hi"), "date", "lo", "hi")
    d = F.col("date")
    iso_day = F.weekday(d) + 1
    return tagged.select(
        date_key(d).alias("date_sk"), "date", F.year(d).alias("year"),
        F.concat(F.lit("Q"), F.quarter(d).cast("string")).alias("quarter"), F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.weekofyear(d).alias("week_number"),
        iso_day.alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        F.when(iso_day >= 6, "Yes").otherwise("No").alias("is_weekend"), "season",
        F.coalesce("is_current", F.lit(False)).alias("is_current_season"))


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.col("id").cast("int")
    part = (F.when(hour.between(6, 11), "Morning").when(hour.between(12, 17), "Afternoon")
            .when(hour.between(18, 23), "Evening").otherwise("Night"))
    hours = spark.range(24).select(hour.alias("time_sk"), hour.alias("hour"), part.alias("period_of_day"))
    return hours.unionByName(values(spark, "time_sk int, hour int, period_of_day string", [
        (-1, None, "Unknown Period Of Day"), (-2, None, "Not Applicable Period Of Day")]))


def _static(spark: SparkSession, name: str, members: dict) -> DataFrame:
    return values(spark, f"{name}_sk int, {name} string", list(members.items()))


def dim_match_result(spark: SparkSession) -> DataFrame:
    return _static(spark, "match_result", codes.MATCH_RESULTS)


def dim_team_side(spark: SparkSession) -> DataFrame:
    return _static(spark, "team_side", codes.TEAM_SIDES)


def dim_appearance_type(spark: SparkSession) -> DataFrame:
    return _static(spark, "appearance_type", codes.APPEARANCE_TYPES)


def dim_team(teams: DataFrame, names: DataFrame, target: DataFrame | None = None) -> DataFrame:
    cols = ["name", "country_name", "founded", "image_path", "venue_name", "venue_city", "venue_capacity"]
    latest = latest_per_key(teams.filter("id IS NOT NULL").select("id", "last_played_at", "_season_id", "_ingested_at", *cols), ["id"],
                            ["last_played_at", "_season_id", "_ingested_at", "name"])
    source = overlay(
        latest.select(F.col("id").alias("team_id"), F.col("name").alias("team_name"),
                      F.col("country_name").alias("team_country"), F.col("founded").alias("team_founded_year"),
                      F.col("image_path").alias("team_logo"), F.col("venue_name").alias("team_venue_name"),
                      F.col("venue_city").alias("team_venue_city"),
                      F.col("venue_capacity").alias("team_venue_capacity")),
        names, "team_id",
        {"team_name": "display_name", "team_code": "team_code", "team_short_name": "team_short_name"})
    return _merge("dim_team", source, target, "team_id")


def dim_opponent_team(dim: DataFrame) -> DataFrame:
    """The team dimension under its second role; a renamed view, nothing is copied."""
    return dim.select(*[F.col(c).alias(f"opponent_{c}") for c in (
        "team_sk", "team_id", "team_name", "team_code", "team_short_name", "team_country", "team_founded_year",
        "team_logo")])


def regular_round_max(fixtures: DataFrame, stages: DataFrame) -> DataFrame:
    regular = stages.filter(F.col("name") == codes.REGULAR_STAGE).select(F.col("id").alias("stage_id"))
    return (fixtures.join(regular, "stage_id")
            .groupBy("season_id").agg(F.max(int_from_text(F.col("round_name"), "int")).alias("max_round"))
            .filter("max_round IS NOT NULL"))


def match_source(fixtures: DataFrame, stages: DataFrame, participants: DataFrame, scores: DataFrame,
                 names: DataFrame) -> DataFrame:
    """Attributes of dim_match, one row per fixture."""
    attrs = ["stage_id", "season_id", "round_name", "starting_at", "state_developer_name", "state_name"]
    at = lambda cond, col: F.when(cond, F.col(col))
    home, away = F.col("location") == "home", F.col("location") == "away"
    current = F.col("description") == "CURRENT"
    parts = [
        fixtures.select(F.col("id").alias("fixture_id"), *attrs, F.lit(1).alias("present")),
        participants.select("fixture_id", *[at(cond, c).alias(f"{side}_{c}") for side, cond in
                                            (("home", home), ("away", away))
                                            for c in ("team_id", "team_name", "team_short_code")]),
        scores.select("fixture_id", at(current & (F.col("side") == "home"), "goals").alias("goals_home"),
                      at(current & (F.col("side") == "away"), "goals").alias("goals_away"))]
    columns = [c for p in parts for c in p.columns if c != "fixture_id"]
    m = stack_by_key(parts, ["fixture_id"], {c: F.max(c) for c in columns}).filter("present = 1")
    m = (m.join(stages.select(F.col("id").alias("stage_id"), F.col("name").alias("match_round_type"),
                              "type_developer_name"), "stage_id", "left")
         # a row per season: joined as it is planned, all matches would be dealt by season to meet it
         .join(written(regular_round_max(fixtures, stages), "rounds"), "season_id", "left"))
    for side in ("home", "away"):
        m = m.join(names.select(F.col("team_id").alias(f"{side}_team_id"), F.col("display_name").alias(f"{side}_display"),
                                F.col("team_short_name").alias(f"{side}_short")), f"{side}_team_id", "left")
    number = int_from_text(F.col("round_name"), "int")
    shifted = (F.col("match_round_type") != codes.REGULAR_STAGE) & (number <= F.col("max_round"))
    m = m.withColumn("match_round_number", F.when(shifted, number + F.col("max_round")).otherwise(number))
    blank = F.lit("")
    label = lambda side, *cols: F.coalesce(*[F.col(f"{side}_{c}") for c in cols], blank)
    kind = F.lit(None).cast("string")
    for code, text in codes.MATCH_TYPES.items():
        kind = F.when(F.col("type_developer_name") == code, text).otherwise(kind)
    return m.select(
        F.col("fixture_id").alias("match_id"), "match_round_type", "match_round_number",
        F.concat("match_round_type", F.lit(" - "), F.col("match_round_number").cast("string")).alias("match_round_name"),
        kind.alias("match_type"),
        F.concat(label("home", "display", "team_name"), F.lit(" - "),
                 label("away", "display", "team_name")).alias("match_name"),
        F.concat(label("home", "short", "team_short_code", "team_name"), F.lit(" - "),
                 label("away", "short", "team_short_code", "team_name")).alias("match_short_name"),
        F.when(is_finished(F.col("state_developer_name")),
               F.concat(F.col("goals_home").cast("string"), F.lit(" - "), F.col("goals_away").cast("string")))
        .alias("match_result"),
        F.date_format(local_time(F.col("starting_at")), "HH:mm").alias("kick_off_time"),
        F.col("state_name").alias("match_status"))


def dim_match(fixtures: DataFrame, stages: DataFrame, participants: DataFrame, scores: DataFrame, names: DataFrame,
              target: DataFrame | None = None) -> DataFrame:
    return _merge("dim_match", match_source(fixtures, stages, participants, scores, names), target, "match_id")


PLAYER_COLUMNS = {
    "player_name": "display_name", "player_firstname": "firstname", "player_lastname": "lastname",
    "player_nationality": "nationality_name", "player_birth_date": "date_of_birth", "player_birth_place": "city_name",
    "player_birth_country": "country_name", "player_height": "height", "player_weight": "weight",
    "player_photo": "image_path", "player_position": "position_name",
    "player_detailed_position": "detailed_position_name"}


def dim_player(players: DataFrame, lineups: DataFrame, target: DataFrame | None = None) -> DataFrame:
    master = players.filter((F.col("id").isNotNull()) & (F.col("position_name") != "Coach")).select(
        F.col("id").alias("player_id"), *[F.col(s).alias(t) for t, s in PLAYER_COLUMNS.items()], "_ingested_at")
    listed = lineups.filter("player_id IS NOT NULL").select(
        "player_id", "player_name", F.col("position_name").alias("player_position"),
        F.col("detailed_position_name").alias("player_detailed_position"), "_ingested_at", "fixture_id")
    best = latest_per_key(master, ["player_id"], ["_ingested_at", "player_lastname"]).drop("_ingested_at")
    # only ids the master lacks are reduced; the small side of the anti join is the player list
    unlisted = listed.join(best.select("player_id"), "player_id", "left_anti")
    extra = latest_per_key(unlisted, ["player_id"], ["_ingested_at", "fixture_id", "player_position",
                                                     "player_detailed_position"]).drop("_ingested_at", "fixture_id")
    return _merge("dim_player", best.unionByName(extra, allowMissingColumns=True), target, "player_id")


def dim_referee(referees: DataFrame, match_referees: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """The referee list, and those that only matches name; both as the silver models give them."""
    names = ["common_name", "firstname", "lastname", "display_name", "image_path"]
    listed = referees.filter("id IS NOT NULL").select(F.col("id").alias("referee_id"), *[F.col(n).alias(f"referee_{n}") for n in names],
                                                      F.col("country_name").alias("referee_nationality"), "_ingested_at")
    master = latest_per_key(listed, ["referee_id"], ["_ingested_at", "referee_image_path"])
    seen = match_referees.select("referee_id", *[f"referee_{n}" for n in names], F.lit(None).cast("string").alias("referee_nationality"),
                                 "_ingested_at")
    seen = seen.filter("referee_id IS NOT NULL").join(master.select("referee_id"), "referee_id", "left_anti")
    extra = latest_per_key(seen, ["referee_id"], ["_ingested_at", "referee_image_path"])
    return _merge("dim_referee", master.unionByName(extra).drop("_ingested_at"), target, "referee_id")


def dim_coach(coaches: DataFrame, countries: DataFrame, target: DataFrame | None = None) -> DataFrame:
    cols = ["coach_id", "common_name", "display_name", "firstname", "lastname", "nationality_id", "image_path"]
    latest = latest_per_key(coaches.filter("coach_id IS NOT NULL").select(*cols, "_ingested_at", "fixture_id"),
                            ["coach_id"], ["_ingested_at", "fixture_id"])
    source = latest.join(countries.select(F.col("id").alias("nationality_id"), F.col("name").alias("coach_nationality")),
                         "nationality_id", "left")
    return _merge("dim_coach", source.select(
        "coach_id", F.col("common_name").alias("coach_name"), F.col("display_name").alias("coach_display_name"),
        F.col("firstname").alias("coach_firstname"), F.col("lastname").alias("coach_lastname"), "coach_nationality",
        F.col("image_path").alias("coach_image_path")), target, "coach_id")


def dim_stadium(venues: DataFrame, fixtures: DataFrame, target: DataFrame | None = None) -> DataFrame:
    master = latest_per_key(venues.filter("id IS NOT NULL").select(
        F.col("id").alias("stadium_id"), F.col("name").alias("stadium_name"), F.col("address").alias("stadium_address"),
        F.col("city_name").alias("stadium_city"), F.col("country_name").alias("stadium_country"),
        F.col("capacity").alias("stadium_capacity"), F.col("surface").alias("stadium_surface"),
        F.col("latitude").alias("stadium_latitude"), F.col("longitude").alias("stadium_longitude"),
        F.col("image_path").alias("stadium_image"), "_ingested_at"), ["stadium_id"],
        ["_ingested_at", "stadium_capacity"]).drop("_ingested_at")
    seen = fixtures.filter("venue_id IS NOT NULL AND venue_name IS NOT NULL").select(
        F.col("venue_id").alias("stadium_id"), F.col("venue_name").alias("stadium_name"),
        F.col("venue_city").alias("stadium_city"), F.col("venue_capacity").alias("stadium_capacity"),
        F.col("venue_surface").alias("stadium_surface")).distinct()
    return _merge("dim_stadium", with_fallback(master, seen, "stadium_id"), target, "stadium_id")


def dim_league(leagues: DataFrame, countries: DataFrame, target: DataFrame | None = None) -> DataFrame:
    country = countries.select(F.col("id").alias("country_id"), F.col("name").alias("league_country"),
                               F.col("iso2").alias("league_country_code"),
                               F.col("flag_image_path").alias("league_country_flag"))
    source = leagues.filter("id IS NOT NULL").join(country, "country_id", "left")
    return _merge("dim_league", source.select(
        F.col("id").alias("league_id"), F.col("name").alias("league_name"), F.col("type").alias("league_type"),
        F.col("image_path").alias("league_logo"), "league_country", "league_country_code", "league_country_flag",
        F.col("short_code").alias("league_short_code"), F.col("sub_type").alias("league_sub_type"),
        F.col("active").alias("league_is_active")), target, "league_id")


def dim_formation(formations: DataFrame, target: DataFrame | None = None) -> DataFrame:
    source = formations.filter("formation IS NOT NULL").select("formation").distinct()
    return _merge("dim_formation", source, target, "formation")


def dim_position(lineups: DataFrame, target: DataFrame | None = None) -> DataFrame:
    groups = dominant_value(lineups, "detailed_position_name", "position_name", "position_group")
    short = F.lit(None).cast("string")
    for name, code in codes.POSITION_SHORT_CODES.items():
        short = F.when(F.col("detailed_position_name") == name, code).otherwise(short)
    return _merge("dim_position", groups.select(
        F.col("detailed_position_name").alias("position_name"), short.alias("position_short_code"),
        "position_group"), target, "position_name")
