"""Hand-made matches through dimensions and facts: states, corrections, keepers, fallbacks, stable keys."""

import pytest
from match_rows import rows
from pyspark.sql import functions as F

from matchlake.operators import quality
from matchlake.operators.literals import values
from matchlake.plans import checks, dims as D, facts, marts

# id, season, stage, round, state, kick-off, venue
FIXTURES = [
    (1, 1, 10, "1", "FT", "2024-07-01 23:30:00", 5), (2, 1, 10, "2", "AET", "2024-08-01 18:00:00", 77),
    (3, 1, 12, "1", "FT_PEN", "2024-12-01 12:00:00", None), (4, 1, 11, "1", "NS", "2025-03-01 12:00:00", 5),
    (5, 1, 11, "Final", "FT", "2024-11-01 12:00:00", 5), (6, 1, 10, "2", "FT", "2024-08-02 18:00:00", 5)]
SIDES = [(f, t, loc) for f in range(1, 7) for t, loc in ((21, "home"), (22 if f != 6 else 99, "away"))]
SCORES = [(1, 21, "home", "CURRENT", 2), (1, 22, "away", "CURRENT", 1), (1, 21, "home", "1ST_HALF", 3), (2, 21, "home", "CURRENT", 0),
          (2, 22, "away", "CURRENT", 0), (3, 21, "home", "CURRENT", 1), (3, 22, "away", "CURRENT", 0), (5, 21, "home", "CURRENT", 1),
          (5, 22, "away", "CURRENT", 1), (6, 21, "home", "CURRENT", 0), (6, 99, "away", "CURRENT", 4)]
# keeper 101 plays to 60, keeper 102 comes on; keeper 201 is alone
LINEUPS = [(1, 101, 21, 24, 11), (1, 102, 21, 24, 12), (1, 201, 22, 24, 11), (1, 103, 21, 27, 12), (1, 104, 21, 27, 12),
           (1, 201, 22, 24, 12), (1, 105, 55, 26, 11)]
MINUTES = [(1, 101, 119, 60.0), (1, 102, 119, 30.0), (1, 201, 119, 90.0), (1, 103, 119, 0.0), (1, 104, 119, 12.0), (1, 104, 52, 1.0),
           (1, 104, 118, 7.5)]
EVENTS = [(1, 22, 900, "GOAL", 50, None), (1, 22, 900, "GOAL", 90, 4), (1, 21, 104, "OWNGOAL", 70, None), (1, 21, 103, "GOAL", 5, None),
          (1, 21, 102, "SUBSTITUTION", 61, None), (1, None, 1, "GOAL", 7, None), (1, 22, 1, "GOAL", None, None)]


@pytest.fixture(scope="module")
def silver(spark):
    make = lambda ddl, data: spark.createDataFrame(data, ddl)
    s = {}
    s["fixtures"] = make("id bigint, season_id int, stage_id int, round_name string, state_developer_name string, t string, venue_id bigint",
                         FIXTURES).selectExpr(
        "*", "CAST(t AS TIMESTAMP_NTZ) AS starting_at", "CAST(t AS TIMESTAMP_NTZ) AS _ingested_at", "CAST(1 AS BIGINT) AS league_id",
        "CASE WHEN venue_id = 77 THEN 'Neutral' ELSE 'Home Park' END AS venue_name", "'c' AS venue_city", "'grass' AS venue_surface",
        "CAST(9 AS INT) AS venue_capacity", "CASE state_developer_name WHEN 'FT' THEN 'Full Time' WHEN 'AET' THEN 'After Extra Time' "
        "WHEN 'FT_PEN' THEN 'After Penalties' ELSE 'Not Started' END AS state_name")
    s["stages"] = make("id int, name string, type_developer_name string", [
        (10, "Regular Season", "GROUP_STAGE"), (11, "Cup", "KNOCK_OUT"), (12, "Championship Round", "GROUP_STAGE")])
    s["participants"] = make("fixture_id bigint, team_id bigint, location string", SIDES).selectExpr(
        "*", "concat('Club ', team_id) AS team_name", "concat('C', team_id) AS team_short_code")
    s["scores"] = make("fixture_id bigint, team_id bigint, side string, description string, goals bigint", SCORES)
    s["corrections"] = make("fixture_id bigint, team_id bigint, goals_scored_corrected int", [(1, 21, 5), (2, 21, 2), (2, 22, 1)])
    s["statistics"] = make("fixture_id bigint, team_id bigint, type_id int, value double", [
        (1, 21, 34, 2.5), (1, 22, 34, 3.5), (1, 21, 45, 55.0), (1, 22, 45, 40.0)])
    s["referees"] = make("fixture_id bigint, referee_id bigint, type_id int", [(1, 7, 6), (1, 8, 9)])
    s["coaches"] = make("fixture_id bigint, team_id bigint, coach_id bigint", [(1, 21, 3)])
    s["formations"] = make("fixture_id bigint, team_id bigint, formation string", [(1, 21, "4-4-2"), (1, 22, None)])
    s["lineups"] = make("fixture_id bigint, player_id bigint, team_id bigint, position_id bigint, type_id int", LINEUPS).selectExpr(
        "*", "concat('P', player_id) AS player_name", "'Keeper' AS position_name",
        "CASE WHEN position_id = 24 THEN 'Goalkeeper' END AS detailed_position_name", "TIMESTAMP_NTZ '2024-07-01 00:00:00' AS _ingested_at")
    s["details"] = make("fixture_id bigint, player_id bigint, type_id int, value double", MINUTES)
    s["events"] = make("fixture_id bigint, team_id bigint, player_id bigint, type_developer_name string, minute int, extra_minute int", EVENTS)
    s["players"] = make("id bigint, display_name string, position_name string, v int", [
        (101, "Old", "Goalkeeper", 0), (101, "New", "Goalkeeper", 1), (300, "Trainer", "Coach", 0)]).selectExpr(
        "*", "display_name AS firstname", "display_name AS lastname", "'N' AS nationality_name", "DATE '2000-01-01' AS date_of_birth",
        "'c' AS city_name", "'d' AS country_name", "1 AS height", "1 AS weight", "'i' AS image_path",
        "'Goalkeeper' AS detailed_position_name", "make_timestamp_ntz(2024, 1, 1 + v, 0, 0, 0) AS _ingested_at")
    s["teams"] = make("id bigint, name string, last_played_at string, _season_id int", [
        (21, "Older", "2020-01-01", 1), (21, "Newest", "2024-01-01", 2), (21, "Never", None, 3), (22, "Away", None, 4)]).selectExpr(
        "*", "make_timestamp_ntz(2024, 1, 1, 0, 0, 0) AS _ingested_at", "'c' AS country_name", "1900 AS founded", "'logo' AS image_path", "'v' AS venue_name", "'w' AS venue_city", "1 AS venue_capacity")
    s["names"] = make("team_id bigint, display_name string, team_code string, team_short_name string", [(22, "Curated", "CUR", "Cur")])
    s["seasons"] = spark.sql("SELECT 1 AS id, '2024/2025' AS name, DATE '2024-07-01' AS starting_at, DATE '2025-06-30' AS ending_at, true AS is_current")
    s["venues"] = make("id bigint, name string", [(5, "Home Park")]).selectExpr(
        "*", "'a' AS address", "'c' AS city_name", "'d' AS country_name", "10 AS capacity", "'grass' AS surface", "55.0D AS latitude",
        "9.0D AS longitude", "'i' AS image_path", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _ingested_at")
    return s


@pytest.fixture(scope="module")
def star(spark, silver):
    s = silver
    person = lambda df: df.selectExpr("*", "'n' AS common_name", "'f' AS firstname", "'l' AS lastname", "'d' AS display_name",
                                      "'i' AS image_path", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _ingested_at")
    countries = spark.sql("SELECT CAST(1 AS BIGINT) AS id, 'Land' AS name, 'LA' AS iso2, 'flag' AS flag_image_path")
    leagues = spark.sql("SELECT CAST(1 AS BIGINT) AS id, 'L' AS name, CAST(1 AS BIGINT) AS country_id, 't' AS type, 's' AS sub_type, "
                        "'l' AS short_code, 'i' AS image_path, true AS active")
    d = {
        "dim_date": D.dim_date(spark, s["seasons"]), "dim_time": D.dim_time(spark), "dim_team": D.dim_team(s["teams"], s["names"]),
        "dim_match": D.dim_match(s["fixtures"], s["stages"], s["participants"], s["scores"], s["names"]),
        "dim_player": D.dim_player(s["players"], s["lineups"]), "dim_stadium": D.dim_stadium(s["venues"], s["fixtures"]),
        "dim_referee": D.dim_referee(person(s["referees"].selectExpr("referee_id AS id")).withColumn("country_name", F.lit("x")).limit(0),
                                     s["referees"].selectExpr("*", "'n' AS referee_common_name", "'f' AS referee_firstname",
                                                              "'l' AS referee_lastname", "'d' AS referee_display_name",
                                                              "'i' AS referee_image_path", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS _ingested_at")),
        "dim_coach": D.dim_coach(person(s["coaches"]).withColumn("nationality_id", F.lit(1).cast("bigint")), countries),
        "dim_league": D.dim_league(leagues, countries), "dim_formation": D.dim_formation(s["formations"]),
        "dim_position": D.dim_position(s["lineups"]), "dim_match_result": D.dim_match_result(spark),
        "dim_team_side": D.dim_team_side(spark), "dim_appearance_type": D.dim_appearance_type(spark)}
    d = {k: v.cache() for k, v in d.items()}
    d["dim_opponent_team"] = D.dim_opponent_team(d["dim_team"])
    sheet = facts.match_sheet(*[s[k] for k in ("fixtures", "stages", "participants", "scores", "corrections", "statistics", "referees",
                                               "coaches", "formations")]).cache()
    shown = facts.appearances(s["lineups"], s["details"]).cache()
    d["sheet"], d["shown"] = sheet, shown
    d["team"] = facts.fct_team_matches(sheet, d).cache()
    d["player"] = facts.fct_player_appearances(sheet, shown, s["events"], s["players"], d).cache()
    return d


def of_match(star, match_id, *cols, fact="team"):
    m = star["dim_match"].filter(F.col("match_id") == match_id).select("match_sk")
    return rows(star[fact].join(m, "match_sk").select(*cols))


def test_results_points_and_corrections(star):
    cols = ("team_side_sk", "goals_scored", "goals_conceded", "match_result_sk", "points_earned")
    assert of_match(star, 1, *cols) == [(1, 5, 1, 1, 3), (2, 1, 5, 3, 0)]      # corrected on one side, seen by both
    assert of_match(star, 2, *cols) == [(1, 2, 1, 1, 3), (2, 1, 2, 3, 0)]      # corrected on both
    assert of_match(star, 5, *cols) == [(1, 1, 1, 2, None), (2, 1, 1, 2, None)]  # knock-out: no points
    assert of_match(star, 4, *cols) == [(1, None, None, 4, None), (2, None, None, 4, None)]


def test_utc_day_and_local_hour(star):
    assert of_match(star, 1, "date_sk", "time_sk") == [(20240701, 1)] * 2
    assert of_match(star, 3, "date_sk", "time_sk") == [(20241201, 13)] * 2
    kick = star["dim_match"].filter("match_id = 1").first()["kick_off_time"]
    assert kick == "01:30"


def test_statistics_round_half_even(star):
    assert of_match(star, 1, "team_side_sk", "corner_kicks", "yellow_cards") == [(1, 2, 0), (2, 4, 0)]


def test_round_numbers(star):
    got = {r.match_id: (r.match_round_number, r.match_result, r.match_type) for r in star["dim_match"].filter("match_sk > 0").collect()}
    assert got[3] == (3, "1 - 0", "Group Stage") and got[5][0] is None and got[4] == (3, None, "Knockout") and got[2][0] == 2


def test_keeper_goals(star, spark):
    got = {r.player_id: r.keeper_goals for r in facts.keeper_goals(
        star["shown"], spark.createDataFrame(EVENTS, "fixture_id bigint, team_id bigint, player_id bigint, type_developer_name string, "
                                                     "minute int, extra_minute int"), star["sheet"]).collect()}
    assert got == {101: 1, 102: 2, 201: 1}


def test_appearances(star):
    got = of_match(star, 1, "player_sk", "appearance_type_sk", "minutes_played", "team_side_sk", "match_result_sk", "rating", fact="player")
    assert len(got) == 5                      # the unused substitute is left out, the double entry counts once
    stranger = [r for r in got if r[3] == -1]
    assert len(stranger) == 1 and stranger[0][4] == -1
    names = {r.player_name for r in star["dim_player"].collect()}
    assert {"New", "P102"} <= names and "Trainer" not in names and "Old" not in names


def test_dimension_details(star):
    teams = {r.team_id: (r.team_name, r.team_code) for r in star["dim_team"].filter("team_sk > 0").collect()}
    assert teams == {21: ("Newest", None), 22: ("Curated", "CUR")}
    assert {r.stadium_name for r in star["dim_stadium"].filter("stadium_sk > 0").collect()} == {"Home Park", "Neutral"}
    assert {r.referee_id for r in star["dim_referee"].filter("referee_sk > 0").collect()} == {7, 8}
    assert star["dim_date"].count() == 7670


def test_mart(star):
    mart = marts.mart_match_facts(star["team"], star["player"], star)
    got = {(r.match_id, r.team_side): r for r in mart.collect()}
    assert (5, "Home") not in got                                      # no round number
    assert got[(6, "Away")].team_name == "Unknown Team"
    # matches 2 and 6 are both round 2: the team shows the same running total on both
    assert got[(2, "Home")].cumulative_points == got[(6, "Home")].cumulative_points == 6
    assert got[(1, "Home")].standings_type == "Championship Group"


def test_checks(star):
    assert rows(checks.points_off(star["team"])) == []
    assert len(rows(checks.halftime_above_fulltime(star["team"]))) == 0
    assert [r[1] for r in rows(checks.possession_off(star["team"]))] == [pytest.approx(95)]
    assert {r[0] for r in rows(checks.team_keys_resolved(star["team"]))} == {"team_sk", "opponent_team_sk", "stadium_sk"}
    assert rows(quality.sentinels_present({n: (star[n], sk) for n, sk in checks.SENTINEL_DIMS.items()})) == []
    without = star["dim_match"].filter("match_sk < 2")
    assert rows(checks.completed_without_rows(star["dim_match"], star["team"].filter("match_sk <> 2"))) == [(2, "Club 21 - Curated")]
    assert without.count() == 3


def test_second_load_keeps_keys(spark, silver, star):
    s = silver
    again = D.dim_team(s["teams"], s["names"], star["dim_team"])
    assert rows(again) == rows(star["dim_team"])
    more = s["teams"].unionByName(s["teams"].filter("id = 22").withColumn("id", F.lit(3).cast("bigint")))
    grown = {r.team_id: r.team_sk for r in D.dim_team(more, s["names"], star["dim_team"]).collect()}
    assert grown[21] == 1 and grown[22] == 2 and grown[3] == 3
    formations = values(spark, "formation string", [("3-5-2",), ("4-4-2",)])
    first = D.dim_formation(s["formations"])
    assert rows(D.dim_formation(formations, first)) == [(-1, "Unknown"), (-2, "Not Applicable"), (1, "4-4-2"), (2, "3-5-2")]
