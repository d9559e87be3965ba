"""Gold facts: two rows per match, one row per player appearance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from ..functions.columns import int_from_double, is_finished, local_time
from ..operators.keys import latest_per_key, resolve_fks
from ..operators.shape import stack_by_key, two_sided
from ..sources.storage import upsert_partitions

SIDE_COLUMNS = ("team_id", "goals", "goals_ht", "goals_fixed", "corner_kicks", "ball_possession_pct", "red_cards",
                "yellow_cards", "coach_id", "formation")
MATCH_COLUMNS = ("league_id", "venue_id", "starting_at", "stage_id", "state", "referee_id")


def match_sheet(fixtures: DataFrame, stages: DataFrame, participants: DataFrame, scores: DataFrame,
                corrections: DataFrame, statistics: DataFrame, referees: DataFrame, coaches: DataFrame,
                formations: DataFrame) -> DataFrame:
    """One row per fixture: match attributes plus a struct for each side.

    Everything known per (fixture, team) or per fixture (team NULL) is stacked and folded by key, then the two sides of
    a fixture are folded into one row. That replaces a chain of eight joins on the same key; both folds combine inside
    the tasks first. A side keeps one coach and one formation, so the match x side grain always holds.
    """
    no_team = F.lit(None).cast("bigint").alias("team_id")
    described = lambda text: F.when(F.col("description") == text, F.col("goals"))
    stat = lambda name, cast: F.when(F.col("type_id") == _TEAM_CODE[name], cast(F.col("value"))).alias(name)
    decimal = lambda c: c.cast("decimal(5,2)")
    parts = [
        participants.select("fixture_id", "team_id", "location"),
        scores.select("fixture_id", "team_id", described("CURRENT").alias("goals"),
                      described("1ST_HALF").alias("goals_ht")),
        corrections.select("fixture_id", "team_id", F.col("goals_scored_corrected").cast("bigint").alias("goals_fixed")),
        statistics.select("fixture_id", "team_id", stat("corner_kicks", int_from_double),
                          stat("ball_possession_pct", decimal), stat("red_cards", int_from_double),
                          stat("yellow_cards", int_from_double)),
        coaches.select("fixture_id", "team_id", "coach_id"),
        formations.select("fixture_id", "team_id", "formation"),
        fixtures.select(F.col("id").alias("fixture_id"), no_team, "league_id", "venue_id", "starting_at", "stage_id",
                        F.col("state_developer_name").alias("state"), F.lit(1).alias("present")),
        referees.filter(F.col("type_id") == codes.MAIN_REFEREE_TYPE).select("fixture_id", no_team, "referee_id")]
    folded = stack_by_key(parts, ["fixture_id", "team_id"], {
        c: F.max(c) for c in ("location", *SIDE_COLUMNS[1:], *MATCH_COLUMNS, "present")})
    side = lambda where: F.max(F.when(F.col("location") == where, F.struct(*SIDE_COLUMNS)))
    whole = F.col("team_id").isNull()
    rows = folded.groupBy("fixture_id").agg(
        side("home").alias("home"), side("away").alias("away"),
        *[F.max(F.when(whole, F.col(c))).alias(c) for c in (*MATCH_COLUMNS, "present")])
    kinds = stages.select(F.col("id").alias("stage_id"), F.col("type_developer_name").alias("stage_type"))
    return (rows.filter("present = 1").drop("present").join(kinds, "stage_id", "left")
            .withColumn("is_finished", is_finished(F.col("state"))).drop("state"))


_TEAM_CODE = {name: code for code, name in codes.TEAM_STATS.items()}


def _lookups(dims: dict[str, DataFrame]) -> list[tuple]:
    return [
        (dims["dim_date"], "_day", "date", "date_sk", "date_sk"),
        (dims["dim_match"], "fixture_id", "match_id", "match_sk", "match_sk"),
        (dims["dim_team"], "team_id", "team_id", "team_sk", "team_sk"),
        (dims["dim_team"], "opponent_team_id", "team_id", "team_sk", "opponent_team_sk"),
        (dims["dim_league"], "league_id", "league_id", "league_sk", "league_sk"),
        (dims["dim_stadium"], "venue_id", "stadium_id", "stadium_sk", "stadium_sk"),
        (dims["dim_referee"], "referee_id", "referee_id", "referee_sk", "referee_sk"),
        (dims["dim_coach"], "coach_id", "coach_id", "coach_sk", "coach_sk"),
        (dims["dim_formation"], "formation", "formation", "formation_sk", "formation_sk")]


def _clock(ts: str = "starting_at") -> list[Column]:
    """Day from the UTC timestamp, hour key from the local one."""
    return [F.col(ts).cast("date").alias("_day"),
            F.coalesce(F.hour(local_time(F.col(ts))), F.lit(-1)).alias("time_sk")]


def outcome(own: Column, other: Column) -> Column:
    return F.when(own > other, 1).when(own == other, 2).otherwise(3)


TEAM_FACT_COLUMNS = (
    "date_sk", "time_sk", "team_sk", "opponent_team_sk", "league_sk", "stadium_sk", "referee_sk", "match_sk",
    "coach_sk", "formation_sk", "team_side_sk", "match_result_sk", "points_earned", "goals_scored", "goals_conceded",
    "goals_ht_scored", "goals_ht_conceded", "corner_kicks", "ball_possession_pct", "yellow_cards", "red_cards")


def fct_team_matches(sheet: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    wide = sheet.filter("home IS NOT NULL AND away IS NOT NULL").select(
        "fixture_id", "league_id", "venue_id", "starting_at", "stage_type", "referee_id", "is_finished",
        *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for s in ("home", "away") for c in SIDE_COLUMNS])
    # one row per match meets the dimension of matches, not one per side
    wide = resolve_fks(wide, [(dims["dim_match"], "fixture_id", "match_id", "match_sk", "match_sk")])
    own = lambda side, other: {**{c: f"{side}_{c}" for c in SIDE_COLUMNS}, "opponent_team_id": f"{other}_team_id",
                               **{f"opponent_{c}": f"{other}_{c}" for c in ("goals", "goals_ht", "goals_fixed")}}
    rows = two_sided(wide, ["match_sk", "league_id", "venue_id", "starting_at", "stage_type", "referee_id",
                            "is_finished"], own("home", "away"), own("away", "home"))
    done = F.col("is_finished")
    zero = F.lit(0)
    measure = lambda *c: F.when(done, F.coalesce(*c))
    rows = rows.select(
        "*", F.col("side_sk").alias("team_side_sk"),
        measure(F.col("goals_fixed"), F.col("goals"), zero).alias("goals_scored"),
        measure(F.col("opponent_goals_fixed"), F.col("opponent_goals"), zero).alias("goals_conceded"),
        measure(F.col("goals_ht"), zero).alias("goals_ht_scored"),
        measure(F.col("opponent_goals_ht"), zero).alias("goals_ht_conceded"),
        *[measure(F.col(c), zero).alias(f"_{c}") for c in ("corner_kicks", "yellow_cards", "red_cards")],
        F.when(done, F.col("ball_possession_pct")).alias("_ball_possession_pct"))
    rows = rows.drop("corner_kicks", "yellow_cards", "red_cards", "ball_possession_pct").withColumnsRenamed(
        {f"_{c}": c for c in ("corner_kicks", "yellow_cards", "red_cards", "ball_possession_pct")})
    result = F.when(done, outcome(F.col("goals_scored"), F.col("goals_conceded"))).otherwise(4)
    rows = rows.withColumn("match_result_sk", result)
    counts = done & (F.col("stage_type") == codes.GROUP_STAGE)
    points = F.when(F.col("match_result_sk") == 1, 3).when(F.col("match_result_sk") == 2, 1).otherwise(0)
    rows = rows.select("*", F.when(counts, points).alias("points_earned"), *_clock())
    return resolve_fks(rows, [x for x in _lookups(dims) if x[1] != "fixture_id"]).select(*TEAM_FACT_COLUMNS)


def month_of(date_sk: Column) -> Column:
    """Month of a date key, by which facts are stored; -1 without a date."""
    return F.when(date_sk > 0, F.floor(date_sk / 100)).otherwise(-1).cast("int")


def refresh_team_matches(path: str, sheet: DataFrame, dims: dict[str, DataFrame], as_of: str, days_back: int) -> None:
    """Rebuild the window from ``days_back`` days before ``as_of`` on in the stored team fact, which is partitioned by month.

    Only matches of the window are computed, and only months they are in, or were in before they moved, are rewritten.
    """
    recent = sheet.filter(F.col("starting_at").cast("date") >= F.date_sub(F.lit(as_of).cast("date"), days_back))
    batch = fct_team_matches(recent, dims).withColumn("month", month_of(F.col("date_sk")))
    upsert_partitions(sheet.sparkSession, path, batch, ["match_sk", "team_side_sk"], "month", moving=True)


#: What is known of an appearance besides its counted statistics.
LISTED = ("fixture_id", "player_id", "type_id", "team_id", "position_id", "detailed_position_name", "minutes_played")


def _shown(lineups: DataFrame, stats: DataFrame) -> DataFrame:
    """Line-up entries folded to one row per (fixture, player), next to its ``minutes`` and whatever else ``stats`` has."""
    entry = F.struct("type_id", "team_id", "position_id", "detailed_position_name")
    listed = lineups.filter("player_id IS NOT NULL AND team_id IS NOT NULL").groupBy("fixture_id", "player_id").agg(
        F.min(entry).alias("any_entry"),
        F.min(F.when(F.col("type_id") == codes.STARTER_TYPE, entry)).alias("starter_entry"))
    both = listed.join(stats, ["fixture_id", "player_id"], "left").selectExpr(
        "*", "coalesce(minutes, 0) AS minutes_played",
        "CASE WHEN coalesce(minutes, 0) > 0 THEN any_entry ELSE starter_entry END AS entry")
    return both.filter("entry IS NOT NULL").select("*", "entry.*")


_MINUTES = f"max(CASE WHEN type_id = {codes.MINUTES_STAT} THEN CAST(rint(value) AS INT) END) AS minutes"


def player_statistics(details: DataFrame) -> DataFrame:
    """The statistics of a player in a match as columns."""
    # numeric folds only: they run in a hash aggregate, and rows of one player mostly meet in one task beforehand. Counts are made
    # integers once, in their own row: done for each column of the result, the code for a row is too long to be compiled by the JVM
    counted = f"CASE WHEN type_id IN ({', '.join(map(str, codes.PLAYER_STATS))}) THEN CAST(rint(value) AS INT) END AS _n"
    return details.filter("player_id IS NOT NULL").selectExpr("fixture_id", "player_id", "type_id", "value", counted).groupBy("fixture_id", "player_id").agg(
        F.expr(_MINUTES), F.expr(f"max(CASE WHEN type_id = {codes.RATING_STAT} THEN value END)").alias("rating"),
        *[F.expr(f"max(CASE WHEN type_id = {code} THEN _n ELSE 0 END)").alias(name)
          for code, name in codes.PLAYER_STATS.items()])


_COUNTS = [f"coalesce({n}, 0) AS {n}" for n in codes.PLAYER_STATS.values()]


def appearances(lineups: DataFrame, details: DataFrame) -> DataFrame:
    """Line-up entries and statistics folded to one row per (fixture, player).

    Starters always count, others only with minutes. A player listed twice keeps the entry with the lowest type.
    """
    return _shown(lineups, player_statistics(details)).selectExpr(*LISTED, "rating", *_COUNTS)


def listed(lineups: DataFrame, details: DataFrame) -> DataFrame:
    """``appearances`` without the counted statistics, which are many times as large as the rest of a row."""
    minutes = details.filter(f"player_id IS NOT NULL AND type_id = {codes.MINUTES_STAT}").groupBy("fixture_id", "player_id").agg(F.expr(_MINUTES))
    return _shown(lineups, minutes).select(*LISTED)


def goals_against(events: DataFrame, sheet: DataFrame) -> DataFrame:
    """Goals per (fixture, conceding team, minute). Own goals count against the scorer's team."""
    goals = events.filter(F.col("type_developer_name").isin("GOAL", "OWNGOAL")
                          & F.col("team_id").isNotNull() & F.col("minute").isNotNull())
    sides = sheet.select("fixture_id", F.array("home.team_id", "away.team_id").alias("_teams"))
    others = F.filter(F.col("_teams"), lambda t: t.isNotNull() & (t != F.col("team_id")))
    against = F.when(F.col("type_developer_name") == "OWNGOAL", F.array("team_id")).otherwise(others)
    return (goals.join(sides, "fixture_id", "left")
            .select("fixture_id", F.explode(against).alias("team_id"),
                    (F.col("minute") + F.coalesce("extra_minute", F.lit(0))).alias("goal_minute"))
            .groupBy("fixture_id", "team_id", "goal_minute").agg(F.count("*").alias("n")))


def keeper_goals(players: DataFrame, events: DataFrame, sheet: DataFrame) -> DataFrame:
    """Goals conceded per goalkeeper.

    The only keeper of a team takes every goal; otherwise a goal belongs to the keeper on the pitch: starters from the
    start to their last minute, substitutes from the minute they came on. Goals are counted per minute beforehand, so a
    team carries at most one entry per minute and no row pairs are formed.
    """
    keepers = players.filter(F.col("position_id") == codes.KEEPER_POSITION).select(
        "fixture_id", "player_id", "team_id", "type_id", "minutes_played")
    crew = keepers.groupBy("fixture_id", "team_id").agg(F.count("*").alias("keepers"))
    conceded = goals_against(events, sheet).groupBy("fixture_id", "team_id").agg(
        F.sum("n").alias("all_goals"), F.collect_list(F.struct("goal_minute", "n")).alias("by_minute"))
    entered = (events.filter((F.col("type_developer_name") == "SUBSTITUTION") & F.col("player_id").isNotNull())
               .groupBy("fixture_id", "player_id").agg(F.min("minute").alias("minute_on")))
    rows = (keepers.join(crew, ["fixture_id", "team_id"]).join(conceded, ["fixture_id", "team_id"], "left")
            .join(entered, ["fixture_id", "player_id"], "left"))
    starter = F.col("type_id") == codes.STARTER_TYPE
    came_on = F.coalesce("minute_on", F.greatest(F.lit(0), 90 - F.col("minutes_played")))
    rows = rows.withColumn("_lo", F.when(starter, 0).otherwise(came_on)).withColumn(
        "_hi", F.when(starter, F.col("minutes_played")).otherwise(codes.SUB_LAST_MINUTE))
    inside = F.filter("by_minute", lambda g: (g["goal_minute"] > F.col("_lo")) & (g["goal_minute"] <= F.col("_hi")))
    split = F.aggregate(inside, F.lit(0).cast("bigint"), lambda acc, g: acc + g["n"])
    share = F.when(F.col("keepers") == 1, F.col("all_goals")).otherwise(split)
    return rows.select("fixture_id", "player_id", F.coalesce(share, F.lit(0)).alias("keeper_goals"))


PLAYER_FACT_KEYS = (
    "date_sk", "time_sk", "match_sk", "player_sk", "team_sk", "opponent_team_sk", "league_sk", "stadium_sk",
    "referee_sk", "coach_sk", "formation_sk", "position_sk", "team_side_sk", "match_result_sk", "appearance_type_sk")


def fct_player_appearances(sheet: DataFrame, shown: DataFrame, events: DataFrame, players: DataFrame,
                           dims: dict[str, DataFrame], statistics: DataFrame | None = None, dealt: bool = False) -> DataFrame:
    """``shown`` is the result of ``appearances``, or of ``listed`` if ``statistics`` has those of the players; it is read several
    times here, so callers store it first. ``dealt`` says that the statistics are folded where they have been dealt by match, as
    the other rows are here; else those go to the statistics, which are larger.

    The statistics come last: what is looked up by match and by player is looked up by rows that do not carry them.
    """
    pair = ["fixture_id", "player_id"]
    if statistics is None:
        statistics = shown.select(*pair, "rating", *codes.PLAYER_STATS.values())
    shown = shown.select(*LISTED)
    finished = sheet.filter("is_finished").select("fixture_id", "league_id", "venue_id", "starting_at", "referee_id",
                                                  "home", "away", *_clock())
    goals = keeper_goals(shown.join(finished.select("fixture_id"), "fixture_id", "left_semi"), events, sheet)
    detail = latest_per_key(players.filter("id IS NOT NULL").select(
        F.col("id").alias("player_id"), F.col("detailed_position_name").alias("_listed_position"), "_ingested_at"),
        ["player_id"], ["_ingested_at", "_listed_position"]).drop("_ingested_at")
    person = resolve_fks(shown.select(*pair).join(detail, "player_id", "left"),
                         [(dims["dim_player"], "player_id", "player_id", "player_sk", "player_sk")])
    rows = shown.join(finished, "fixture_id")
    # a team context exists only when both sides are known
    at_home = F.col("team_id") == F.col("home.team_id")
    at_away = F.col("team_id") == F.col("away.team_id")
    paired = F.col("home").isNotNull() & F.col("away").isNotNull()
    own = F.when(at_home, F.col("home")).when(at_away, F.col("away"))
    other = F.when(paired & at_home, F.col("away")).when(paired & at_away, F.col("home"))
    rows = rows.select("*", own.alias("own"), other.alias("other"))
    nil = F.lit(0).cast("bigint")
    rows = rows.select(
        "fixture_id", "player_id", "team_id", "league_id", "venue_id", "referee_id", "_day", "time_sk", "detailed_position_name",
        F.col("other.team_id").alias("opponent_team_id"), F.col("own.coach_id").alias("coach_id"),
        F.col("own.formation").alias("formation"), (F.col("position_id") == codes.KEEPER_POSITION).alias("_keeper"),
        F.when(paired & at_home, 1).when(paired & at_away, 2).otherwise(-1).alias("team_side_sk"),
        F.when(F.col("other").isNull(), -1).otherwise(
            outcome(F.coalesce("own.goals", nil), F.coalesce("other.goals", nil))).alias("match_result_sk"),
        F.when(F.col("type_id") == codes.STARTER_TYPE, 1).otherwise(2).alias("appearance_type_sk"), "minutes_played")
    rows = resolve_fks(rows, _lookups(dims)).join(goals, pair, "left").join(person, pair).withColumn(
        "position_label", F.coalesce("detailed_position_name", "_listed_position"))
    rows = resolve_fks(rows, [(dims["dim_position"], "position_label", "position_name", "position_sk", "position_sk")])
    keeper = F.col("_keeper")
    counted = (rows if dealt else rows.repartition(*pair)).join(statistics.selectExpr(*pair, "rating", *_COUNTS), pair, "left")
    counts = {n: F.coalesce(n, F.lit(0)) for n in codes.PLAYER_STATS.values()}
    counts = {n: F.when(keeper, c) if n in codes.KEEPER_STATS else c for n, c in counts.items()}
    counts["goals_conceded"] = F.when(keeper, F.coalesce("keeper_goals", nil))
    return counted.select(*PLAYER_FACT_KEYS, "minutes_played", *[c.alias(n) for n, c in counts.items()], "rating")
