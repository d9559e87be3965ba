"""Patterns of the older feed: deeper nesting, positions in arrays, text-labelled statistics, id backfill."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import codes
from ..functions.columns import recent_date_key
from ..operators.flatten import Model, flatten, wrap_arrays
from ..operators.keys import latest_per_key
from ..operators.shape import eav_pivot

ODDS = "array<struct<bookmakers: array<struct<id: bigint, name: string, bets: array<struct<id: bigint, name: string, values: array<struct<value: string, odd: string>>>>>>>>"
PLAYERS = "array<struct<team: struct<id: bigint, name: string>, players: array<struct<player: struct<id: bigint, name: string>, statistics: array<struct<games: struct<minutes: string, rating: string>, goals: struct<total: string>>>>>>>"
GROUPS = "array<struct<league: struct<id: bigint, standings: array<array<struct<rank: bigint, team: struct<id: bigint>, points: bigint>>>>>>"
LINEUPS = "array<struct<team: struct<id: bigint>, formation: string, startXI: array<struct<player: struct<id: bigint, pos: string>>>, substitutes: array<struct<player: struct<id: bigint, pos: string>>>>>"
LEADERS = "array<struct<player: struct<id: bigint, name: string>, statistics: array<struct<goals: bigint, assists: bigint>>>>"
TEAM_STATS = "array<struct<team: struct<id: bigint>, statistics: array<struct<type: string, value: string>>>>"


def _parsed(docs: DataFrame, shape: str) -> DataFrame:
    return docs.withColumn("doc", F.from_json("raw_json", shape)).drop("raw_json")


def odds(docs: DataFrame) -> DataFrame:
    """Document, bookmaker, bet, value: four levels, each exploded in a pipeline without materialising the product."""
    return (_parsed(docs, ODDS).select("fixture_id", F.explode("doc").alias("w"))
            .select("fixture_id", F.explode("w.bookmakers").alias("m"))
            .select("fixture_id", F.col("m.id").alias("bookmaker_id"), F.col("m.name").alias("bookmaker_name"),
                    F.explode("m.bets").alias("b"))
            .select("fixture_id", "bookmaker_id", "bookmaker_name", F.col("b.id").alias("bet_id"),
                    F.col("b.name").alias("bet_name"), F.inline("b.values"))
            .withColumnRenamed("value", "bet_value"))


def player_statistics(docs: DataFrame) -> DataFrame:
    return (_parsed(docs, PLAYERS).select("fixture_id", F.explode("doc").alias("t"))
            .select("fixture_id", F.col("t.team.id").alias("team_id"), F.explode("t.players").alias("p"))
            .select("fixture_id", "team_id", F.col("p.player.id").alias("player_id"), F.explode("p.statistics").alias("s"))
            .select("fixture_id", "team_id", "player_id", F.col("s.games.minutes").try_cast("int").alias("minutes_played"),
                    F.col("s.games.rating").alias("rating"), F.col("s.goals.total").try_cast("int").alias("goals")))


def standings(docs: DataFrame) -> DataFrame:
    """Groups are arrays inside an array."""
    rows = _parsed(docs, GROUPS).select("season", F.explode("doc").alias("d"))
    return rows.select("season", F.explode(F.flatten("d.league.standings")).alias("s")).select(
        "season", F.col("s.rank").alias("rank"), F.col("s.team.id").alias("team_id"), F.col("s.points").alias("points"))


def rounds(docs: DataFrame) -> DataFrame:
    return _parsed(docs, "array<string>").select("season", F.explode("doc").alias("round_name"))


def last_statistics(docs: DataFrame) -> DataFrame:
    """Only the last statistics block of each player counts."""
    s = (_parsed(docs, LEADERS).select("season", F.explode("doc").alias("e"))
         .select("season", F.col("e.player.id").alias("player_id"), F.posexplode("e.statistics").alias("pos", "s"))
         .select("season", "player_id", "pos", F.col("s.goals").alias("goals"), F.col("s.assists").alias("assists")))
    return latest_per_key(s, ["season", "player_id"], ["pos", "goals", "assists"])


def lineups(docs: DataFrame) -> DataFrame:
    """Starters and substitutes come in two arrays; a flag tells them apart."""
    teams = _parsed(docs, LINEUPS).select("fixture_id", F.explode("doc").alias("t"))
    tag = lambda c, flag: F.transform(F.coalesce(F.col(c), F.array()), lambda p: F.struct(
        p["player"]["id"].alias("player_id"), p["player"]["pos"].alias("player_position"), F.lit(flag).alias("is_starter")))
    return teams.select("fixture_id", F.col("t.team.id").alias("team_id"), F.col("t.formation").alias("formation"),
                        F.inline(F.concat(tag("t.startXI", True), tag("t.substitutes", False)))).filter(
        "player_id IS NOT NULL")


# label -> (column, type, default). Fixed values.
LABELS = {
    "Shots on Goal": ("shots_on_goal", "int", None), "Shots off Goal": ("shots_off_goal", "int", None),
    "Total Shots": ("total_shots", "int", None), "Blocked Shots": ("blocked_shots", "int", None),
    "Shots insidebox": ("shots_insidebox", "int", None), "Shots outsidebox": ("shots_outsidebox", "int", None),
    "Fouls": ("fouls", "int", None), "Corner Kicks": ("corner_kicks", "int", None), "Offsides": ("offsides", "int", 0),
    "Ball Possession": ("ball_possession_pct", "decimal(5,2)", None), "Yellow Cards": ("yellow_cards", "int", 0),
    "Red Cards": ("red_cards", "int", 0), "Goalkeeper Saves": ("goalkeeper_saves", "int", 0),
    "Total passes": ("total_passes", "int", None), "Passes accurate": ("passes_accurate", "int", None),
    "Passes %": ("passes_pct", "decimal(5,2)", None), "expected_goals": ("expected_goals", "decimal(6,3)", None)}


def team_statistics(docs: DataFrame) -> DataFrame:
    """Statistics addressed by text label; percent signs are stripped before the cast."""
    rows = (_parsed(docs, TEAM_STATS).select("fixture_id", F.explode("doc").alias("t"))
            .select("fixture_id", F.col("t.team.id").alias("team_id"), F.inline("t.statistics"))
            .select("fixture_id", "team_id", "type", F.replace("value", F.lit("%"), F.lit("")).alias("clean")))
    columns = []
    for label, (name, kind, default) in LABELS.items():
        best = F.max(F.when(F.col("type") == label, F.col("clean").try_cast(kind)))
        columns.append((best if default is None else F.coalesce(best, F.lit(default))).alias(name))
    return rows.groupBy("fixture_id", "team_id").agg(*columns)


def backfill_id(df: DataFrame, by_name: DataFrame, by_owner: DataFrame, own: str, name: str, owner: str, out: str) -> DataFrame:
    """First known of: the row's own id, the id found by name, the default id of the owner."""
    n = by_name.select(F.col(name).alias("_n"), F.col("id").alias("_by_name"))
    o = by_owner.select(F.col(owner).alias("_o"), F.col("id").alias("_by_owner"))
    return (df.join(n, F.col(name) == F.col("_n"), "left").join(o, F.col(owner) == F.col("_o"), "left")
            .withColumn(out, F.coalesce(own, "_by_name", "_by_owner")).drop("_n", "_by_name", "_o", "_by_owner"))


def canonical_name(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """Cut at the first comma, trim, and map aliases through a (alias, canonical) relation."""
    cleaned = df.withColumn(column, F.trim(F.split_part(F.col(column), F.lit(","), F.lit(1))))
    seed = names.select(F.col("alias").alias("_a"), F.col("canonical").alias("_c"))
    return cleaned.join(seed, F.col(column) == F.col("_a"), "left").withColumn(
        column, F.coalesce("_c", column)).drop("_a", "_c")


def derived_rounds(team_matches: DataFrame) -> DataFrame:
    """Round number of a match: the smaller of its two teams' running match numbers.

    A team's matches are counted per day, the days are summed up (at most a calendar of them), and only the matches of
    one day are put in order.
    """
    team = ["season", "team_id"]
    rows = team_matches.withColumn("_day", F.to_date("kick_off"))
    days = rows.groupBy(*team, "_day").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*team).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = days.select(*team, "_day", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy(*team, "_day").orderBy("kick_off", "fixture_id"))
    numbered = rows.withColumn("_in", inside).join(offsets, [*team, "_day"])
    return numbered.groupBy("fixture_id").agg(F.min(F.col("_before") + F.col("_in")).cast("int").alias("round_number"))


def result_code(status: Column, own: Column, other: Column) -> Column:
    done = status.isin(*codes.LEGACY_FINISHED)
    return (F.when(done & (own > other), 1).when(done & (own == other), 2).when(done & (own < other), 3)
            .when(status.isin(*codes.LEGACY_LIVE), 4).when(status.isin(*codes.LEGACY_VOID), -2).otherwise(-1))


def load_filter(season: int | None, season_col: Column, date_sk: Column, as_of: str | None = None, back: int = 5,
                forward: int = 28) -> Column:
    """One season when given, else a window around ``as_of``."""
    return season_col == season if season is not None else recent_date_key(date_sk, back, as_of, forward)


def accurate_from_percent(total: Column, percent: Column) -> Column:
    """Count recovered from a percentage."""
    count = F.round(total * percent.try_cast("decimal(18,3)") / 100).cast("int")
    return F.when(F.coalesce(total, F.lit(0)) == 0, 0).otherwise(count)


def drop_parents(parents: DataFrame, details: Mapping[str, DataFrame], key: str, gone: Column) -> dict[str, DataFrame]:
    """Delete the parent rows of a scope and every detail row that belongs to them."""
    ids = parents.filter(gone).select(key).distinct()
    keep = lambda df: df.join(ids, key, "left_anti")
    return {"parents": keep(parents), **{name: keep(df) for name, df in details.items()}}


# One-level tables of the older feed. Every document is a bare array; it is keyed by season and league, or by fixture.
# Field names, paths and types are fixed values of that feed.
_SEASON = "season=@season:int league_id=@league_id:int"
_PERSON = ("player_id=player.id:int player_name=player.name:string firstname=player.firstname:string "
           "lastname=player.lastname:string age=player.age:int birth_date=player.birth.date:string "
           "birth_place=player.birth.place:string birth_country=player.birth.country:string "
           "nationality=player.nationality:string height=player.height:string weight=player.weight:string "
           "injured=player.injured:boolean photo=player.photo:string")
_SEASON_STATS = (
    "team_id=team.id:int team_name=team.name:string team_logo=team.logo:string appearances=games.appearences:int "
    "lineups=games.lineups:int minutes=games.minutes:int shirt_number=games.number:int position=games.position:string "
    "rating=games.rating:string captain=games.captain:boolean sub_in=substitutes.in:int sub_out=substitutes.out:int "
    "sub_bench=substitutes.bench:int shots_total=shots.total:int shots_on=shots.on:int goals=goals.total:int "
    "goals_conceded=goals.conceded:int assists=goals.assists:int saves=goals.saves:int passes_total=passes.total:int "
    "passes_key=passes.key:int passes_accuracy=passes.accuracy:string tackles_total=tackles.total:int "
    "tackles_blocks=tackles.blocks:int interceptions=tackles.interceptions:int duels_total=duels.total:int "
    "duels_won=duels.won:int dribbles_attempts=dribbles.attempts:int dribbles_success=dribbles.success:int "
    "dribbles_past=dribbles.past:int fouls_drawn=fouls.drawn:int fouls_committed=fouls.committed:int "
    "yellow_cards=cards.yellow:int yellowred_cards=cards.yellowred:int red_cards=cards.red:int "
    "penalty_won=penalty.won:int penalty_committed=penalty.committed:int penalty_scored=penalty.scored:int "
    "penalty_missed=penalty.missed:int penalty_saved=penalty.saved:int")
MODELS = {
    "events": Model("fixture_events", ("fixture_id",), (
        "time_elapsed=time.elapsed:int time_extra=time.extra:int team_id=team.id:int team_name=team.name:string "
        "team_logo=team.logo:string player_id=player.id:int player_name=player.name:string assist_player_id=assist.id:int "
        "assist_player_name=assist.name:string event_type=type:string event_detail=detail:string comments:string"),
        "fixture_id=@fixture_id:bigint", ("items",)),
    "predictions": Model("fixture_predictions", ("fixture_id",), (
        "predicted_winner_id=predictions.winner.id:int predicted_winner_name=predictions.winner.name:string "
        "predicted_winner_comment=predictions.winner.comment:string win_or_draw=predictions.win_or_draw:boolean "
        "under_over=predictions.under_over:string predicted_goals_home=predictions.goals.home:string "
        "predicted_goals_away=predictions.goals.away:string advice=predictions.advice:string "
        "pct_home=predictions.percent.home:string pct_draw=predictions.percent.draw:string "
        "pct_away=predictions.percent.away:string comparison:string h2h:string"), "fixture_id=@fixture_id:bigint", ("items",)),
    "injuries": Model("injuries", ("season", "league_id", "player_id", "fixture_id"), (
        "player_id=player.id:int player_name=player.name:string player_photo=player.photo:string injury_type=player.type:string "
        "injury_reason=player.reason:string team_id=team.id:int team_name=team.name:string team_logo=team.logo:string "
        "fixture_id=fixture.id:int fixture_timezone=fixture.timezone:string fixture_date=fixture.date:timestamp "
        "fixture_timestamp=fixture.timestamp:bigint league_id_json=league.id:int season_json=league.season:int "
        "league_name=league.name:string league_country=league.country:string league_logo=league.logo:string "
        "league_flag=league.flag:string"), _SEASON, ("items",)),
    "leagues": Model("leagues", ("league_id",), (
        "league_id=league.id:int league_name=league.name:string league_type=league.type:string league_logo=league.logo:string "
        "country_name=country.name:string country_code=country.code:string country_flag=country.flag:string seasons:string"),
        explode=("items",)),
    "teams": Model("teams", ("season", "league_id", "team_id"), (
        "team_id=team.id:int team_name=team.name:string team_code=team.code:string team_country=team.country:string "
        "team_founded=team.founded:int team_national=team.national:boolean team_logo=team.logo:string venue_id=venue.id:int "
        "venue_name=venue.name:string venue_address=venue.address:string venue_city=venue.city:string "
        "venue_capacity=venue.capacity:int venue_surface=venue.surface:string venue_image=venue.image:string"), _SEASON, ("items",)),
    "venues": Model("venues", ("venue_id",), (
        "venue_id=id:int venue_name=name:string address:string city:string country:string capacity:int surface:string "
        "image:string"), "league_id=@league_id:int", ("items",)),
    "players": Model("players", ("season", "league_id", "player_id"), _SEASON_STATS, _SEASON, ("items", "statistics"),
                     middle=_PERSON),
}


# Deeper tables of the older feed: an array of teams with players with statistics, tables in groups inside an array, the four
# leaderboards, and line-ups in two arrays. Field names, paths and types are fixed values of that feed.
_TEAM = "team_id=team.id:int team_name=team.name:string team_logo=team.logo:string"
MATCH_PLAYER = (
    "minutes_played=games.minutes:int shirt_number=games.number:int position=games.position:string rating=games.rating:string "
    "captain=games.captain:boolean substitute=games.substitute:boolean offsides:int shots_total=shots.total:int shots_on=shots.on:int "
    "goals=goals.total:int goals_conceded=goals.conceded:int assists=goals.assists:int saves=goals.saves:int "
    "passes_total=passes.total:int passes_key=passes.key:int passes_accuracy=passes.accuracy:string tackles_total=tackles.total:int "
    "tackles_blocks=tackles.blocks:int interceptions=tackles.interceptions:int duels_total=duels.total:int duels_won=duels.won:int "
    "dribbles_attempts=dribbles.attempts:int dribbles_success=dribbles.success:int dribbles_past=dribbles.past:int "
    "fouls_drawn=fouls.drawn:int fouls_committed=fouls.committed:int yellow_cards=cards.yellow:int red_cards=cards.red:int "
    "penalty_won=penalty.won:int penalty_committed=penalty.committed:int penalty_scored=penalty.scored:int "
    "penalty_missed=penalty.missed:int penalty_saved=penalty.saved:int")
TABLE_LEAGUE = "league_id_json=league.id:int league_name=league.name:string season_json=league.season:int"
TABLE_ROW = (
    "rank:int " + _TEAM + " points:int goal_diff=goalsDiff:int standing_group=group:string form:string status:string description:string "
    + " ".join(f"{out}played={side}.played:int {out}wins={side}.win:int {out}draws={side}.draw:int {out}losses={side}.lose:int "
               f"{out}goals_for={side}.goals.for:int {out}goals_against={side}.goals.against:int"
               for side, out in (("all", ""), ("home", "home_"), ("away", "away_")))
    + " updated_at=update:timestamp")
MATCH = "kick_off=fixture.date:timestamp league_id=league.id:int season=league.season:int"
LINEUP_TEAM = (_TEAM + " formation:string coach_id=coach.id:int coach_name=coach.name:string coach_photo=coach.photo:string")
LINEUP_PLAYER = ("player_id=player.id:int player_name=player.name:string player_number=player.number:int player_position=player.pos:string "
                 "player_grid=player.grid:string")
LEADERBOARDS = ("topscorers", "topassists", "topyellowcards", "topredcards")


def fields(text: str) -> list[tuple[str, str, str]]:
    """(column, path, type) of a field list."""
    out = []
    for part in text.split():
        name, kind = part.rsplit(":", 1)
        column, _, path = name.partition("=")
        out.append((column, path or column, kind))
    return out


def shape(text: str, **arrays: str) -> str:
    """Struct type of the objects that hold these fields, and further arrays by path."""
    tree: dict = {}
    for path, kind in [*((p, k) for _, p, k in fields(text)), *((p.replace("__", "."), t) for p, t in arrays.items())]:
        *above, leaf = path.split(".")
        node = tree
        for a in above:
            node = node.setdefault(a, {})
        node[leaf] = "string" if kind == "timestamp" else kind
    render = lambda node: "struct<" + ", ".join(f"`{n}`: {render(v) if isinstance(v, dict) else v}" for n, v in node.items()) + ">"
    return render(tree)


def picked(text: str, base: str) -> list[Column]:
    """The fields of an object as typed columns."""
    return [F.col(f"{base}." + ".".join(f"`{p}`" for p in path.split("."))).cast("timestamp_ntz" if kind == "timestamp" else kind).alias(column)
            for column, path, kind in fields(text)]


def names(text: str) -> list[str]:
    return [column for column, _, _ in fields(text)]


def match_attributes(docs: DataFrame) -> DataFrame:
    """Kick-off, league and season of each match document, which the detail tables of a match carry along."""
    return docs.select("fixture_id", F.from_json("raw_json", shape(MATCH)).alias("m")).select("fixture_id", *picked(MATCH, "m"))


def match_player_statistics(docs: DataFrame, matches: DataFrame) -> DataFrame:
    """All statistics of a player in a match, with the match's attributes."""
    person = "player_id=player.id:int player_name=player.name:string player_photo=player.photo:string"
    players = shape(person, statistics=f"array<{shape(MATCH_PLAYER)}>")
    return (docs.select("fixture_id", "_ingested_at", F.explode(F.from_json("raw_json", f"array<{shape(_TEAM, players=f'array<{players}>')}>")).alias("t"))
            .select("fixture_id", "_ingested_at", *picked(_TEAM, "t"), F.explode("t.players").alias("p"))
            .select("fixture_id", "_ingested_at", *names(_TEAM), *picked(person, "p"), F.explode("p.statistics").alias("s"))
            .select("fixture_id", "_ingested_at", *names(_TEAM), *names(person), *picked(MATCH_PLAYER, "s"))
            .join(match_attributes(matches), "fixture_id"))


def league_table(docs: DataFrame) -> DataFrame:
    """All rows of all groups of a season's table."""
    kind = f"array<{shape(TABLE_LEAGUE, league__standings=f'array<array<{shape(TABLE_ROW)}>>')}>"
    return (docs.select("season", "league_id", "_ingested_at", F.explode(F.from_json("raw_json", kind)).alias("d"))
            .select("season", "league_id", "_ingested_at", *picked(TABLE_LEAGUE, "d"), F.explode(F.flatten("d.league.standings")).alias("s"))
            .select("season", "league_id", "_ingested_at", *names(TABLE_LEAGUE), *picked(TABLE_ROW, "s")))


def leaderboard(docs: DataFrame) -> DataFrame:
    """A leaderboard: each player of a season and league once, with the last of the statistics blocks."""
    kind = f"array<{shape(_PERSON, statistics=f'array<{shape(_SEASON_STATS)}>')}>"
    rows = docs.select("season", "league_id", "_ingested_at", F.posexplode(F.from_json("raw_json", kind)).alias("pos", "e"))
    last = rows.where("size(e.statistics) > 0").select(
        "season", "league_id", "_ingested_at", "pos", F.size("e.statistics").alias("blocks"), *picked(_PERSON, "e"),
        F.element_at("e.statistics", -1).alias("s"))
    flat = last.select("season", "league_id", "_ingested_at", "pos", "blocks", *names(_PERSON), *picked(_SEASON_STATS, "s"))
    return latest_per_key(flat, ["season", "league_id", "player_id"], ["blocks", "_ingested_at", "pos"]).drop("pos", "blocks")


def match_lineups(docs: DataFrame, matches: DataFrame) -> DataFrame:
    """Starters and substitutes of both teams, with team, coach and match; substitutes have no place in the grid."""
    person = f"array<{shape(LINEUP_PLAYER)}>"
    teams = docs.select("fixture_id", "_ingested_at", F.explode(F.from_json(
        "raw_json", f"array<{shape(LINEUP_TEAM, startXI=person, substitutes=person)}>")).alias("t"))
    tag = lambda column, starter: F.transform(F.coalesce(F.col(column), F.array()), lambda p: F.struct(p.alias("p"), F.lit(starter).alias("is_starter")))
    rows = teams.select("fixture_id", "_ingested_at", *picked(LINEUP_TEAM, "t"), F.inline(F.concat(tag("t.startXI", True), tag("t.substitutes", False))))
    flat = rows.select("fixture_id", "_ingested_at", *names(LINEUP_TEAM), *picked(LINEUP_PLAYER, "p"), "is_starter").where("player_id IS NOT NULL")
    return flat.withColumn("player_grid", F.when(F.col("is_starter"), F.col("player_grid"))).join(match_attributes(matches), "fixture_id")


def build(name: str, docs: DataFrame) -> DataFrame:
    return flatten(wrap_arrays(docs), MODELS[name])
