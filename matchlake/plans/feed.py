"""The given star-schema tables as landed documents: what a feed would deliver for the matches of ``adapter``.

One JSON document per match with all that belongs to it, one per team, player, referee, ground, country, league, season and
stage. Names inside the documents are fixed values of the feed.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import codes
from .adapter import (COACH, EXPR, FIXTURE, FORMATION, HAS_COACH, HAS_REFEREES, HAS_SCORES, LINE_TEAM, MATCH, REFEREES, SCORES, STATISTICS,
                      Silver, detailed_case)

#: What documents hold of an order line stems from these columns, and from what is made of them once.
LINE = ("l_partkey", "l_linenumber", "l_quantity")
MADE = {"line_id": "(l_orderkey * 10 + l_linenumber)", "base": Silver.STATISTIC_BASE}
TIME = "yyyy-MM-dd HH:mm:ss"


def _struct(**fields: str) -> str:
    """A named_struct expression; a double underscore in a name begins a nested object."""
    tree: dict = {}
    for name, expr in fields.items():
        *outer, leaf = name.split("__")
        node = tree
        for step in outer:
            node = node.setdefault(step, {})
        node[leaf] = expr
    render = lambda node: "named_struct(" + ", ".join(
        f"'{n}', {render(v) if isinstance(v, dict) else v}" for n, v in node.items()) + ")"
    return render(tree)


def _inside(expr: str, owner: str, names: Sequence[str]) -> str:
    """An expression over columns as one over the fields of ``owner``; quoted names and fields of others stay."""
    return re.sub(rf"(?<![\w.'])({'|'.join(names)})(?![\w'])", rf"{owner}.\1", expr)


def _body(df: DataFrame, key: str, **fields: str) -> DataFrame:
    return df.selectExpr(f"CAST({key} AS BIGINT) AS id", f"to_json({_struct(**fields)}) AS raw_json",
                         *[c for c in ("_season_id", "_ingested_at") if c in df.columns])


class Feed:
    """``documents(kind)`` is the lazy relation of landed documents of a kind, in the envelope of ``landing``."""

    KINDS = ("fixtures", "teams", "players", "referees", "venues", "core_countries", "league", "seasons", "stages")

    def __init__(self, tables: Silver):
        self.tables = tables

    def documents(self, kind: str) -> DataFrame:
        docs = getattr(self, f"_{kind}")()
        none = lambda name, type_: F.lit(None).cast(type_).alias(name)
        known: dict[str, Column] = {c: F.col(c) for c in docs.columns}
        return docs.select("id", "raw_json", known.get("_season_id", none("_season_id", "int")).cast("int").alias("_season_id"),
                           known.get("_fixture_date", none("_fixture_date", "date")),
                           known.get("_ingested_at", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'").alias("_ingested_at")))

    # matches -----------------------------------------------------------------------------------------------------

    @staticmethod
    def _dealt(df: DataFrame, key: str) -> DataFrame:
        """Rows by key in a fixed number of partitions: documents take long to make, and neither a source of one file nor few
        bytes should leave that to one task."""
        return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)

    def _line_lists(self) -> tuple[str, str]:
        """A line-up entry with its statistics, and an event; both stem from an order line."""
        line, detail = "line_id", lambda code, value: _struct(id=f"(line_id * 1000 + {code})", player_id="l_partkey", team_id="team_id",
                                                              lineup_id="line_id", type_id=code, data__value=value)
        fixed = [detail(str(code), f"CAST({EXPR[name]} AS DOUBLE)") for code, name in ((codes.MINUTES_STAT, "minutes"), (codes.RATING_STAT, "rating"))]
        details = (f"concat(array({', '.join(fixed)}), "
                   f"transform({self.tables.statistics_shown()}, x -> {detail('x.c', self.tables.counted_value('base'))}))")
        entry = _struct(id=line, player_id="l_partkey", team_id="team_id", position_id="24 + l_partkey % 4",
                        type_id=f"CASE WHEN l_linenumber <= 4 THEN {codes.STARTER_TYPE} ELSE 12 END",
                        player_name="concat('Player ', CAST(l_partkey AS STRING))", position__name=EXPR["position_name"],
                        detailedposition__name=f"CASE WHEN l_partkey % 10 <> 3 THEN {detailed_case('l_partkey')} END", details=details)
        event = _struct(id=line, participant_id="CASE WHEN l_orderkey % 307 <> 0 THEN team_id END", player_id="l_partkey",
                        minute=f"least(90, {EXPR['event_minute']})",
                        extra_minute=f"CASE WHEN {EXPR['event_minute']} > 90 THEN {EXPR['event_minute']} - 90 END",
                        type__developer_name=EXPR["event_type"])
        return entry, event

    def _fixtures(self) -> DataFrame:
        """Orders and order lines are dealt by match and folded as they are, once. What a document holds of them, which is many
        times as large, is made after that, in the row of its match."""
        t = self.tables
        matches = t._matches().selectExpr("o_orderkey AS fixture_id", f"{_struct(**{c: c for c in MATCH})} AS m")
        lines = t._lines().selectExpr("l_orderkey AS fixture_id", f"{_struct(**{c: c for c in LINE})} AS l")
        both = self._dealt(matches.unionByName(lines, allowMissingColumns=True), "fixture_id")
        folded = both.groupBy("fixture_id").agg(F.collect_list("m").alias("matches"), F.collect_list("l").alias("lines")).filter("size(matches) > 0")
        of_match = lambda expr: _inside(expr, "m", MATCH)
        each = lambda expr: f"transform(matches, m -> {of_match(expr)})"
        # of the sides of a match, and of what a side lists
        sides = "array({})".format(", ".join(
            _struct(team_id=f"{side}_team", location=f"'{side}'", side_no=str(i), goals=EXPR[f"{side}_goals"]) for i, side in enumerate(("home", "away"))))
        of_side = lambda expr: _inside(expr, "s", ("team_id", "location", "side_no", "goals"))
        by_side = lambda entry, where="true": f"transform(filter({sides}, s -> {of_side(where)}), s -> {of_side(entry)})"
        all_sides = lambda listed: f"flatten({by_side(listed)})"
        fixture = {c: FIXTURE[c] for c in ("league_id", "season_id", "stage_id", "venue_id")}
        fixture["starting_at"] = f"date_format(starting_at, '{TIME}')"
        fixture |= {f"{a}__{b}": FIXTURE[f"{a}_{b}"] for a, b in (
            ("venue", "name"), ("venue", "city"), ("venue", "surface"), ("venue", "capacity"), ("state", "name"), ("state", "developer_name"))}
        fixture = {{"venue__city": "venue__city_name"}.get(c, c): expr for c, expr in fixture.items()}
        score = _struct(id="o_orderkey * 4 + CASE location WHEN 'home' THEN 0 ELSE 2 END + CASE x.d WHEN 'CURRENT' THEN 0 ELSE 1 END",
                        participant_id="team_id", description="x.d", score__goals="x.g", score__participant="location")
        statistic = _struct(id="o_orderkey * 1000 + team_id * 100 + x.c", type_id="x.c", participant_id="team_id", data__value="x.v")
        n = "CAST(CASE WHEN x.r IN (16, 17) THEN 1 ELSE x.r END AS STRING)"
        referee = _struct(id="o_orderkey * 10 + x.t", referee_id="x.r", type_id="x.t", referee__common_name=f"concat('Referee ', {n})",
                          referee__firstname=f"concat('First ', {n})", referee__lastname=f"concat('Last ', {n})",
                          referee__display_name=f"concat('Ref. ', {n})", referee__image_path="concat('ref-', CAST(o_orderkey AS STRING))")
        named = lambda name: f"concat('{name} ', CAST({COACH} AS STRING))"
        coach = _struct(id=COACH, common_name=named("Coach"), display_name=f"concat({named('Coach')}, ' v', CAST(o_orderkey % 3 AS STRING))",
                        firstname=named("First"), lastname=named("Last"), nationality_id=f"{COACH} % 25",
                        image_path="concat('coach-', CAST(o_orderkey AS STRING))", meta__participant_id="team_id")
        lists = {
            "participants": by_side(_struct(id="team_id", name="concat('Club ', CAST(team_id AS STRING))",
                                            short_code="concat('C', CAST(team_id AS STRING))", meta__location="location")),
            "scores": f"CASE WHEN {HAS_SCORES} THEN {all_sides(f'transform({SCORES}, x -> {score})')} ELSE array() END",
            "statistics": all_sides(f"transform({STATISTICS}, x -> {statistic})"),
            "referees": f"CASE WHEN {HAS_REFEREES} THEN transform({REFEREES}, x -> {referee}) ELSE array() END",
            "coaches": by_side(coach, HAS_COACH),
            "formations": by_side(_struct(id="o_orderkey * 100 + team_id", participant_id="team_id", formation=FORMATION, location="location"))}
        # lines with the team that they are of in a match
        of_line = lambda expr: _inside(expr, "l", (*LINE, *MADE, "team_id"))
        known = f"filter(lines, l -> {of_match(of_line(t.known_line))})"
        teamed = f"flatten(transform(matches, m -> transform({known}, l -> {of_match(of_line(_struct(**{c: c for c in LINE}, **MADE, team_id=LINE_TEAM)))})))"
        entry, event = (of_line(expr) for expr in self._line_lists())
        lists_of_lines = {"lineups": f"transform(teamed, l -> {entry})",
                          "events": f"transform(filter(teamed, l -> {of_line(EXPR['event_type'])} IS NOT NULL), l -> {event})"}
        made = folded.selectExpr("fixture_id", "fixture_id AS l_orderkey", "matches", f"{teamed} AS teamed").selectExpr(
            "fixture_id AS id", f"array_max({each(_struct(**fixture, round__name=FIXTURE['round_name']))}) AS fixture",
            f"array_max({each('season_id')}) AS _season_id", f"array_max({each('starting_at')}) AS starting_at",
            *[f"flatten({each(listed)}) AS {name}" for name, listed in lists.items()],
            *[f"{listed} AS {name}" for name, listed in lists_of_lines.items()])
        return made.select("id", F.to_json(F.struct("fixture.*", *lists, *lists_of_lines)).alias("raw_json"), "_season_id",
                           F.col("starting_at").cast("date").alias("_fixture_date"), F.col("starting_at").alias("_ingested_at"))

    # reference data ----------------------------------------------------------------------------------------------

    def _teams(self) -> DataFrame:
        return _body(self.tables.teams(), "id", name="name", founded="founded", image_path="image_path",
                     last_played_at=f"date_format(last_played_at, '{TIME}')", country__name="country_name", venue__name="venue_name",
                     venue__city_name="venue_city", venue__capacity="venue_capacity")

    def _players(self) -> DataFrame:
        return _body(self.tables.players(), "id", display_name="display_name", firstname="firstname", lastname="lastname",
                     date_of_birth="CAST(date_of_birth AS STRING)", height="height", weight="weight", image_path="image_path",
                     nationality__name="nationality_name", city__name="city_name", country__name="country_name", position__name="position_name",
                     detailedposition__name="detailed_position_name")

    def _referees(self) -> DataFrame:
        return _body(self.tables.listed_referees(), "id", common_name="common_name", firstname="firstname", lastname="lastname",
                     display_name="display_name", image_path="image_path", country__name="country_name")

    def _venues(self) -> DataFrame:
        return _body(self.tables.venues(), "id", name="name", address="address", city_name="city_name", surface="surface", capacity="capacity",
                     latitude="latitude", longitude="longitude", image_path="image_path", country__name="country_name")

    def _core_countries(self) -> DataFrame:
        return _body(self.tables.countries(), "id", name="name", iso2="iso2", image_path="flag_image_path")

    def _league(self) -> DataFrame:
        return _body(self.tables.leagues(), "id", name="name", country_id="country_id", type="type", sub_type="sub_type",
                     short_code="short_code", image_path="image_path", active="active")

    def _seasons(self) -> DataFrame:
        return _body(self.tables.seasons(), "id", name="name", starting_at="CAST(starting_at AS STRING)",
                     ending_at="CAST(ending_at AS STRING)", is_current="is_current")

    def _stages(self) -> DataFrame:
        return _body(self.tables.stages(), "id", season_id="season_id", name="name", type__developer_name="type_developer_name")
