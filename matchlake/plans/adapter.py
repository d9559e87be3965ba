"""The given star-schema tables seen as silver match tables.

orders become fixtures, order lines become line-ups, player statistics and match events, part becomes the player list,
supplier the teams, nation/region countries, venues, referees and leagues. The rules are plain integer arithmetic; those
kept in ``EXPR`` are valid in Spark SQL and in standard SQL.
"""

from __future__ import annotations

import copy

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import codes
from ..operators.literals import values

TEAMS = 12
UNKNOWN_TEAM = 99

EXPR = {
    "season_id": "year(o_orderdate) + 24",
    "home_no": "CASE WHEN month(o_orderdate) < 9 THEN o_custkey % 12 "
               "ELSE (o_custkey % 2) * 6 + CAST(floor(o_custkey / 2) AS BIGINT) % 6 END",
    "away_no": "CASE WHEN month(o_orderdate) < 9 THEN (o_custkey % 12 + 1 + o_orderkey % 11) % 12 "
               "ELSE (o_custkey % 2) * 6 + (CAST(floor(o_custkey / 2) AS BIGINT) % 6 + 1 + o_orderkey % 5) % 6 END",
    "stage_no": "CASE WHEN month(o_orderdate) < 9 THEN 1 WHEN month(o_orderdate) = 12 AND o_orderkey % 10 = 0 THEN 4 "
                "WHEN o_custkey % 2 = 0 THEN 2 ELSE 3 END",
    "state": "CASE WHEN o_orderstatus = 'F' THEN 'FT' WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 1 THEN 'AET' "
             "WHEN o_orderstatus = 'P' THEN 'FT_PEN' ELSE 'NS' END",
    "state_name": "CASE WHEN o_orderstatus = 'F' THEN 'Full Time' WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 1 "
                  "THEN 'After Extra Time' WHEN o_orderstatus = 'P' THEN 'After Penalties' ELSE 'Not Started' END",
    "venue_id": "CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 50 = 1 THEN 101 + o_orderkey % 3 "
                "ELSE home_no + 1 END",
    "home_goals": "(o_orderkey + o_custkey) % 5",
    "away_goals": "(o_custkey * 3 + CAST(floor(o_orderkey / 7) AS BIGINT)) % 4",
    # order lines
    "minutes": "CASE WHEN l_linenumber <= 4 THEN CASE WHEN l_quantity > 8 THEN 90 ELSE 40 + l_quantity * 5 END "
               "WHEN l_quantity > 20 THEN l_quantity - 10 ELSE 0 END",
    "rating": "CASE WHEN CAST(l_quantity AS BIGINT) % 6 = 0 THEN NULL "
              "ELSE 5 + ((l_partkey + l_linenumber) % 17) * 0.25 END",
    "event_type": "CASE WHEN CAST(l_quantity AS BIGINT) % 5 = 0 THEN 'GOAL' WHEN l_quantity = 7 THEN 'OWNGOAL' "
                  "WHEN l_linenumber >= 5 AND l_quantity > 20 THEN 'SUBSTITUTION' END",
    "event_minute": "(l_partkey * 7 + CAST(l_quantity AS BIGINT) * 3) % 96 + 1",
    "position_name": "CASE WHEN l_quantity = 1 THEN 'Midfielder' WHEN l_partkey % 4 = 0 THEN 'Goalkeeper' "
                     "WHEN l_partkey % 4 = 1 THEN 'Defender' WHEN l_partkey % 4 = 2 THEN 'Midfielder' "
                     "ELSE 'Attacker' END",
}

#: Columns of a match, in terms of its order.
MATCH = ("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "season_id", "home_no", "away_no", "stage_no", "home_team", "away_team",
         "venue_id", "starting_at")
FIXTURE = {
    "id": "o_orderkey", "league_id": "CAST(1 AS BIGINT)", "season_id": "season_id", "stage_id": "season_id * 10 + stage_no",
    "round_name": "CASE WHEN stage_no = 1 THEN CAST(o_orderkey % 22 + 1 AS STRING) WHEN stage_no < 4 THEN "
                  "CAST(o_orderkey % 10 + 1 AS STRING) WHEN o_orderkey % 3 = 0 THEN 'Final' "
                  "ELSE CAST(o_orderkey % 2 + 1 AS STRING) END",
    "venue_id": "venue_id",
    "venue_name": "CASE WHEN venue_id > 100 THEN concat('Neutral Ground ', CAST(venue_id AS STRING)) "
                  "WHEN venue_id IS NOT NULL THEN concat('Arena ', CAST(venue_id AS STRING)) END",
    "venue_city": "CASE WHEN venue_id IS NOT NULL THEN concat('City ', CAST(venue_id AS STRING)) END",
    "venue_surface": "CASE WHEN venue_id IS NOT NULL THEN 'grass' END", "venue_capacity": "CAST(venue_id * 100 AS INT)",
    "starting_at": "starting_at", "state_developer_name": EXPR["state"], "state_name": EXPR["state_name"]}
LINE_TEAM = "CASE WHEN l_linenumber % 2 = 1 THEN home_team ELSE away_team END"
# what is listed of a match, and of one of its sides
HAS_SCORES, HAS_REFEREES, HAS_COACH = "o_orderstatus <> 'O' AND o_orderkey % 211 <> 0", "o_orderkey % 89 <> 0", "(o_orderkey + side_no) % 9 <> 0"
HALF_GOALS = "CASE WHEN o_orderkey % 400 = 3 AND side_no = 0 THEN goals + 1 ELSE CAST(floor(goals / 2) AS BIGINT) END"
SCORES = f"array(named_struct('d', 'CURRENT', 'g', goals), named_struct('d', '1ST_HALF', 'g', {HALF_GOALS}))"
STATISTICS = ("array(named_struct('c', 34, 'v', CAST((o_orderkey + side_no * 3) % 12 AS DOUBLE) "
              "  + CASE WHEN o_orderkey % 250 = 9 THEN 0.5D ELSE 0.0D END), "
              "named_struct('c', 45, 'v', CASE WHEN o_orderkey % 13 = 0 THEN NULL "
              "  WHEN side_no = 0 THEN CAST(40 + o_orderkey % 21 AS DOUBLE) "
              "  ELSE CAST(60 - o_orderkey % 21 AS DOUBLE) + CASE WHEN o_orderkey % 300 = 5 THEN 5.0D ELSE 0.0D END END), "
              "named_struct('c', 83, 'v', CASE WHEN (o_custkey + side_no) % 17 = 0 THEN 1.0D ELSE 0.0D END), "
              "named_struct('c', 84, 'v', "
              "  CAST((CAST(floor(o_orderkey / 3) AS BIGINT) + side_no * 2) % 5 AS DOUBLE)))")
REFEREES = "array(named_struct('r', o_custkey % 20 + 1, 't', 6), named_struct('r', (o_custkey + 7) % 20 + 1, 't', 7))"
COACH = "(team_id * 10 + season_id % 3)"

# detailed position by (key % 4, floor(key / 4) % 3)
DETAILED = {
    0: ("Goalkeeper", "Goalkeeper", "Goalkeeper"),
    1: ("Centre Back", "Left Back", "Right Back"),
    2: ("Defensive Midfield", "Central Midfield", "Attacking Midfield"),
    3: ("Left Wing", "Right Wing", "Attacker"),
}
GROUPS = ("Goalkeeper", "Defender", "Midfielder", "Attacker")
FORMATIONS = ("4-3-3", "4-4-2", "3-5-2", "4-2-3-1", "3-4-3")
SURFACES = ("grass", "Artificial turf", "natural", "hybrid")


def detailed_case(key: str) -> str:
    whens = " ".join(f"WHEN {key} % 4 = {g} AND CAST(floor({key} / 4) AS BIGINT) % 3 = {i} THEN '{name}'"
                     for g, names in DETAILED.items() for i, name in enumerate(names))
    return f"CASE {whens} END"


def pick_case(index: str, options: tuple) -> str:
    return "CASE " + " ".join(f"WHEN {index} = {i} THEN '{v}'" for i, v in enumerate(options)) + " END"


def stat_rows() -> list[tuple[int, int, int]]:
    """(code, position in the list, modulus of the generated value) of every counted player statistic."""
    return [(code, i, (40 if code in (80, 116) else 2 + i % 7)) for i, code in enumerate(codes.PLAYER_STATS)]


def match_tables(sf_dir: str) -> list[str]:
    """The tables that matches and all that belongs to them are made of."""
    return [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("orders", "lineitem")]


FORMATION = f"CASE WHEN o_orderkey % 31 <> 0 THEN {pick_case('(o_orderkey + team_id) % 5', FORMATIONS)} END"


class Silver:
    """Lazy silver tables over ``sf_dir``. Every property is a plan, nothing runs here."""

    #: Which order lines are known, in terms of a line and the start of its match.
    known_line = "true"

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._tables[name]

    def by_match(self) -> Silver:
        """The same tables, orders dealt by their key as they are. What is folded by match is then made where it is folded: the rows
        of a match are many times as large as its order."""
        dealt = copy.copy(self)
        dealt._tables = {**self._tables, "orders": self.dealt(self.table("orders"), "o_orderkey")}
        return dealt

    def dealt(self, df: DataFrame, key: str) -> DataFrame:
        """Rows by key in a fixed number of partitions: many rows are made of each, and few bytes should not leave that to few tasks."""
        return df.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), key)

    # matches -----------------------------------------------------------------------------------------------------

    def _matches(self) -> DataFrame:
        orders = self.table("orders").filter("o_orderkey IS NOT NULL AND o_custkey IS NOT NULL")
        return (orders.selectExpr("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus",
                                  *[f"{EXPR[c]} AS {c}" for c in ("season_id", "home_no", "away_no", "stage_no")])
                .selectExpr("*", "home_no + 1 AS home_team",
                            f"CASE WHEN o_orderkey % 500 = 7 THEN {UNKNOWN_TEAM} ELSE away_no + 1 END AS away_team",
                            f"CAST({EXPR['venue_id']} AS BIGINT) AS venue_id",
                            "CAST(add_months(CAST(o_orderdate AS DATE), 288) AS TIMESTAMP_NTZ) "
                            "+ make_dt_interval(0, CAST(o_orderkey % 24 AS INT), CAST(o_orderkey % 4 AS INT) * 15, 0) "
                            "AS starting_at"))

    def fixtures(self) -> DataFrame:
        return self._matches().selectExpr(*[f"{expr} AS {name}" for name, expr in FIXTURE.items()], "starting_at AS _ingested_at")

    def _sides(self, home: list[str], away: list[str], where: str = "true") -> DataFrame:
        """Two rows per match; ``home``/``away`` hold the expressions of each side in the same order."""
        struct = lambda cols: "named_struct(" + ", ".join(
            f"'{c.rsplit(' AS ', 1)[1]}', {c.rsplit(' AS ', 1)[0]}" for c in cols) + ")"
        return (self._matches().filter(where)
                .selectExpr("o_orderkey AS fixture_id", "o_orderkey", "o_custkey", "season_id", "o_orderstatus",
                            "starting_at AS _ingested_at", f"explode(array({struct(home)}, {struct(away)})) AS s")
                .selectExpr("*", "s.*").drop("s"))

    def _teams_of(self, extra_home: list[str] = (), extra_away: list[str] = (), where: str = "true") -> DataFrame:
        return self._sides(["home_team AS team_id", "'home' AS location", "0 AS side_no", *extra_home],
                           ["away_team AS team_id", "'away' AS location", "1 AS side_no", *extra_away], where)

    def participants(self) -> DataFrame:
        return self._teams_of().selectExpr(
            "fixture_id", "team_id", "concat('Club ', CAST(team_id AS STRING)) AS team_name",
            "concat('C', CAST(team_id AS STRING)) AS team_short_code", "location", "_ingested_at")

    def scores(self) -> DataFrame:
        both = self._teams_of([f"{EXPR['home_goals']} AS goals"], [f"{EXPR['away_goals']} AS goals"],
                              HAS_SCORES)
        return both.selectExpr("fixture_id", "team_id", "location AS side", f"explode({SCORES}) AS x").selectExpr(
            "fixture_id", "team_id", "side", "x.d AS description", "x.g AS goals")

    def score_corrections(self) -> DataFrame:
        return self._teams_of(where="o_orderkey % 1000 = 1").filter(
            "side_no = 0 OR o_orderkey % 2000 = 1").selectExpr(
            "fixture_id", "team_id", "CASE WHEN side_no = 0 THEN 3 ELSE 0 END AS goals_scored_corrected")

    def statistics(self) -> DataFrame:
        return self._teams_of().selectExpr("fixture_id", "team_id", f"explode({STATISTICS}) AS x").selectExpr(
            "fixture_id", "team_id", "x.c AS type_id", "x.v AS value")

    def referee_calls(self) -> DataFrame:
        """Referees of matches under the ids that the feed gives them."""
        return self._matches().filter(HAS_REFEREES).selectExpr(
            "o_orderkey AS fixture_id", "starting_at AS _ingested_at", f"explode({REFEREES}) AS x"
        ).selectExpr("fixture_id", "_ingested_at", "x.r AS raw_id", "x.t AS type_id")

    def match_referees(self) -> DataFrame:
        raw = self.referee_calls().withColumnRenamed("raw_id", "referee_id")
        from ..operators.keys import canonical_id
        named = canonical_id(raw, self.referee_overrides(), "referee_id", "referee_id", "canonical_referee_id")
        return named.selectExpr(
            "fixture_id", "referee_id", "type_id", "concat('Referee ', CAST(referee_id AS STRING)) AS referee_common_name",
            "concat('First ', CAST(referee_id AS STRING)) AS referee_firstname",
            "concat('Last ', CAST(referee_id AS STRING)) AS referee_lastname",
            "concat('Ref. ', CAST(referee_id AS STRING)) AS referee_display_name",
            "concat('ref-', CAST(fixture_id AS STRING)) AS referee_image_path", "_ingested_at")

    def coaches(self) -> DataFrame:
        return self._teams_of().filter(HAS_COACH).selectExpr(
            "fixture_id", "team_id", f"{COACH} AS coach_id", "_ingested_at", "o_orderkey"
        ).selectExpr(
            "fixture_id", "team_id", "coach_id", "concat('Coach ', CAST(coach_id AS STRING)) AS common_name",
            "concat('Coach ', CAST(coach_id AS STRING), ' v', CAST(o_orderkey % 3 AS STRING)) AS display_name",
            "concat('First ', CAST(coach_id AS STRING)) AS firstname",
            "concat('Last ', CAST(coach_id AS STRING)) AS lastname", "coach_id % 25 AS nationality_id",
            "concat('coach-', CAST(fixture_id AS STRING)) AS image_path", "_ingested_at")

    def formations(self) -> DataFrame:
        return self._teams_of().selectExpr("fixture_id", "team_id", f"{FORMATION} AS formation", "location", "_ingested_at")

    # players -----------------------------------------------------------------------------------------------------

    def _lines(self) -> DataFrame:
        return self.table("lineitem").filter("l_orderkey IS NOT NULL")

    def _team_lines(self) -> DataFrame:
        teams = self._matches().select("o_orderkey", "home_team", "away_team", "starting_at")
        return (self._lines().join(teams, F.expr("l_orderkey = o_orderkey"))
                .selectExpr("*", f"{LINE_TEAM} AS team_id").filter(self.known_line))

    def lineups(self) -> DataFrame:
        return self._team_lines().selectExpr(
            "l_orderkey AS fixture_id", "l_partkey AS player_id", "team_id", "24 + l_partkey % 4 AS position_id",
            f"CASE WHEN l_linenumber <= 4 THEN {codes.STARTER_TYPE} ELSE 12 END AS type_id",
            "concat('Player ', CAST(l_partkey AS STRING)) AS player_name", f"{EXPR['position_name']} AS position_name",
            f"CASE WHEN l_partkey % 10 <> 3 THEN {detailed_case('l_partkey')} END AS detailed_position_name",
            "starting_at AS _ingested_at")

    #: What the values of the counted statistics of an order line have in common.
    STATISTIC_BASE = "(l_partkey * 3 + l_linenumber + CAST(l_quantity AS BIGINT))"

    @staticmethod
    def counted_value(base: str = STATISTIC_BASE) -> str:
        """Value of the counted statistic ``x`` (code, place, modulus) of an order line."""
        return f"CASE WHEN x.i = 0 AND l_orderkey % 700 = 11 THEN -1.0D ELSE CAST(({base} + x.i * 5) % x.m AS DOUBLE) END"

    @classmethod
    def statistic_value(cls) -> str:
        """Value of the statistic ``x`` (code, place, modulus) of an order line."""
        return (f"CASE WHEN x.c = {codes.MINUTES_STAT} THEN CAST({EXPR['minutes']} AS DOUBLE) "
                f"WHEN x.c = {codes.RATING_STAT} THEN CAST({EXPR['rating']} AS DOUBLE) ELSE {cls.counted_value()} END")

    @staticmethod
    def statistics_shown(*fixed: int) -> str:
        """The statistics (code, place, modulus) that an order line has: the ``fixed`` ones, and of the counted ones those of every
        fourth place. They are picked as one list, as most of a list that is looked through for each line would be thrown away."""
        listed = lambda rows: "CAST(array({}) AS array<struct<c: int, i: int, m: int>>)".format(", ".join(f"named_struct('c', {c}, 'i', {i}, 'm', {m})" for c, i, m in rows))
        always = [(code, -1, 1) for code in fixed]
        quarters = [listed([*always, *(row for row in stat_rows() if (row[1] + rest) % 4 == 0)]) for rest in range(4)]
        picked = " ".join(f"WHEN {rest} THEN {quarter}" for rest, quarter in enumerate(quarters))
        return f"CASE pmod(l_orderkey + l_partkey, 4) {picked} ELSE {listed(always)} END"

    def lineup_details(self) -> DataFrame:
        # dealt as order lines, which are a tenth of what is made of them, to where their statistics are folded
        lines = self.dealt(self._lines(), "l_orderkey")
        return (lines.selectExpr("*", f"explode({self.statistics_shown(codes.MINUTES_STAT, codes.RATING_STAT)}) AS x")
                .selectExpr("l_orderkey AS fixture_id", "l_partkey AS player_id", "x.c AS type_id", f"{self.statistic_value()} AS value"))

    def events(self) -> DataFrame:
        return self._team_lines().selectExpr(
            "l_orderkey AS fixture_id", "CASE WHEN l_orderkey % 307 <> 0 THEN team_id END AS team_id",
            "l_partkey AS player_id", f"{EXPR['event_type']} AS type_developer_name",
            f"least(90, {EXPR['event_minute']}) AS minute",
            f"CASE WHEN {EXPR['event_minute']} > 90 THEN {EXPR['event_minute']} - 90 END AS extra_minute"
        ).filter("type_developer_name IS NOT NULL")

    def players(self) -> DataFrame:
        return (self.table("part").filter("p_partkey % 20 <> 19")
                .selectExpr("*", "explode(array(0, 1)) AS v")
                .selectExpr(
                    "p_partkey AS id", "concat('Player ', CAST(p_partkey AS STRING)) AS display_name",
                    "p_name AS firstname", "concat(p_brand, ' v', CAST(v AS STRING)) AS lastname",
                    "concat('NATION_', CAST(p_partkey % 25 AS STRING)) AS nationality_name",
                    "date_add(DATE '1980-01-01', CAST(p_partkey % 7000 AS INT)) AS date_of_birth",
                    "concat('City ', CAST(p_partkey % 40 AS STRING)) AS city_name",
                    "concat('NATION_', CAST(p_partkey % 24 AS STRING)) AS country_name",
                    "160 + p_size AS height", "60 + p_size + v AS weight",
                    "concat('photo-', CAST(p_partkey AS STRING)) AS image_path",
                    "CASE WHEN p_partkey % 97 = 5 THEN 'Coach' WHEN p_partkey % 41 = 7 THEN NULL ELSE "
                    + pick_case("p_partkey % 4", GROUPS) + " END AS position_name",
                    f"{detailed_case('p_partkey')} AS detailed_position_name",
                    "make_timestamp_ntz(2024, 1, 1 + v, 0, 0, 0) AS _ingested_at"))

    # reference data ----------------------------------------------------------------------------------------------

    def referee_overrides(self) -> DataFrame:
        return values(self.spark, "referee_id bigint, canonical_referee_id bigint", [(16, 1), (17, 1)])

    def team_names(self) -> DataFrame:
        return values(self.spark, "team_id bigint, display_name string, team_code string, team_short_name string",
                      [(i, f"{name} FC", name[:3].upper(), name) for i, name in enumerate(CURATED, 1)])

    def seasons(self) -> DataFrame:
        years = self.table("orders").selectExpr(f"{EXPR['season_id']} AS id").filter("id IS NOT NULL").distinct()
        newest = years.agg(F.max("id").alias("top")).scalar()
        return years.select(
            "id", F.expr("concat(CAST(id AS STRING), '/', CAST(id + 1 AS STRING)) AS name"),
            F.expr("make_date(id, 1, 1) AS starting_at"), F.expr("make_date(id, 12, 31) AS ending_at"),
            (F.col("id") == newest).alias("is_current"))

    def stages(self) -> DataFrame:
        years = self.table("orders").selectExpr(f"{EXPR['season_id']} AS season_id").filter(
            "season_id IS NOT NULL").distinct()
        kinds = ", ".join(f"named_struct('n', {i}, 'name', '{n}', 't', '{t}')" for i, n, t in STAGES)
        return years.selectExpr("season_id", f"explode(array({kinds})) AS x").selectExpr(
            "season_id * 10 + x.n AS id", "season_id", "x.name AS name", "x.t AS type_developer_name")

    def teams(self) -> DataFrame:
        nation = self.table("nation")
        return (self.table("supplier").join(nation, F.expr("s_nationkey = n_nationkey"), "left").selectExpr(
            "s_suppkey % 12 + 1 AS id", "CAST(s_suppkey AS INT) AS _season_id",
            "make_timestamp_ntz(2024, 1, 1, 0, 0, 0) AS _ingested_at", "s_name AS name", "n_name AS country_name",
            "CAST(1900 + s_suppkey % 100 AS INT) AS founded",
            "concat('logo-', CAST(s_suppkey % 12 + 1 AS STRING)) AS image_path",
            "concat('Arena ', CAST(s_suppkey % 12 + 1 AS STRING)) AS venue_name",
            "concat('City ', CAST(s_suppkey % 30 AS STRING)) AS venue_city",
            "CAST(1000 + s_suppkey % 500 AS INT) AS venue_capacity",
            "CASE WHEN s_suppkey % 7 <> 0 THEN date_add(DATE '2020-01-01', CAST(s_suppkey % 3000 AS INT)) END "
            "AS last_played_at"))

    def countries(self) -> DataFrame:
        return self.table("nation").selectExpr(
            "CAST(n_nationkey AS BIGINT) AS id", "n_name AS name", "concat('N', CAST(n_nationkey AS STRING)) AS iso2",
            "concat('flag-', CAST(n_nationkey AS STRING)) AS flag_image_path")

    def leagues(self) -> DataFrame:
        return self.table("region").selectExpr(
            "CAST(r_regionkey + 1 AS BIGINT) AS id", "concat('League ', r_name) AS name",
            "CAST(r_regionkey AS BIGINT) AS country_id", "'league' AS type", "'domestic' AS sub_type",
            "left(r_name, 3) AS short_code", "concat('logo-', r_name) AS image_path", "r_regionkey % 2 = 0 AS active")

    def referees(self) -> DataFrame:
        return self.listed_referees().join(self.referee_overrides().selectExpr("referee_id AS id"), "id", "left_anti")

    def listed_referees(self) -> DataFrame:
        """The referee list with the ids that stand for somebody else."""
        rows = self.table("nation").filter("n_nationkey < 17").selectExpr(
            "CAST(n_nationkey + 1 AS BIGINT) AS id", "n_name AS country_name")
        return rows.selectExpr(
            "id", "concat('Referee ', CAST(id AS STRING)) AS common_name",
            "concat('First ', CAST(id AS STRING)) AS firstname", "concat('Last ', CAST(id AS STRING)) AS lastname",
            "concat('Ref. ', CAST(id AS STRING)) AS display_name", "country_name",
            "explode(array(0, 1)) AS v").selectExpr(
            "id", "common_name", "firstname", "lastname", "display_name", "country_name",
            "concat('img-', CAST(id AS STRING), '-', CAST(v AS STRING)) AS image_path",
            "make_timestamp_ntz(2024, 1, 1 + v, 0, 0, 0) AS _ingested_at")

    def venues(self) -> DataFrame:
        region = self.table("region")
        return (self.table("nation").filter("n_nationkey < 11").join(region, F.expr("n_regionkey = r_regionkey"), "left")
                .selectExpr("CAST(n_nationkey + 1 AS BIGINT) AS id", "r_name", "explode(array(0, 1)) AS v")
                .selectExpr(
                    "id", "concat('Arena ', CAST(id AS STRING)) AS name",
                    "concat('Street ', CAST(id AS STRING)) AS address",
                    "concat('City ', CAST(id AS STRING)) AS city_name", "r_name AS country_name",
                    pick_case("id % 4", SURFACES) + " AS surface", "CAST(5000 + id * 1000 + v AS INT) AS capacity",
                    "54.75D + 0.25D * id AS latitude", "8.0D + 0.5D * id AS longitude",
                    "concat('venue-', CAST(id AS STRING)) AS image_path",
                    "make_timestamp_ntz(2024, 1, 1 + v, 0, 0, 0) AS _ingested_at"))


STAGES = ((1, "Regular Season", "GROUP_STAGE"), (2, "Championship Round", "GROUP_STAGE"),
          (3, "Relegation Round", "GROUP_STAGE"), (4, "Play-offs", "KNOCK_OUT"))
# invented display names for teams 1..10; teams 11 and 12 stay uncurated
CURATED = ("Amber", "Birch", "Cobalt", "Delta", "Ember", "Falcon", "Granite", "Harbor", "Indigo", "Juniper")
