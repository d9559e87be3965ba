"""Data-quality checks DQ-01 ... DQ-19 and archived patterns AR-01 ... AR-16."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q, shape
from ..plans import checks, legacy
from ..plans.warehouse import DIMS, warehouse
from ..sources import landing
from .document_queries import documents
from .operator_queries import count_by, table
from .registry import query, register


def gold(fn, *names):
    return lambda spark, sf: fn(*[warehouse(spark, sf).get(n) for n in names])


TEAM, PLAYER = "fct_team_matches", "fct_player_appearances"

register("dq01_not_null", gold(lambda f: Q.not_null(f, "points_earned", checks.PLAYED_SK).select("match_sk", "team_side_sk"), TEAM),
         "SELECT match_sk, team_side_sk FROM g_teamfact WHERE match_result_sk IN (1, 2, 3) AND points_earned IS NULL")
register("dq02_unique", lambda spark, sf: Q.unique(table(spark, sf, "lineitem"), "l_partkey", "l_quantity > 40"),
         "SELECT l_partkey, count(*) AS row_count FROM lineitem WHERE l_quantity > 40 GROUP BY l_partkey HAVING count(*) > 1")
register("dq03_accepted_values", lambda spark, sf: Q.accepted_values(table(spark, sf, "events"), "event_type", ["click", "view"]),
         "SELECT event_type, count(*) AS row_count FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY event_type")
register("dq04_unique_combination", lambda spark, sf: Q.unique(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"]),
         "SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1")
register("dq05_two_rows_per_match", gold(lambda f: Q.rows_per_key(f, "match_sk", 2, "match_sk > 0"), TEAM),
         "SELECT match_sk, count(*) AS row_count FROM g_teamfact WHERE match_sk > 0 GROUP BY match_sk HAVING count(*) <> 2")
register("dq05_two_lines_per_order", lambda spark, sf: Q.rows_per_key(table(spark, sf, "lineitem"), "l_orderkey", 2),
         "SELECT l_orderkey, count(*) AS row_count FROM lineitem GROUP BY l_orderkey HAVING count(*) <> 2")
register("dq06_completed_have_rows", gold(lambda m, f: checks.completed_without_rows(m, f.filter("goals_scored > 0")), "dim_match", TEAM), """
SELECT match_sk, match_name FROM g_match WHERE match_sk > 0 AND match_status IN ('Full Time', 'After Extra Time', 'After Penalties')
  AND match_sk NOT IN (SELECT match_sk FROM g_teamfact WHERE match_sk > 0 AND goals_scored > 0)""")
register("dq07_sentinels", lambda spark, sf: Q.sentinels_present({
    **{n: (warehouse(spark, sf).get(n), sk) for n, sk in checks.SENTINEL_DIMS.items()},
    "dim_date": (warehouse(spark, sf).get("dim_date"), "date_sk")}),
    "SELECT 'dim_date' AS dim_name, e AS expected_sk FROM (VALUES (-1), (-2)) t(e) WHERE e NOT IN (SELECT date_sk FROM g_date)")
register("dq08_team_keys", gold(checks.team_keys_resolved, TEAM), " UNION ALL ".join(
    f"SELECT '{k}' AS fk, match_sk FROM g_teamfact WHERE match_result_sk IN (1, 2, 3) AND {k} = -1"
    for k in ("team_sk", "opponent_team_sk", "match_sk", "stadium_sk")))
register("dq08_player_keys", gold(checks.player_keys_resolved, PLAYER), """
SELECT 'player_sk' AS fk, match_sk, player_sk FROM g_playerfact WHERE match_sk > 0 AND player_sk = -1 UNION ALL
SELECT 'team_sk', match_sk, player_sk FROM g_playerfact WHERE match_sk > 0 AND team_sk = -1 UNION ALL
SELECT 'match_sk', match_sk, player_sk FROM g_playerfact WHERE player_sk > 0 AND match_sk = -1""")
register("dq09_halftime", gold(checks.halftime_above_fulltime, TEAM), """
SELECT match_sk, team_sk, goals_ht_scored, goals_scored, goals_ht_conceded, goals_conceded FROM g_teamfact
WHERE match_result_sk IN (1, 2, 3) AND (goals_ht_scored > goals_scored OR goals_ht_conceded > goals_conceded)""")
register("dq09_silver_halftime", lambda spark, sf: checks.silver_halftime_above_fulltime(
    warehouse(spark, sf).silver.scores(), warehouse(spark, sf).silver.fixtures()), """
SELECT fixture_id, side, ht AS goals_ht, ft AS goals_ft FROM z_score JOIN z_fixture ON id = fixture_id WHERE state_developer_name <> 'NS' AND ht > ft""")
register("dq10_row_floors", lambda spark, sf: Q.too_few({
    **{n: (warehouse(spark, sf).get(n), w, floor) for n, (w, floor) in checks.FLOORS.items()},
    "region": (table(spark, sf, "region"), None, 10)}), """
SELECT * FROM (SELECT 'dim_team' AS model, count(*) AS actual, 10 AS min_expected FROM g_team WHERE team_sk > 0 UNION ALL
  SELECT 'dim_match', count(*), 1000 FROM g_match WHERE match_sk > 0 UNION ALL SELECT 'dim_player', count(*), 500 FROM g_player WHERE player_sk > 0
  UNION ALL SELECT 'fct_team_matches', count(*), 2000 FROM g_teamfact WHERE match_sk > 0
  UNION ALL SELECT 'fct_player_appearances', count(*), 20000 FROM g_playerfact WHERE match_sk > 0
  UNION ALL SELECT 'region', count(*), 10 FROM region) WHERE actual < min_expected""")
register("dq11_negative_team", gold(lambda f: Q.negative(f.withColumn("goals_scored", F.col("goals_scored") - 1), ["match_sk", "team_sk"],
                                                         checks.TEAM_COUNTS), TEAM),
         "SELECT match_sk, team_sk, 'goals_scored' AS col FROM g_teamfact WHERE goals_scored - 1 < 0")
register("dq12_negative_player", gold(lambda f: Q.negative(f.withColumn("assists", F.col("assists") - 1), ["match_sk", "player_sk"],
                                                           checks.PLAYER_COUNTS), PLAYER),
         "SELECT match_sk, player_sk, 'assists' AS col FROM g_playerfact WHERE assists - 1 < 0")
register("dq13_minutes", gold(lambda f: Q.outside(f, "minutes_played", 20, 80).select("match_sk", "player_sk", "minutes_played"), PLAYER),
         "SELECT match_sk, player_sk, minutes_played FROM g_playerfact WHERE minutes_played < 20 OR minutes_played > 80")
register("dq14_points", gold(lambda f: checks.points_off(f.withColumn("points_earned", F.when(F.col("points_earned") == 1, 3).otherwise(
    F.col("points_earned")))), TEAM), """
SELECT match_sk, team_side_sk, goals_scored, goals_conceded, 3 AS points_earned FROM g_teamfact WHERE points_earned = 1""")
register("dq15_possession", gold(checks.possession_off, TEAM), """
SELECT match_sk, sum(ball_possession_pct) AS total_possession FROM g_teamfact WHERE ball_possession_pct IS NOT NULL AND match_sk > 0
GROUP BY match_sk HAVING count(*) = 2 AND abs(sum(ball_possession_pct) - 100) > 1""")
_n = lambda c: f"CASE WHEN (k + {c}) % 5 <> 0 THEN CAST((k + {c}) % 40 AS INT) END"
_team = "CASE WHEN (k + 101) % 11 <> 0 THEN CAST((k * 7 + 101) % 1000 AS INT) END"
_season = "CASE WHEN (k + 103) % 11 <> 0 THEN CAST((k * 7 + 103) % 1000 AS INT) END"


def _standings(spark, sf):
    from ..plans import silver
    return silver.build("standings", documents(spark, sf, "standings"))


register("dq16_played", lambda spark, sf: checks.played_off(_standings(spark, sf)), f"""
SELECT *, overall_won + overall_draw + overall_lost AS wdl_sum FROM (SELECT {_team} AS team_id, concat('text ', CAST((k + 111) % 97 AS VARCHAR)) AS team_name,
  {_season} AS season_id, {_n(129)} AS overall_played, {_n(130)} AS overall_won, {_n(131)} AS overall_draw, {_n(132)} AS overall_lost
  FROM (SELECT c_custkey AS k FROM customer) WHERE k % 13 <> 0) WHERE overall_played <> overall_won + overall_draw + overall_lost""")
register("dq17_freshness", lambda spark, sf: landing.freshness(
    warehouse(spark, sf).silver.fixtures().withColumn("_ingested_at", F.col("_ingested_at").cast("timestamp")),
    F.lit("2025-08-03 06:00:00").cast("timestamp")).select("severity"), """
SELECT CASE WHEN h > 49 THEN 'error' WHEN h > 25 THEN 'warn' ELSE 'pass' END AS severity
FROM (SELECT epoch(TIMESTAMP '2025-08-03 06:00:00' - max(ingested)) / 3600 AS h FROM z_fixture)""")
register("dq18_relationships", lambda spark, sf: Q.relationships(
    table(spark, sf, "lineitem"), "l_suppkey", table(spark, sf, "supplier").filter("s_acctbal > 0"), "s_suppkey"), """
SELECT l_suppkey, count(*) AS row_count FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey""")
register("dq19_ranges", lambda spark, sf: Q.outside(table(spark, sf, "part"), "p_size", 5, 45, "p_size IS NOT NULL").select("p_partkey", "p_size"),
         "SELECT p_partkey, p_size FROM part WHERE p_size NOT BETWEEN 5 AND 45")
register("dq_summary", lambda spark, sf: Q.summary(checks.star_checks(warehouse(spark, sf).get)), """
SELECT 'team_grain' AS "check", 'error' AS severity, count(*) AS violations, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END AS status
  FROM (SELECT 1 FROM g_teamfact GROUP BY match_sk, team_side_sk HAVING count(*) > 1)
UNION ALL SELECT 'player_grain', 'error', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END
  FROM (SELECT 1 FROM g_playerfact GROUP BY match_sk, player_sk, team_sk HAVING count(*) > 1)
UNION ALL SELECT n, 'error', 0, 'pass' FROM (VALUES ('two_rows_per_match'), ('completed_have_rows'), ('sentinels'), ('team_negative'),
  ('player_negative'), ('minutes'), ('points')) t(n)
UNION ALL SELECT 'team_keys', 'error', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END FROM (
  SELECT unnest([team_sk, opponent_team_sk, match_sk, stadium_sk]) AS k FROM g_teamfact WHERE match_result_sk IN (1, 2, 3)) WHERE k = -1
UNION ALL SELECT 'player_keys', 'error', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END FROM (
  SELECT 1 FROM g_playerfact WHERE match_sk > 0 AND player_sk = -1 UNION ALL SELECT 1 FROM g_playerfact WHERE match_sk > 0 AND team_sk = -1
  UNION ALL SELECT 1 FROM g_playerfact WHERE player_sk > 0 AND match_sk = -1)
UNION ALL SELECT 'halftime', 'warn', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END FROM g_teamfact
  WHERE match_result_sk IN (1, 2, 3) AND (goals_ht_scored > goals_scored OR goals_ht_conceded > goals_conceded)
UNION ALL SELECT 'possession', 'error', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END FROM (
  SELECT 1 FROM g_teamfact WHERE ball_possession_pct IS NOT NULL AND match_sk > 0 GROUP BY match_sk
  HAVING count(*) = 2 AND abs(sum(ball_possession_pct) - 100) > 1)""")


# archived patterns: documents are built per source row, then unnested ------------------------------------------------

def _docs(spark, sf, name, select, body):
    """Rows as documents, dealt by their first key: the table may be one file, and documents take long to make and to parse."""
    rows = table(spark, sf, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), select.split()[0])
    return rows.selectExpr(select, f"to_json({body}) AS raw_json")


@query("ar01_four_level_unnest", """
SELECT l_orderkey AS fixture_id, b AS bookmaker_id, 'maker ' || b AS bookmaker_name, b * 10 + t AS bet_id, 'bet ' || t AS bet_name,
  'v' || (l_linenumber % 3) AS bet_value, CAST(l_partkey + v AS VARCHAR) AS odd FROM lineitem, range(2) x(b), range(2) y(t), range(2) z(v)""")
def ar01(spark, sf):
    values = "transform(sequence(0, 1), v -> named_struct('value', concat('v', CAST(l_linenumber % 3 AS STRING)), 'odd', CAST(l_partkey + v AS STRING)))"
    bets = f"transform(sequence(0, 1), t -> named_struct('id', b * 10 + t, 'name', concat('bet ', CAST(t AS STRING)), 'values', {values}))"
    makers = f"transform(sequence(0, 1), b -> named_struct('id', b, 'name', concat('maker ', CAST(b AS STRING)), 'bets', {bets}))"
    return legacy.odds(_docs(spark, sf, "lineitem", "l_orderkey AS fixture_id", f"array(named_struct('bookmakers', {makers}))"))


@query("ar02_three_level_unnest", """
SELECT l_orderkey AS fixture_id, l_suppkey AS team_id, l_partkey * 10 + p AS player_id, CASE WHEN p = 1 THEN CAST(l_quantity AS INTEGER) END AS minutes_played,
  CAST(l_linenumber AS VARCHAR) AS rating, CAST(l_linenumber + p AS INTEGER) AS goals FROM lineitem, range(2) x(p)""")
def ar02(spark, sf):
    stats = ("array(named_struct('games', named_struct('minutes', CASE WHEN p = 1 THEN CAST(CAST(l_quantity AS INT) AS STRING) ELSE 'n/a' END, "
             "'rating', CAST(l_linenumber AS STRING)), 'goals', named_struct('total', CAST(l_linenumber + p AS STRING))))")
    players = f"transform(sequence(0, 1), p -> named_struct('player', named_struct('id', l_partkey * 10 + p), 'statistics', {stats}))"
    body = f"array(named_struct('team', named_struct('id', l_suppkey), 'players', {players}))"
    return legacy.player_statistics(_docs(spark, sf, "lineitem", "l_orderkey AS fixture_id", body))


@query("ar03_array_of_arrays", """
SELECT c_custkey AS season, c_nationkey * 10 + g AS rank, c_custkey + r AS team_id, 3 * g + r AS points FROM customer, range(2) x(g), range(3) y(r)""")
def ar03(spark, sf):
    row = "named_struct('rank', c_nationkey * 10 + g, 'team', named_struct('id', c_custkey + r), 'points', 3 * g + r)"
    body = f"array(named_struct('league', named_struct('standings', transform(sequence(0, 1), g -> transform(sequence(0, 2), r -> {row})))))"
    return legacy.standings(_docs(spark, sf, "customer", "c_custkey AS season", body))


@query("ar04_array_of_scalars", "SELECT s_suppkey AS season, 'Round - ' || (s_nationkey + i) AS round_name FROM supplier, range(4) x(i)")
def ar04(spark, sf):
    body = "transform(sequence(0, 3), i -> concat('Round - ', CAST(s_nationkey + i AS STRING)))"
    return legacy.rounds(_docs(spark, sf, "supplier", "s_suppkey AS season", body))


@query("ar05_last_position", """
SELECT c_nationkey AS season, c_custkey AS player_id, 2 AS pos, c_custkey + 2 AS goals, c_custkey % 7 + 2 AS assists FROM customer""")
def ar05(spark, sf):
    stats = "transform(sequence(0, 2), i -> named_struct('goals', c_custkey + i, 'assists', c_custkey % 7 + i))"
    body = f"array(named_struct('player', named_struct('id', c_custkey), 'statistics', {stats}))"
    return legacy.last_statistics(_docs(spark, sf, "customer", "c_nationkey AS season", body))


@query("ar06_starters_and_substitutes", """
SELECT o_orderkey AS fixture_id, o_custkey AS team_id, '4-4-2' AS formation, o_custkey * 10 + i AS player_id, 'P' || i AS player_position, i < 3 AS is_starter
FROM orders, range(5) x(i) WHERE i < 3 OR o_orderstatus <> 'O'""")
def ar06(spark, sf):
    person = "named_struct('player', named_struct('id', o_custkey * 10 + i, 'pos', concat('P', CAST(i AS STRING))))"
    body = (f"array(named_struct('team', named_struct('id', o_custkey), 'formation', '4-4-2', 'startXI', transform(sequence(0, 2), i -> {person}), "
            f"'substitutes', CASE WHEN o_orderstatus <> 'O' THEN transform(sequence(3, 4), i -> {person}) END))")
    return legacy.lineups(_docs(spark, sf, "orders", "o_orderkey AS fixture_id", body))


_LABELS = list(legacy.LABELS.items())
_ar07 = ", ".join(
    f"CASE WHEN (o_orderkey + {i}) % 6 <> 0 THEN CAST((o_orderkey + {i}) % 90 AS {k.upper() if k != 'int' else 'INTEGER'}) "
    f"{'ELSE 0' if d is not None else ''} END AS {n}" for i, (_, (n, k, d)) in enumerate(_LABELS))


@query("ar07_text_label_pivot", f"SELECT o_orderkey AS fixture_id, o_custkey AS team_id, {_ar07} FROM orders")
def ar07(spark, sf):
    entries = ", ".join(
        f"named_struct('type', '{label}', 'value', CASE WHEN (o_orderkey + {i}) % 6 <> 0 THEN concat(CAST((o_orderkey + {i}) % 90 AS STRING), "
        f"'{'%' if '%' in label or label == 'Ball Possession' else ''}') END)" for i, (label, _) in enumerate(_LABELS))
    body = f"array(named_struct('team', named_struct('id', o_custkey), 'statistics', array({entries})))"
    return legacy.team_statistics(_docs(spark, sf, "orders", "o_orderkey AS fixture_id", body))


@query("ar08_id_backfill", """
SELECT c_custkey, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey END, r_regionkey, s.id) AS venue_id
FROM customer LEFT JOIN region ON r_name = c_mktsegment LEFT JOIN (SELECT s_nationkey, min(s_suppkey) AS id FROM supplier GROUP BY s_nationkey) s ON s.s_nationkey = c_nationkey""")
def ar08(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey", "CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_nationkey AS BIGINT) END AS own",
                                                "c_mktsegment AS name", "c_nationkey AS owner")
    by_name = table(spark, sf, "region").selectExpr("r_name AS name", "CAST(r_regionkey AS BIGINT) AS id")
    by_owner = table(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("owner")).agg(F.min("s_suppkey").alias("id"))
    return legacy.backfill_id(c, by_name, by_owner, "own", "name", "owner", "venue_id").select("c_custkey", "venue_id")


@query("ar09_name_canonicalisation", """
SELECT CASE p_name WHEN 'small ring' THEN 'Ring' WHEN 'red widget' THEN 'Widget' ELSE p_name END AS name, count(*) AS n FROM part GROUP BY 1""")
def ar09(spark, sf):
    from ..operators.literals import values
    names = values(spark, "alias string, canonical string", [("small ring", "Ring"), ("red widget", "Widget")])
    raw = table(spark, sf, "part").select(F.concat(F.lit(" "), "p_name", F.lit(" , Country")).alias("name"))
    return count_by(legacy.canonical_name(raw, "name", names), "name")


@query("ar10_derived_round", """
SELECT fixture_id, min(n) AS round_number FROM (SELECT fixture_id, row_number() OVER (PARTITION BY season_id, team_id ORDER BY ingested, fixture_id) AS n FROM z_side)
GROUP BY fixture_id""")
def ar10(spark, sf):
    s = warehouse(spark, sf).silver
    rows = s._teams_of().select("fixture_id", F.col("season_id").alias("season"), "team_id", F.col("_ingested_at").alias("kick_off"))
    return legacy.derived_rounds(rows)


@query("ar11_swapped_columns", """
SELECT o_orderkey, 1 AS side_sk, o_custkey AS a, o_orderkey % 10 AS b FROM orders UNION ALL SELECT o_orderkey, 2, o_orderkey % 10, o_custkey FROM orders""")
def ar11(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 10).alias("other"))
    return shape.two_sided(o, ["o_orderkey"], {"a": "o_custkey", "b": "other"}, {"a": "other", "b": "o_custkey"})


@query("ar12_status_families", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN o_custkey % 5 > o_orderkey % 5 THEN 1 WHEN o_custkey % 5 = o_orderkey % 5 THEN 2 ELSE 3 END
  WHEN o_orderstatus = 'O' THEN 4 ELSE -2 END AS code FROM orders""")
def ar12(spark, sf):
    status = F.when(F.col("o_orderstatus") == "F", "PEN").when(F.col("o_orderstatus") == "O", "LIVE").otherwise("SUSP")
    return table(spark, sf, "orders").select("o_orderkey", legacy.result_code(status, F.col("o_custkey") % 5, F.col("o_orderkey") % 5).alias("code"))


@query("ar13_load_filter", """
SELECT 'season' AS mode, count(*) AS n FROM orders WHERE year(o_orderdate) = 1999
UNION ALL SELECT 'window', count(*) FROM orders WHERE o_orderdate BETWEEN DATE '1999-05-27' AND DATE '1999-06-29'""")
def ar13(spark, sf):
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("y"), legacy_key(F.col("o_orderdate")).alias("sk"))
    one = lambda mode, season: o.filter(legacy.load_filter(season, F.col("y"), F.col("sk"), "1999-06-01")).agg(
        F.count("*").alias("n")).withColumn("mode", F.lit(mode))
    return one("season", 1999).unionByName(one("window", None))


def legacy_key(c):
    from ..functions.columns import date_key
    return date_key(c)


@query("ar14_count_from_percent", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 50 = 0 THEN 0 ELSE CAST(round((l_partkey % 50) * CAST(l_quantity AS DECIMAL(18,3)) / 100) AS INTEGER) END AS accurate FROM lineitem""")
def ar14(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", legacy.accurate_from_percent(
        F.col("l_partkey") % 50, F.col("l_quantity").cast("string")).alias("accurate"))


@query("ar15_one_level_unnest", "SELECT o_orderkey AS fixture_id, o_custkey + i AS player_id, 'kind ' || i AS event_type FROM orders, range(2) x(i)")
def ar15(spark, sf):
    body = "transform(sequence(0, 1), i -> named_struct('player', named_struct('id', o_custkey + i), 'type', concat('kind ', CAST(i AS STRING))))"
    docs = _docs(spark, sf, "orders", "o_orderkey AS fixture_id", body)
    shape_ = "array<struct<player: struct<id: bigint>, type: string>>"
    return docs.select("fixture_id", F.explode(F.from_json("raw_json", shape_)).alias("e")).select(
        "fixture_id", F.col("e.player.id").alias("player_id"), F.col("e.type").alias("event_type"))


@query("ar16_delete_with_details", """
SELECT 'parents' AS part, count(*) AS n FROM orders WHERE year(o_orderdate) <> 1998
UNION ALL SELECT 'lines', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1998)""")
def ar16(spark, sf):
    parents = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "k")
    left = legacy.drop_parents(parents, {"lines": table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "k")}, "k",
                               F.year("o_orderdate") == 1998)
    one = lambda name: left[name].agg(F.count("*").alias("n")).withColumn("part", F.lit(name))
    return one("parents").unionByName(one("lines"))
