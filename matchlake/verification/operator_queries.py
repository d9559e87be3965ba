"""Reusable operators on the given tables: sources, predicates, joins, aggregates, windows, sorts, sets, scalars, upserts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window, functions as F

from ..functions import columns as C
from ..operators import intervals, keys, ranking, shape, upsert
from ..operators.literals import values
from ..plans import dims, facts, legacy
from ..plans.adapter import EXPR
from ..plans.warehouse import warehouse
from ..sources import landing, storage
from ..streaming import incremental
from .registry import query


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def space(spark):
    return storage.workspace(spark)


CUT = "TIMESTAMP '2024-01-20 00:00:00'"
CUT_NTZ = "TIMESTAMP_NTZ '2024-01-20 00:00:00'"


# sources -----------------------------------------------------------------------------------------------------------

_DOCS = """SELECT o_orderkey AS id, CAST(year(o_orderdate) AS INTEGER) AS _season_id, CAST(o_orderdate AS DATE) AS _fixture_date,
  CAST(o_custkey AS VARCHAR) AS customer, o_orderstatus AS league FROM orders"""


def _orders_docs(spark, sf):
    o = table(spark, sf, "orders")
    body = F.struct(F.col("o_custkey").alias("customer_id"), F.col("o_orderstatus").alias("league_id"),
                    F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("starting_at"))
    return landing.to_documents(o, "o_orderkey", body, F.year("o_orderdate"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


def _read_docs(docs):
    at = lambda p: F.get_json_object("raw_json", p)
    return docs.select("id", "_season_id", "_fixture_date", at("$.customer_id").alias("customer"), at("$.league_id").alias("league"))


@query("src01_landing", _DOCS, dates=["_fixture_date"])
def src01(spark, sf):
    return _read_docs(_orders_docs(spark, sf))


_CENTS = "CAST(round(o_totalprice * 100) AS BIGINT)"


@query("src02_replace_global", f"SELECT o_orderkey, {_CENTS} + 1 AS cents FROM orders")
def src02(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", f"{_CENTS} AS cents")
    path = f"{space(spark)}/global"
    storage.replace_scope(spark, path, rows, "global")
    storage.replace_scope(spark, path, rows.selectExpr("o_orderkey", "cents + 1 AS cents"), "global")
    return spark.read.parquet(path)


@query("src03_replace_season", f"""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS _season_id, {_CENTS} + CASE WHEN year(o_orderdate) = 1997 THEN 1 ELSE 0 END AS cents
FROM orders WHERE year(o_orderdate) NOT IN (1995, 1997) OR year(o_orderdate) = 1997 AND o_orderstatus = 'F'""")
def src03(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderstatus", f"{_CENTS} AS cents", "year(o_orderdate) AS _season_id")
    path = f"{space(spark)}/season"
    storage.replace_scope(spark, path, rows.drop("o_orderstatus"), "season")
    batch = rows.filter("_season_id = 1997 AND o_orderstatus = 'F'").selectExpr("o_orderkey", "cents + 1 AS cents", "_season_id")
    storage.replace_scope(spark, path, batch, "season", seasons=[1995, 1997])  # nothing came for 1995
    return spark.read.parquet(path)


@query("src04_replace_dates", f"""
WITH rows AS (SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS day, {_CENTS} AS cents, o_orderstatus FROM orders)
SELECT o_orderkey, day AS _fixture_date, cents FROM rows WHERE NOT coalesce(day BETWEEN DATE '1996-03-01' AND DATE '1996-06-30', false)
UNION ALL SELECT o_orderkey, day, -cents FROM rows WHERE day BETWEEN DATE '1996-03-01' AND DATE '1996-06-30' AND o_orderstatus = 'F'
UNION ALL SELECT -o_orderkey, day, cents FROM rows WHERE o_orderkey % 100 = 0 OR day = DATE '1996-07-01'""", dates=["_fixture_date"])
def src04(spark, sf):
    """A window is reloaded; the batch also has rows without a date and rows behind the window, which are added."""
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 50 <> 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS _fixture_date",
                                                 f"{_CENTS} AS cents", "o_orderstatus")
    path = f"{space(spark)}/dates"
    storage.replace_scope(spark, path, rows.drop("o_orderstatus"), "date", "1990-01-01", "2000-12-31")
    inside = rows.filter("_fixture_date BETWEEN '1996-03-01' AND '1996-06-30' AND o_orderstatus = 'F'").withColumn("cents", -F.col("cents"))
    more = rows.filter("o_orderkey % 100 = 0 OR _fixture_date = '1996-07-01'").withColumn("o_orderkey", -F.col("o_orderkey"))
    batch = inside.unionByName(more).drop("o_orderstatus")
    storage.replace_scope(spark, path, batch, "date", "1996-03-01", "1996-06-30")
    return storage.stored(spark, path, batch.schema)


@query("src04_replace_where", f"""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, {_CENTS} AS cents FROM orders
WHERE NOT (CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-06-30')
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), -{_CENTS} FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1996-06-30' AND o_orderstatus = 'F'""", dates=["day"])
def src04_relation(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "CAST(o_orderdate AS DATE) AS day", f"{_CENTS} AS cents", "o_orderstatus")
    window = F.col("day").between("1996-03-01", "1996-06-30")
    batch = rows.filter(window & (F.col("o_orderstatus") == "F")).withColumn("cents", -F.col("cents"))
    return upsert.replace_where(rows.drop("o_orderstatus"), batch.drop("o_orderstatus"), window)


@query("u01_partition_upsert", f"""
WITH rows AS (SELECT o_orderkey, CASE WHEN o_orderkey % 40 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS season, {_CENTS} AS cents FROM orders)
SELECT o_orderkey, season, cents + CASE WHEN season = 1994 OR o_orderkey % 80 = 0 THEN 1 ELSE 0 END AS cents FROM rows
UNION ALL SELECT -o_orderkey, season, cents FROM rows WHERE season = 1994 AND o_orderkey % 3 = 0 OR o_orderkey % 80 = 0""")
def u01_partitions(spark, sf):
    """Changed and new rows of one season and of the rows without a season go in; other partitions are not rewritten."""
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 40 <> 0 THEN year(o_orderdate) END AS season", f"{_CENTS} AS cents")
    path = f"{space(spark)}/seasons"
    storage.upsert_partitions(spark, path, rows, ["o_orderkey"], "season")
    changed = rows.filter("season = 1994 OR o_orderkey % 80 = 0").withColumn("cents", F.col("cents") + 1)
    added = rows.filter("season = 1994 AND o_orderkey % 3 = 0 OR o_orderkey % 80 = 0").withColumn("o_orderkey", -F.col("o_orderkey"))
    storage.upsert_partitions(spark, path, changed.unionByName(added), ["o_orderkey"], "season")
    return storage.stored(spark, path, rows.schema)


@query("src05_load_window", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-13' AND DATE '2024-02-19'
GROUP BY ALL""", dates=["day"])
def src05(spark, sf):
    e = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    return e.filter(landing.load_window("incremental", F.col("day"), "2024-01-20")).groupBy("day").agg(F.count("*").alias("n"))


def _landed(spark, sf):
    """Events as dated documents, orders as documents of a season, nations as a global list."""
    stamp = F.lit("2024-01-31").cast("timestamp")
    events = landing.to_documents(table(spark, sf, "events"), "event_id", F.struct("event_type"), date_text=F.date_format("ts", "yyyy-MM-dd"), loaded_at=stamp)
    orders = landing.to_documents(table(spark, sf, "orders"), "o_orderkey", F.struct("o_orderstatus"), season=F.year("o_orderdate"), loaded_at=stamp)
    nations = landing.to_documents(table(spark, sf, "nation"), "n_nationkey", F.struct("n_name"), loaded_at=stamp)
    return {"fixtures": events, "standings": orders, "core_countries": nations}


def _counted(spark, root):
    """What the loaded tables hold, by scope."""
    parts = [spark.read.parquet(f"{root}/{name}").groupBy(F.lit(name).alias("name"), F.col(scope).cast("string").alias("scope")).agg(
        F.count("*").alias("n"), F.sum("id").alias("ids")) for name, scope in (
            ("fixtures", "_fixture_date"), ("standings", "_season_id"), ("core_countries", "_season_id"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("src12_manifest_full", """
SELECT 'fixtures' AS name, CAST(CAST(ts AS DATE) AS VARCHAR) AS scope, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY ALL
UNION ALL SELECT 'standings', CAST(year(o_orderdate) AS VARCHAR), count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders GROUP BY ALL
UNION ALL SELECT 'core_countries', NULL, count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation GROUP BY ALL""")
def src12_full(spark, sf):
    root = space(spark)
    landing.load(spark, _landed(spark, sf), root, "full", seasons=range(1990, 2011), first=date(2023, 12, 1), last=date(2024, 2, 29))
    return _counted(spark, root)


@query("src12_manifest_incremental", """
SELECT 'fixtures' AS name, CAST(CAST(ts AS DATE) AS VARCHAR) AS scope, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events
WHERE CAST(ts AS DATE) < DATE '2024-01-13' OR event_id % 2 = 0 GROUP BY ALL
UNION ALL SELECT 'standings', CAST(year(o_orderdate) AS VARCHAR), count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders
WHERE year(o_orderdate) <> 1997 OR o_orderstatus = 'F' GROUP BY ALL
UNION ALL SELECT 'core_countries', NULL, count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation GROUP BY ALL""")
def src12_incremental(spark, sf):
    """A full load, then a daily one of which only half of the window's documents and part of the running season are left."""
    root, landed = space(spark), _landed(spark, sf)
    landing.load(spark, landed, root, "full", seasons=range(1990, 2011), first=date(2024, 1, 1), last=date(2024, 1, 31))
    later = landed | {"fixtures": landed["fixtures"].filter("id % 2 = 0"),
                      "standings": landed["standings"].filter(F.get_json_object("raw_json", "$.o_orderstatus") == "F")}
    landing.load(spark, later, root, "incremental", running=[1997], as_of=date(2024, 1, 20))
    return _counted(spark, root)


@query("src06_date_chunks", """
SELECT y AS season, CAST(d AS DATE) AS from_date, least(CAST(d AS DATE) + 89, hi) AS to_date
FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi
      FROM orders GROUP BY ALL), unnest(generate_series(lo, hi, INTERVAL 90 DAY)) t(d)""", dates=["from_date", "to_date"])
def src06(spark, sf):
    spans = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("season")).agg(
        F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    return intervals.date_chunks(spans, "lo", "hi", landing.DATE_CHUNK_DAYS).select("season", "from_date", "to_date")


@query("src07_seasons", """
SELECT c_custkey AS league_id, c_custkey * 10 + i AS id, y || '/' || (y + 1) AS name, make_date(y, 7, 1) AS starting_at,
  make_date(y + 1, 5, 31) AS ending_at, CASE WHEN c_nationkey < 12 AND c_nationkey % 5 > 0 THEN i = 2 ELSE i = 3 END AS current
FROM (SELECT *, CAST(2007 + c_nationkey % 5 + i AS INTEGER) AS y FROM customer, range(4) r(i)) WHERE y >= 2010
""", dates=["starting_at", "ending_at"])
def src07(spark, sf):
    c = table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_nationkey AS n")
    one = ("named_struct('id', id * 10 + i, 'name', concat(CAST(2007 + n % 5 + i AS STRING), '/', CAST(2008 + n % 5 + i AS STRING)), "
           "'starting_at', make_date(2007 + n % 5 + i, 7, 1), 'ending_at', make_date(2008 + n % 5 + i, 5, 31), "
           "'is_current', n < 12 AND i = 2)")
    docs = c.selectExpr("id", f"to_json(named_struct('seasons', transform(sequence(0, 3), i -> {one}))) AS raw_json")
    return landing.bootstrap_seasons(docs)


@query("src08_first_seen", """
SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""")
def src08(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return upsert.first_seen(e, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("src09_league_filter", f"SELECT * FROM ({_DOCS}) WHERE league = 'F'", dates=["_fixture_date"])
def src09(spark, sf):
    return _read_docs(landing.of_league(_orders_docs(spark, sf), "F"))


@query("src10_known_keys", "SELECT DISTINCT user_id FROM events")
def src10(spark, sf):
    e = table(spark, sf, "events")
    return upsert.known_keys(e.filter(f"ts >= {CUT_NTZ}"), e.filter(f"ts < {CUT_NTZ}"), "user_id")


@query("src11_missing_columns", "SELECT s_suppkey, s_name, CAST(NULL AS INTEGER) AS _season_id, CAST(NULL AS VARCHAR) AS _note FROM supplier")
def src11(spark, sf):
    return upsert.add_missing_columns(table(spark, sf, "supplier").select("s_suppkey", "s_name"), "s_name string, _season_id int, _note string")


@query("src13_typed_csv", "SELECT s_suppkey AS team_id, s_name AS display_name, CAST(s_nationkey AS INTEGER) AS country_id FROM supplier")
def src13(spark, sf):
    path = f"{space(spark)}/seed"
    table(spark, sf, "supplier").selectExpr("s_suppkey AS team_id", "s_name AS display_name", "s_nationkey AS country_id").write.option(
        "header", True).csv(path)
    return landing.read_seed(spark, path, "team_id bigint, display_name string, country_id int")


@query("src14_materialise", "SELECT o_orderstatus AS status, count(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY ALL")
def src14(spark, sf):
    """A table, and a view over it that copies nothing."""
    path = f"{space(spark)}/orders"
    storage.write_table(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), path)
    spark.read.parquet(path).filter("o_orderstatus <> 'P'").createOrReplaceTempView("open_or_final")
    return spark.table("open_or_final").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("n"))


@query("src15_publish", """
SELECT 'gold.part' AS table_name, count(*) AS row_count FROM part UNION ALL SELECT 'gold.supplier', count(*) FROM supplier""")
def src15(spark, sf):
    tables = {"gold.part": table(spark, sf, "part"), "gold.supplier": table(spark, sf, "supplier"), "raw.nation": table(spark, sf, "nation")}
    return storage.publish(spark, tables, space(spark), schemas=["gold"])


@query("src16_extract", "SELECT season, count(*) AS n FROM mm GROUP BY season")
def src16(spark, sf):
    return warehouse(spark, sf).get("mart_match_facts").groupBy("season").agg(F.count("*").alias("n"))


@query("src17_calendar", """
SELECT CAST(d AS DATE) AS day, count(o_orderkey) AS n FROM (SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
  unnest(generate_series(lo, hi, INTERVAL 1 DAY)) t(d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY ALL""", dates=["day"])
def src17(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"))
    days = o.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).select(F.explode(F.sequence("lo", "hi")).alias("day"))
    return days.join(o.groupBy("day").agg(F.count("*").alias("n")), "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("src18_inline_values", """
SELECT label, count(*) AS n FROM orders JOIN (VALUES ('F', 'final'), ('O', 'open'), ('P', 'pending')) t(code, label) ON code = o_orderstatus GROUP BY label""")
def src18(spark, sf):
    names = values(spark, "o_orderstatus string, label string", [("F", "final"), ("O", "open"), ("P", "pending")])
    return table(spark, sf, "orders").join(names, "o_orderstatus").groupBy("label").agg(F.count("*").alias("n"))


@query("src19_freshness", """
SELECT max(ts) AS newest, CASE WHEN epoch(TIMESTAMP '2024-02-01 00:00:00' - max(ts)) / 3600 > 49 THEN 'error'
  WHEN epoch(TIMESTAMP '2024-02-01 00:00:00' - max(ts)) / 3600 > 25 THEN 'warn' ELSE 'pass' END AS severity FROM events""", times=["newest"])
def src19(spark, sf):
    docs = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("_ingested_at"))
    return landing.freshness(docs, F.lit("2024-02-01 00:00:00").cast("timestamp")).drop("age_hours")


@query("src20_label", "SELECT strftime(max(ts), '%d %b %Y %H:%M UTC') AS last_updated FROM events")
def src20(spark, sf):
    from ..plans.marts import last_updated
    return last_updated(table(spark, sf, "events"), "ts")


# predicates --------------------------------------------------------------------------------------------------------

def count_by(df, *cols):
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


@query("pf01_typed_projection", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(ts AS DATE) AS day FROM events", dates=["day"])
def pf01(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", C.from_text(F.get_json_object("props", "$.k"), "int").alias("k"), F.to_date("ts").alias("day"))


@query("pf02_in_not_in", "SELECT o_orderpriority AS p, count(*) AS n FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('5-LOW') GROUP BY ALL")
def pf02(spark, sf):
    o = table(spark, sf, "orders")
    return count_by(o.filter(F.col("o_orderstatus").isin("F", "P") & ~F.col("o_orderpriority").isin("5-LOW")), F.col("o_orderpriority").alias("p"))


@query("pf03_not_in_subquery", """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_totalprice > 300000)""")
def pf03(spark, sf):
    from ..operators.quality import missing_in
    return missing_in(table(spark, sf, "customer"), table(spark, sf, "orders").filter("o_totalprice > 300000"), "c_custkey",
                      "o_custkey").select("c_custkey")


@query("pf04_between", "SELECT count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 10 AND 20 AND l_discount BETWEEN 0.02 AND 0.05")
def pf04(spark, sf):
    return table(spark, sf, "lineitem").filter("l_quantity BETWEEN 10 AND 20 AND l_discount BETWEEN 0.02D AND 0.05D").agg(F.count("*").alias("n"))


@query("pf05_like", "SELECT p_partkey FROM part WHERE p_name ILIKE '%RED%' AND p_name NOT LIKE 'small%'")
def pf05(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_name").ilike("%RED%") & ~F.col("p_name").like("small%")).select("p_partkey")


@query("pf06_null_guards", "SELECT count(*) FILTER (team_id IS NULL) AS no_team, count(*) FILTER (team_id IS NOT NULL AND kind IS NOT NULL) AS known FROM z_event")
def pf06(spark, sf):
    e = warehouse(spark, sf).silver.events()
    return e.agg(C.count_if(F.col("team_id").isNull()).alias("no_team"),
                 C.count_if(F.col("team_id").isNotNull() & F.col("type_developer_name").isNotNull()).alias("known"))


@query("pf07_multi_select", """
SELECT 'all' AS pick, count(*) AS n FROM customer UNION ALL SELECT 'two', count(*) FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')""")
def pf07(spark, sf):
    c = table(spark, sf, "customer")
    pick = lambda name, choices: c.filter(C.any_of(F.col("c_mktsegment"), choices)).agg(F.count("*").alias("n")).withColumn("pick", F.lit(name))
    return pick("all", ["All", "BUILDING"]).unionByName(pick("two", ["BUILDING", "MACHINERY"]))


@query("pf08_scalar_subquery", "SELECT count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders WHERE o_orderdate < DATE '1998-01-01')")
def pf08(spark, sf):
    o = table(spark, sf, "orders")
    newest = o.filter("o_orderdate < DATE '1998-01-01'").agg(F.max(F.to_date("o_orderdate"))).scalar()
    return o.filter(F.to_date("o_orderdate") == newest).agg(F.count("*").alias("n"))


@query("pf09_text_order", "SELECT season, count(*) AS n FROM mm WHERE season >= '2023/24' GROUP BY season")
def pf09(spark, sf):
    return count_by(warehouse(spark, sf).get("mart_match_facts").filter("season >= '2023/24'"), "season")


@query("pf10_high_water", f"SELECT event_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < {CUT})")
def pf10(spark, sf):
    e = table(spark, sf, "events")
    return upsert.since_high_water(e, e.filter(f"ts < {CUT_NTZ}"), "ts").select("event_id")


def _line_docs(spark, sf, where="true"):
    """Order lines packed into arrays of their own row: a document never gathers a group."""
    return table(spark, sf, "lineitem").filter(where).selectExpr(
        "l_orderkey AS id", "to_json(named_struct('lines', array(named_struct('part', l_partkey, 'n', 0), "
        "named_struct('part', l_suppkey, 'n', 1)))) AS raw_json", "CAST(l_shipdate AS TIMESTAMP_NTZ) AS _ingested_at")


@query("pf11_filter_before_explode", """
SELECT l_orderkey AS id, n, CASE WHEN n = 0 THEN l_partkey ELSE l_suppkey END AS part FROM lineitem, range(2) r(n)
WHERE l_shipdate >= DATE '2000-01-01'""")
def pf11(spark, sf):
    from ..operators.flatten import Model, flatten
    docs = _line_docs(spark, sf, "l_shipdate >= DATE '2000-01-01'")
    return flatten(docs, Model("lines", ("id",), "part:bigint n:bigint", "id=@id:bigint", ("lines",))).drop("_ingested_at")


@query("pf12_rolling_date_key", "SELECT count(*) AS n FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) >= 20010101")
def pf12(spark, sf):
    return table(spark, sf, "orders").filter(C.recent_date_key(C.date_key(F.col("o_orderdate")), 7, "2001-01-08")).agg(F.count("*").alias("n"))


@query("pf13_case", """
SELECT CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END AS state, CASE WHEN o_totalprice > 300000 THEN 'big' ELSE 'small' END AS size,
  count(*) AS n FROM orders GROUP BY ALL""")
def pf13(spark, sf):
    s = F.col("o_orderstatus")
    return count_by(table(spark, sf, "orders"), F.when(s == "F", "final").when(s == "O", "open").alias("state"),
                    F.when(F.col("o_totalprice") > 300000, "big").otherwise("small").alias("size"))


@query("pf14_nested_pipeline", """
SELECT n_orders, count(*) AS customers FROM (SELECT o_custkey, count(*) AS n_orders FROM (SELECT * FROM orders WHERE o_orderstatus = 'F')
  GROUP BY o_custkey) GROUP BY n_orders""")
def pf14(spark, sf):
    per = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    return per.groupBy("n_orders").agg(F.count("*").alias("customers"))


@query("pf15_boolean_column", "SELECT state_developer_name IN ('FT', 'FT_PEN', 'AET') AS is_finished, count(*) AS n FROM z_fixture GROUP BY ALL")
def pf15(spark, sf):
    return count_by(warehouse(spark, sf).silver.fixtures(), C.is_finished(F.col("state_developer_name")).alias("is_finished"))


# joins -------------------------------------------------------------------------------------------------------------

@query("j01_star_join", """
SELECT n_name, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""")
def j01(spark, sf):
    o, c, n = (table(spark, sf, t) for t in ("orders", "customer", "nation"))
    return count_by(o.join(c, F.expr("c_custkey = o_custkey")).join(n, F.expr("n_nationkey = c_nationkey")), "n_name")


@query("j02_dim_lookup", """
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_partkey, -1) AS part_sk FROM lineitem
LEFT JOIN (SELECT p_partkey FROM part WHERE p_size < 25) ON p_partkey = l_partkey""")
def j02(spark, sf):
    small = table(spark, sf, "part").filter("p_size < 25").select("p_partkey", F.col("p_partkey").alias("part_sk"))
    return keys.resolve_fk(table(spark, sf, "lineitem"), small, "l_partkey", "p_partkey", "part_sk").select(
        "l_orderkey", "l_linenumber", "l_partkey", "part_sk")


@query("j03_composite_key", """
SELECT p.fixture_id, p.team_id, s.ft AS goals FROM z_side p LEFT JOIN z_score s ON s.fixture_id = p.fixture_id AND s.team_id = p.team_id""")
def j03(spark, sf):
    s = warehouse(spark, sf).silver
    goals = s.scores().filter("description = 'CURRENT'").select("fixture_id", "team_id", "goals")
    return s.participants().select("fixture_id", "team_id").join(goals, ["fixture_id", "team_id"], "left")


@query("j04_opponents", """
SELECT p.fixture_id, p.location, p.team_id, o.team_id AS opponent_team_id FROM z_side p JOIN z_side o
ON o.fixture_id = p.fixture_id AND o.location <> p.location""")
def j04(spark, sf):
    p = warehouse(spark, sf).silver.participants().select("fixture_id", "location", "team_id")
    return shape.pair_opponents(p, "fixture_id", "location", ["team_id"])


@query("j05_conceding_team", "SELECT fixture_id, team_id, at_minute AS goal_minute, goals AS n FROM z_minute")
def j05(spark, sf):
    from ..plans.facts import goals_against
    w = warehouse(spark, sf)
    return goals_against(w.silver.events(), w.get("match_sheet"))


_SPAN = """SELECT event_id, user_id, epoch(ts)::BIGINT AS lo, epoch(ts)::BIGINT + 86400 AS hi FROM (SELECT event_id, user_id, date_trunc('second', ts) AS ts
  FROM events WHERE event_type = 'view')"""


@query("j06_interval_count", f"""
SELECT v.event_id, count(s.event_id) AS n FROM ({_SPAN}) v LEFT JOIN events s ON s.user_id = v.user_id AND s.event_type = 'signup'
  AND epoch(date_trunc('second', s.ts)) > v.lo AND epoch(date_trunc('second', s.ts)) <= v.hi GROUP BY v.event_id""")
def j06(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"))
    rows = e.filter("event_type = 'view'").selectExpr("event_id", "user_id", "t AS lo", "t + 86400 AS hi")
    return intervals.count_in_interval(rows, e.filter("event_type = 'signup'"), ["user_id"], "t", "lo", "hi", "n").select("event_id", "n")


_RANGES = """SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi, CAST(year(o_orderdate) AS INTEGER) AS season
  FROM orders WHERE o_orderstatus = 'F' GROUP BY year(o_orderdate)"""


@query("j07_range_join", f"""
SELECT season, count(*) AS n FROM lineitem LEFT JOIN ({_RANGES}) ON CAST(l_shipdate AS DATE) BETWEEN lo AND hi GROUP BY season""")
def j07(spark, sf):
    ranges = table(spark, sf, "orders").filter("o_orderstatus = 'F'").groupBy(F.year("o_orderdate").alias("season")).agg(
        F.min(F.to_date("o_orderdate")).alias("lo"), F.max(F.to_date("o_orderdate")).alias("hi"))
    points = table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    return count_by(intervals.tag_ranges(points, ranges, "day", "lo", "hi"), "season")


@query("j08_one_row_sides", """
SELECT (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS final, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS open""")
def j08(spark, sf):
    one = lambda s: F.count(F.when(F.col("o_orderstatus") == s, 1))
    return table(spark, sf, "orders").agg(one("F").alias("final"), one("O").alias("open"))


@query("j09_constant_predicate", """
SELECT a.n AS customers, b.c_name AS richest FROM (SELECT count(*) AS n FROM customer) a
LEFT JOIN (SELECT c_name FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1) b ON true""")
def j09(spark, sf):
    c = table(spark, sf, "customer")
    best = ranking.top_n(c, 1, [F.col("c_acctbal").desc(), F.col("c_custkey")]).select("c_name").scalar()
    return c.agg(F.count("*").alias("customers")).select("customers", best.alias("richest"))


@query("j10_lateral_unnest", "SELECT l_orderkey AS id, CASE WHEN n = 0 THEN l_partkey ELSE l_suppkey END AS part FROM lineitem, range(2) r(n)")
def j10(spark, sf):
    from ..operators.flatten import Model, flatten
    return flatten(_line_docs(spark, sf), Model("lines", ("id",), "part:bigint", "id=@id:bigint", ("lines",))).drop("_ingested_at")


@query("j11_unnest_then_override", """
SELECT fixture_id, referee_id, type_id FROM z_ref""")
def j11(spark, sf):
    return warehouse(spark, sf).silver.match_referees().select("fixture_id", "referee_id", "type_id")


@query("j12_anti_join", "SELECT p_partkey FROM part WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity > 40)")
def j12(spark, sf):
    returned = table(spark, sf, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf, "part").join(returned, "p_partkey", "left_anti").select("p_partkey")


@query("j13_two_roles", """
SELECT a.n_name AS home, b.n_name AS away, count(*) AS n FROM z_match JOIN nation a ON a.n_nationkey = home_team JOIN nation b ON b.n_nationkey = away_team GROUP BY ALL""")
def j13(spark, sf):
    n = table(spark, sf, "nation")
    role = lambda r: n.select(F.col("n_nationkey").alias(f"{r}_team"), F.col("n_name").alias(r))
    m = warehouse(spark, sf).silver._matches().select("home_team", "away_team")
    return count_by(m.join(role("home"), "home_team").join(role("away"), "away_team"), "home", "away")


@query("j14_using_then_unnest", """
SELECT l_orderkey AS id, o_custkey AS customer, CASE WHEN n = 0 THEN l_partkey ELSE l_suppkey END AS part
FROM lineitem JOIN orders ON l_orderkey = o_orderkey, range(2) r(n)""")
def j14(spark, sf):
    parent = table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_custkey AS customer")
    docs = _line_docs(spark, sf).withColumn("l", F.from_json("raw_json", "lines array<struct<part: bigint>>")["lines"])
    return parent.join(docs, "id").select("id", "customer", F.inline("l"))


# aggregates --------------------------------------------------------------------------------------------------------

@query("a01_group_by", """
SELECT l_returnflag, CAST(sum(l_quantity) AS BIGINT) AS total, count(*) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi,
  round(sum(l_quantity) / count(*), 6) AS mean FROM lineitem GROUP BY l_returnflag""")
def a01(spark, sf):
    q = "l_quantity"
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.sum(q).cast("bigint").alias("total"), F.count("*").alias("n"), F.min(q).alias("lo"), F.max(q).alias("hi"), C.rounded(F.avg(q), 6).alias("mean"))


@query("a02_count_distinct", "SELECT o_orderstatus, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY o_orderstatus")
def a02(spark, sf):
    return table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.countDistinct("o_custkey").alias("customers"))


_KINDS = {"click": "clicks", "view": "views", "signup": "signups", "purchase": "purchases", "error": "errors"}


@query("a03_pivot", f"""
SELECT user_id, {", ".join(f"max(value) FILTER (event_type = '{k}') AS {v}" for k, v in _KINDS.items())} FROM events GROUP BY user_id""")
def a03(spark, sf):
    return shape.eav_pivot(table(spark, sf, "events"), ["user_id"], "event_type", "value", _KINDS)


@query("a04_pivot_default", f"""
SELECT user_id, {", ".join(f"CAST(round_even(coalesce(greatest(max(value) FILTER (event_type = '{k}'), CASE WHEN bool_or(event_type <> '{k}') THEN 0 END), 0), 0) AS INTEGER) AS {v}" for k, v in _KINDS.items())}
FROM events GROUP BY user_id""")
def a04(spark, sf):
    wide = shape.eav_pivot(table(spark, sf, "events"), ["user_id"], "event_type", "value", _KINDS, default=0.0)
    return wide.select("user_id", *[C.int_from_double(F.col(c)).alias(c) for c in _KINDS.values()])


@query("a05_filtered_aggregate", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS final, count(DISTINCT o_custkey) FILTER (o_orderstatus = 'O') AS open_customers
FROM orders GROUP BY o_orderpriority""")
def a05(spark, sf):
    s = F.col("o_orderstatus")
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        C.count_if(s == "F").alias("final"), F.countDistinct(F.when(s == "O", F.col("o_custkey"))).alias("open_customers"))


@query("a06_conditional_sum", "SELECT l_linestatus, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned FROM lineitem GROUP BY l_linestatus")
def a06(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_linestatus").agg(C.sum_if(F.col("l_returnflag") == "R").alias("returned"))


@query("a07_ratio", """
SELECT l_linenumber, round(100 * (count(*) FILTER (l_returnflag = 'R'))::DOUBLE / nullif((count(*) FILTER (l_linestatus = 'F'))::DOUBLE, 0), 1) AS pct
FROM lineitem GROUP BY l_linenumber""")
def a07(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_linenumber").agg(
        C.percent(C.count_if(F.col("l_returnflag") == "R"), C.count_if(F.col("l_linestatus") == "F")).alias("pct"))


@query("a08_per90", """
SELECT l_suppkey, round(90::DOUBLE * count(*)::DOUBLE / nullif(sum(l_quantity), 0), 2) AS rate FROM lineitem GROUP BY l_suppkey""")
def a08(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(C.per90(F.count("*"), F.sum("l_quantity")).alias("rate"))


@query("a09_mode", """
SELECT c_nationkey, c_mktsegment AS usual FROM (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY n DESC, c_mktsegment) = 1""")
def a09(spark, sf):
    return shape.dominant_value(table(spark, sf, "customer"), "c_nationkey", "c_mktsegment", "usual")


@query("a10_having", "SELECT o_custkey, count(DISTINCT o_orderstatus) AS kinds FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 3")
def a10(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.countDistinct("o_orderstatus").alias("kinds")).filter("kinds = 3")


@query("a11_global_having", "SELECT 'lineitem' AS model, count(*) AS actual FROM lineitem HAVING count(*) > 1000")
def a11(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("actual")).filter("actual > 1000").select(F.lit("lineitem").alias("model"), "actual")


@query("a12_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def a12(spark, sf):
    return table(spark, sf, "part").select("p_brand", "p_type").distinct()


@query("a13_latest_per_key", """
SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def a13(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return keys.latest_per_key(e, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query("a14_dominant", """
SELECT l_suppkey, l_returnflag AS usual FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1""")
def a14(spark, sf):
    return shape.dominant_value(table(spark, sf, "lineitem"), "l_suppkey", "l_returnflag", "usual")


@query("a15_aggregate_of_aggregate", "SELECT min(n) AS lo, max(n) AS hi FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)")
def a15(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))


@query("a16_group_by_document", "SELECT doc_id, any_value(text) AS body, count(*) AS n FROM documents GROUP BY doc_id")
def a16(spark, sf):
    """Grouping by the id alone; the body depends on it and is carried, not hashed."""
    return table(spark, sf, "documents").groupBy("doc_id").agg(F.max("text").alias("body"), F.count("*").alias("n"))


@query("a17_weighted_index", """
SELECT l_suppkey, round(CAST(count(*) FILTER (l_returnflag = 'N') + 5 * count(*) FILTER (l_returnflag = 'A') + 15 * count(*) FILTER (l_returnflag = 'R') AS DOUBLE)
  / nullif(count(DISTINCT l_orderkey)::DOUBLE, 0), 1) AS idx FROM lineitem GROUP BY l_suppkey""")
def a17(spark, sf):
    flag = lambda f: C.count_if(F.col("l_returnflag") == f)
    return table(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        C.weighted([(flag("N"), 1), (flag("A"), 5), (flag("R"), 15)], F.countDistinct("l_orderkey"), 1).alias("idx"))


@query("a18_two_keys", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY 1, 2")
def a18(spark, sf):
    return count_by(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


# windows -----------------------------------------------------------------------------------------------------------

@query("w01_rank_in_group", """
SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer QUALIFY rn <= 5""")
def w01(spark, sf):
    return ranking.top_n(table(spark, sf, "customer"), 5, [F.col("c_acctbal").desc(), F.col("c_custkey")], "rn", ["c_nationkey"]).select(
        "c_nationkey", "c_custkey", "rn")


@query("w02_rank_of_groups", """
SELECT n_name, n, row_number() OVER (ORDER BY n DESC, n_name) AS rank FROM (SELECT n_name, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name)""")
def w02(spark, sf):
    per = count_by(table(spark, sf, "customer").join(table(spark, sf, "nation"), F.expr("n_nationkey = c_nationkey")), "n_name")
    # one row per nation is ranked
    return per.withColumn("rank", F.row_number().over(Window.orderBy(F.col("n").desc(), "n_name")))


@query("w03_number_text_keys", """
SELECT key, row_number() OVER (ORDER BY key) + 5 AS n FROM (SELECT md5(CAST(o_orderkey AS VARCHAR)) AS key FROM orders)""")
def w03_text(spark, sf):
    named = table(spark, sf, "orders").select(F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("key"))
    return keys.dense_number(named, "key", "n", 5)


@query("w03_number_sparse_keys", """
SELECT key, row_number() OVER (ORDER BY key) AS n FROM (SELECT o_orderkey * 1000000007 % 2305843009213693951 AS key FROM orders)""")
def w03_sparse(spark, sf):
    return keys.dense_number(table(spark, sf, "orders").selectExpr("o_orderkey * 1000000007 % 2305843009213693951 AS key"), "key", "n")


@query("w03_number_dimension", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS sk FROM orders")
def w03(spark, sf):
    return keys.dense_number(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", "sk")


@query("w04_running_total", """
SELECT o_orderkey, CAST(sum(w) OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate RANGE UNBOUNDED PRECEDING) AS BIGINT) AS total
FROM (SELECT *, o_custkey % 7 AS w FROM orders)""")
def w04(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", (F.col("o_custkey") % 7).alias("w"))
    return ranking.running_total(o, ["o_orderstatus"], "o_orderdate", {"total": F.col("w")}).select("o_orderkey", "total")


@query("w05_partition_flag", """
SELECT o_orderkey, CASE WHEN bool_or(o_orderstatus = 'P') OVER (PARTITION BY o_custkey) THEN 'has pending' ELSE 'none' END AS flag FROM orders""")
def w05(spark, sf):
    """The flag is aggregated per key and joined: a key of any size never has to sit in one task."""
    o = table(spark, sf, "orders")
    flags = o.groupBy("o_custkey").agg(F.max(F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)).alias("p"))
    return o.join(flags, "o_custkey").select("o_orderkey", F.when(F.col("p") == 1, "has pending").otherwise("none").alias("flag"))


@query("w06_percent_rank", """
SELECT c_custkey, round(percent_rank() OVER (ORDER BY c_acctbal NULLS LAST) * 100) AS low, round(percent_rank() OVER (ORDER BY k DESC NULLS LAST) * 100) AS high
FROM (SELECT *, CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(floor(c_acctbal / 100) AS INTEGER) END AS k FROM customer)""")
def w06(spark, sf):
    c = table(spark, sf, "customer").selectExpr(
        "c_custkey", "c_acctbal AS a", "CASE WHEN c_mktsegment <> 'BUILDING' THEN CAST(floor(c_acctbal / 100) AS INT) END AS k")
    r = ranking.pct_rank(c, "c_custkey", {"a": "asc", "k": "desc"})
    return r.select("c_custkey", C.rounded(F.col("a_pct") * 100, 0).alias("low"), C.rounded(F.col("k_pct") * 100, 0).alias("high"))


@query("w07_window_over_aggregate", "SELECT p_brand, count(*) AS n, count(*) - min(count(*)) OVER () AS above FROM part GROUP BY p_brand")
def w07(spark, sf):
    per = count_by(table(spark, sf, "part"), "p_brand")
    return per.withColumn("above", F.col("n") - F.min("n").over(Window.partitionBy()))  # one row per brand


@query("w08_order_by_group_total", """
SELECT c_custkey, c_nationkey, max(c_acctbal) OVER (PARTITION BY c_nationkey) AS best FROM customer""")
def w08(spark, sf):
    c = table(spark, sf, "customer")
    best = c.groupBy("c_nationkey").agg(F.max("c_acctbal").alias("best"))
    return c.join(best, "c_nationkey").orderBy(F.col("best").desc(), "c_nationkey", "c_custkey").select("c_custkey", "c_nationkey", "best")


@query("w09_best_per_category", """
SELECT category, p_partkey FROM (SELECT 'size' AS category, p_partkey, CAST(p_size AS DOUBLE) AS v FROM part UNION ALL
  SELECT 'price', p_partkey, p_retailprice FROM part) QUALIFY row_number() OVER (PARTITION BY category ORDER BY v DESC, p_partkey) = 1""")
def w09(spark, sf):
    long = table(spark, sf, "part").selectExpr("p_partkey", "stack(2, 'size', CAST(p_size AS DOUBLE), 'price', p_retailprice) AS (category, v)")
    return long.groupBy("category").agg(F.min_by("p_partkey", F.struct(-F.col("v"), "p_partkey")).alias("p_partkey"))


# sorts -------------------------------------------------------------------------------------------------------------

@query("t01_multi_key_sort", "SELECT s_nationkey, s_acctbal, s_suppkey FROM supplier ORDER BY s_nationkey, s_acctbal DESC")
def t01(spark, sf):
    return table(spark, sf, "supplier").orderBy("s_nationkey", F.col("s_acctbal").desc()).select("s_nationkey", "s_acctbal", "s_suppkey")


@query("t02_sort_by_case", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def t02(spark, sf):
    s = F.col("o_orderstatus")
    return count_by(table(spark, sf, "orders"), "o_orderstatus").orderBy(F.when(s == "P", 1).when(s == "O", 2).otherwise(3))


@query("t03_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def t03(spark, sf):
    return ranking.top_n(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 10, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("t04_top_n_resorted", "SELECT * FROM (SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 10) ORDER BY ts", times=["ts"])
def t04(spark, sf):
    return ranking.top_n(table(spark, sf, "events").select("event_id", "ts"), 10, [F.col("ts").desc(), F.col("event_id").desc()]).orderBy("ts", "event_id")


@query("t05_top_by_row_number", """
SELECT o_custkey, n, row_number() OVER (ORDER BY n DESC, o_custkey) AS rn FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) QUALIFY rn <= 3""")
def t05(spark, sf):
    return ranking.top_n(count_by(table(spark, sf, "orders"), "o_custkey"), 3, [F.col("n").desc(), F.col("o_custkey")], "rn")


@query("t06_nulls_last", f"SELECT l_partkey, CAST({EXPR['rating']} AS DOUBLE) AS rating FROM lineitem ORDER BY rating DESC NULLS LAST, l_partkey LIMIT 5")
def t06(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_partkey", f"CAST({EXPR['rating']} AS DOUBLE) AS rating")
    return ranking.top_n(rows, 5, [F.col("rating").desc_nulls_last(), F.col("l_partkey")])


@query("t07_all_entry_first", "SELECT 'All' AS c_mktsegment UNION ALL SELECT DISTINCT c_mktsegment FROM customer")
def t07(spark, sf):
    from ..plans.analytics.common import with_all
    return with_all(table(spark, sf, "customer"), "c_mktsegment")


# set operations ----------------------------------------------------------------------------------------------------

@query("s01_primary_and_fallback", """
SELECT s_suppkey AS k, s_name AS name FROM supplier UNION ALL SELECT DISTINCT l_partkey, NULL FROM lineitem WHERE l_partkey NOT IN (SELECT s_suppkey FROM supplier)""")
def s01(spark, sf):
    master = table(spark, sf, "supplier").selectExpr("s_suppkey AS k", "s_name AS name")
    return keys.with_fallback(master, table(spark, sf, "lineitem").select(F.col("l_partkey").alias("k")).distinct(), "k")


@query("s02_static_members", "SELECT label AS result, count(match_sk) AS n FROM g_result LEFT JOIN g_teamfact ON match_result_sk = sk GROUP BY label")
def s02(spark, sf):
    w = warehouse(spark, sf)
    members = dims.dim_match_result(spark).withColumnRenamed("match_result", "result")
    return members.join(count_by(w.get("fct_team_matches"), "match_result_sk"), "match_result_sk", "left").select(
        "result", F.coalesce("n", F.lit(0)).alias("n"))


@query("s03_average_and_one", """
SELECT 'all' AS source, event_type, count(*) AS n FROM events GROUP BY event_type UNION ALL SELECT 'user 8', event_type, count(*) FROM events WHERE user_id = 8 GROUP BY event_type""")
def s03(spark, sf):
    e = table(spark, sf, "events")
    part = lambda df, name: count_by(df, "event_type").withColumn("source", F.lit(name))
    return part(e, "all").unionByName(part(e.filter("user_id = 8"), "user 8"))


@query("s04_union_of_checks", """
SELECT 'no customer' AS failed, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'no part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)""")
def s04(spark, sf):
    from ..operators.quality import missing_in
    one = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("failed"), "n")
    return one(missing_in(table(spark, sf, "orders"), table(spark, sf, "customer"), "o_custkey", "c_custkey"), "no customer").unionByName(
        one(missing_in(table(spark, sf, "lineitem"), table(spark, sf, "part"), "l_partkey", "p_partkey"), "no part"))


@query("s05_unpivot", """
SELECT l_returnflag, col, count(*) AS n FROM (SELECT l_returnflag, unnest(['l_quantity', 'l_tax']) AS col, unnest([l_quantity, nullif(l_tax, 0)]) AS val FROM lineitem)
WHERE val IS NOT NULL GROUP BY ALL""")
def s05(spark, sf):
    l = table(spark, sf, "lineitem").selectExpr("l_returnflag", "l_quantity", "nullif(l_tax, 0D) AS l_tax")
    return count_by(shape.unpivot_columns(l, ["l_returnflag"], ["l_quantity", "l_tax"]), "l_returnflag", "col")


# scalars -----------------------------------------------------------------------------------------------------------

@query("f01_json_extract", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def f01(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("f02_json_array", "SELECT l_orderkey AS id, 2 AS n, l_suppkey AS last_part FROM lineitem")
def f02(spark, sf):
    d = _line_docs(spark, sf).withColumn("l", F.from_json("raw_json", "lines array<struct<part: bigint>>")["lines"])
    return d.select("id", F.json_array_length(F.get_json_object("raw_json", "$.lines")).alias("n"), F.element_at("l", -1)["part"].alias("last_part"))


@query("f03_text_casts", "SELECT o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS price FROM orders")
def f03(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", C.int_from_text(F.col("o_totalprice").cast("string")).alias("price"))


@query("f04_try_cast", "SELECT doc_id, TRY_CAST(lang AS INTEGER) AS bad, TRY_CAST(CAST(n_chars AS VARCHAR) AS INTEGER) AS good FROM documents")
def f04(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.col("lang").try_cast("int").alias("bad"), F.col("n_chars").cast("string").try_cast("int").alias("good"))


@query("f05_half_even", "SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS INTEGER) AS half FROM lineitem")
def f05(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", C.int_from_double(F.col("l_quantity") / 2).alias("half"))


@query("f06_boolean_text", "SELECT event_type, CAST(sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS DOUBLE) AS big FROM events GROUP BY event_type")
def f06(spark, sf):
    flag = C.stat_value((F.col("value") > 20).cast("string"))
    return table(spark, sf, "events").groupBy("event_type").agg(F.sum(flag).alias("big"))


@query("f07_null_handling", "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'pending') AS state FROM orders")
def f07(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.coalesce(F.nullif(F.col("o_orderstatus"), F.lit("P")), F.lit("pending")).alias("state"))


@query("f08_concat_null", "SELECT p_partkey, p_brand || ' - ' || nullif(p_type, 'ECONOMY') AS label FROM part")
def f08(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.concat("p_brand", F.lit(" - "), F.nullif(F.col("p_type"), F.lit("ECONOMY"))).alias("label"))


@query("f09_split_part", "SELECT page_id, split_part(url, '://', 2) AS rest, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages")
def f09(spark, sf):
    part = lambda c, d, i: F.split_part(c, F.lit(d), F.lit(i))
    rest = part(F.col("url"), "://", 2)
    return table(spark, sf, "pages").select("page_id", rest.alias("rest"), part(rest, "/", 1).alias("host"))


@query("f10_left_right", "SELECT c_custkey, left(c_name, 4) AS a, right(c_name, 3) AS b, substr(c_name, 3, 2) AS c FROM customer")
def f10(spark, sf):
    n = F.col("c_name")
    return table(spark, sf, "customer").select("c_custkey", F.left(n, F.lit(4)).alias("a"), F.right(n, F.lit(3)).alias("b"), F.substring(n, 3, 2).alias("c"))


@query("f11_lpad", "SELECT p_partkey, lpad(CAST(p_size AS VARCHAR), 3, '0') AS size FROM part")
def f11(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.lpad(F.col("p_size").cast("string"), 3, "0").alias("size"))


@query("f12_trim_replace", "SELECT doc_id, trim(replace(source, 'a', ' ')) AS cleaned FROM documents")
def f12(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.trim(F.replace(F.col("source"), F.lit("a"), F.lit(" "))).alias("cleaned"))


_DAY = "CAST(o_orderdate AS DATE)"


@query("f14_date_parts", f"""
SELECT DISTINCT {_DAY} AS day, CAST(year({_DAY}) AS INTEGER) AS y, CAST(month({_DAY}) AS INTEGER) AS m, CAST(day({_DAY}) AS INTEGER) AS d,
  CAST(quarter({_DAY}) AS INTEGER) AS q, CAST(weekofyear({_DAY}) AS INTEGER) AS w, CAST(isodow({_DAY}) AS INTEGER) AS dow FROM orders""", dates=["day"])
def f14(spark, sf):
    d = F.col("day")
    return table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct().select(
        "day", F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("d"), F.quarter(d).alias("q"), F.weekofyear(d).alias("w"), (F.weekday(d) + 1).alias("dow"))


@query("f15_names", f"SELECT DISTINCT monthname({_DAY}) AS month, dayname({_DAY}) AS day FROM orders")
def f15(spark, sf):
    return table(spark, sf, "orders").select(F.date_format("o_orderdate", "MMMM").alias("month"), F.date_format("o_orderdate", "EEEE").alias("day")).distinct()


@query("f16_strftime", "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS a, strftime(o_orderdate, '%d %b') AS b, strftime(o_orderdate, '%Y%m%d') AS c FROM orders")
def f16(spark, sf):
    f = lambda p: F.date_format("o_orderdate", p)
    return table(spark, sf, "orders").select(f("yyyy-MM-dd").alias("a"), f("dd MMM").alias("b"), f("yyyyMMdd").alias("c")).distinct()


@query("f17_local_time", "SELECT match_id, kick_off_time FROM g_match WHERE match_sk > 0")
def f17(spark, sf):
    f = warehouse(spark, sf).silver.fixtures()
    return f.select(F.col("id").alias("match_id"), F.date_format(C.local_time(F.col("starting_at")), "HH:mm").alias("kick_off_time"))


@query("f18_date_arithmetic", f"SELECT DISTINCT {_DAY} - 7 AS before, {_DAY} + 30 AS after FROM orders", dates=["before", "after"])
def f18(spark, sf):
    return table(spark, sf, "orders").select(F.date_sub("o_orderdate", 7).alias("before"), F.date_add("o_orderdate", 30).alias("after")).distinct()


@query("f19_date_key", f"SELECT DISTINCT CAST(strftime({_DAY}, '%Y%m%d') AS INTEGER) AS date_sk FROM orders")
def f19(spark, sf):
    return table(spark, sf, "orders").select(C.date_key(F.col("o_orderdate")).alias("date_sk")).distinct()


@query("f20_math", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / 7, 1) AS r, abs(l_quantity - 25) AS a, floor(l_extendedprice / 1000) AS f, ceil(l_extendedprice / 1000) AS c,
  greatest(l_quantity, 10) AS g FROM lineitem""")
def f20(spark, sf):
    p, q = F.col("l_extendedprice"), F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", C.rounded(p / 7, 1).alias("r"), F.abs(q - 25).alias("a"), F.floor(p / 1000).cast("double").alias("f"),
        F.ceil(p / 1000).cast("double").alias("c"), F.greatest(q, F.lit(10.0)).alias("g"))


# upserts and keys --------------------------------------------------------------------------------------------------

@query("u01_delete_insert", f"""
SELECT event_id, user_id, event_type FROM events t WHERE ts < {CUT} AND NOT EXISTS (SELECT 1 FROM events b WHERE b.ts >= {CUT} AND b.user_id = t.user_id
  AND b.event_type = t.event_type) UNION ALL SELECT event_id, user_id, event_type FROM events WHERE ts >= {CUT}""")
def u01(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return upsert.delete_insert(e.filter(f"ts < {CUT_NTZ}"), e.filter(f"ts >= {CUT_NTZ}"), ["user_id", "event_type"]).drop("ts")


# the dimension as it was: customers in credit, numbered; the load: every customer with a changed name
_OLD = "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS sk FROM customer WHERE c_acctbal > 0"


@query("u02_merge_scd1", f"""
SELECT coalesce(o.sk, (SELECT max(sk) FROM ({_OLD})) + n.rn) AS sk, n.c_custkey, n.name AS c_name
FROM (SELECT c_custkey, c_name || ' *' AS name, row_number() OVER (ORDER BY c_custkey) AS rn FROM customer) n LEFT JOIN ({_OLD}) o USING (c_custkey)""")
def u02(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    old = keys.dense_number(c.filter("c_acctbal > 0").select("c_custkey", "c_name"), "c_custkey", "sk")
    source = c.select("c_custkey", F.concat("c_name", F.lit(" *")).alias("c_name"))
    return keys.merge_scd1(old, source, "c_custkey", "sk", ["c_name"])


@query("u03_stable_keys_dense", f"""
SELECT coalesce(o.sk, (SELECT max(sk) FROM ({_OLD})) + row_number() OVER (PARTITION BY o.sk IS NULL ORDER BY c_custkey)) AS sk, c_custkey
FROM customer LEFT JOIN ({_OLD}) o USING (c_custkey)""")
def u03(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    old = keys.dense_number(c.filter("c_acctbal > 0").select("c_custkey", "c_name"), "c_custkey", "sk")
    return keys.merge_scd1(old, c.select("c_custkey", "c_name"), "c_custkey", "sk", ["c_name"], dense=True).select("sk", "c_custkey")


@query("u04_dense_number", "SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderkey) AS sk FROM orders WHERE o_orderstatus = 'F'")
def u04(spark, sf):
    return keys.dense_number(table(spark, sf, "orders").filter("o_orderstatus = 'F'").select("o_orderkey"), "o_orderkey", "sk", 1000)


@query("u05_sentinels", "SELECT s_suppkey AS sk, s_name AS name FROM supplier WHERE s_suppkey > 0 UNION ALL SELECT * FROM (VALUES (-1, 'Unknown'), (-2, 'Not Applicable'))")
def u05(spark, sf):
    dim = table(spark, sf, "supplier").filter("s_suppkey > 0").selectExpr("s_suppkey AS sk", "s_name AS name")
    rows = [{"sk": -1, "name": "Unknown"}, {"sk": -2, "name": "Not Applicable"}]
    return keys.with_sentinels(keys.with_sentinels(dim, "sk", rows), "sk", rows)


@query("u06_foreign_keys", """
SELECT l_orderkey, l_linenumber, l_suppkey, coalesce(s_suppkey + 100, -1) AS supplier_sk FROM lineitem
LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey""")
def u06(spark, sf):
    dim = table(spark, sf, "supplier").filter("s_acctbal > 0").selectExpr("s_suppkey", "s_suppkey + 100 AS supplier_sk")
    return keys.resolve_fk(table(spark, sf, "lineitem"), dim, "l_suppkey", "s_suppkey", "supplier_sk").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "supplier_sk")


@query("u07_fallback", """
SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_acctbal > 0 UNION ALL SELECT DISTINCT o_custkey, NULL FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def u07(spark, sf):
    master = table(spark, sf, "customer").filter("c_acctbal > 0").selectExpr("c_custkey AS k", "c_name AS name")
    return keys.with_fallback(master, table(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct(), "k")


@query("u08_identity_override", "SELECT o_orderkey, CASE WHEN o_custkey IN (1, 2) THEN 0 ELSE o_custkey END AS o_custkey FROM orders")
def u08(spark, sf):
    aliases = values(spark, "a bigint, c bigint", [(1, 0), (2, 0)])
    return keys.canonical_id(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), aliases, "o_custkey", "a", "c")


@query("u09_correction_overlay", "SELECT s.fixture_id, s.team_id, coalesce(x.fixed, s.ft) AS goals FROM z_score s LEFT JOIN z_fix x USING (fixture_id, team_id)")
def u09(spark, sf):
    s = warehouse(spark, sf).silver
    goals = s.scores().filter("description = 'CURRENT'").select("fixture_id", "team_id", "goals")
    seed = s.score_corrections().withColumn("goals_scored_corrected", F.col("goals_scored_corrected").cast("bigint"))
    return keys.overlay(goals, seed, ["fixture_id", "team_id"], {"goals": "goals_scored_corrected"})


@query("u10_name_overlay", """
SELECT s_suppkey AS team_id, coalesce(display_name, s_name) AS name, code FROM supplier LEFT JOIN z_curated ON team_id = s_suppkey""")
def u10(spark, sf):
    teams = table(spark, sf, "supplier").selectExpr("s_suppkey AS team_id", "s_name AS name")
    return keys.overlay(teams, warehouse(spark, sf).silver.team_names(), "team_id", {"name": "display_name", "code": "team_code"})


@query("u11_two_sided_rows", """
SELECT o_orderkey AS fixture_id, 1 AS side_sk, home_team AS team_id, away_team AS rival_id FROM z_match
UNION ALL SELECT o_orderkey, 2, away_team, home_team FROM z_match""")
def u11(spark, sf):
    m = warehouse(spark, sf).silver._matches().select(F.col("o_orderkey").alias("fixture_id"), "home_team", "away_team")
    return shape.two_sided(m, ["fixture_id"], {"team_id": "home_team", "rival_id": "away_team"}, {"team_id": "away_team", "rival_id": "home_team"})


@query("u12_points", "SELECT match_result_sk, points_earned, count(*) AS n FROM g_teamfact GROUP BY ALL")
def u12(spark, sf):
    return count_by(warehouse(spark, sf).get("fct_team_matches"), "match_result_sk", "points_earned")


@query("u13_round_renumber", "SELECT match_round_type, match_round_number, count(*) AS n FROM g_match WHERE match_sk > 0 GROUP BY ALL")
def u13(spark, sf):
    s = warehouse(spark, sf).silver
    return count_by(dims.match_source(s.fixtures(), s.stages(), s.participants(), s.scores(), s.team_names()), "match_round_type", "match_round_number")


@query("u14_keeper_goals", "SELECT fixture_id, player_id, n AS keeper_goals FROM z_keeper")
def u14(spark, sf):
    from ..plans.facts import keeper_goals
    w = warehouse(spark, sf)
    sheet = w.get("match_sheet")
    shown = w.get("appearances").join(sheet.filter("is_finished").select("fixture_id"), "fixture_id", "left_semi")
    return keeper_goals(shown, w.silver.events(), sheet)


@query("u15_appearances", "SELECT fixture_id, player_id, team_id, type_id, position_id, minutes_played FROM z_shown")
def u15(spark, sf):
    w = warehouse(spark, sf)
    finished = w.silver.fixtures().filter(C.is_finished(F.col("state_developer_name"))).select(F.col("id").alias("fixture_id"))
    return w.get("appearances").join(finished, "fixture_id", "left_semi").select("fixture_id", "player_id", "team_id", "type_id", "position_id", "minutes_played")


@query("u16_recent_window", "SELECT match_sk, team_side_sk FROM g_teamfact WHERE date_sk >= 20250701")
def u16_window(spark, sf):
    """The rows of a rolling window; rows without a date fall out."""
    return warehouse(spark, sf).get("fct_team_matches").filter(C.recent_date_key(F.col("date_sk"), 7, "2025-07-08")).select("match_sk", "team_side_sk")


@query("u16_incremental_fact", "SELECT match_sk, team_side_sk, date_sk, goals_scored, points_earned, match_result_sk FROM g_teamfact")
def u16(spark, sf):
    """A stored fact of an earlier day, on which matches of the window were missing, unfinished or in another month; after the
    refresh it is what a full build gives, under the same keys."""
    w = warehouse(spark, sf)
    dims, sheet = w.dims(), w.get("match_sheet")
    late = F.coalesce(F.col("starting_at").cast("date") >= F.lit("2025-07-01").cast("date"), F.lit(False))
    part = F.pmod("fixture_id", F.lit(3))
    before = sheet.filter(~late | (part > 0)).withColumns({
        "is_finished": F.when(late & (part == 1), False).otherwise(F.col("is_finished")),
        "starting_at": F.when(late & (part == 2), F.col("starting_at") - F.expr("INTERVAL 400 DAYS")).otherwise(F.col("starting_at"))})
    path = f"{space(spark)}/team_matches"
    first = facts.fct_team_matches(before, dims).withColumn("month", facts.month_of(F.col("date_sk")))
    storage.upsert_partitions(spark, path, first, ["match_sk", "team_side_sk"], "month")
    facts.refresh_team_matches(path, sheet, dims, "2025-07-08", 7)
    return storage.stored(spark, path, first.schema).select("match_sk", "team_side_sk", "date_sk", "goals_scored", "points_earned", "match_result_sk")


@query("u17_season_tags", "SELECT season, is_current_season, count(*) AS n FROM g_date GROUP BY ALL")
def u17(spark, sf):
    return count_by(warehouse(spark, sf).get("dim_date"), "season", "is_current_season")


@query("st01_stream_load", """
SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CASE WHEN event_id % 4 = 0 THEN 2 ELSE 1 END AS version FROM events""")
def st01(spark, sf):
    """The landed events as a stream of several files, a quarter of which come again later: flatten, upsert by key into the
    partitions a micro-batch touches, stop when everything is read."""
    root = space(spark)
    events = table(spark, sf, "events").withColumn("version", F.lit(1))
    (events.repartition(3).write.parquet(f"{root}/landed"))
    source = incremental.landed_stream(spark, f"{root}/landed", events.schema, files_per_batch=2)
    flat = lambda df: df.select("event_id", "user_id", "event_type", C.from_text(F.get_json_object("props", "$.k"), "int").alias("k"), "version")
    load = lambda: incremental.stream_upsert_partitions(spark, source, f"{root}/events", ["event_id", "event_type"], "event_type", f"{root}/progress", flat)
    load()
    again = events.filter("event_id % 4 = 0").withColumn("version", F.lit(2))
    again.coalesce(1).write.mode("append").parquet(f"{root}/landed")
    load()
    return storage.stored(spark, f"{root}/events", flat(events).schema)


@query("st01_replayed_batches", """
SELECT event_id, user_id, CASE WHEN event_id % 5 = 0 THEN concat('late ', event_type) ELSE event_type END AS event_type,
  CASE WHEN event_id % 5 = 0 THEN 2 ELSE 1 END AS version FROM events""")
def st01_replayed(spark, sf):
    """Batches that come again under their old numbers with other rows change nothing; rows that come back in another partition
    leave the old one."""
    path = f"{space(spark)}/events"
    first = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.lit(1).alias("version"))
    late = first.filter("event_id % 5 = 0").select("event_id", "user_id", F.concat(F.lit("late "), "event_type").alias("event_type"), F.lit(2).alias("version"))
    for number, batch in ((0, first), (1, late), (1, first.withColumn("version", F.lit(3))), (0, late.withColumn("version", F.lit(4)))):
        incremental.upsert_once(spark, batch, number, path, ["event_id"], "event_type", "events")
    return storage.stored(spark, path, first.schema)
