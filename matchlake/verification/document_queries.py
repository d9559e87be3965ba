"""Silver tables M-01 ... M-36: documents are built from the given tables, flattened, and must equal the plain columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions import codes
from ..operators.flatten import Model
from ..operators.literals import values
from ..plans import legacy, silver
from .registry import register

# model -> (table, key): every row of the table becomes one document
SOURCES = {
    "core_continents": ("region", "r_regionkey"), "core_countries": ("nation", "n_nationkey"),
    "core_regions": ("customer", "c_custkey"), "league": ("region", "r_regionkey"), "seasons": ("supplier", "s_suppkey"),
    "stages": ("supplier", "s_suppkey"), "rounds": ("customer", "c_custkey"), "states": ("nation", "n_nationkey"),
    "types": ("part", "p_partkey"), "tv_stations": ("supplier", "s_suppkey"), "teams": ("supplier", "s_suppkey"),
    "venues": ("supplier", "s_suppkey"), "players": ("part", "p_partkey"), "referees": ("supplier", "s_suppkey"),
    "rivals": ("customer", "c_custkey"), "round_statistics": ("orders", "o_orderkey"),
    "stage_statistics": ("orders", "o_orderkey"), "topscorers": ("part", "p_partkey"),
    "stage_topscorers": ("part", "p_partkey"), "team_coaches": ("supplier", "s_suppkey"),
    "standing_details": ("customer", "c_custkey"), "standings": ("customer", "c_custkey")}
DEFAULT_SOURCE = ("orders", "o_orderkey")
ALIASES = [(16, 1), (17, 1)]
TIME = {"spark": "TIMESTAMP_NTZ", "sql": "TIMESTAMP"}


def value(kind: str, k: str, j: int, typed: bool, engine: str) -> str:
    """The generated value of field ``j``: as stored in the document, or typed as the flattened column."""
    day = f"DATE '2000-01-01' + CAST(({k} + {j}) % 9000 AS INT)"
    match kind:
        case "int": return f"CASE WHEN ({k} + {j}) % 11 <> 0 THEN CAST(({k} * 7 + {j}) % 1000 AS INT) END"
        case "bigint": return f"CAST({k} * 1000 + {j} AS BIGINT)"
        case "boolean": return f"({k} + {j}) % 2 = 0"
        case "double": return f"CAST(({k} + {j}) % 360 AS DOUBLE) / 4"
        case "date": return day
        case "timestamp":
            text = f"concat(CAST({day} AS STRING), ' 10:20:30')"
            return f"CAST({text} AS {TIME[engine]})" if typed else text
        case "stat":
            if typed:
                return (f"CASE WHEN {k} % 4 = 0 THEN CAST(1 AS DOUBLE) WHEN {k} % 4 = 1 THEN NULL "
                        f"WHEN {k} % 4 = 2 THEN CAST(7.5 AS DOUBLE) ELSE CAST({k} % 90 AS DOUBLE) END")
            return (f"CASE WHEN {k} % 4 = 0 THEN 'true' WHEN {k} % 4 = 1 THEN 'abc' WHEN {k} % 4 = 2 THEN '7.5' "
                    f"ELSE CAST({k} % 90 AS STRING) END")
    return f"concat('text ', CAST(({k} + {j}) % 97 AS STRING))"


def _struct(leaves: list[tuple[str, str]]) -> str:
    """named_struct expression with nested objects for dotted paths."""
    tree: dict = {}
    for path, expr in leaves:
        *parents, leaf = path.split(".")
        node = tree
        for p in parents:
            node = node.setdefault(p, {})
        node[leaf] = expr
    render = lambda node: "named_struct(" + ", ".join(
        f"'{n}', {render(v) if isinstance(v, dict) else v}" for n, v in node.items()) + ")"
    return render(tree)


def envelope(engine: str) -> dict[str, str]:
    return {"@id": "k", "@_season_id": "CAST(2010 + k % 10 AS INT)",
            "@_fixture_date": "DATE '2020-01-01' + CAST(k % 365 AS INT)",
            "@season": "CAST(2010 + k % 10 AS INT)", "@league_id": "CAST(k % 7 AS INT)", "@fixture_id": "k",
            "_ingested_at": f"CAST(DATE '2024-01-01' + CAST(k % 30 AS INT) AS {TIME[engine]})"}


ITEMS, SUBITEMS = 3, 2
PRESENT = "k % 11 <> 0 AND k % 13 <> 0"


def document_sql(model: Model) -> str:
    """Spark expression for the JSON body of one document."""
    leaves = [(path, value(kind, "k", 100 + j, False, "spark"))
              for j, (_, path, kind) in enumerate(model.columns(model.parent)) if not path.startswith("@")]
    keys = ["k", "(k * 10 + p)", "((k * 10 + p) * 10 + q)"]
    body = [(path, value(kind, keys[len(model.explode)], j, False, "spark"))
            for j, (_, path, kind) in enumerate(model.columns(model.fields)) if not path.startswith("@")]
    if not model.explode:
        if model.required == "weatherreport":
            inner = _struct([(p.split(".", 1)[1], e) for p, e in body])
            return f"to_json(named_struct('weatherreport', CASE WHEN k % 5 <> 0 THEN {inner} END))"
        return f"to_json({_struct(leaves + body)})"
    items = _struct(body)
    if len(model.explode) == 2:
        outer = [(path, value(kind, keys[1], 200 + j, False, "spark")) for j, (_, path, kind) in enumerate(model.columns(model.middle))]
        items = _struct([*outer, (model.explode[1], f"transform(sequence(0, {SUBITEMS - 1}), q -> {items})")])
    array = f"transform(sequence(0, {ITEMS - 1}), p -> {items})"
    # every 11th document has an empty array, every 13th none at all
    array = f"CASE WHEN k % 13 = 0 THEN NULL WHEN k % 11 = 0 THEN slice({array}, 1, 0) ELSE {array} END"
    return f"to_json({_struct([*leaves, (model.explode[0], array)])})"


def standings_sql(model: Model) -> str:
    leaves = [(path, value(kind, "k", 100 + j, False, "spark"))
              for j, (_, path, kind) in enumerate(model.columns(model.parent)) if not path.startswith("@")]
    numbers = ", ".join(str(c) for c in [*codes.STANDING_STATS, codes.STREAK_STAT])
    details = (f"transform(filter(array({numbers}), c -> (k + c) % 5 <> 0), c -> named_struct('type_id', c, 'value', "
               f"CASE WHEN c = {codes.STREAK_STAT} THEN concat('W', CAST(k % 5 AS STRING)) ELSE CAST((k + c) % 40 AS STRING) END))")
    return f"to_json({_struct([*leaves, ('details', f'CASE WHEN k % 13 <> 0 THEN {details} END')])})"


def _dealt(rows: DataFrame) -> DataFrame:
    """Keys dealt to all tasks: a document takes long to make and to parse, and a table may be one file that one task reads."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "k")


def documents(spark: SparkSession, sf: str, name: str, models=silver.MODELS) -> DataFrame:
    model = models[name]
    table, key = SOURCES.get(name, DEFAULT_SOURCE)
    e = envelope("spark")
    body = standings_sql(model) if name == "standings" else document_sql(model)
    rows = _dealt(spark.read.parquet(f"{sf}/{table}.parquet").selectExpr(f"CAST({key} AS BIGINT) AS k").filter("k IS NOT NULL"))
    if models is legacy.MODELS:
        # bare arrays, keyed by season and league or by fixture
        array = f"get_json_object({body}, '$.items')"
        return rows.selectExpr(f"{array} AS raw_json", f"{e['@season']} AS season", f"{e['@league_id']} AS league_id",
                               "k AS fixture_id", f"{e['_ingested_at']} AS _ingested_at")
    return rows.selectExpr("k AS id", f"{body} AS raw_json", f"{e['@_season_id']} AS _season_id",
                           f"{e['@_fixture_date']} AS _fixture_date", f"{e['_ingested_at']} AS _ingested_at")


def expected(name: str, models=silver.MODELS) -> tuple[str, list[str], list[str]]:
    model = models[name]
    table, key = SOURCES.get(name, DEFAULT_SOURCE)
    e, cols, dates, times = envelope("sql"), [], [], ["_ingested_at"]
    depth = len(model.explode)
    element = ["k", "e", "d"][depth]
    parts = [(model.parent, "k", 100), (model.middle, "e", 200), (model.fields, element, 0)]
    for part, base, offset in parts if name != "standings" else parts[:1]:
        for j, (out, path, kind) in enumerate(model.columns(part)):
            expr = e[path] if path.startswith("@") else value(kind, base, offset + j, True, "sql")
            if name == "fixture_referees" and out == "referee_id":
                expr = f"CASE WHEN ({expr}) IN (16, 17) THEN 1 ELSE ({expr}) END"
            cols.append(f"{expr} AS {out}")
            (dates if kind == "date" else times if kind == "timestamp" else []).append(out)
    if name == "standings":
        cols += [f"CASE WHEN (k + {c}) % 5 <> 0 THEN CAST((k + {c}) % 40 AS INT) END AS {n}" for c, n in codes.STANDING_STATS.items()]
        cols.append(f"CASE WHEN (k + {codes.STREAK_STAT}) % 5 <> 0 THEN 'W' || (k % 5) END AS streak")
    cols.append(f"{e['_ingested_at']} AS _ingested_at")
    source = f"(SELECT CAST({key} AS BIGINT) AS k FROM {table} WHERE {key} IS NOT NULL)"
    where = "true"
    if name == "standings":
        where = "k % 13 <> 0"
    elif depth:
        source = f"(SELECT k, k * 10 + p AS e FROM {source}, range({ITEMS}) r(p) WHERE {PRESENT})"
        if depth == 2:
            source = f"(SELECT k, e, e * 10 + q AS d FROM {source}, range({SUBITEMS}) r(q))"
    elif model.required == "weatherreport":
        where = "k % 5 <> 0"
    elif model.required:
        j = [o for o, _, _ in model.columns(model.fields)].index(model.required)
        where = f"({value('int', 'k', j, True, 'sql')}) IS NOT NULL"
    if name == "referees" and models is silver.MODELS:
        where = "k NOT IN (16, 17)"
    return f"SELECT {', '.join(cols)} FROM {source} WHERE {where}", dates, times


def _run(name: str):
    def run(spark, sf):
        aliases = values(spark, "referee_id bigint, canonical_referee_id bigint", ALIASES)
        return silver.build(name, documents(spark, sf, name), aliases)
    return run


_ORDER = ["core_continents", "core_countries", "core_regions", "league", "seasons", "stages", "rounds", "states", "types",
          "tv_stations", "teams", "venues", "players", "referees", "rivals", "round_statistics", "stage_statistics",
          "topscorers", "stage_topscorers", "fixtures", "fixture_weather", "fixture_coaches", "fixture_events",
          "fixture_formations", "fixture_lineups", "fixture_lineup_details", "fixture_participants", "fixture_periods",
          "fixture_referees", "fixture_scores", "fixture_sidelined", "fixture_statistics", "fixture_timeline",
          "team_coaches", "standing_details", "standings"]
for _i, _name in enumerate(_ORDER, 1):
    _sql, _dates, _times = expected(_name)
    register(f"m{_i:02d}_{_name}", _run(_name), _sql, dates=_dates, times=_times)

for _name in legacy.MODELS:
    _sql, _dates, _times = expected(_name, legacy.MODELS)
    register(f"ar15_{_name}", (lambda n: lambda spark, sf: legacy.build(n, documents(spark, sf, n, legacy.MODELS)))(_name), _sql,
             dates=_dates, times=_times)


# deeper tables of the older feed ------------------------------------------------------------------------------------

def _object(text: str, key: str, offset: int, *more: tuple[str, str]) -> str:
    """A generated object with the fields of a list."""
    return _struct([*((path, value(kind, key, offset + j, False, "spark")) for j, (_, path, kind) in enumerate(legacy.fields(text))), *more])


def _typed(text: str, key: str, offset: int) -> list[str]:
    return [f"{value(kind, key, offset + j, True, 'sql')} AS {column}" for j, (column, _, kind) in enumerate(legacy.fields(text))]


def _bare(spark, sf, body: str) -> DataFrame:
    """Orders as documents of the older feed, in envelopes of season, league and fixture."""
    e = envelope("spark")
    rows = _dealt(spark.read.parquet(f"{sf}/orders.parquet").selectExpr("CAST(o_orderkey AS BIGINT) AS k"))
    return rows.selectExpr("k AS fixture_id", f"{e['@season']} AS season", f"{e['@league_id']} AS league_id",
                           f"{e['_ingested_at']} AS _ingested_at", f"to_json({body}) AS raw_json")


_K = "(SELECT CAST(o_orderkey AS BIGINT) AS k FROM orders)"
_LOADED = f"{envelope('sql')['_ingested_at']} AS _ingested_at"
_MATCH_DOC = lambda spark, sf: _bare(spark, sf, _object(legacy.MATCH, "k", 700))
_PLAYER = "player_id=player.id:int player_name=player.name:string player_photo=player.photo:string"
_each = lambda n, name, body: f"transform(sequence(0, {n - 1}), {name} -> {body})"


def _match_players(spark, sf):
    stats = _each(2, "r", _object(legacy.MATCH_PLAYER, "(k * 1000 + p * 100 + q * 10 + r)", 0))
    players = _each(2, "q", _object(_PLAYER, "(k * 100 + p * 10 + q)", 100, ("statistics", stats)))
    return legacy.match_player_statistics(_bare(spark, sf, _each(2, "p", _object(legacy._TEAM, "(k * 10 + p)", 200, ("players", players)))), _MATCH_DOC(spark, sf))


register("ar02_match_player_statistics", _match_players, f"""
SELECT k AS fixture_id, {", ".join([_LOADED, *_typed(legacy._TEAM, "(k * 10 + p)", 200), *_typed(_PLAYER, "(k * 100 + p * 10 + q)", 100),
    *_typed(legacy.MATCH_PLAYER, "(k * 1000 + p * 100 + q * 10 + r)", 0), *_typed(legacy.MATCH, "k", 700)])}
FROM {_K}, range(2) a(p), range(2) b(q), range(2) c(r)""", times=["_ingested_at", "kick_off"])


def _league_table(spark, sf):
    rows = _each(2, "q", _each(3, "r", _object(legacy.TABLE_ROW, "(k * 100 + q * 10 + r)", 0)))
    return legacy.league_table(_bare(spark, sf, f"array({_object(legacy.TABLE_LEAGUE, 'k', 300, ('league.standings', rows))})"))


register("ar03_league_table", _league_table, f"""
SELECT {envelope('sql')['@season']} AS season, {envelope('sql')['@league_id']} AS league_id, {", ".join([
    _LOADED, *_typed(legacy.TABLE_LEAGUE, "k", 300), *_typed(legacy.TABLE_ROW, "(k * 100 + q * 10 + r)", 0)])}
FROM {_K}, range(2) b(q), range(3) c(r)""", times=["_ingested_at", "updated_at"])


def _leaders(salt: int):
    """Documents of a leaderboard; a player id is unique in its document, and the last of two blocks counts."""
    person = legacy._PERSON.replace("player_id=player.id:int ", "")

    def run(spark, sf):
        blocks = _each(2, "r", _object(legacy._SEASON_STATS, "(k * 100 + p * 10 + r)", salt))
        body = _each(2, "p", _object(person, "(k * 10 + p)", salt + 100, ("player.id", "CAST(k * 2 + p AS INT)"), ("statistics", blocks)))
        return legacy.leaderboard(_bare(spark, sf, body))

    return run, f"""
SELECT {envelope('sql')['@season']} AS season, {envelope('sql')['@league_id']} AS league_id, CAST(k * 2 + p AS INTEGER) AS player_id, {", ".join([
    _LOADED, *_typed(person, "(k * 10 + p)", salt + 100), *_typed(legacy._SEASON_STATS, "(k * 100 + p * 10 + 1)", salt)])}
FROM {_K}, range(2) a(p)"""


for _salt, _board in enumerate(legacy.LEADERBOARDS, 1):
    _fn, _sql = _leaders(_salt)
    register(f"ar05_{_board}", _fn, _sql, times=["_ingested_at"])


def _match_lineups(spark, sf):
    eleven = _each(3, "q", _object(legacy.LINEUP_PLAYER, "(k * 100 + p * 10 + q)", 0))
    bench = f"CASE WHEN k % 3 <> 0 THEN {_each(2, 'q', _object(legacy.LINEUP_PLAYER, '(k * 100 + p * 10 + q + 5)', 0))} END"
    body = _each(2, "p", _object(legacy.LINEUP_TEAM, "(k * 10 + p)", 100, ("startXI", eleven), ("substitutes", bench)))
    return legacy.match_lineups(_bare(spark, sf, body), _MATCH_DOC(spark, sf))


_LINED = "(k * 100 + p * 10 + q)"
register("ar06_match_lineups", _match_lineups, f"""
SELECT * REPLACE (CASE WHEN is_starter THEN player_grid END AS player_grid) FROM (
  SELECT k AS fixture_id, {", ".join([_LOADED, *_typed(legacy.LINEUP_TEAM, "(k * 10 + p)", 100), *_typed(legacy.LINEUP_PLAYER, _LINED, 0),
    *_typed(legacy.MATCH, "k", 700)])}, q < 5 AS is_starter
  FROM {_K}, range(2) a(p), (VALUES (0), (1), (2), (5), (6)) b(q) WHERE q < 5 OR k % 3 <> 0)
WHERE player_id IS NOT NULL""", times=["_ingested_at", "kick_off"])
