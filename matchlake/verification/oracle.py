"""The expected results in standard SQL: the match model as common table expressions, and a composer.

The SQL works on the given tables directly. With the Spark plans it shares the fixed value tables (codes, sentinel rows, lists
of measures and sums) and the arithmetic rules of the adapter.
"""

from __future__ import annotations

import re

from ..functions import codes
from ..plans import adapter as A
from ..plans.dims import SENTINELS
from ..plans.marts import PLAYER_MEASURES, TEAM_SUMS

CTES: dict[str, str] = {}


def lit(v) -> str:
    return "NULL" if v is None else repr(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def in_list(items) -> str:
    return "(" + ", ".join(lit(i) for i in items) + ")"


def rat(num: str, den: str, digits: int | None = None, scale: int = 1) -> str:
    top = f"CAST({num} AS DOUBLE)" if scale == 1 else f"{scale}::DOUBLE * CAST({num} AS DOUBLE)"
    value = f"{top} / NULLIF(CAST({den} AS DOUBLE), 0)"
    return value if digits is None else f"round({value}, {digits})"


def pct(num: str, den: str, digits: int | None = 1) -> str:
    return rat(num, den, digits, 100)


def p90(num: str, minutes: str = "sum(minutes_played)", digits: int | None = 2) -> str:
    return rat(num, minutes, digits, 90)


def isum(x: str) -> str:
    return f"CAST(sum({x}) AS BIGINT)"


def compose(sql: str) -> str:
    """Prefix a query with the expressions it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in ordered and re.search(rf"\b{name}\b", text):
                visit_one(name)

    def visit_one(name: str) -> None:
        visit(re.sub(rf"\b{name}\b", "", CTES[name]))
        if name not in ordered:
            ordered.append(name)

    visit(sql)
    unknown = {n for text in (sql, *(CTES[o] for o in ordered)) for n in re.findall(r"\b(?:FROM|JOIN)\s+([zgy]_\w+)", text)} - set(CTES)
    if unknown:
        raise KeyError(f"no such expression: {', '.join(sorted(unknown))}")
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + sql


# silver ------------------------------------------------------------------------------------------------------------

CTES["z_match"] = f"""
SELECT *, home_no + 1 AS home_team, CASE WHEN o_orderkey % 500 = 7 THEN {A.UNKNOWN_TEAM} ELSE away_no + 1 END AS away_team,
  {A.EXPR['venue_id']} AS venue_id,
  o_orderdate + INTERVAL 288 MONTH + to_hours(CAST(o_orderkey % 24 AS INT)) + to_minutes(CAST(o_orderkey % 4 * 15 AS INT))
    AS starting_at
FROM (SELECT *, {", ".join(f"{A.EXPR[c]} AS {c}" for c in ("season_id", "home_no", "away_no", "stage_no", "state", "state_name"))}
      FROM orders WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL)"""

CTES["z_fixture"] = """
SELECT o_orderkey AS id, 1 AS league_id, season_id, season_id * 10 + stage_no AS stage_id,
  CASE WHEN stage_no = 1 THEN CAST(o_orderkey % 22 + 1 AS VARCHAR) WHEN stage_no < 4 THEN CAST(o_orderkey % 10 + 1 AS VARCHAR)
       WHEN o_orderkey % 3 = 0 THEN 'Final' ELSE CAST(o_orderkey % 2 + 1 AS VARCHAR) END AS round_name,
  venue_id, CASE WHEN venue_id > 100 THEN 'Neutral Ground ' || venue_id WHEN venue_id IS NOT NULL THEN 'Arena ' || venue_id
    END AS venue_name, 'City ' || venue_id AS venue_city, CASE WHEN venue_id IS NOT NULL THEN 'grass' END AS venue_surface,
  venue_id * 100 AS venue_capacity, starting_at, state AS state_developer_name, state_name, starting_at AS ingested
FROM z_match"""

CTES["z_side"] = """
SELECT o_orderkey AS fixture_id, o_orderkey AS ok, o_custkey AS ck, season_id, o_orderstatus AS st, home_team AS team_id,
  'home' AS location, 0 AS side_no, starting_at AS ingested FROM z_match
UNION ALL
SELECT o_orderkey, o_orderkey, o_custkey, season_id, o_orderstatus, away_team, 'away', 1, starting_at FROM z_match"""

CTES["z_score"] = f"""
SELECT fixture_id, team_id, location AS side, goals AS ft,
  CASE WHEN ok % 400 = 3 AND side_no = 0 THEN goals + 1 ELSE goals // 2 END AS ht
FROM (SELECT s.*, CASE WHEN side_no = 0 THEN {A.EXPR['home_goals'].replace('o_orderkey', 'ok').replace('o_custkey', 'ck')}
        ELSE {A.EXPR['away_goals'].replace('o_orderkey', 'ok').replace('o_custkey', 'ck')} END AS goals
      FROM z_side s WHERE st <> 'O' AND ok % 211 <> 0)"""

CTES["z_fix"] = """
SELECT fixture_id, team_id, CASE WHEN side_no = 0 THEN 3 ELSE 0 END AS fixed FROM z_side
WHERE ok % 1000 = 1 AND (side_no = 0 OR ok % 2000 = 1)"""

CTES["z_teamstat"] = """
SELECT fixture_id, team_id,
  CAST(round_even(((ok + side_no * 3) % 12)::DOUBLE + CASE WHEN ok % 250 = 9 THEN 0.5 ELSE 0 END, 0) AS INTEGER) AS corner_kicks,
  CAST(CASE WHEN ok % 13 = 0 THEN NULL WHEN side_no = 0 THEN 40 + ok % 21
       ELSE 60 - ok % 21 + CASE WHEN ok % 300 = 5 THEN 5 ELSE 0 END END AS DECIMAL(5,2)) AS ball_possession_pct,
  CASE WHEN (ck + side_no) % 17 = 0 THEN 1 ELSE 0 END AS red_cards, CAST((ok // 3 + side_no * 2) % 5 AS INTEGER) AS yellow_cards
FROM z_side"""

CTES["z_ref"] = """
SELECT fixture_id, CASE WHEN r IN (16, 17) THEN 1 ELSE r END AS referee_id, type_id, ingested
FROM (SELECT o_orderkey AS fixture_id, o_custkey % 20 + 1 AS r, 6 AS type_id, starting_at AS ingested FROM z_match
      WHERE o_orderkey % 89 <> 0
      UNION ALL SELECT o_orderkey, (o_custkey + 7) % 20 + 1, 7, starting_at FROM z_match WHERE o_orderkey % 89 <> 0)"""

CTES["z_coach"] = """
SELECT fixture_id, team_id, team_id * 10 + season_id % 3 AS coach_id, ok, ingested FROM z_side WHERE (ok + side_no) % 9 <> 0"""

CTES["z_formation"] = f"""
SELECT fixture_id, team_id, location, CASE WHEN ok % 31 <> 0 THEN {A.pick_case('(ok + team_id) % 5', A.FORMATIONS)} END AS formation
FROM z_side"""

CTES["z_line"] = """
SELECT l.*, m.starting_at, CASE WHEN l_linenumber % 2 = 1 THEN home_team ELSE away_team END AS team_id
FROM lineitem l JOIN z_match m ON l_orderkey = o_orderkey"""

CTES["z_lineup"] = f"""
SELECT l_orderkey AS fixture_id, l_partkey AS player_id, team_id, 24 + l_partkey % 4 AS position_id,
  CASE WHEN l_linenumber <= 4 THEN 11 ELSE 12 END AS type_id, 'Player ' || l_partkey AS player_name,
  {A.EXPR['position_name']} AS position_name,
  CASE WHEN l_partkey % 10 <> 3 THEN {A.detailed_case('l_partkey')} END AS detailed_position_name, starting_at AS ingested
FROM z_line"""

# values of all counted statistics of one order line, as columns
_stat_cols = []
for _code, _i, _m in A.stat_rows():
    _v = f"(l_partkey * 3 + {_i} * 5 + l_linenumber + CAST(l_quantity AS BIGINT)) % {_m}"
    if _i == 0:
        _v = f"CASE WHEN l_orderkey % 700 = 11 THEN -1 ELSE {_v} END"
    _stat_cols.append(f"CASE WHEN (l_orderkey + l_partkey + {_i}) % 4 = 0 THEN {_v} ELSE 0 END AS {codes.PLAYER_STATS[_code]}")

# minutes and rating rows exist for every line, so a counted statistic never falls below 0
CTES["z_playerstat"] = f"""
SELECT fixture_id, player_id, max(minutes) AS minutes, max(rating) AS rating,
  {", ".join(f"CAST(greatest(max({c}), 0) AS INTEGER) AS {c}" for c in codes.PLAYER_STATS.values())}
FROM (SELECT l_orderkey AS fixture_id, l_partkey AS player_id, CAST({A.EXPR['minutes']} AS INTEGER) AS minutes,
        CAST({A.EXPR['rating']} AS DOUBLE) AS rating, {", ".join(_stat_cols)} FROM lineitem)
GROUP BY fixture_id, player_id"""

CTES["z_event"] = f"""
SELECT l_orderkey AS fixture_id, CASE WHEN l_orderkey % 307 <> 0 THEN team_id END AS team_id, l_partkey AS player_id,
  {A.EXPR['event_type']} AS kind, {A.EXPR['event_minute']} AS at_minute FROM z_line WHERE {A.EXPR['event_type']} IS NOT NULL"""

CTES["z_stage"] = """
SELECT y * 10 + n AS id, y AS season_id, name, kind FROM
  (SELECT DISTINCT year(o_orderdate) + 24 AS y FROM orders WHERE o_orderdate IS NOT NULL),
  (VALUES """ + ", ".join(f"({i}, '{n}', '{t}')" for i, n, t in A.STAGES) + """) t(n, name, kind)"""

CTES["z_season"] = """
SELECT y AS id, y || '/' || (y + 1) AS name, make_date(y, 1, 1) AS lo, make_date(y, 12, 31) AS hi,
  y = max(y) OVER () AS is_current
FROM (SELECT DISTINCT year(o_orderdate) + 24 AS y FROM orders WHERE o_orderdate IS NOT NULL)"""

CTES["z_curated"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n} FC', '{n[:3].upper()}', '{n}')" for i, n in enumerate(A.CURATED, 1)) + \
    ") t(team_id, display_name, code, short_name)"

# dimensions --------------------------------------------------------------------------------------------------------


def _special_rows(name: str, columns: list[str], casts: dict[str, str] | None = None) -> str:
    rows = SENTINELS[name]
    return " UNION ALL ".join(
        "SELECT " + ", ".join(f"{lit(r.get(c))} AS {c}" for c in columns) for r in rows)


CTES["g_date"] = """
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_sk, CAST(d AS DATE) AS date,
  CAST(year(d) AS INTEGER) AS year, 'Q' || quarter(d) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
  CAST(weekofyear(d) AS INTEGER) AS week_number, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name,
  CASE WHEN isodow(d) > 5 THEN 'Yes' ELSE 'No' END AS is_weekend,
  substr(s.name, 1, 4) || '/' || substr(s.name, 8, 2) AS season, coalesce(s.is_current, false) AS is_current_season
FROM range(DATE '2010-01-01', DATE '2031-01-01', INTERVAL 1 DAY) t(d) LEFT JOIN z_season s ON d >= s.lo AND d <= s.hi"""

CTES["g_time"] = """
SELECT CAST(h AS INTEGER) AS time_sk, CAST(h AS INTEGER) AS hour,
  CASE WHEN h < 6 THEN 'Night' WHEN h < 12 THEN 'Morning' WHEN h < 18 THEN 'Afternoon' ELSE 'Evening' END AS period_of_day
FROM range(24) t(h)
UNION ALL SELECT * FROM (VALUES (-1, NULL, 'Unknown Period Of Day'), (-2, NULL, 'Not Applicable Period Of Day'))"""

for _name, _members in (("result", codes.MATCH_RESULTS), ("side", codes.TEAM_SIDES), ("apptype", codes.APPEARANCE_TYPES)):
    CTES[f"g_{_name}"] = "SELECT * FROM (VALUES " + ", ".join(f"({k}, '{v}')" for k, v in _members.items()) + ") t(sk, label)"

_team_cols = ["team_sk", "team_id", "team_name", "team_code", "team_short_name", "team_country", "team_founded_year",
              "team_logo", "team_venue_name", "team_venue_city", "team_venue_capacity"]
CTES["g_team"] = f"""
SELECT row_number() OVER (ORDER BY id) AS team_sk, id AS team_id, coalesce(c.display_name, t.s_name) AS team_name,
  c.code AS team_code, c.short_name AS team_short_name, n_name AS team_country,
  CAST(1900 + s_suppkey % 100 AS INTEGER) AS team_founded_year, 'logo-' || id AS team_logo, 'Arena ' || id AS team_venue_name,
  'City ' || (s_suppkey % 30) AS team_venue_city, CAST(1000 + s_suppkey % 500 AS INTEGER) AS team_venue_capacity
FROM (SELECT *, s_suppkey % 12 + 1 AS id,
        row_number() OVER (PARTITION BY s_suppkey % 12 ORDER BY CASE WHEN s_suppkey % 7 <> 0
          THEN DATE '2020-01-01' + CAST(s_suppkey % 3000 AS INT) END DESC NULLS LAST, s_suppkey DESC) AS place FROM supplier) t
  LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN z_curated c ON c.team_id = id
WHERE place = 1 UNION ALL {_special_rows('dim_team', _team_cols)}"""

CTES["z_matchname"] = """
SELECT f.id, sg.name AS match_round_type, sg.kind, TRY_CAST(f.round_name AS INTEGER) AS n, mx.top,
  coalesce(h.display_name, 'Club ' || m.home_team) || ' - ' || coalesce(a.display_name, 'Club ' || m.away_team) AS match_name,
  coalesce(h.short_name, 'C' || m.home_team) || ' - ' || coalesce(a.short_name, 'C' || m.away_team) AS match_short_name,
  f.state_developer_name, f.state_name, f.starting_at
FROM z_fixture f JOIN z_match m ON m.o_orderkey = f.id LEFT JOIN z_stage sg ON sg.id = f.stage_id
  LEFT JOIN (SELECT g.season_id, max(TRY_CAST(g.round_name AS INTEGER)) AS top FROM z_fixture g JOIN z_stage s ON s.id = g.stage_id
             WHERE s.name = 'Regular Season' GROUP BY g.season_id) mx ON mx.season_id = f.season_id
  LEFT JOIN z_curated h ON h.team_id = m.home_team LEFT JOIN z_curated a ON a.team_id = m.away_team"""

_match_cols = ["match_sk", "match_id", "match_round_type", "match_round_number", "match_round_name", "match_type",
               "match_name", "match_short_name", "match_result", "kick_off_time", "match_status"]
CTES["g_match"] = f"""
SELECT row_number() OVER (ORDER BY id) AS match_sk, id AS match_id, match_round_type, no AS match_round_number,
  match_round_type || ' - ' || no AS match_round_name,
  CASE kind WHEN 'GROUP_STAGE' THEN 'Group Stage' WHEN 'KNOCK_OUT' THEN 'Knockout' END AS match_type, match_name,
  match_short_name, result AS match_result,
  strftime(starting_at + to_hours(CASE WHEN starting_at >= summer AND starting_at < winter THEN 2 ELSE 1 END), '%H:%M')
    AS kick_off_time, state_name AS match_status
FROM (SELECT x.*, CASE WHEN match_round_type <> 'Regular Season' AND n <= top THEN n + top ELSE n END AS no,
        CASE WHEN state_developer_name <> 'NS' THEN h.ft || ' - ' || a.ft END AS result,
        -- central European summer time: last Sundays of March and October, 01:00 UTC
        make_date(year(starting_at), 3, 31) - CAST(isodow(make_date(year(starting_at), 3, 31)) % 7 AS INT) + INTERVAL 1 HOUR AS summer,
        make_date(year(starting_at), 10, 31) - CAST(isodow(make_date(year(starting_at), 10, 31)) % 7 AS INT) + INTERVAL 1 HOUR AS winter
      FROM z_matchname x LEFT JOIN z_score h ON h.fixture_id = x.id AND h.side = 'home'
        LEFT JOIN z_score a ON a.fixture_id = x.id AND a.side = 'away')
UNION ALL {_special_rows('dim_match', _match_cols)}"""

_player_cols = ["player_sk", "player_id", "player_name", "player_firstname", "player_lastname", "player_nationality",
                "player_birth_date", "player_birth_place", "player_birth_country", "player_height", "player_weight",
                "player_photo", "player_position", "player_detailed_position"]
CTES["z_master"] = f"""
SELECT p_partkey AS player_id, 'Player ' || p_partkey AS player_name, p_name AS player_firstname,
  p_brand || ' v1' AS player_lastname, 'NATION_' || (p_partkey % 25) AS player_nationality,
  DATE '1980-01-01' + CAST(p_partkey % 7000 AS INT) AS player_birth_date, 'City ' || (p_partkey % 40) AS player_birth_place,
  'NATION_' || (p_partkey % 24) AS player_birth_country, CAST(160 + p_size AS INTEGER) AS player_height,
  CAST(61 + p_size AS INTEGER) AS player_weight, 'photo-' || p_partkey AS player_photo,
  {A.pick_case('p_partkey % 4', A.GROUPS)} AS player_position, {A.detailed_case('p_partkey')} AS player_detailed_position
FROM part WHERE p_partkey % 20 <> 19 AND p_partkey % 97 <> 5 AND p_partkey % 41 <> 7"""

CTES["g_player"] = f"""
SELECT row_number() OVER (ORDER BY player_id) AS player_sk, * FROM (
  SELECT * FROM z_master UNION ALL
  SELECT player_id, player_name, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, position_name, detailed_position_name
  FROM (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY ingested DESC, fixture_id DESC,
          position_name DESC NULLS LAST, detailed_position_name DESC NULLS LAST) AS place
        FROM z_lineup l WHERE NOT EXISTS (SELECT 1 FROM z_master m WHERE m.player_id = l.player_id)) WHERE place = 1)
UNION ALL {_special_rows('dim_player', _player_cols)}"""

_referee_cols = ["referee_sk", "referee_id", "referee_common_name", "referee_firstname", "referee_lastname",
                 "referee_display_name", "referee_nationality", "referee_image_path"]
CTES["g_referee"] = f"""
SELECT row_number() OVER (ORDER BY id) AS referee_sk, id AS referee_id, 'Referee ' || id AS referee_common_name,
  'First ' || id AS referee_firstname, 'Last ' || id AS referee_lastname, 'Ref. ' || id AS referee_display_name,
  nationality AS referee_nationality, image AS referee_image_path
FROM (SELECT n_nationkey + 1 AS id, n_name AS nationality, 'img-' || (n_nationkey + 1) || '-1' AS image FROM nation
      WHERE n_nationkey < 17 AND n_nationkey + 1 NOT IN (16, 17)
      UNION ALL SELECT referee_id, NULL, image FROM (
        SELECT referee_id, 'ref-' || fixture_id AS image, row_number() OVER (PARTITION BY referee_id
          ORDER BY ingested DESC, 'ref-' || fixture_id DESC) AS place FROM z_ref
        WHERE referee_id NOT IN (SELECT n_nationkey + 1 FROM nation WHERE n_nationkey < 15)) WHERE place = 1)
UNION ALL {_special_rows('dim_referee', _referee_cols)}"""

_coach_cols = ["coach_sk", "coach_id", "coach_name", "coach_display_name", "coach_firstname", "coach_lastname",
               "coach_nationality", "coach_image_path"]
CTES["g_coach"] = f"""
SELECT row_number() OVER (ORDER BY coach_id) AS coach_sk, coach_id, 'Coach ' || coach_id AS coach_name,
  'Coach ' || coach_id || ' v' || (ok % 3) AS coach_display_name, 'First ' || coach_id AS coach_firstname,
  'Last ' || coach_id AS coach_lastname, n_name AS coach_nationality, 'coach-' || fixture_id AS coach_image_path
FROM (SELECT *, row_number() OVER (PARTITION BY coach_id ORDER BY ingested DESC, fixture_id DESC) AS place FROM z_coach)
  LEFT JOIN nation ON n_nationkey = coach_id % 25
WHERE place = 1 UNION ALL {_special_rows('dim_coach', _coach_cols)}"""

_stadium_cols = ["stadium_sk", "stadium_id", "stadium_name", "stadium_address", "stadium_city", "stadium_country",
                 "stadium_capacity", "stadium_surface", "stadium_latitude", "stadium_longitude", "stadium_image"]
CTES["g_stadium"] = f"""
SELECT row_number() OVER (ORDER BY id) AS stadium_sk, * FROM (
  SELECT n_nationkey + 1 AS id, 'Arena ' || (n_nationkey + 1) AS stadium_name, 'Street ' || (n_nationkey + 1) AS stadium_address,
    'City ' || (n_nationkey + 1) AS stadium_city, r_name AS stadium_country,
    CAST(5001 + (n_nationkey + 1) * 1000 AS INTEGER) AS stadium_capacity,
    {A.pick_case('(n_nationkey + 1) % 4', A.SURFACES)} AS stadium_surface, 54.75::DOUBLE + 0.25::DOUBLE * (n_nationkey + 1) AS stadium_latitude,
    8::DOUBLE + 0.5::DOUBLE * (n_nationkey + 1) AS stadium_longitude, 'venue-' || (n_nationkey + 1) AS stadium_image
  FROM nation LEFT JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 11
  UNION ALL SELECT DISTINCT venue_id, venue_name, NULL, venue_city, NULL, CAST(venue_capacity AS INTEGER), venue_surface, NULL::DOUBLE, NULL::DOUBLE, NULL
  FROM z_fixture WHERE venue_id IS NOT NULL AND venue_name IS NOT NULL
    AND venue_id NOT IN (SELECT n_nationkey + 1 FROM nation WHERE n_nationkey < 11))
UNION ALL {_special_rows('dim_stadium', _stadium_cols)}"""

_league_cols = ["league_sk", "league_id", "league_name", "league_type", "league_logo", "league_country",
                "league_country_code", "league_country_flag", "league_short_code", "league_sub_type", "league_is_active"]
CTES["g_league"] = f"""
SELECT row_number() OVER (ORDER BY r_regionkey) AS league_sk, r_regionkey + 1 AS league_id, 'League ' || r_name AS league_name,
  'league' AS league_type, 'logo-' || r_name AS league_logo, n_name AS league_country, 'N' || n_nationkey AS league_country_code,
  'flag-' || n_nationkey AS league_country_flag, substr(r_name, 1, 3) AS league_short_code, 'domestic' AS league_sub_type,
  r_regionkey % 2 = 0 AS league_is_active
FROM region LEFT JOIN nation ON n_nationkey = r_regionkey UNION ALL {_special_rows('dim_league', _league_cols)}"""

CTES["g_formation"] = """
SELECT row_number() OVER (ORDER BY formation) AS formation_sk, formation FROM (SELECT DISTINCT formation FROM z_formation
WHERE formation IS NOT NULL) UNION ALL SELECT * FROM (VALUES (-1, 'Unknown'), (-2, 'Not Applicable'))"""

CTES["g_position"] = f"""
SELECT row_number() OVER (ORDER BY d) AS position_sk, d AS position_name,
  CASE d {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in codes.POSITION_SHORT_CODES.items())} END AS position_short_code,
  g AS position_group
FROM (SELECT d, g, row_number() OVER (PARTITION BY d ORDER BY n DESC, g) AS place
      FROM (SELECT detailed_position_name AS d, position_name AS g, count(*) AS n FROM z_lineup
            WHERE detailed_position_name IS NOT NULL AND position_name IS NOT NULL GROUP BY d, g))
WHERE place = 1 UNION ALL {_special_rows('dim_position', ["position_sk", "position_name", "position_short_code", "position_group"])}"""

# facts -------------------------------------------------------------------------------------------------------------

CTES["z_clock"] = """
SELECT f.*, coalesce(d.date_sk, -1) AS date_sk, coalesce(m.match_sk, -1) AS match_sk,
  coalesce(CAST(substr(m.kick_off_time, 1, 2) AS INTEGER), -1) AS time_sk, coalesce(l.league_sk, -1) AS league_sk,
  coalesce(s.stadium_sk, -1) AS stadium_sk, coalesce(r.referee_sk, -1) AS referee_sk, sg.kind AS stage_type,
  f.state_developer_name <> 'NS' AS done
FROM z_fixture f LEFT JOIN g_date d ON d.date = CAST(f.starting_at AS DATE) LEFT JOIN g_match m ON m.match_id = f.id
  LEFT JOIN g_league l ON l.league_id = f.league_id LEFT JOIN g_stadium s ON s.id = f.venue_id
  LEFT JOIN (SELECT * FROM z_ref WHERE type_id = 6) mr ON mr.fixture_id = f.id
  LEFT JOIN g_referee r ON r.referee_id = mr.referee_id LEFT JOIN z_stage sg ON sg.id = f.stage_id"""

CTES["z_pair"] = """
SELECT p.fixture_id, p.team_id, p.location, o.team_id AS opp_id, s.ft, s.ht, os.ft AS oft, os.ht AS oht, x.fixed, ox.fixed AS ofixed,
  coalesce(t.team_sk, -1) AS team_sk, coalesce(ot.team_sk, -1) AS opponent_team_sk, coalesce(c.coach_sk, -1) AS coach_sk,
  coalesce(fo.formation_sk, -1) AS formation_sk
FROM z_side p JOIN z_side o ON o.fixture_id = p.fixture_id AND o.location <> p.location
  LEFT JOIN z_score s ON s.fixture_id = p.fixture_id AND s.team_id = p.team_id
  LEFT JOIN z_score os ON os.fixture_id = p.fixture_id AND os.team_id = o.team_id
  LEFT JOIN z_fix x ON x.fixture_id = p.fixture_id AND x.team_id = p.team_id
  LEFT JOIN z_fix ox ON ox.fixture_id = p.fixture_id AND ox.team_id = o.team_id
  LEFT JOIN z_coach co ON co.fixture_id = p.fixture_id AND co.team_id = p.team_id
  LEFT JOIN z_formation zf ON zf.fixture_id = p.fixture_id AND zf.team_id = p.team_id
  LEFT JOIN g_team t ON t.team_id = p.team_id LEFT JOIN g_team ot ON ot.team_id = o.team_id
  LEFT JOIN g_coach c ON c.coach_id = co.coach_id LEFT JOIN g_formation fo ON fo.formation = zf.formation"""

CTES["g_teamfact"] = """
SELECT date_sk, time_sk, team_sk, opponent_team_sk, league_sk, stadium_sk, referee_sk, match_sk, coach_sk, formation_sk,
  team_side_sk, CASE WHEN NOT done THEN 4 WHEN gs > gc THEN 1 WHEN gs = gc THEN 2 ELSE 3 END AS match_result_sk,
  CASE WHEN done AND stage_type = 'GROUP_STAGE' THEN CASE WHEN gs > gc THEN 3 WHEN gs = gc THEN 1 ELSE 0 END END AS points_earned,
  gs AS goals_scored, gc AS goals_conceded, CASE WHEN done THEN coalesce(ht, 0) END AS goals_ht_scored,
  CASE WHEN done THEN coalesce(oht, 0) END AS goals_ht_conceded, CASE WHEN done THEN corner_kicks END AS corner_kicks,
  CASE WHEN done THEN ball_possession_pct END AS ball_possession_pct, CASE WHEN done THEN yellow_cards END AS yellow_cards,
  CASE WHEN done THEN red_cards END AS red_cards
FROM (SELECT c.*, p.*, st.corner_kicks, st.ball_possession_pct, st.yellow_cards, st.red_cards,
        CASE WHEN p.location = 'home' THEN 1 ELSE 2 END AS team_side_sk,
        CASE WHEN c.done THEN coalesce(fixed, ft, 0) END AS gs, CASE WHEN c.done THEN coalesce(ofixed, oft, 0) END AS gc
      FROM z_clock c JOIN z_pair p ON p.fixture_id = c.id
        JOIN z_teamstat st ON st.fixture_id = p.fixture_id AND st.team_id = p.team_id)"""

CTES["z_shown"] = """
SELECT * FROM (
  SELECT l.*, coalesce(s.minutes, 0) AS minutes_played, row_number() OVER (PARTITION BY l.fixture_id, l.player_id
    ORDER BY l.type_id, l.team_id, l.position_id, l.detailed_position_name NULLS FIRST) AS place
  FROM z_lineup l JOIN z_fixture f ON f.id = l.fixture_id AND f.state_developer_name <> 'NS'
    LEFT JOIN z_playerstat s ON s.fixture_id = l.fixture_id AND s.player_id = l.player_id
  WHERE l.type_id = 11 OR coalesce(s.minutes, 0) > 0) WHERE place = 1"""

# goals against a team by minute; the other side of a match is what is left of the sum of its two team ids
CTES["z_minute"] = """
SELECT fixture_id, CASE kind WHEN 'OWNGOAL' THEN team_id ELSE both_ids - team_id END AS team_id, at_minute, count(*) AS goals
FROM z_event LEFT JOIN (SELECT fixture_id, sum(team_id) AS both_ids FROM z_side GROUP BY fixture_id) USING (fixture_id)
WHERE team_id IS NOT NULL AND kind IN ('OWNGOAL', 'GOAL') GROUP BY ALL"""

# the minutes a keeper is answerable for: all of them if alone, else up to leaving or from coming on
CTES["z_spell"] = """
WITH entered AS (SELECT fixture_id, player_id, min(CASE WHEN at_minute > 90 THEN 90 ELSE at_minute END) AS minute_on
                 FROM z_event WHERE kind = 'SUBSTITUTION' GROUP BY ALL),
crews AS (SELECT fixture_id, team_id, count(*) AS keepers FROM z_shown WHERE position_id = 24 GROUP BY ALL)
SELECT fixture_id, player_id, team_id,
  CASE WHEN keepers = 1 THEN -1000 WHEN type_id = 11 THEN 0 WHEN minute_on IS NOT NULL THEN minute_on
       WHEN minutes_played < 90 THEN 90 - minutes_played ELSE 0 END AS after,
  CASE WHEN keepers = 1 THEN 1000 WHEN type_id = 11 THEN minutes_played ELSE 200 END AS until
FROM z_shown JOIN crews USING (fixture_id, team_id) LEFT JOIN entered USING (fixture_id, player_id) WHERE position_id = 24"""

CTES["z_keeper"] = """
SELECT fixture_id, player_id, coalesce(sum(goals) FILTER (WHERE at_minute > after AND at_minute <= until), 0) AS n
FROM z_spell LEFT JOIN z_minute USING (fixture_id, team_id) GROUP BY ALL"""

_plain = [c for c in codes.PLAYER_STATS.values() if c not in codes.KEEPER_STATS]
CTES["g_playerfact"] = f"""
SELECT c.date_sk, c.time_sk, c.match_sk, coalesce(p.player_sk, -1) AS player_sk, coalesce(x.team_sk, -1) AS team_sk,
  coalesce(x.opponent_team_sk, -1) AS opponent_team_sk, c.league_sk, c.stadium_sk, c.referee_sk,
  coalesce(x.coach_sk, -1) AS coach_sk, coalesce(x.formation_sk, -1) AS formation_sk, coalesce(po.position_sk, -1) AS position_sk,
  CASE x.location WHEN 'home' THEN 1 WHEN 'away' THEN 2 ELSE -1 END AS team_side_sk,
  CASE WHEN x.opp_id IS NULL THEN -1 WHEN coalesce(x.ft, 0) > coalesce(x.oft, 0) THEN 1
       WHEN coalesce(x.ft, 0) = coalesce(x.oft, 0) THEN 2 ELSE 3 END AS match_result_sk,
  CASE WHEN l.type_id = 11 THEN 1 ELSE 2 END AS appearance_type_sk, l.minutes_played,
  {", ".join(f"s.{c}" for c in _plain)},
  CASE WHEN l.position_id = 24 THEN coalesce(k.n, 0) END AS goals_conceded,
  {", ".join(f"CASE WHEN l.position_id = 24 THEN s.{c} END AS {c}" for c in codes.KEEPER_STATS[1:])}, s.rating
FROM z_shown l JOIN z_clock c ON c.id = l.fixture_id
  LEFT JOIN z_pair x ON x.fixture_id = l.fixture_id AND x.team_id = l.team_id
  LEFT JOIN z_playerstat s ON s.fixture_id = l.fixture_id AND s.player_id = l.player_id
  LEFT JOIN z_keeper k ON k.fixture_id = l.fixture_id AND k.player_id = l.player_id
  LEFT JOIN g_player p ON p.player_id = l.player_id
  LEFT JOIN (SELECT p_partkey, {A.detailed_case('p_partkey')} AS d FROM part WHERE p_partkey % 20 <> 19) pd ON pd.p_partkey = l.player_id
  LEFT JOIN g_position po ON po.position_name = coalesce(l.detailed_position_name, pd.d)"""

# extracts ----------------------------------------------------------------------------------------------------------

# The extracts are put together from small relations that each name one thing.
CTES["y_day"] = "SELECT date_sk, date AS match_date, season, is_current_season FROM g_date WHERE season >= '2020/21'"
CTES["y_game"] = """
SELECT match_sk, match_id, match_name, match_short_name, match_result AS score, match_status, kick_off_time, match_round_name,
  match_round_type, match_round_number FROM g_match WHERE match_round_number IS NOT NULL"""
CTES["y_foe"] = """
SELECT team_sk AS opponent_team_sk, team_name AS opponent_team_name, team_short_name AS opponent_team_short_name,
  team_code AS opponent_team_code FROM g_team"""
CTES["y_end"] = "SELECT sk AS match_result_sk, label AS result FROM g_result WHERE sk > 0"
CTES["y_place"] = "SELECT sk AS team_side_sk, label AS team_side FROM g_side"
CTES["y_whistle"] = "SELECT referee_sk, referee_common_name AS referee_name FROM g_referee"

# one row per side of a match that counts
CTES["y_side"] = """
SELECT * FROM g_teamfact JOIN y_day USING (date_sk) JOIN y_game USING (match_sk) JOIN y_end USING (match_result_sk)"""

CTES["y_progress"] = """
WITH rounds AS (SELECT team_sk, season, match_round_number, sum(points_earned) AS points, sum(goals_scored) AS gf, sum(goals_conceded) AS ga
                FROM y_side GROUP BY ALL)
SELECT now.team_sk, now.season, now.match_round_number, CAST(sum(past.points) AS BIGINT) AS cumulative_points,
  CAST(sum(past.gf) - sum(past.ga) AS BIGINT) AS cumulative_gd, CAST(sum(past.gf) AS BIGINT) AS cumulative_gf
FROM rounds now JOIN rounds past ON past.team_sk = now.team_sk AND past.season = now.season
  AND past.match_round_number <= now.match_round_number GROUP BY ALL"""

CTES["y_table"] = """
SELECT team_sk, season, CASE max(CASE match_round_type WHEN 'Championship Round' THEN 2 WHEN 'Relegation Round' THEN 1 ELSE 0 END)
  WHEN 2 THEN 'Championship Group' WHEN 1 THEN 'Relegation Group' ELSE 'Regular Season' END AS standings_type
FROM y_side GROUP BY ALL"""

CTES["y_squad"] = f"""
SELECT match_sk, team_sk, {", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {n}" for n, c in TEAM_SUMS.items())}
FROM g_playerfact GROUP BY ALL"""

MM_SIDE = ("match_sk", "team_sk", "opponent_team_sk", "team_side_sk", "referee_sk", "stadium_sk", "coach_sk", "match_date", "season",
           "is_current_season", "match_round_name", "match_round_type", "match_round_number", "match_id", "match_name", "match_short_name",
           "score", "match_status", "kick_off_time", "result", "points_earned", "goals_scored", "goals_conceded", "goals_ht_scored",
           "goals_ht_conceded", "ball_possession_pct", "corner_kicks", "yellow_cards", "red_cards")
MP_KEYS = ("date_sk", "match_sk", "player_sk", "team_sk", "opponent_team_sk", "match_result_sk", "team_side_sk", "referee_sk",
           "stadium_sk", "appearance_type_sk", "formation_sk", "position_sk")

CTES["mm"] = f"""
SELECT match_date, season, is_current_season, match_round_name, match_round_type, match_round_number, match_id, match_name,
  match_short_name, score, match_status, kick_off_time, team_name, team_short_name, team_code, team_logo, team_sk,
  opponent_team_name, opponent_team_short_name, opponent_team_code, opponent_team_sk, team_side, result, referee_name, coach_name,
  stadium_name, stadium_surface, stadium_capacity, stadium_latitude, stadium_longitude, points_earned, goals_scored,
  goals_conceded, goals_ht_scored, goals_ht_conceded, ball_possession_pct AS possession_pct, corner_kicks, yellow_cards, red_cards,
  {", ".join(f"coalesce({c}, 0) AS {c}" for c in TEAM_SUMS)}, standings_type, cumulative_points, cumulative_gd, cumulative_gf
FROM (SELECT {", ".join(MM_SIDE)} FROM y_side)
  JOIN y_progress USING (team_sk, season, match_round_number)
  JOIN y_table USING (team_sk, season)
  LEFT JOIN y_squad USING (match_sk, team_sk)
  JOIN y_foe USING (opponent_team_sk)
  JOIN (SELECT team_sk, team_name, team_short_name, team_code, team_logo FROM g_team) USING (team_sk)
  JOIN y_place USING (team_side_sk)
  JOIN y_whistle USING (referee_sk)
  JOIN (SELECT stadium_sk, stadium_name, stadium_surface, stadium_capacity, stadium_latitude, stadium_longitude FROM g_stadium) USING (stadium_sk)
  LEFT JOIN (SELECT coach_sk, coach_name FROM g_coach) USING (coach_sk)"""

CTES["mp"] = f"""
SELECT match_date, season, is_current_season, match_id, match_name, match_short_name, match_round_name, match_round_number,
  match_status, player_id, player_name, player_nationality, player_birth_date, player_height, player_weight, player_photo,
  player_position, player_detailed_position, position_name, position_short_code, position_group, formation, team_name,
  team_short_name, team_logo, opponent_team_name, opponent_team_short_name, result, team_side, referee_name, stadium_name,
  appearance_type, {", ".join(PLAYER_MEASURES)}
FROM (SELECT {", ".join(MP_KEYS)}, {", ".join(PLAYER_MEASURES)} FROM g_playerfact WHERE player_sk > 0)
  JOIN y_end USING (match_result_sk)
  JOIN (SELECT date_sk, match_date, season, is_current_season FROM y_day) USING (date_sk)
  JOIN (SELECT * EXCLUDE (score, kick_off_time, match_round_type) FROM y_game) USING (match_sk)
  JOIN (SELECT player_sk, player_id, player_name, player_nationality, player_birth_date, player_height, player_weight, player_photo,
          player_position, player_detailed_position FROM g_player) USING (player_sk)
  JOIN (SELECT position_sk, position_name, position_short_code, position_group FROM g_position) USING (position_sk)
  JOIN (SELECT formation_sk, formation FROM g_formation) USING (formation_sk)
  JOIN (SELECT sk AS appearance_type_sk, label AS appearance_type FROM g_apptype) USING (appearance_type_sk)
  JOIN y_foe USING (opponent_team_sk)
  JOIN (SELECT team_sk, team_name, team_short_name, team_logo FROM g_team) USING (team_sk)
  JOIN y_place USING (team_side_sk)
  JOIN y_whistle USING (referee_sk)
  JOIN (SELECT stadium_sk, stadium_name FROM g_stadium) USING (stadium_sk)"""
