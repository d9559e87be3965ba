"""Analytic queries Q-01 ... Q-73 with fixed example parameters."""

from __future__ import annotations

from ..plans import marts
from ..plans.analytics import common, games, league, player, team, venue
from ..plans.warehouse import warehouse
from .oracle import isum, p90, pct, rat
from .registry import register

SEASON, CURRENT, TEAM, OTHER, REFEREE = "2024/25", "2025/26", "Amber FC", "Birch FC", "Referee 3"
PAIR = f"{TEAM}|||{OTHER}"
ROUNDS = [1, 2, 3]
PLAYED = "result IN ('Win', 'Draw', 'Loss')"
S = f"season = '{SEASON}' AND {PLAYED}"
MM, MP = f"FROM mm WHERE {S}", f"FROM mp WHERE {S}"
GAMES = "count(DISTINCT match_id)"
WIN, DRAW, LOSS = (f"count(*) FILTER (result = '{r}')" for r in ("Win", "Draw", "Loss"))
GROUP = "CASE standings_type WHEN 'Championship Group' THEN 1 WHEN 'Relegation Group' THEN 2 ELSE 3 END"
SEVERITY = "(sum(yellow_cards) + 3 * sum(red_cards))"


def per(x: str, digits: int | None) -> str:
    return rat(f"sum({x})", GAMES, digits)


def share(a: str, b: str, digits: int | None = 1) -> str:
    return pct(f"sum({a})", f"sum({b})", digits)


HOME_WIN = pct("count(*) FILTER (team_side = 'Home' AND result = 'Win')", "count(*) FILTER (team_side = 'Home')")
TABLE = (f"{GAMES} AS gp, {WIN} AS w, {DRAW} AS d, {LOSS} AS l, {isum('goals_scored')} AS gf, {isum('goals_conceded')} AS ga, "
         f"CAST(sum(goals_scored) - sum(goals_conceded) AS BIGINT) AS gd, {isum('points_earned')} AS pts")
ORDER = "pts DESC NULLS LAST, gd DESC NULLS LAST, gf DESC NULLS LAST"


def mm(fn, *args, **kw):
    return lambda spark, sf: fn(warehouse(spark, sf).get("mart_match_facts"), *args, **kw)


def mp(fn, *args, **kw):
    return lambda spark, sf: fn(warehouse(spark, sf).get("mart_player_facts"), *args, **kw)


# home and standings
register("q01_home_league", lambda spark, sf: marts.league_info(warehouse(spark, sf).get("dim_league"), 1),
         "SELECT league_name, league_logo, league_country_flag FROM g_league WHERE league_id = 1")
register("q02_home_last_updated", lambda spark, sf: marts.last_updated(warehouse(spark, sf).silver.fixtures()),
         "SELECT strftime(max(ingested), '%d %b %Y %H:%M UTC') AS last_updated FROM z_fixture")
register("q03_home_kpis", mm(league.home_kpis), f"""
SELECT {GAMES} AS total_matches, {isum('goals_scored')} AS total_goals, count(DISTINCT team_name) AS total_teams, max(season) AS season
FROM mm WHERE is_current_season AND {PLAYED}""")
register("q04_leader", mm(league.leader), f"""
SELECT team_name, team_short_name, pts FROM (SELECT team_name, team_short_name, standings_type, {TABLE} FROM mm
  WHERE is_current_season AND {PLAYED} GROUP BY team_name, team_short_name, standings_type) ORDER BY {GROUP}, {ORDER}, team_name LIMIT 1""")
register("q05_seasons", mm(common.season_list, False), "SELECT DISTINCT season FROM mm")
register("q05_seasons_played", mm(common.season_list), f"SELECT DISTINCT season FROM mm WHERE {PLAYED}")
register("q05_seasons_players", mp(common.season_list), f"SELECT DISTINCT season FROM mp WHERE {PLAYED}")
register("q05_seasons_referee", mm(common.season_list, True, "2020/21"),
         f"SELECT DISTINCT season FROM mm WHERE {PLAYED} AND season >= '2020/21'")

_STANDINGS = f"""
SELECT row_number() OVER (PARTITION BY standings_type ORDER BY {ORDER}, team_name) AS rank, team_name AS team,
  team_short_name AS team_short, gp, w, d, l, gf, ga, gd, pts, standings_type AS round_group
FROM (SELECT team_name, team_short_name, standings_type, {TABLE} {MM} GROUP BY team_name, team_short_name, standings_type)
WHERE standings_type <> 'Regular Season'"""
register("q06_standings", mm(league.standings, SEASON), _STANDINGS)
for _id, _group in (("q07_championship", "Championship Group"), ("q08_relegation", "Relegation Group")):
    register(_id, mm(league.group_table, SEASON, _group),
             f"SELECT * EXCLUDE (round_group) FROM ({_STANDINGS}) WHERE round_group = '{_group}'")
register("q09_regular", mm(league.regular_table, SEASON), f"""
SELECT row_number() OVER (ORDER BY {ORDER}, team_name) AS rank, team_name AS team, team_short_name AS team_short, gp, w, d, l,
  gf, ga, gd, pts FROM (SELECT team_name, team_short_name, {TABLE} {MM} AND match_round_type = 'Regular Season' GROUP BY ALL)""")
register("q10_all_teams", mm(league.all_teams, SEASON), f"""
SELECT team_short_name AS team, pts, w, d, l, standings_type AS round_group
FROM (SELECT team_short_name, standings_type, {TABLE} {MM} GROUP BY team_short_name, standings_type)""")

# results
IN_ROUNDS = "match_round_number IN (1, 2, 3)"
register("q11_rounds", mm(games.rounds, SEASON), f"SELECT DISTINCT CAST(match_round_number AS INTEGER) AS round_number {MM}")
_RESULTS = f"""
SELECT match_id, match_date, match_round_name AS round, match_round_number, match_name, match_short_name, score,
  {isum('goals_scored')} AS total_goals, {isum('shots_on_goal')} AS total_shots_on_goal, {isum('total_shots')} AS total_shots,
  {isum('big_chances_created')} AS total_big_chances, {isum('yellow_cards')} AS total_yellow_cards,
  {isum('red_cards')} AS total_red_cards, referee_name AS referee, season
{MM} AND {IN_ROUNDS} GROUP BY ALL"""
register("q12_results", mm(games.results, SEASON, ROUNDS), _RESULTS, dates=["match_date"])
register("q13_round_kpis", mm(games.round_kpis, SEASON, ROUNDS), f"""
SELECT {isum('total_goals')} AS total_goals, {per('total_goals', 2)} AS avg_goals_per_match,
  {per('total_shots_on_goal', 1)} AS avg_shots_on_goal, {rat('sum(total_goals)', 'sum(total_big_chances)', 2)} AS goals_per_big_chance
FROM ({_RESULTS})""")
register("q14_match_options", mm(games.match_options, SEASON, ROUNDS), f"""
SELECT DISTINCT match_name || '|' || CAST(match_date AS VARCHAR) AS match_key, match_short_name || '  (' || score || ')' AS match_label,
  match_date {MM} AND {IN_ROUNDS}""", dates=["match_date"])


def _chosen_match(spark, sf):
    """The match a reader would pick: the first one of the season with both line-ups."""
    w = warehouse(spark, sf)
    listed = w.get("mart_player_facts").filter(f"{S} AND appearance_type = 'Substitute'")
    return listed.orderBy("match_id").limit(1).select(games.match_key().alias("k")).scalar()


_PICK = (f"(SELECT (match_name, match_date) FROM mp WHERE {S} AND appearance_type = 'Substitute' ORDER BY match_id LIMIT 1)")
_pairs = {"team": "team_name", "team_short": "team_short_name", "goals": "goals_scored", "sog": "shots_on_goal",
          "possession": "possession_pct", "corners": "corner_kicks", "fouls": "fouls", "offsides": "offsides",
          "yc": "yellow_cards", "rc": "red_cards", "saves": "saves", "total_shots": "total_shots",
          "big_chances": "big_chances_created", "tackles": "tackles", "woodwork": "woodwork_hits"}
_at = lambda c, side: f"max({c}) FILTER (team_side = '{side}')"
register("q15_match_centre", lambda spark, sf: games.match_centre(
    warehouse(spark, sf).get("mart_match_facts"), SEASON, _chosen_match(spark, sf)), f"""
SELECT max(score) AS score, {", ".join(f"{_at(c, s)} AS {s.lower()}_{n}" for n, c in _pairs.items() for s in ("Home", "Away"))},
  {", ".join(f"round(CAST({_at('passes_accurate', s)} AS DOUBLE) / nullif(CAST({_at('total_passes', s)} AS DOUBLE), 0) * 100, 1) AS {s.lower()}_pass_accuracy" for s in ("Home", "Away"))}
FROM mm WHERE season = '{SEASON}' AND (match_name, match_date) = {_PICK}""")
_line = "player_name, player_photo, team_name, team_side, position_group, position_name, position_short_code, formation"
_squad = f"FROM mp WHERE {PLAYED} AND (match_name, match_date) = {_PICK} AND appearance_type ="
register("q16_lineup", lambda spark, sf: games.lineup(
    warehouse(spark, sf).get("mart_player_facts"), _chosen_match(spark, sf)), f"""
SELECT {_line}, team_logo, minutes_played, goals_scored, assists, shots_total, shots_on_target, key_passes, big_chances_created,
  dribbles_completed, tackles, interceptions, clearances, aerials_won, blocks, fouls_committed, saves, yellow_cards, red_cards,
  round(rating, 2) AS rating {_squad} 'Starter'""")
register("q17_subs", lambda spark, sf: games.substitutes(
    warehouse(spark, sf).get("mart_player_facts"), _chosen_match(spark, sf)),
    f"SELECT {_line}, round(rating, 2) AS rating {_squad} 'Substitute'")

# upcoming and head-to-head
PICKED = [TEAM, OTHER]
register("q18_upcoming_teams", mm(games.pending_teams), "SELECT DISTINCT team_name FROM mm WHERE result = 'Pending'")
_UPCOMING = """
SELECT home_team || '|||' || away_team AS match_key, match_name, round, match_round_number, home_team, away_team,
  home_team_short, away_team_short, home_team_short || ' - ' || away_team_short AS match_short_name,
  strftime(match_date, '%Y-%m-%d') AS match_date, kick_off_time,
  CASE WHEN stadium_name LIKE '%Unknown%' OR stadium_name LIKE '%Applicable%' THEN 'TBD' ELSE stadium_name END AS stadium, referee, season
FROM (SELECT match_name, match_round_name AS round, match_round_number, match_date, kick_off_time, stadium_name,
        referee_name AS referee, season, max(team_name) FILTER (team_side = 'Home') AS home_team,
        max(team_name) FILTER (team_side = 'Away') AS away_team, max(team_short_name) FILTER (team_side = 'Home') AS home_team_short,
        max(team_short_name) FILTER (team_side = 'Away') AS away_team_short
      FROM mm WHERE result = 'Pending' GROUP BY ALL)
WHERE home_team IN ('Amber FC', 'Birch FC') OR away_team IN ('Amber FC', 'Birch FC')"""
register("q19_upcoming", mm(games.upcoming, PICKED), _UPCOMING)
register("q20_match_info", mm(games.match_info, PAIR, PICKED), f"""
SELECT home_team, away_team, home_team_short, away_team_short, match_date, round, kick_off_time, stadium FROM ({_UPCOMING})
WHERE match_key = '{PAIR}' ORDER BY match_date NULLS LAST, kick_off_time NULLS LAST, match_round_number NULLS LAST, stadium NULLS LAST LIMIT 1""")
_MEET = f"{PLAYED} AND match_name IN ('{TEAM} - {OTHER}', '{OTHER} - {TEAM}')"
H2H_SEASONS = ["2023/24", "2024/25"]
_IN = "season IN ('2023/24', '2024/25')"
register("q21_h2h_seasons", mm(games.h2h_seasons, PAIR), f"SELECT DISTINCT season FROM mm WHERE {_MEET}")
register("q22_h2h", mm(games.h2h, PAIR, H2H_SEASONS), f"""
SELECT season, match_date, match_round_name AS round, max(team_code) FILTER (team_side = 'Home') || ' - ' ||
  max(team_code) FILTER (team_side = 'Away') AS match, score, {isum('goals_scored')} AS total_goals,
  {isum('shots_on_goal')} AS total_shots_on_goal, {isum('big_chances_created')} AS total_big_chances
FROM mm WHERE {_MEET} AND {_IN} GROUP BY season, match_date, match_round_name, score""", dates=["match_date"])
_won = lambda a, b: (f"CAST(coalesce(sum(CASE WHEN (team_name = '{a}' AND result = 'Win') OR (team_name = '{b}' AND result = 'Loss') "
                     f"THEN 1 ELSE 0 END), NULL) AS BIGINT)")
register("q23_h2h_stats", mm(games.h2h_stats, PAIR, H2H_SEASONS), f"""
SELECT {_won(TEAM, OTHER)} AS team1_wins, CAST(sum(CASE WHEN result = 'Draw' THEN 1 ELSE 0 END) AS BIGINT) AS draws,
  {_won(OTHER, TEAM)} AS team2_wins
FROM mm WHERE team_side = 'Home' AND {PLAYED} AND {_IN} AND least(team_name, opponent_team_name) = '{TEAM}'
  AND greatest(team_name, opponent_team_name) = '{OTHER}'""")
for _id, _t in (("q24_home_form", TEAM), ("q25_away_form", OTHER)):
    register(_id, mm(games.recent_form, _t), f"""
SELECT strftime(match_date, '%d %b') AS match_date, opponent_team_short_name AS opponent, goals_scored AS gf, goals_conceded AS ga,
  result FROM mm WHERE team_name = '{_t}' AND {PLAYED} ORDER BY mm.match_date DESC, match_id DESC LIMIT 5""")

# league
register("q26_team_filter", mm(league.team_filter, SEASON),
         f"SELECT 'All' AS team_name UNION ALL SELECT DISTINCT team_name {MM}")
_KPI = {"total_goals": isum("goals_scored"), "goals_per_match": per("goals_scored", 2),
        "cross_accuracy": share("crosses_accurate", "crosses_total"), "shot_conversion": share("goals_scored", "total_shots"),
        "pass_accuracy": share("passes_accurate", "total_passes"), "yc_per_match": per("yellow_cards", 2),
        "rc_per_match": per("red_cards", 2), "sot_per_match": per("shots_on_goal", 1)}
_names = {"total_goals": "total_goals_ratio", "goals_per_match": "goals_ratio", "cross_accuracy": "cross_accuracy_ratio",
          "shot_conversion": "shot_conv_ratio", "pass_accuracy": "pass_ratio", "yc_per_match": "yc_ratio",
          "rc_per_match": "rc_ratio", "sot_per_match": "sot_ratio"}


def _kpis_sql(teams: str) -> str:
    return f"""
SELECT c.*, p.*, {", ".join(f"{rat('c.' + k, 'p.prev_' + k, 2)} AS {n}" for k, n in _names.items())}
FROM (SELECT {GAMES} AS total_matches, {HOME_WIN} AS home_win_pct, {", ".join(f"{v} AS {k}" for k, v in _KPI.items())}
      {MM} AND {teams}) c,
  (SELECT {", ".join(f"{v} AS prev_{k}" for k, v in _KPI.items())} FROM mm WHERE {PLAYED} AND {teams}
     AND season = (SELECT max(season) FROM mm WHERE season < '{SEASON}' AND {PLAYED})) p"""


register("q27_league_kpis", mm(league.league_kpis, SEASON), _kpis_sql("true"))
register("q27_league_kpis_teams", mm(league.league_kpis, SEASON, [TEAM, OTHER]),
         _kpis_sql(f"team_name IN ('{TEAM}', '{OTHER}')"))
for _id, _fn, _col, _out in (("q28_scorers", league.top_scorers, "goals_scored", "goals"),
                             ("q29_assisters", league.top_assisters, "assists", "assists")):
    register(_id, mp(_fn, SEASON), f"""
SELECT player_name, player_photo, team_name, v AS {_out}, row_number() OVER (ORDER BY v DESC, player_name, team_name) AS rn
FROM (SELECT player_name, player_photo, team_name, {isum(_col)} AS v {MP} GROUP BY ALL) WHERE v > 0
QUALIFY rn <= 3""")
register("q30_top_rated", mp(league.top_rated, SEASON), f"""
SELECT player_name, player_photo, team_name, round(v, 2) AS avg_rating, matches,
  row_number() OVER (ORDER BY v DESC, player_name, team_name) AS rn
FROM (SELECT player_name, player_photo, team_name, avg(rating) AS v, {GAMES} AS matches {MP} AND rating > 0 GROUP BY ALL)
WHERE matches >= 5 QUALIFY rn <= 3""")
register("q30_top_rated_two_matches", mp(league.top_rated, SEASON, min_matches=2), f"""
SELECT player_name, player_photo, team_name, round(v, 2) AS avg_rating, matches,
  row_number() OVER (ORDER BY v DESC, player_name, team_name) AS rn
FROM (SELECT player_name, player_photo, team_name, avg(rating) AS v, {GAMES} AS matches {MP} AND rating > 0 GROUP BY ALL)
WHERE matches >= 2 QUALIFY rn <= 3""")
register("q31_current_standings", mm(league.current_standings, SEASON), f"""
SELECT team_name, team_short_name, gp AS mp, pts, gd, gf, standings_type AS round_group
FROM (SELECT team_name, team_short_name, team_logo, standings_type, {TABLE} {MM} GROUP BY team_name, team_short_name, team_logo, standings_type)""")
_CLEAN = "count(DISTINCT match_id) FILTER (goals_conceded = 0)"
register("q32_team_landscape", mm(league.team_landscape, SEASON), f"""
SELECT team_name, team_logo, {isum('goals_scored')} AS goals_for, {isum('goals_conceded')} AS goals_against,
  {isum('points_earned')} AS points, {pct(WIN, 'count(*)')} AS win_pct, {share('goals_scored', 'total_shots')} AS shot_conv,
  {_CLEAN} AS clean_sheets, {share('passes_accurate', 'total_passes')} AS pass_accuracy {MM} GROUP BY team_name, team_logo""")
register("q33_landscape_bounds", mm(league.team_landscape_bounds, SEASON), f"""
SELECT CAST(floor(min(f) * 9 / 10) AS BIGINT) AS x_min, CAST(ceil(max(f) * 11 / 10) AS BIGINT) AS x_max,
  CAST(floor(min(a) * 9 / 10) AS BIGINT) AS y_min, CAST(ceil(max(a) * 11 / 10) AS BIGINT) AS y_max
FROM (SELECT sum(goals_scored) AS f, sum(goals_conceded) AS a {MM} GROUP BY team_name)""")
register("q34_points_progression", mm(league.points_progression, SEASON), f"""
SELECT match_round_number AS round, team_name, cumulative_points, cumulative_gd, cumulative_gf {MM}""")
_STATS = f"""
SELECT team_name, {isum('goals_scored')} AS goals_for, {isum('goals_conceded')} AS goals_against,
  {share('goals_scored', 'total_shots')} AS shot_conversion_pct, {share('goals_scored', 'shots_on_goal')} AS on_target_conversion_pct,
  {_CLEAN} AS clean_sheets, {per('saves', 1)} AS avg_saves, {per('goals_conceded', 2)} AS avg_goals_conceded,
  {per('possession_pct', 1)} AS avg_possession, {share('passes_accurate', 'total_passes')} AS avg_pass_accuracy,
  {per('corner_kicks', 1)} AS avg_corners, {per('fouls', 1)} AS avg_fouls,
  {rat('(sum(fouls) + 5 * sum(yellow_cards) + 15 * sum(red_cards))', GAMES, 1)} AS aggression_index,
  {isum('yellow_cards')} AS yellow_cards, {isum('red_cards')} AS red_cards {MM} GROUP BY team_name"""
register("q35_team_season_stats", mm(league.team_season_stats, SEASON), _STATS)
for _id, _kind in (("q36_attack_rankings", "attack"), ("q37_defence_rankings", "defence"),
                   ("q38_possession_rankings", "possession"), ("q39_discipline_rankings", "discipline")):
    register(_id, mm(league.ranking, SEASON, _kind),
             f"SELECT team_name, {', '.join(league.RANKINGS[_kind][0])} FROM ({_STATS})")
_rank = lambda c, d="": f"round(percent_rank() OVER (ORDER BY {c} {d} NULLS LAST) * 100)"
register("q40_radar", mm(league.radar, SEASON, [TEAM, OTHER]), f"""
SELECT * FROM (SELECT *, {_rank('goals_per_match')} AS attack_pct, {_rank('conceded_per_match', 'DESC')} AS defense_pct,
    {_rank('pass_accuracy')} AS passing_pct, {_rank('avg_possession')} AS possession_pct, {_rank('shot_conv')} AS efficiency_pct,
    {_rank('win_rate')} AS wins_pct
  FROM (SELECT team_name, {per('goals_scored', None)} AS goals_per_match, {per('goals_conceded', None)} AS conceded_per_match,
          {share('passes_accurate', 'total_passes', None)} AS pass_accuracy, {per('possession_pct', None)} AS avg_possession,
          {share('goals_scored', 'total_shots', None)} AS shot_conv, {pct(WIN, GAMES, None)} AS win_rate {MM} GROUP BY team_name))
WHERE team_name IN ('{TEAM}', '{OTHER}')""")

# team
T = f"{MM} AND team_name = '{TEAM}'"
register("q41_teams", mm(team.teams, SEASON), f"SELECT DISTINCT team_name, team_logo {MM}")
register("q42_team_header", mm(team.header, SEASON, TEAM), f"""
SELECT team_name, team_logo, max(coach_name) AS coach_name, {isum('points_earned')} AS points, {GAMES} AS matches, {WIN} AS wins,
  {DRAW} AS draws, {LOSS} AS losses, {isum('goals_scored')} AS gf, {isum('goals_conceded')} AS ga,
  CAST(sum(goals_scored) - sum(goals_conceded) AS BIGINT) AS gd {T} GROUP BY team_name, team_logo""")
_TK = {"goals_per_match": per("goals_scored", 2), "conceded_per_match": per("goals_conceded", 2),
       "pass_accuracy": share("passes_accurate", "total_passes"), "avg_possession": per("possession_pct", 1),
       "shot_conv": share("goals_scored", "total_shots"), "yc_per_match": per("yellow_cards", 2), "win_rate": pct(WIN, GAMES)}
_tr = {"goals_ratio": "goals_per_match", "conceded_ratio": "conceded_per_match", "pass_ratio": "pass_accuracy",
       "shot_conv_ratio": "shot_conv", "yc_ratio": "yc_per_match", "win_rate_ratio": "win_rate", "possession_ratio": "avg_possession"}
_LASTROUND = f"(SELECT max(match_round_number) {T})"
_PREV = f"(SELECT max(season) FROM mm WHERE season < '{SEASON}')"
_place = lambda where: f"""(SELECT place FROM (SELECT team_name, row_number() OVER (ORDER BY {GROUP}, {ORDER}, team_name) AS place
  FROM (SELECT team_name, max(standings_type) AS standings_type, {TABLE} FROM mm WHERE {PLAYED} AND {where} GROUP BY team_name))
  WHERE team_name = '{TEAM}')"""
_before = f"season = {_PREV} AND match_round_number <= {_LASTROUND}"
register("q43_team_kpis", mm(team.kpis, SEASON, TEAM), f"""
SELECT c.*, p.*, {", ".join(f"{rat('c.' + k, 'p.prev_' + k, 2)} AS {n}" for n, k in _tr.items())},
  {_place(f"season = '{SEASON}'")} AS current_rank, {_place(_before)} AS prev_rank
FROM (SELECT max(match_round_number) AS max_round, {", ".join(f"{v} AS {k}" for k, v in _TK.items())} {T}) c,
  (SELECT {", ".join(f"{v} AS prev_{k}" for k, v in _TK.items())} FROM mm WHERE {PLAYED} AND team_name = '{TEAM}' AND {_before}) p""")
register("q44_all_teams_points", mm(team.all_teams_points, SEASON, TEAM), f"""
SELECT match_round_number AS round, team_name, cumulative_points,
  CASE WHEN team_name = '{TEAM}' THEN team_name ELSE 'Other Teams' END AS highlight {MM}""")
register("q45_match_results", mm(team.match_log, SEASON, TEAM), f"""
SELECT match_date, match_round_name AS round, team_side AS home_away, opponent_team_name AS opponent, goals_scored AS gf,
  goals_conceded AS ga, result, points_earned AS pts, possession_pct AS possession, shots_on_goal, total_shots,
  {pct('passes_accurate', 'total_passes')} AS pass_accuracy, {pct('goals_scored', 'total_shots')} AS shot_conv, yellow_cards {T}""",
         dates=["match_date"])
register("q46_form_last10", mm(team.form, SEASON, TEAM), f"""
SELECT match_date, result, goals_scored AS gf, goals_conceded AS ga, opponent_team_name AS opponent {T}
ORDER BY match_date DESC, match_id DESC LIMIT 10""", dates=["match_date"])
register("q47_home_away_split", mm(team.home_away_split, SEASON, TEAM), f"""
SELECT team_side AS venue, {GAMES} AS matches, {WIN} AS wins, {DRAW} AS draws, {LOSS} AS losses, {isum('points_earned')} AS points,
  {per('goals_scored', 2)} AS goals_per_match, {per('goals_conceded', 2)} AS conceded_per_match,
  {share('passes_accurate', 'total_passes')} AS pass_accuracy, {per('possession_pct', 1)} AS avg_possession {T} GROUP BY team_side""")
GA = "(sum(goals_scored) + sum(assists))"
_r = lambda c: p90(f"sum({c})")
_SQUAD = f"""
SELECT player_name, player_photo, player_position, {isum('goals_scored')} AS goals, {isum('assists')} AS assists,
  CAST({GA} AS BIGINT) AS goal_contributions, {GAMES} AS matches, round(avg(rating), 2) AS avg_rating, {_r('goals_scored')} AS goals_per90,
  {p90(GA)} AS contributions_per90, {isum('shots_total')} AS shots, {_r('shots_total')} AS shots_per90,
  {isum('shots_on_target')} AS shots_on_target, {isum('big_chances_created')} AS big_chances_created, {isum('key_passes')} AS key_passes,
  {_r('key_passes')} AS key_passes_per90, {isum('chances_created')} AS chances_created, {_r('chances_created')} AS chances_created_per90,
  {isum('passes_total')} AS passes, {share('passes_accurate', 'passes_total')} AS pass_accuracy, {isum('crosses_total')} AS crosses,
  {_r('crosses_total')} AS crosses_per90, {share('crosses_accurate', 'crosses_total')} AS cross_accuracy, {isum('tackles')} AS tackles,
  {_r('tackles')} AS tackles_per90, {isum('interceptions')} AS interceptions, {_r('interceptions')} AS interceptions_per90,
  {isum('clearances')} AS clearances, {isum('aerials_won')} AS aerials_won, {isum('dribbles_completed')} AS dribbles,
  {_r('dribbles_completed')} AS dribbles_per90, {share('dribbles_completed', 'dribbles_attempts')} AS dribble_success_pct,
  {isum('yellow_cards')} AS yellow_cards, {isum('red_cards')} AS red_cards, {isum('fouls_committed')} AS fouls,
  {isum('fouls_drawn')} AS fouls_drawn, {isum('minutes_played')} AS minutes
{MP} AND team_name = '{TEAM}' GROUP BY player_name, player_photo, player_position HAVING {GAMES} >= 3"""
register("q48_squad_contributors", mp(team.squad, SEASON, TEAM), _SQUAD)
register("q48_squad_two_matches", mp(team.squad, SEASON, TEAM, 2), _SQUAD.replace(">= 3", ">= 2"))
for _kind, _metrics in team.METRIC_LISTS.items():
    _long = " UNION ALL ".join(f"SELECT player_name, player_photo, '{m}' AS value, '{lab}' AS label, CAST({m} AS DOUBLE) AS amount FROM sq"
                               for m, lab in _metrics)
    register(f"q49_{_kind}_metrics", mp(team.metric_board, SEASON, TEAM, _kind), f"""
SELECT value, label, row_number() OVER (PARTITION BY value ORDER BY amount DESC, player_name, player_photo) AS place, player_name, amount
FROM (WITH sq AS ({_SQUAD}) {_long}) WHERE amount IS NOT NULL""")
register("q50_phase_performance", mm(team.phase_performance, SEASON, TEAM), f"""
SELECT match_round_type AS phase, {GAMES} AS matches, {isum('points_earned')} AS points, {per('points_earned', 2)} AS points_per_match,
  {isum('goals_scored')} AS gf, {isum('goals_conceded')} AS ga, {per('goals_scored', 2)} AS goals_per_match {T} GROUP BY match_round_type""")

# players
register("q51_player_teams", mp(player.team_filter, SEASON), f"SELECT 'All' AS team_name UNION ALL SELECT DISTINCT team_name {MP}")
register("q52_positions", mp(player.position_filter, SEASON, [TEAM]), f"""
SELECT 'All' AS player_position UNION ALL SELECT DISTINCT player_position {MP} AND team_name = '{TEAM}' AND player_position IS NOT NULL""")
register("q53_players_in_team", mp(player.players, SEASON, [TEAM], ["Goalkeeper", "Defender"]), f"""
SELECT DISTINCT player_name {MP} AND team_name = '{TEAM}' AND player_position IN ('Goalkeeper', 'Defender')""")
_tops = {"goals": isum("goals_scored"), "assists": isum("assists"), "dribbles": isum("dribbles_completed"),
         "defensive_actions": "CAST(sum(tackles) + sum(interceptions) AS BIGINT)", "crosses": isum("crosses_total"),
         "passes": isum("passes_accurate")}
_cat = " UNION ALL ".join(f"SELECT '{n}' AS category, b.*, {c} AS stat_value, '{lab}' AS stat_label FROM b" for n, c, lab in player.CATEGORIES)
register("q54_top_players", mp(player.top_players, SEASON), f"""
SELECT category, player_name, player_photo, player_position, team_name, team_logo, stat_value, stat_label FROM (
  WITH b AS (SELECT player_name, player_photo, player_position, max(team_name) AS team_name, max(team_logo) AS team_logo,
      {", ".join(f"{v} AS {k}" for k, v in _tops.items())} {MP} GROUP BY player_name, player_photo, player_position HAVING {GAMES} >= 3)
  {_cat}) QUALIFY row_number() OVER (PARTITION BY category ORDER BY stat_value DESC, player_name, player_photo) = 1""")


def _chosen_player(spark, sf):
    """The player a reader would pick: the one with most minutes in the season."""
    from pyspark.sql import functions as F
    rows = common.in_season(warehouse(spark, sf).get("mart_player_facts"), SEASON)
    best = rows.groupBy("player_name").agg(F.sum("minutes_played").alias("m")).orderBy(F.col("m").desc(), "player_name").limit(1)
    return best.select("player_name").scalar()


def one_player(fn):
    return lambda spark, sf: fn(warehouse(spark, sf).get("mart_player_facts"), SEASON, _chosen_player(spark, sf))


_WHO = f"(SELECT player_name {MP} GROUP BY player_name ORDER BY sum(minutes_played) DESC, player_name LIMIT 1)"
P = f"{MP} AND player_name = {_WHO}"
register("q55_player_profile", one_player(player.profile), f"""
SELECT player_name, player_photo, team_name, team_logo, player_position, {GAMES} AS matches, {isum('minutes_played')} AS minutes,
  {isum('goals_scored')} AS goals, {isum('assists')} AS assists, {isum('shots_total')} AS shots, {isum('shots_on_target')} AS shots_on_target,
  {isum('key_passes')} AS key_passes, {isum('tackles')} AS tackles, {isum('yellow_cards')} AS yellow_cards, round(avg(rating), 2) AS avg_rating,
  {_r('goals_scored')} AS goals_per90, {_r('assists')} AS assists_per90, {p90(GA)} AS contributions_per90,
  {share('passes_accurate', 'passes_total')} AS pass_accuracy, {share('goals_scored', 'shots_total')} AS shot_conversion,
  {WIN} AS wins, {DRAW} AS draws, {LOSS} AS losses {P} GROUP BY player_name, player_photo, team_name, team_logo, player_position""")
register("q56_player_trend", one_player(player.trend),
         f"SELECT match_round_number AS round, goals_scored AS goals, assists, rating {P}")
register("q57_player_match_log", one_player(player.match_log), f"""
SELECT strftime(match_date, '%Y-%m-%d') AS match_date, match_round_name AS round, opponent_team_name AS opponent, team_side AS home_away,
  result, minutes_played, goals_scored AS goals, assists, shots_total AS shots, shots_on_target, key_passes, tackles, yellow_cards, rating {P}""")
_u = lambda c: p90(f"sum({c})", digits=None)
_ctx = {"goals_pct": "goals", "assists_pct": "assists", "rating_pct": "avg_rating", "goals_per90_pct": "goals_per90",
        "assists_per90_pct": "assists_per90", "pass_pct": "pass_accuracy", "shot_conv_pct": "shot_conversion", "defense_pct": "tackles_per90"}
_BOARD = f"""
SELECT player_name, {", ".join(f"{_rank(c)} AS {n}" for n, c in _ctx.items())}
FROM (SELECT player_name, sum(goals_scored) AS goals, sum(assists) AS assists, avg(rating) AS avg_rating, {_u('goals_scored')} AS goals_per90,
        {_u('assists')} AS assists_per90, {share('passes_accurate', 'passes_total', None)} AS pass_accuracy,
        {share('goals_scored', 'shots_total', None)} AS shot_conversion, {_u('tackles')} AS tackles_per90
      {MP} GROUP BY player_name HAVING sum(minutes_played) >= 450)"""
register("q58_league_context", one_player(player.league_context), f"SELECT * FROM ({_BOARD}) WHERE player_name = {_WHO}")
register("q58_percentile_board", mp(player.percentile_board, SEASON), _BOARD)

# referees
_AVG = {"yc": ("yellow_cards", 2), "rc": ("red_cards", 3)}
register("q59_referee_season_kpis", mm(venue.referee_kpis_league, SEASON), f"""
SELECT count(DISTINCT referee_name) AS total_referees, {per('yellow_cards', 2)} AS league_avg_yellows, {per('red_cards', 3)} AS league_avg_reds,
  {per('fouls', 1)} AS league_avg_fouls, {rat(SEVERITY, GAMES, 2)} AS league_severity_index {MM}""")
_yc = lambda s: f"coalesce(sum(yellow_cards) FILTER (team_side = '{s}'), 0)"
_REF = f"""
SELECT referee_name, {GAMES} AS matches_managed, {isum('yellow_cards')} AS total_yellow_cards, {isum('red_cards')} AS total_red_cards,
  {isum('fouls')} AS total_fouls, {per('yellow_cards', 2)} AS avg_yellows_per_match, {per('red_cards', 3)} AS avg_reds_per_match,
  {per('fouls', 1)} AS avg_fouls_per_match, {rat(SEVERITY, GAMES, 2)} AS card_severity_index,
  {rat(_yc('Home'), GAMES, 2)} AS home_yc_per_match, {rat(_yc('Away'), GAMES, 2)} AS away_yc_per_match,
  {pct(_yc('Home'), 'sum(yellow_cards)')} AS home_yc_pct {MM} GROUP BY referee_name"""
register("q60_referee_season_stats", mm(venue.referee_stats, SEASON), _REF)
register("q61_top3_strictest", mm(venue.strictest, SEASON),
         f"SELECT * FROM ({_REF}) ORDER BY avg_yellows_per_match DESC NULLS LAST, referee_name LIMIT 3")
register("q62_top3_lenient", mm(venue.strictest, SEASON, lenient=True),
         f"SELECT * FROM ({_REF}) ORDER BY avg_yellows_per_match NULLS LAST, referee_name LIMIT 3")
_trend = lambda more: f"""
SELECT substr(season, 3, 2) || '/' || right(season, 2) AS season, {per('yellow_cards', 2)} AS yc_per_match, {per('red_cards', 4)} AS rc_per_match,
  {per('fouls', 1)} AS fouls_per_match, {rat(SEVERITY, GAMES, 2)} AS severity_index FROM mm WHERE {PLAYED} AND season >= '2020/21' {more}
GROUP BY mm.season"""
_ONE = f"AND referee_name = '{REFEREE}'"
register("q63_historical_trends", mm(venue.card_trend), _trend(""))
register("q64_referee_trends", mm(venue.card_trend, REFEREE), _trend(_ONE))
register("q65_combined_trends", mm(venue.combined_trends, REFEREE), f"""
SELECT *, 'League Avg' AS source FROM ({_trend('')}) UNION ALL SELECT *, '{REFEREE}' FROM ({_trend(_ONE)})""")
register("q66_referee_team_exposure", mm(venue.referee_exposure, SEASON, REFEREE),
         f"SELECT team_name, {GAMES} AS matches {MM} {_ONE} GROUP BY team_name")
register("q67_referee_match_log", mm(venue.referee_log, SEASON, REFEREE), f"""
SELECT match_date, match_round_name AS round, match_name, score, {isum('yellow_cards')} AS yellow_cards, {isum('red_cards')} AS red_cards,
  {isum('fouls')} AS fouls {MM} {_ONE} GROUP BY match_date, match_round_name, match_name, score""", dates=["match_date"])
register("q68_referee_kpis", mm(venue.referee_of, SEASON, REFEREE), f"SELECT * FROM ({_REF}) WHERE referee_name = '{REFEREE}'")

# stadiums
_LOC = f"{MM} AND stadium_latitude BETWEEN 54.5 AND 57.8 AND stadium_longitude BETWEEN 7.5 AND 15.5"
_NAMED = "stadium_name NOT LIKE '%Unknown%' AND stadium_name NOT LIKE '%Applicable%'"
_grass = lambda c: f"regexp_matches(lower({c}), 'grass|natural')"
_turf = lambda c: f"regexp_matches(lower({c}), 'artif|turf')"
register("q69_stadium_stats", mm(venue.stadium_stats, SEASON), f"""
SELECT *, CASE WHEN {_grass('stadium_surface')} THEN 1 WHEN {_turf('stadium_surface')} THEN 2 ELSE 3 END AS surface_code,
  total_goals - (min(total_goals) OVER () - 1) AS total_goals_scaled
FROM (SELECT stadium_name, max(stadium_latitude) AS lat, max(stadium_longitude) AS lon, max(stadium_surface) AS stadium_surface,
        max(stadium_capacity) AS stadium_capacity, {GAMES} AS total_matches, {isum('goals_scored')} AS total_goals,
        {per('goals_scored', 2)} AS goals_per_match, {HOME_WIN} AS home_win_pct, {pct(DRAW, 'count(*)')} AS draw_pct,
        {share('passes_accurate', 'total_passes')} AS pass_accuracy, {per('yellow_cards', 2)} AS yc_per_match,
        {per('fouls', 1)} AS fouls_per_match, {per('corner_kicks', 1)} AS corners_per_match
      {_LOC} AND {_NAMED} GROUP BY stadium_name HAVING {GAMES} >= 4)""")
register("q70_surface_analysis", mm(venue.surface_analysis, SEASON), f"""
SELECT stadium_surface, {GAMES} AS matches, {per('goals_scored', 2)} AS goals_per_match, {HOME_WIN} AS home_win_pct,
  {pct(DRAW, 'count(*)')} AS draw_pct, {share('passes_accurate', 'total_passes')} AS pass_accuracy, {per('possession_pct', 1)} AS avg_possession,
  {per('shots_on_goal', 1)} AS shots_per_match, {per('yellow_cards', 2)} AS yc_per_match, {per('fouls', 1)} AS fouls_per_match,
  {per('corner_kicks', 1)} AS corners_per_match, {share('goals_scored', 'total_shots')} AS shot_conversion,
  {share('crosses_accurate', 'crosses_total')} AS cross_accuracy
{_LOC} AND coalesce(stadium_surface, '') <> '' GROUP BY stadium_surface""")
_H = "FILTER (team_side = 'Home')"
_mode = lambda c: f"""(SELECT {c} {_LOC} AND team_side = 'Home' AND stadium_name = o.stadium_name AND {c} IS NOT NULL
  GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"""
_modes = lambda c: f"""(SELECT stadium_name AS sn, {c} AS pick FROM (SELECT stadium_name, {c}, count(*) AS n {_LOC} AND team_side = 'Home'
  AND {c} IS NOT NULL GROUP BY stadium_name, {c}) QUALIFY row_number() OVER (PARTITION BY stadium_name ORDER BY n DESC, {c}) = 1)"""
_FORT = f"""
SELECT o.*, a.pick AS home_team, b.pick AS team_logo
FROM (SELECT stadium_name, max(stadium_surface) AS stadium_surface, max(stadium_capacity) AS stadium_capacity, {GAMES} {_H} AS home_matches,
        count(*) FILTER (team_side = 'Home' AND result = 'Win') AS home_wins, count(*) FILTER (team_side = 'Home' AND result = 'Draw') AS home_draws,
        count(*) FILTER (team_side = 'Home' AND result = 'Loss') AS home_losses,
        {pct("count(*) FILTER (team_side = 'Home' AND result = 'Win')", f"{GAMES} {_H}")} AS home_win_pct,
        {rat(f"sum(goals_scored) {_H}", f"{GAMES} {_H}", 2)} AS goals_scored_per_match,
        {rat(f"sum(goals_conceded) {_H}", f"{GAMES} {_H}", 2)} AS goals_conceded_per_match
      {_LOC} AND {_NAMED} GROUP BY stadium_name HAVING {GAMES} {_H} >= 4) o
  LEFT JOIN {_modes('team_name')} a ON a.sn = o.stadium_name LEFT JOIN {_modes('team_logo')} b ON b.sn = o.stadium_name"""
register("q71_fortress_ranking", mm(venue.fortress, SEASON), _FORT)
register("q72_fortress_podium", mm(venue.fortress_podium, SEASON),
         f"SELECT * FROM ({_FORT}) ORDER BY home_win_pct DESC NULLS LAST, stadium_name LIMIT 3")
register("q73_stadium_kpis", mm(venue.stadium_kpis, SEASON), f"""
SELECT count(*) AS total_stadiums, count(*) FILTER ({_grass('s')}) AS grass_stadiums, count(*) FILTER ({_turf('s')}) AS turf_stadiums
FROM (SELECT stadium_name, max(stadium_surface) AS s {_LOC} AND stadium_name NOT LIKE '%Unknown%' GROUP BY stadium_name HAVING {GAMES} >= 4)""")
