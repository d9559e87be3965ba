"""Domain codes. They must match the feed, so they are kept together as plain tables."""

FINISHED_STATES = ("FT", "FT_PEN", "AET")
FINISHED_STATUS_NAMES = ("Full Time", "After Extra Time", "After Penalties")
PLAYED_RESULTS = ("Win", "Draw", "Loss")
STARTER_TYPE = 11
KEEPER_POSITION = 24
MINUTES_STAT = 119
RATING_STAT = 118
MAIN_REFEREE_TYPE = 6
GROUP_STAGE = "GROUP_STAGE"
REGULAR_STAGE = "Regular Season"
LOCAL_ZONE = "Europe/Copenhagen"
FIRST_SEASON = "2020/21"
FIRST_SEASON_YEAR = 2010
CALENDAR_START, CALENDAR_END = "2010-01-01", "2030-12-31"
SUB_LAST_MINUTE = 200

# team statistics, one row per (fixture, team, code)
TEAM_STATS = {34: "corner_kicks", 45: "ball_possession_pct", 83: "red_cards", 84: "yellow_cards"}

# player statistics, one row per (fixture, player, code)
PLAYER_STATS = {
    52: "goals_scored", 324: "own_goals", 79: "assists",
    42: "shots_total", 86: "shots_on_target", 41: "shots_off_target", 58: "shots_blocked",
    64: "woodwork_hits", 580: "big_chances_created", 581: "big_chances_missed", 9706: "chances_created",
    80: "passes_total", 116: "passes_accurate", 117: "key_passes",
    27269: "passes_final_third", 27272: "passes_backward",
    122: "long_balls", 123: "long_balls_won", 98: "crosses_total", 99: "crosses_accurate",
    78: "tackles", 27267: "tackles_won", 101: "clearances", 100: "interceptions",
    107: "aerials_won", 27266: "aerials_lost", 97: "blocks", 27271: "balls_recovered",
    583: "last_man_tackle", 582: "clearances_off_line",
    105: "duels_total", 106: "duels_won", 1491: "duels_lost",
    108: "dribbles_attempts", 109: "dribbles_completed", 110: "times_dribbled_past", 94: "dispossessed",
    56: "fouls_committed", 96: "fouls_drawn", 84: "yellow_cards", 85: "yellow_red_cards", 83: "red_cards",
    51: "offsides",
    115: "penalty_won", 114: "penalty_committed", 111: "penalty_scored", 112: "penalty_missed", 113: "penalty_saved",
    88: "goals_conceded", 57: "saves", 104: "saves_inside_box", 103: "goalkeeper_punches", 584: "high_ball_claims",
    571: "errors_leading_to_goal", 48997: "errors_leading_to_shot",
    27273: "possession_losses",
}
# reported for goalkeepers only, NULL for everyone else
KEEPER_STATS = ("goals_conceded", "saves", "saves_inside_box", "goalkeeper_punches", "high_ball_claims")

# league-table details, one row per (standing, code)
STANDING_STATS = {
    129: "overall_played", 130: "overall_won", 131: "overall_draw", 132: "overall_lost",
    133: "goals_for", 134: "goals_against", 179: "goal_diff", 187: "overall_points",
    135: "home_played", 136: "home_won", 137: "home_draw", 138: "home_lost",
    139: "home_goals_for", 140: "home_goals_against", 185: "home_points",
    141: "away_played", 142: "away_won", 143: "away_draw", 144: "away_lost",
    145: "away_goals_for", 146: "away_goals_against", 186: "away_points",
}
STREAK_STAT = 176

POSITION_SHORT_CODES = {
    "Goalkeeper": "GK", "Centre Back": "CB", "Left Back": "LB", "Right Back": "RB",
    "Defensive Midfield": "DM", "Central Midfield": "CM", "Attacking Midfield": "AM",
    "Left Midfield": "LM", "Right Midfield": "RM", "Left Wing": "LW", "Right Wing": "RW", "Attacker": "ST",
}

MATCH_TYPES = {"GROUP_STAGE": "Group Stage", "KNOCK_OUT": "Knockout"}
MATCH_RESULTS = {1: "Win", 2: "Draw", 3: "Loss", 4: "Pending",
                 -1: "Unknown Match Result", -2: "Not Applicable Match Result"}
TEAM_SIDES = {1: "Home", 2: "Away", -1: "Unknown Team Side", -2: "Not Applicable Team Side"}
APPEARANCE_TYPES = {1: "Starter", 2: "Substitute",
                    -1: "Unknown Appearance Type", -2: "Not Applicable Appearance Type"}

# archived feed: status families and text-labelled team statistics
LEGACY_FINISHED = ("FT", "AET", "PEN")
LEGACY_LIVE = ("NS", "TBD", "1H", "HT", "2H", "ET", "BT", "P", "LIVE")
LEGACY_VOID = ("PST", "CANC", "ABD", "AWD", "WO", "SUSP", "INT")
LEGACY_POINT_ROUNDS = ("Regular Season", "Championship Group", "Relegation Group")
