"""Fixed schemas of the three stored tables.

Ids that look like numbers (``32428e51``) are always strings; nothing is
inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()
D = T.DoubleType()


def _struct(cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


SEASON_DIMS_COLUMNS = [
    ("season_id", S),
    ("league_id", S),
    ("league_name", S),
    ("season_year_id", S),
    ("season_name", S),
    ("url", S),
]
SEASON_DIMS = _struct(SEASON_DIMS_COLUMNS)

# Columns a schedule reader requires from the season dimension.
SCHEDULE_REQUIRED = ["league_id", "league_name", "season_id", "season_name", "url"]

MATCH_STATS_COLUMNS = [
    ("season_id", S),
    ("round", S),
    ("date", S),
    ("start_time", S),
    ("home_team", S),
    ("away_team", S),
    ("score", S),
    ("attendance", S),
    ("referee", S),
    ("venue", S),
    ("match_report", S),
    ("notes", S),
    ("home_score", S),
    ("away_score", S),
    ("match_id", S),
]
MATCH_STATS = _struct(MATCH_STATS_COLUMNS)

# Stat keys of a schedule row, in capture order.
SCHEDULE_STAT_KEYS = [c for c, _ in MATCH_STATS_COLUMNS[:12]]

PLAYER_COUNT_COLUMNS = [
    "minutes",
    "goals",
    "assists",
    "pens_made",
    "pens_att",
    "shots",
    "shots_on_target",
    "cards_yellow",
    "cards_red",
    "fouls",
    "fouled",
    "offsides",
    "crosses",
    "tackles_won",
    "interceptions",
    "own_goals",
    "pens_won",
    "penalties_conceded",
]
GK_COLUMNS = ["gk_shots_on_target_against", "gk_goals_against", "gk_saves", "gk_save_pct"]

PLAYER_MATCH_STATS_COLUMNS = (
    [
        ("team_name", S),
        ("player_url", S),
        ("player_id", S),
        ("match_id", S),
        ("player", S),
        ("lineup_status", S),
        ("nationality", S),
        ("position", S),
        ("age", S),
    ]
    + [(c, L) for c in PLAYER_COUNT_COLUMNS]
    + [("primary_position", S)]
    + [(c, D) for c in GK_COLUMNS]
)
PLAYER_MATCH_STATS = _struct(PLAYER_MATCH_STATS_COLUMNS)
PLAYER_COLUMNS = [c for c, _ in PLAYER_MATCH_STATS_COLUMNS]

# Outfield/keeper stat keys of a player table row (capture order).
OUTFIELD_STAT_KEYS = ["player", "nationality", "position", "age"] + PLAYER_COUNT_COLUMNS[:]
OUTFIELD_TEXT_KEYS = {"player", "nationality", "position"}
KEEPER_STAT_KEYS = ["player", "nationality"] + GK_COLUMNS
KEEPER_TEXT_KEYS = {"player", "nationality"}

# Old spellings accepted on read: {old: new}.
COLUMN_ALIASES = {"tackles_wom": "tackles_won"}


def all_string(schema: T.StructType) -> T.StructType:
    """Same column names, every field a string (raw CSV layer)."""
    return _struct([(f.name, S) for f in schema.fields])
