"""Independent SQL (DuckDB dialect) for every registered query.

The driver runs these next to the Spark queries on the same parquet tables.
They take their own road to each result - lookup tables for outcomes and
kick-off bands, sides as a union, streaks as differences of daily totals,
figures per grain joined back - with the same explicit tie-breaks and NULLS
LAST ordering as the Spark code. Sums are cast to BIGINT and row numbers to
INTEGER to line up with Spark's result types.
"""

from __future__ import annotations

from touchline.functions.text import (
    MATCH_URL_MARKER,
    PLAYER_URL_MARKER,
    SCORE_DASHES,
    SHOOTOUT_PATTERN,
    SURROGATE_NULL,
)
from touchline.sources.shim import BASE_URL

EN, EM, MOJI = SCORE_DASHES


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def hex8(expr: str) -> str:
    return f"lpad(lower(hex({expr})), CAST(greatest(8, length(hex({expr}))) AS INTEGER), '0')"


def token(url: str, marker: str) -> str:
    return (f"CASE WHEN strpos({url}, {q(marker)}) > 0 "
            f"THEN nullif(regexp_extract({url}, {q(marker + '([^/]*)')}, 1), '') END")


def slug_name(url: str, marker: str) -> str:
    return (f"CASE WHEN strpos({url}, {q(marker)}) > 0 THEN nullif(trim(replace(regexp_extract({url}, "
            f"{q(marker + '[^/]*/([^/]*)')}, 1), '-', ' ')), '') END")


def normalize_score(expr: str) -> str:
    return (f"nullif(trim(replace(replace(replace({expr}, {q(EN)}, '-'), {q(EM)}, '-'), {q(MOJI)}, '-')), '')")


def surrogate(expr: str) -> str:
    return f"md5(coalesce(CAST({expr} AS VARCHAR), {q(SURROGATE_NULL)}))"


# --------------------------------------------------------------------------
# League shim (mirror of touchline.sources.shim)
# --------------------------------------------------------------------------
SHIM_SCHEDULE = f"""
sched_base AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS ck, o.o_orderdate AS od,
         hn.n_name AS home_team, an.n_name AS away_team
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation hn ON hn.n_nationkey = c.c_nationkey
  JOIN nation an ON an.n_nationkey = (c.c_nationkey + 1 + o.o_orderkey % 24) % 25
),
sched_parts AS (
  SELECT *,
    CASE k % 4 WHEN 0 THEN '-' WHEN 1 THEN {q(EN)} WHEN 2 THEN {q(EM)} ELSE {q(MOJI)} END AS dash,
    CAST(ck % 5 AS VARCHAR) AS hs, CAST(k % 4 AS VARCHAR) AS aws
  FROM sched_base
),
sched_scored AS (
  SELECT *,
    CASE WHEN k % 13 = 0 AND ck % 5 = k % 4
         THEN '(' || CAST(2 + k % 5 AS VARCHAR) || ') ' || hs || dash || aws || ' (' || CAST(2 + ck % 3 AS VARCHAR) || ')'
         ELSE hs || dash || aws END AS s0
  FROM sched_parts
),
schedule_capture AS (
  SELECT
    '73_' || CAST(year(od) AS VARCHAR) AS season_id,
    CASE WHEN k % 13 = 0 THEN CASE k % 3 WHEN 0 THEN 'Quarterfinals' WHEN 1 THEN 'Semifinals' ELSE 'Final' END END AS round,
    strftime(od, '%Y-%m-%d') AS date,
    CASE WHEN k % 29 <> 0 THEN lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':' || CASE WHEN k % 2 = 0 THEN '00' ELSE '30' END END AS start_time,
    home_team, away_team,
    CASE WHEN NOT (k % 97 = 0 OR k % 89 = 0) THEN CASE WHEN k % 7 = 0 THEN ' ' || s0 || ' ' ELSE s0 END END AS score,
    CASE WHEN k % 11 <> 0 THEN format('{{:,}}', 500 + (ck * 7) % 20000) END AS attendance,
    'Referee ' || CAST(ck % 40 AS VARCHAR) AS referee,
    home_team || ' Park' AS venue,
    CASE WHEN k % 211 <> 0 THEN {q(BASE_URL + MATCH_URL_MARKER)} || {hex8('k')} || '/' || replace(home_team, ' ', '-') || '-' || replace(away_team, ' ', '-') END AS match_report,
    CASE WHEN k % 97 = 0 THEN CASE WHEN k % 2 = 0 THEN 'Match Cancelled' ELSE 'Match canceled due to weather' END
         WHEN k % 89 = 0 THEN CASE WHEN k % 2 = 0 THEN 'Match awarded' END
         WHEN k % 31 = 0 THEN 'Played behind closed doors' END AS notes,
    k AS order_key
  FROM sched_scored
),
match_stats_k AS (
  SELECT season_id, round, date, start_time, home_team, away_team,
    CASE WHEN sc IS NOT NULL THEN '''' || sc END AS score,
    attendance, referee, venue, match_report, notes,
    CASE WHEN strpos(sc, '-') > 0 THEN nullif(trim(split_part(sc, '-', 1)), '') END AS home_score,
    CASE WHEN strpos(sc, '-') > 0 THEN nullif(trim(substr(sc, strpos(sc, '-') + 1)), '') END AS away_score,
    {token('match_report', MATCH_URL_MARKER)} AS match_id,
    order_key
  FROM (SELECT *, {normalize_score('score')} AS sc FROM schedule_capture)
),
match_stats AS (SELECT * EXCLUDE (order_key) FROM match_stats_k)"""

_CNT = [
    ("goals", 1, 1, 4), ("assists", 1, 2, 3), ("pens_made", 2, 1, 5), ("pens_att", 3, 1, 5),
    ("shots", 1, 3, 6), ("shots_on_target", 2, 3, 4), ("cards_yellow", 3, 2, 4), ("cards_red", 5, 1, 9),
    ("fouls", 1, 5, 4), ("fouled", 5, 3, 4), ("offsides", 2, 5, 3), ("crosses", 3, 5, 7),
    ("tackles_won", 7, 1, 5), ("interceptions", 1, 7, 5), ("own_goals", 7, 3, 11), ("pens_won", 3, 7, 6),
    ("penalties_conceded", 7, 5, 8),
]
_cnt_sql = ",\n    ".join(f"CAST((pk * {a} + ok * {b} + ln) % {m} AS BIGINT) AS {n}" for n, a, b, m in _CNT)

SHIM_PLAYERS = f"""
player_base AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, l.l_linenumber AS ln, l.l_quantity AS qty,
         m.home_team, m.away_team, m.match_id, p.p_type, s.s_name, sn.n_name AS s_nation,
         CASE WHEN l.l_partkey % 53 <> 0 THEN {q(BASE_URL + PLAYER_URL_MARKER)} || {hex8('l.l_suppkey')} || '/' || replace(s.s_name, '#', '-') END AS url,
         p.p_type || CASE WHEN l.l_partkey % 4 = 0 THEN ',MF' WHEN l.l_partkey % 4 = 1 THEN ',DF' ELSE '' END AS position
  FROM lineitem l
  JOIN match_stats_k m ON l.l_orderkey = m.order_key
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
),
outfield AS (
  SELECT
    CASE WHEN ln = 7 THEN home_team || ' Reserves' WHEN ln % 2 = 1 THEN home_team ELSE away_team END AS team_name,
    url AS player_url,
    {token('url', PLAYER_URL_MARKER)} AS player_id,
    match_id,
    coalesce({slug_name('url', PLAYER_URL_MARKER)}, s_name) AS player,
    CASE WHEN ln <= 4 THEN 'Starter' ELSE 'Sub' END AS lineup_status,
    CASE WHEN sk % 17 <> 0 THEN s_nation END AS nationality,
    position,
    CASE WHEN ok % 50 = 0 THEN '0' WHEN ok % 71 = 0 THEN NULL
         ELSE CAST(18 + sk % 20 AS VARCHAR) || '-' || lpad(CAST(pk % 365 AS VARCHAR), 3, '0') END AS age,
    CAST(qty AS BIGINT) + 40 AS minutes,
    {_cnt_sql},
    CASE WHEN strpos(position, ',') > 0 THEN trim(split_part(position, ',', 1)) ELSE position END AS primary_position,
    ln, pk, ok
  FROM player_base
),
keeper AS (
  SELECT player_id AS k_player_id, match_id AS k_match_id,
    CAST(pk % 9 AS VARCHAR) AS gk_shots_on_target_against,
    CAST(ok % 4 AS VARCHAR) AS gk_goals_against,
    CAST(pk % 7 AS VARCHAR) AS gk_saves,
    CASE WHEN pk % 9 <> 0 THEN CAST((pk % 7) * 10 AS VARCHAR) ELSE '' END AS gk_save_pct
  FROM outfield WHERE ln = 1
),
player_match_stats AS (
  SELECT o.* EXCLUDE (ln, pk, ok),
    coalesce(TRY_CAST(k.gk_shots_on_target_against AS DOUBLE), 0.0::DOUBLE) AS gk_shots_on_target_against,
    coalesce(TRY_CAST(k.gk_goals_against AS DOUBLE), 0.0::DOUBLE) AS gk_goals_against,
    coalesce(TRY_CAST(k.gk_saves AS DOUBLE), 0.0::DOUBLE) AS gk_saves,
    coalesce(TRY_CAST(k.gk_save_pct AS DOUBLE), 0.0::DOUBLE) AS gk_save_pct
  FROM outfield o LEFT JOIN keeper k
    ON o.match_id = k.k_match_id AND o.player_id IS NOT DISTINCT FROM k.k_player_id
)"""

# --------------------------------------------------------------------------
# Marts
# --------------------------------------------------------------------------
SO = SHOOTOUT_PATTERN

DIM_MATCH = f"""
kickoff_bands(from_hour, to_hour, label) AS (VALUES
  (0, 12, 'Morning Kickoff'), (13, 16, 'Afternoon Kickoff'), (17, 19, 'Evening Kickoff'), (20, 22, 'Night Kickoff')),
result_names(goals, penalties, label) AS (VALUES
  (1, NULL, 'Home Win'), (-1, NULL, 'Away Win'), (0, NULL, 'Draw'), (0, 1, 'Home Win on Penalties'), (0, -1, 'Away Win on Penalties')),
score_texts AS (
  SELECT *, trim(score, ' ''') AS txt, regexp_extract(trim(score, ' '''), {q(SO)}, ['hp', 'h', 'a', 'ap']) AS so FROM match_stats
),
score_numbers AS (
  SELECT * EXCLUDE (so),
    CAST(nullif(so.hp, '') AS INTEGER) AS hp, CAST(nullif(so.ap, '') AS INTEGER) AS ap,
    CAST(coalesce(nullif(so.h, ''), trim(split_part(txt, '-', 1))) AS INTEGER) AS h,
    CAST(coalesce(nullif(so.a, ''), trim(split_part(txt, '-', 2))) AS INTEGER) AS a,
    CAST(start_time AS TIME) AS kick_off
  FROM score_texts
),
dim_match AS (
  SELECT s.match_id, s.season_id, coalesce(s.round, 'Regular Season') AS game_type, CAST(s.date AS DATE) AS match_date,
    CAST(s.kick_off AS VARCHAR) AS match_time, coalesce(k.label, 'Late Night Kickoff') AS match_time_of_day,
    s.home_team AS home_team_name, s.away_team AS away_team_name, s.h AS home_team_score, s.a AS away_team_score,
    s.hp AS home_penalty_shootout_goals, s.ap AS away_penalty_shootout_goals,
    coalesce(r.label, CASE WHEN s.h IS NULL AND s.a IS NULL AND regexp_matches(s.notes, '(?i)match cancell?ed') THEN 'Cancelled' ELSE 'Unknown' END) AS match_result,
    s.attendance, s.referee AS match_referee_name, s.venue AS match_venue, s.match_report AS match_report_url, s.notes AS match_notes
  FROM score_numbers s
  LEFT JOIN kickoff_bands k ON hour(s.kick_off) BETWEEN k.from_hour AND k.to_hour
  LEFT JOIN result_names r ON r.goals = sign(s.h - s.a)
    AND r.penalties IS NOT DISTINCT FROM (CASE WHEN s.h <> s.a OR (s.hp IS NULL AND s.ap IS NULL) THEN NULL ELSE coalesce(sign(s.hp - s.ap), 0) END)
)"""

_WEEK_ORDER = ["match_date", "match_id", "match_time", "game_type", "match_location", "opponent_team_name", "match_outcome", "goals_scored", "goals_conceded"]
# Week-by-week standings: name -> (columns, direction).
_STANDINGS = {
    "": ("season_points season_goal_difference", "DESC"),
    "_home": ("season_points_home", "DESC"),
    "_away": ("season_points_away", "DESC"),
    "_goals_scored_best_offense": ("season_goals_scored", "DESC"),
    "_goals_scored_worst_offense": ("season_goals_scored", "ASC"),
    "_goals_conceded_worst_defence": ("season_goals_conceded", "DESC"),
    "_goals_conceded_best_defence": ("season_goals_conceded", "ASC"),
}
_standings_sql = ",\n    ".join(
    "CAST(row_number() OVER (PARTITION BY season_id, match_week_number ORDER BY "
    + ", ".join(f"{c} {way} NULLS LAST" for c in cols.split()) + f", team_id ASC) AS INTEGER) AS current_match_week_position{name}"
    for name, (cols, way) in _STANDINGS.items())
# Day totals: name -> summed expression.
_DAY_SUMS = {
    "season_points": "match_points",
    "season_points_home": "if(match_location = 'Home', match_points, 0)",
    "season_points_away": "if(match_location = 'Away', match_points, 0)",
    "season_goals_scored": "goals_scored",
    "season_goals_conceded": "goals_conceded",
    "wins": "(match_outcome = 'Win')::INTEGER",
    "others": "(match_outcome <> 'Win')::INTEGER",
}


def nulls_last(cols, table: str = "") -> str:
    return ", ".join(f"{table}{c} ASC NULLS LAST" for c in cols)


MATCHES_BY_TEAM = f"""
favoured(match_result, side) AS (VALUES
  ('Home Win', 'Home'), ('Home Win on Penalties', 'Home'), ('Away Win', 'Away'), ('Away Win on Penalties', 'Away'), ('Draw', 'Neither')),
sides AS (
  SELECT 'Home' AS match_location, home_team_name AS team_name, away_team_name AS opponent_team_name,
    home_team_score AS goals_scored, away_team_score AS goals_conceded,
    match_id, match_date, match_time, season_id, game_type, match_result FROM dim_match
  UNION ALL
  SELECT 'Away', away_team_name, home_team_name, away_team_score, home_team_score,
    match_id, match_date, match_time, season_id, game_type, match_result FROM dim_match
  WHERE away_team_name IS DISTINCT FROM home_team_name
),
mbt_matches AS (
  SELECT DISTINCT {surrogate('team_name')} AS team_id, team_name, match_id, match_date, match_time, season_id,
    split_part(season_id, '_', 2) AS season, game_type, match_location, opponent_team_name, match_outcome, goals_scored, goals_conceded,
    if(game_type = 'Regular Season', coalesce(map {{'Win': 3, 'Draw': 1}}[match_outcome], 0), 0) AS match_points
  FROM (
    SELECT s.*, if(f.side IS NULL, 'Unknown', if(f.side = 'Neither', 'Draw', if(f.side = s.match_location, 'Win', 'Loss'))) AS match_outcome
    FROM sides s LEFT JOIN favoured f USING (match_result) WHERE s.team_name IS NOT NULL)
),
team_days AS (
  SELECT team_id, season_id, match_date, {', '.join(f"sum({e}) AS day_{n}" for n, e in _DAY_SUMS.items())}
  FROM mbt_matches GROUP BY ALL
),
team_totals AS (
  SELECT team_id, season_id, match_date, day_wins, day_others, {', '.join(f"CAST(sum(day_{n}) OVER so_far AS BIGINT) AS {n}" for n in _DAY_SUMS)}
  FROM team_days WINDOW so_far AS (PARTITION BY team_id, season_id ORDER BY match_date ASC NULLS LAST)
),
team_runs AS (  -- a run starts on the day that last raised the other count
  SELECT *, wins - min(wins - day_wins) OVER (PARTITION BY team_id, season_id, others) AS win_run,
    others - min(others - day_others) OVER (PARTITION BY team_id, season_id, wins) AS winless_run
  FROM team_totals
),
team_weeks AS (
  SELECT m.*, CAST(row_number() OVER (PARTITION BY m.team_id, m.season_id ORDER BY {nulls_last(_WEEK_ORDER, 'm.')}) AS INTEGER) AS match_week_number,
    t.season_points, t.season_points_home, t.season_points_away, t.season_goals_scored, t.season_goals_conceded,
    t.season_goals_scored - t.season_goals_conceded AS season_goal_difference,
    CAST(if(m.match_outcome = 'Win', t.win_run, 0) AS BIGINT) AS consecutive_win_count,
    CAST(if(m.match_outcome = 'Win', 0, t.winless_run) AS BIGINT) AS consecutive_winless_count
  FROM mbt_matches m JOIN team_runs t
    ON m.team_id = t.team_id AND m.season_id IS NOT DISTINCT FROM t.season_id AND m.match_date IS NOT DISTINCT FROM t.match_date
),
matches_by_team AS (
  SELECT *, {_standings_sql}
  FROM team_weeks
)"""


def with_ctes(*blocks: str, select: str) -> str:
    body = ",\n".join(b.strip().rstrip(",") for b in blocks)
    return f"WITH {body}\n{select}"


def team_ctes() -> list[str]:
    return [SHIM_SCHEDULE, DIM_MATCH, MATCHES_BY_TEAM]


# --------------------------------------------------------------------------
# Player mart
# --------------------------------------------------------------------------
def _player_sql() -> str:
    from touchline.operators.player_season import SEASON_RANKS, SEASON_TOTALS
    from touchline.plans.match_level_player import APPEARANCE_TIEBREAK

    totals = ", ".join(f"CAST(sum({src}) AS BIGINT) AS {t}" for t, src in SEASON_TOTALS)
    ranks = ", ".join(f"CAST(dense_rank() OVER (PARTITION BY s.team_name, s.season_id ORDER BY {t} DESC NULLS LAST, player ASC NULLS LAST) AS INTEGER) AS {r}"
                      for r, t in SEASON_RANKS)

    def same(a, b, cols):
        return " AND ".join(f"{a}.{c} IS NOT DISTINCT FROM {b}.{c}" for c in cols)

    return f"""
appearances AS (
  SELECT p.*, w.season_id, w.match_week_number, w.match_date
  FROM player_match_stats p LEFT JOIN matches_by_team w USING (match_id, team_name)
),
primary_position_by_season AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY player_id, season_id
      ORDER BY total_minutes DESC NULLS LAST, primary_position ASC NULLS LAST) AS INTEGER) AS season_primary_position_rank
  FROM (SELECT player_id, season_id, primary_position, CAST(sum(minutes) AS BIGINT) AS total_minutes FROM appearances GROUP BY ALL)
),
season_positions AS (
  SELECT player_id, season_id, count(primary_position) AS season_primary_position_count,
    any_value(primary_position) FILTER (season_primary_position_rank = 1) AS season_primary_position
  FROM primary_position_by_season GROUP BY ALL
),
season_rows AS (
  SELECT *, try_cast(split_part(age, '-', 1) AS INTEGER) + try_cast(split_part(age, '-', 2) AS INTEGER) / 365 AS age_numeric
  FROM (SELECT DISTINCT * FROM appearances)
),
season_ages AS (
  SELECT player_id, season_id, min(age_numeric) AS age_at_season_start, max(age_numeric) AS age_at_season_end, avg(age_numeric) AS average_age_per_season
  FROM season_rows GROUP BY ALL
),
season_sums AS (SELECT player_id, season_id, team_name, {totals} FROM season_rows GROUP BY ALL),
season_names AS (SELECT DISTINCT player_id, season_id, team_name, player FROM season_rows),
season_ranks AS (
  SELECT n.player, s.*, {ranks}
  FROM season_names n JOIN season_sums s ON {same('n', 's', ['player_id', 'season_id', 'team_name'])}
),
match_level_player_data AS (
  SELECT r.*, c.season_primary_position, coalesce(c.season_primary_position_count, 0) AS season_primary_position_count,
    a.age_at_season_start, a.age_at_season_end, a.average_age_per_season,
    CAST(row_number() OVER (PARTITION BY r.player_id, r.season_id ORDER BY {nulls_last(["match_date", *APPEARANCE_TIEBREAK], 'r.')}) AS INTEGER) AS season_appearances_number,
    k.* EXCLUDE (player, player_id, season_id, team_name)
  FROM season_rows r
  JOIN season_ages a ON {same('r', 'a', ['player_id', 'season_id'])}
  JOIN season_ranks k ON {same('r', 'k', ['player_id', 'season_id', 'team_name', 'player'])}
  LEFT JOIN season_positions c ON r.player_id = c.player_id AND r.season_id = c.season_id
)"""


PLAYER_MART = _player_sql()


def player_ctes() -> list[str]:
    return [SHIM_SCHEDULE, SHIM_PLAYERS, DIM_MATCH, MATCHES_BY_TEAM, PLAYER_MART]


# --------------------------------------------------------------------------
# Play-off mart: the last regular row, the first and last play-off row, and counts
# --------------------------------------------------------------------------
# Day on which the registered play-off queries look back: later seasons are not completed.
PLAYOFF_AS_OF = "1998-06-30"
_TEAM_SEASON = "team_name, team_id, season_id"


def playoff_mart(as_of: str | None = None) -> str:
    year = f"year(DATE {q(as_of)})" if as_of else "year(current_date)"

    def per(c):
        return f"{c} / match_count AS {c}_per_match"

    def share(cond):
        return f"count(DISTINCT match_id) FILTER ({cond}) / nullif(count(DISTINCT match_id), 0)"

    return f"""
past_rows AS (SELECT * FROM matches_by_team WHERE CAST(split_part(season_id, '_', 2) AS INTEGER) < {year}),
regular_rows AS (SELECT * FROM past_rows WHERE game_type = 'Regular Season'),
knockout_rows AS (
  SELECT *, row_number() OVER (PARTITION BY {_TEAM_SEASON}, match_date IS NULL ORDER BY match_date, match_week_number) AS nth,
    row_number() OVER (PARTITION BY {_TEAM_SEASON}, match_date IS NULL ORDER BY match_date DESC, match_week_number DESC) AS nth_last
  FROM past_rows WHERE game_type <> 'Regular Season'
),
regular_ends AS (
  SELECT {_TEAM_SEASON}, match_week_number AS match_count, current_match_week_position AS regular_season_end_position,
    season_points AS regular_season_end_points, season_goal_difference AS regular_season_end_goal_difference,
    season_goals_scored AS regular_season_end_goals_scored, season_goals_conceded AS regular_season_end_goals_conceded,
    current_match_week_position_goals_scored_best_offense AS regular_season_end_goals_scored_rank,
    current_match_week_position_goals_conceded_best_defence AS regular_season_end_goals_conceded_rank
  FROM regular_rows QUALIFY row_number() OVER (PARTITION BY {_TEAM_SEASON} ORDER BY match_week_number DESC) = 1
),
regular_season_summary AS (
  SELECT e.*, {per('regular_season_end_points')}, {per('regular_season_end_goals_scored')}, {per('regular_season_end_goals_conceded')},
    c.regular_season_longest_consecutive_win_count, c.regular_season_win_percentage
  FROM regular_ends e JOIN (
    SELECT {_TEAM_SEASON}, max(consecutive_win_count) AS regular_season_longest_consecutive_win_count,
      {share("match_outcome = 'Win'")} AS regular_season_win_percentage
    FROM regular_rows GROUP BY ALL) c USING ({_TEAM_SEASON})
),
playoff_history AS (
  SELECT {_TEAM_SEASON},
    any_value(match_location) FILTER (nth = 1 AND match_date IS NOT NULL) AS first_playoff_round_match_location,
    {share("match_location = 'Home'")} AS playoff_run_home_percentage,
    any_value(game_type) FILTER (nth_last = 1 AND match_date IS NOT NULL) AS playoff_run_latest_round,
    any_value(match_outcome) FILTER (nth_last = 1 AND match_date IS NOT NULL) AS playoff_run_latest_round_match_outcome
  FROM knockout_rows GROUP BY ALL
),
playoff_ends AS (
  SELECT team_id, season_id, playoff_run_home_percentage, first_playoff_round_match_location = 'Home' AS began_home,
    if(playoff_run_latest_round = 'Final' AND playoff_run_latest_round_match_outcome = 'Win', 'Playoff Champions', 'Lost in ' || playoff_run_latest_round) AS ending
  FROM playoff_history
),
playoff_champions AS (
  SELECT r.*, coalesce(p.began_home::INTEGER, 0) AS first_playoff_round_match_location_is_home, p.playoff_run_home_percentage,
    coalesce(p.ending, 'Missed Playoffs') AS playoff_result, coalesce((p.ending = 'Playoff Champions')::INTEGER, 0) AS is_playoff_champion
  FROM regular_season_summary r LEFT JOIN playoff_ends p USING (team_id, season_id)
)"""


PLAYOFF_MART = playoff_mart(PLAYOFF_AS_OF)


def playoff_ctes() -> list[str]:
    return [*team_ctes(), PLAYOFF_MART]


# --------------------------------------------------------------------------
# Extraction
# --------------------------------------------------------------------------
_LINK = '<a\\b[^>]*\\bhref="([^"]*)"[^>]*>(.*?)</a>'
_ENT = [("&nbsp;", "\u00a0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
        ("&ndash;", "\u2013"), ("&mdash;", "\u2014"), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&")]


def html_text(expr: str) -> str:
    out = f"regexp_replace({expr}, '<[^>]*>', '', 'g')"
    for ent, ch in _ENT:
        out = f"replace({out}, {q(ent)}, {q(ch)})"
    ws = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
    return f"trim({out}, {q(ws)})"


PAGE_LINKS = f"""
WITH links AS (
  SELECT page_id, unnest(regexp_extract_all(html, {q('(?s)' + _LINK.replace(chr(92)*2, chr(92)))}, 0)) AS a FROM pages
)
SELECT page_id,
  regexp_extract(a, {q('(?s)' + _LINK.replace(chr(92)*2, chr(92)))}, 1) AS href,
  {html_text("regexp_extract(a, " + q('(?s)' + _LINK.replace(chr(92)*2, chr(92))) + ", 2)")} AS link_text
FROM links"""
