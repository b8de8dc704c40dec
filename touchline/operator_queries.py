"""Operator-level registered queries (expressions, sub-steps of the marts,
ingest and source operators), each with its DuckDB oracle.

Inputs are always the driver's tables through the league shim, so every query
grows with the data. Imported by ``touchline.registry``.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline import oracle as O
from touchline.functions import text as X
from touchline.operators import ingest as R
from touchline.operators.keys import DEALT, dealt, dealt_to
from touchline.operators.player_season import PS_KEYS, SEASON_RANKS, SEASON_TOTALS, age_summary, minutes_by_position
from touchline.operators.player_season import position_summary, totals_and_ranks
from touchline.operators.running import RUNNING_COLUMNS
from touchline.operators.sequence import GRAIN_KEY
from touchline.operators.sides import distinct_teams
from touchline.operators.standings import STANDINGS
from touchline.plans.match_level_player import attach_match_context, distinct_rows, match_context
from touchline.plans.matches_by_team import team_match_rows
from touchline.registry import league_dim_match, league_matches_by_team, register
from touchline.schemas import PLAYER_MATCH_STATS
from touchline.session import drop_table, written_once
from touchline.sources import csv_tables as S
from touchline.sources import shim

q = O.q
SCHED = [O.SHIM_SCHEDULE]
PLAYERS = [O.SHIM_SCHEDULE, O.SHIM_PLAYERS]
LEAGUES = {"73": "League 73", "74": "League 74"}
_LEAGUES_SQL = "(VALUES " + ", ".join(f"({O.q(k)}, {O.q(v)})" for k, v in LEAGUES.items()) + ") AS l(id, name)"


def sql(blocks, select):
    return O.with_ctes(*blocks, select=select)


# ============================================================ expressions
@register("score_normalize", sql(SCHED, f"""
SELECT order_key AS match_key, score AS score_raw, sc AS score_normalized,
  CASE WHEN strpos(sc, '-') > 0 THEN nullif(trim(split_part(sc, '-', 1)), '') END AS home_score_text,
  CASE WHEN strpos(sc, '-') > 0 THEN nullif(trim(substr(sc, strpos(sc, '-') + 1)), '') END AS away_score_text
FROM (SELECT *, {O.normalize_score('score')} AS sc FROM schedule_capture)"""))
def q_score_normalize(spark, sf_dir):
    """N1 dash/whitespace normalisation and N7 naive split of captured scores."""
    cap = shim.schedule_capture(spark, sf_dir).withColumn("sc", X.normalize_score("score"))
    hs, as_ = X.naive_score_split("sc")
    return cap.select(F.col("order_key").alias("match_key"), F.col("score").alias("score_raw"),
                      F.col("sc").alias("score_normalized"), hs.alias("home_score_text"),
                      as_.alias("away_score_text"))


@register("match_id_from_url", sql(SCHED, "SELECT order_key AS match_key, match_report, match_id FROM match_stats_k"))
def q_match_id_from_url(spark, sf_dir):
    """N2 match id token of report URLs (NULL URL -> NULL)."""
    cap = shim.schedule_capture(spark, sf_dir)
    return cap.select(F.col("order_key").alias("match_key"), "match_report",
                      X.match_id_from_url("match_report").alias("match_id"))


@register("player_from_url", sql(PLAYERS, f"""
SELECT ok AS order_key, ln AS line_number, player_url, player_id,
  {O.slug_name('player_url', X.PLAYER_URL_MARKER)} AS slug_name
FROM outfield"""))
def q_player_from_url(spark, sf_dir):
    """N3 player id and N4 name from the URL slug."""
    of, _ = shim.player_capture_raw(spark, sf_dir)
    return of.select(F.col("_ok").alias("order_key"), F.col("_line").alias("line_number"), "player_url",
                     X.player_id_from_url("player_url").alias("player_id"),
                     X.name_from_slug("player_url").alias("slug_name"))


_NAT_RAW = ("CASE s.s_suppkey % 4 WHEN 0 THEN lower(substr(n.n_name, 1, 2)) || ' ' || n.n_name "
            "WHEN 1 THEN n.n_name WHEN 2 THEN lower(n.n_name) || ' ' || lower(n.n_name) ELSE '  ' END")


@register("nationality_code", f"""
WITH raw AS (SELECT s.s_suppkey, {_NAT_RAW} AS nationality_raw
             FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey)
SELECT s_suppkey, nationality_raw,
  CASE WHEN trim(nationality_raw) = '' THEN NULL ELSE coalesce(
    list_filter(string_split_regex(trim(nationality_raw), '\\s+'),
                lambda x: length(x) >= 2 AND upper(x) = x AND lower(x) <> x)[-1],
    string_split_regex(trim(nationality_raw), '\\s+')[-1]) END AS nationality
FROM raw""")
def q_nationality_code(spark, sf_dir):
    """Country code = last upper-case token of >= 2 characters, else the last token."""
    s = shim.read_table(spark, sf_dir, "supplier")
    n = shim.read_table(spark, sf_dir, "nation")
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    name = F.col("n_name")
    raw = (F.when(F.col("s_suppkey") % 4 == 0, F.concat(F.lower(F.substr(name, F.lit(1), F.lit(2))), F.lit(" "), name))
           .when(F.col("s_suppkey") % 4 == 1, name)
           .when(F.col("s_suppkey") % 4 == 2, F.concat(F.lower(name), F.lit(" "), F.lower(name)))
           .otherwise(F.lit("  ")))
    return j.select("s_suppkey", raw.alias("nationality_raw")).withColumn(
        "nationality", X.nationality_code("nationality_raw"))


_POS_RAW = ("p_type || CASE p_partkey % 4 WHEN 0 THEN ',MF' WHEN 1 THEN ' ,DF,FW' "
            "WHEN 2 THEN '' ELSE ', GK' END")


@register("primary_position", f"""
SELECT p_partkey, {_POS_RAW} AS position,
  CASE WHEN strpos({_POS_RAW}, ',') > 0 THEN trim(split_part({_POS_RAW}, ',', 1)) ELSE {_POS_RAW} END AS primary_position
FROM part""")
def q_primary_position(spark, sf_dir):
    """First entry of a comma-separated position list."""
    p = shim.read_table(spark, sf_dir, "part")
    k = F.col("p_partkey") % 4
    pos = F.concat(F.col("p_type"), F.when(k == 0, F.lit(",MF")).when(k == 1, F.lit(" ,DF,FW"))
                   .when(k == 2, F.lit("")).otherwise(F.lit(", GK")))
    return p.select("p_partkey", pos.alias("position")).withColumn("primary_position", X.primary_position("position"))


@register("notes_skip", sql(SCHED, """
SELECT order_key AS match_key, notes,
  coalesce(lower(trim(notes)) LIKE '%match cancelled%' OR lower(trim(notes)) LIKE '%match canceled%'
           OR lower(trim(notes)) LIKE '%match awarded%', false) AS skip_player_capture
FROM schedule_capture"""))
def q_notes_skip(spark, sf_dir):
    """Notes that mean no player statistics exist."""
    cap = shim.schedule_capture(spark, sf_dir)
    return cap.select(F.col("order_key").alias("match_key"), "notes",
                      X.notes_skip("notes").alias("skip_player_capture"))


# (layout of Spark, of DuckDB) of the texts that are parsed again; of the one without a day the first.
_LAYOUTS = [("yyyy-MM-dd", "%Y-%m-%d"), ("MM/dd/yyyy", "%m/%d/%Y"), (None, None), ("MMM d, yyyy", "%b %-d, %Y"), ("yyyyMMdd", "%Y%m%d"), ("EEEE, d MMMM yyyy", "%A, %-d %B %Y"),
            ("yyyy-M-d", "%Y-%-m-%-d"), ("ddMMMyyyy", "%d%b%Y"), ("MMMM yyyy", "%B %Y"), ("d.M.yyyy", "%-d.%-m.%Y"), ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"), ("MMM d yyyy", "%b %-d %Y")]
_DATE_TEXT = " ".join(f"WHEN {i} THEN strftime(o_orderdate, {q(f)})" for i, (_, f) in enumerate(_LAYOUTS) if f)


@register("date_parse", f"""
SELECT o_orderkey, CASE o_orderkey % {len(_LAYOUTS)} {_DATE_TEXT} ELSE 'TBD ' || CAST(o_orderkey AS VARCHAR) END AS date_text,
  CASE o_orderkey % {len(_LAYOUTS)} WHEN 2 THEN NULL WHEN 8 THEN CAST(date_trunc('month', o_orderdate) AS DATE)
    WHEN 9 THEN if(day(o_orderdate) <= 12, make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)), CAST(o_orderdate AS DATE)) ELSE CAST(o_orderdate AS DATE) END AS match_date
FROM orders""")
def q_date_parse(spark, sf_dir):
    """Tolerant date parse (unparsable -> NULL); of two numbers that may be months the first is."""
    k = F.col("o_orderkey") % len(_LAYOUTS)
    txt = F.concat(F.lit("TBD "), F.col("o_orderkey").cast("string"))
    for i, (layout, _) in enumerate(_LAYOUTS):
        if layout:
            txt = F.when(k == i, F.date_format("o_orderdate", layout)).otherwise(txt)
    o = shim.read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", txt.alias("date_text")).withColumn("match_date", X.try_parse_date("date_text"))


@register("numeric_fill", sql(PLAYERS, """
SELECT ok AS order_key,
  CASE WHEN pk % 9 <> 0 THEN CAST((pk % 7) * 10 AS VARCHAR) ELSE '' END AS save_pct_text,
  coalesce(TRY_CAST(CASE WHEN pk % 9 <> 0 THEN CAST((pk % 7) * 10 AS VARCHAR) ELSE '' END AS DOUBLE), 0.0::DOUBLE) AS gk_save_pct
FROM outfield WHERE ln = 1"""))
def q_numeric_fill(spark, sf_dir):
    """Keeper cells to double, non-numeric -> 0."""
    _, kp = shim.player_capture_raw(spark, sf_dir)
    return kp.select(F.col("order_key"), F.col("gk_save_pct").alias("save_pct_text"),
                     X.numeric_or_zero("gk_save_pct").alias("gk_save_pct"))


@register("age_numeric", sql(PLAYERS, """
SELECT ok AS order_key, ln AS line_number, age,
  try_cast(split_part(age, '-', 1) AS INTEGER) + try_cast(split_part(age, '-', 2) AS INTEGER) / 365 AS age_numeric
FROM outfield"""))
def q_age_numeric(spark, sf_dir):
    """P6: 'YY-DDD' -> years as a double; malformed parts -> NULL."""
    of, _ = shim.player_capture_raw(spark, sf_dir)
    return of.select(F.col("_ok").alias("order_key"), F.col("_line").alias("line_number"), "age",
                     X.age_numeric("age").alias("age_numeric"))


@register("surrogate_key", sql(O.team_ctes(), "SELECT DISTINCT team_name, team_id FROM mbt_matches"))
def q_surrogate_key(spark, sf_dir):
    """Distinct team names and their md5 surrogate key."""
    return distinct_teams(league_dim_match(spark, sf_dir))


@register("storage_keys", sql(SCHED, """
SELECT order_key AS match_key,
  replace(replace(season_id || ' cup/2', '/', '_'), ' ', '_') AS season_key,
  replace(replace(replace(strftime(CAST(date AS DATE), '%m/%d/%Y') || ' 19:30', '/', '-'), ' ', '_'), ':', '-') AS date_key
FROM schedule_capture"""))
def q_storage_keys(spark, sf_dir):
    """File-safe season and date keys."""
    cap = shim.schedule_capture(spark, sf_dir)
    return cap.select(
        F.col("order_key").alias("match_key"),
        X.season_file_key(F.concat(F.col("season_id"), F.lit(" cup/2"))).alias("season_key"),
        X.date_file_key(F.concat(F.date_format(F.col("date").cast("date"), "MM/dd/yyyy"), F.lit(" 19:30")))
        .alias("date_key"))


_MFILE = "'/raw/match_stats/match_level_data_' || season_id || '.csv'"
_PFILE = "'/raw/player_match_stats/player_match_data_' || season_id || '_' || date || '.csv'"
_MPAT = r"(?i)^match_level_data_(\d+)_(\d+)\.csv"


@register("key_from_filename", sql(SCHED, f"""
SELECT match_key, season_id,
  CASE WHEN regexp_matches(mbase, {q(_MPAT)}) THEN CAST(regexp_extract(mbase, {q(_MPAT)}, 1) AS BIGINT) ELSE 0 END AS league_key,
  CASE WHEN regexp_matches(mbase, {q(_MPAT)}) THEN CAST(regexp_extract(mbase, {q(_MPAT)}, 2) AS BIGINT) ELSE 0 END AS year_key,
  replace(replace(mbase, 'match_level_data_', ''), '.csv', '') AS season_from_file,
  CASE WHEN starts_with(pbase, pref) AND ends_with(pbase, '.csv')
       THEN nullif(substr(pbase, length(pref) + 1, length(pbase) - length(pref) - 4), '') END AS date_from_file
FROM (SELECT order_key AS match_key, season_id,
        regexp_extract({_MFILE}, '([^/]*)$', 1) AS mbase,
        regexp_extract({_PFILE}, '([^/]*)$', 1) AS pbase,
        'player_match_data_' || replace(replace(season_id, '/', '_'), ' ', '_') || '_' AS pref
      FROM schedule_capture)"""))
def q_key_from_filename(spark, sf_dir):
    """(league, year), season id and date recovered from stored file names."""
    cap = shim.schedule_capture(spark, sf_dir)
    mfile = F.concat(F.lit("/raw/match_stats/match_level_data_"), F.col("season_id"), F.lit(".csv"))
    pfile = F.concat(F.lit("/raw/player_match_stats/player_match_data_"), F.col("season_id"), F.lit("_"),
                     F.col("date"), F.lit(".csv"))
    league, year = X.season_key_from_filename(mfile)
    return cap.select(F.col("order_key").alias("match_key"), "season_id", league.alias("league_key"),
                      year.alias("year_key"), X.season_id_from_filename(mfile).alias("season_from_file"),
                      X.date_from_player_filename(pfile, "season_id").alias("date_from_file"))


@register("spreadsheet_safe", sql(SCHED, f"""
SELECT order_key AS match_key,
  CASE WHEN coalesce(CASE WHEN sc <> 'nan' THEN sc END, '') <> '' THEN '''' || sc ELSE '' END AS score_sheet,
  CASE WHEN mid IN ('', 'nan', 'None', '<NA>') THEN NULL ELSE mid END AS match_id_clean
FROM (SELECT *, {O.normalize_score('score')} AS sc,
        CASE order_key % 5 WHEN 0 THEN 'nan' WHEN 1 THEN '<NA>' WHEN 2 THEN 'None'
             ELSE CAST(order_key AS VARCHAR) END AS mid
      FROM schedule_capture)"""))
def q_spreadsheet_safe(spark, sf_dir):
    """S12 apostrophe-prefixed score text; S13 placeholder ids -> NULL."""
    cap = shim.schedule_capture(spark, sf_dir)
    k = F.col("order_key")
    mid = (F.when(k % 5 == 0, F.lit("nan")).when(k % 5 == 1, F.lit("<NA>")).when(k % 5 == 2, F.lit("None"))
           .otherwise(k.cast("string")))
    return cap.select(k.alias("match_key"), X.spreadsheet_safe(X.normalize_score("score")).alias("score_sheet"),
                      X.null_tokens(mid).alias("match_id_clean"))


# ============================================================ team mart steps
@register("match_sides", sql(O.team_ctes(), "SELECT * FROM mbt_matches"))
def q_match_sides(spark, sf_dir):
    """Each match unpivoted to its sides, whole-row distinct."""
    return team_match_rows(league_dim_match(spark, sf_dir)).drop(GRAIN_KEY)


_TEAM_KEYS = "team_id, season_id, match_id, match_date, match_week_number"


@register("team_running_totals", sql(O.team_ctes(), f"""
SELECT {_TEAM_KEYS}, {', '.join(RUNNING_COLUMNS)}, season_goal_difference FROM matches_by_team"""))
def q_team_running_totals(spark, sf_dir):
    """Match week, RANGE-frame running totals, goal difference."""
    return league_matches_by_team(spark, sf_dir).select(
        *_TEAM_KEYS.split(", "), *RUNNING_COLUMNS, "season_goal_difference")


@register("team_streaks", sql(O.team_ctes(), f"""
SELECT {_TEAM_KEYS}, match_outcome, consecutive_win_count, consecutive_winless_count FROM matches_by_team"""))
def q_team_streaks(spark, sf_dir):
    """Win and winless streak lengths (gaps and islands)."""
    return league_matches_by_team(spark, sf_dir).select(
        *_TEAM_KEYS.split(", "), "match_outcome", "consecutive_win_count", "consecutive_winless_count")


_STAND = [n for n, _ in STANDINGS]


@register("team_standings", sql(O.team_ctes(), f"""
SELECT team_id, season_id, match_week_number, {', '.join(_STAND)} FROM matches_by_team"""))
def q_team_standings(spark, sf_dir):
    """Seven week-by-week rankings."""
    return league_matches_by_team(spark, sf_dir).select("team_id", "season_id", "match_week_number", *_STAND)


# ============================================================ player mart steps
def _player_base(spark, sf_dir):
    return attach_match_context(shim.player_match_stats(spark, sf_dir), league_matches_by_team(spark, sf_dir, ranked=False), shim.player_tasks(spark, sf_dir))


@register("primary_position_by_season", sql(O.player_ctes(), "SELECT * FROM primary_position_by_season"))
def q_primary_position_by_season(spark, sf_dir):
    """Minutes per (player, season, position) and their rank."""
    return minutes_by_position(_player_base(spark, sf_dir))


@register("season_position_summary", sql(O.player_ctes(), """
SELECT player_id, season_id,
  max(CASE WHEN season_primary_position_rank = 1 THEN primary_position END) AS season_primary_position,
  count(DISTINCT primary_position) AS season_primary_position_count
FROM primary_position_by_season GROUP BY player_id, season_id"""))
def q_season_position_summary(spark, sf_dir):
    """Primary position and number of distinct positions per player-season."""
    return position_summary(minutes_by_position(_player_base(spark, sf_dir)))


def _dedup_rows(spark, sf_dir):
    rows = distinct_rows(shim.player_match_stats(spark, sf_dir, by_match=True), match_context(league_matches_by_team(spark, sf_dir, ranked=False)))
    return rows.withColumn("age_numeric", X.age_numeric("age"))


@register("player_season_age", sql(O.player_ctes(), """
SELECT DISTINCT player_id, season_id, age_at_season_start, age_at_season_end, average_age_per_season
FROM match_level_player_data"""))
def q_player_season_age(spark, sf_dir):
    """Age at season start / end and average per player-season."""
    return age_summary(_dedup_rows(spark, sf_dir))


@register("player_season_totals", sql(O.player_ctes(), f"""
SELECT DISTINCT player_id, season_id, team_name, player,
  {', '.join(t for t, _ in SEASON_TOTALS)}, {', '.join(r for r, _ in SEASON_RANKS)}
FROM match_level_player_data"""))
def q_player_season_totals(spark, sf_dir):
    """Season totals per player-season-team and their dense ranks within the team."""
    # The few columns that the totals read are written first, so that their shuffles do not lie beside the wide rows'.
    rows = _dedup_rows(spark, sf_dir).select(*PS_KEYS, "team_name", "player", *[src for _, src in SEASON_TOTALS])
    return totals_and_ranks(written_once(rows, "player_rows")).drop("_rows")


@register("appearance_number", sql(O.player_ctes(), """
SELECT player_id, season_id, match_id, team_name, match_date, season_appearances_number
FROM match_level_player_data"""))
def q_appearance_number(spark, sf_dir):
    """N-th appearance of a player in a season."""
    from touchline.plans.match_level_player import match_level_player_data

    mart = match_level_player_data(shim.player_match_stats(spark, sf_dir, by_match=True), league_matches_by_team(spark, sf_dir, ranked=False))
    return mart.select("player_id", "season_id", "match_id", "team_name", "match_date", "season_appearances_number")


# ============================================================ ingest
@register("keeper_merge", sql(PLAYERS, "SELECT * FROM player_match_stats"))
def q_keeper_merge(spark, sf_dir):
    """R1 (+N10): outfield rows left-joined NULL-safe with keeper stats."""
    return shim.player_match_stats(spark, sf_dir)


_LATEST = ("SELECT max_by(season_id, {'l': coalesce(TRY_CAST(split_part(season_id, '_', 1) AS BIGINT), 0), "
           "'y': coalesce(TRY_CAST(split_part(season_id, '_', 2) AS BIGINT), 0), 's': season_id}) AS season_id "
           "FROM match_stats")


@register("latest_season", sql(SCHED, _LATEST))
def q_latest_season(spark, sf_dir):
    """Season with the greatest (league, year)."""
    return R.latest_season(shim.match_stats(spark, sf_dir))


@register("season_filter", sql(SCHED, f"""
SELECT * FROM match_stats WHERE trim(season_id) IN ({_LATEST})"""))
def q_season_filter(spark, sf_dir):
    """R2: rows of the latest season (trimmed equality, here as a semi join)."""
    ms = shim.match_stats(spark, sf_dir)
    return R.season_filter_by(ms, R.latest_season(ms))


_SEED = "SELECT match_report AS match_url, season_id, date, notes FROM match_stats"


@register("match_seed", sql(SCHED, _SEED))
def q_match_seed(spark, sf_dir):
    """Match rows projected for player capture (report URL renamed)."""
    return S.match_seed(shim.match_stats(spark, sf_dir))


@register("start_date_filter", sql(SCHED, f"""
SELECT * FROM ({_SEED}) WHERE TRY_CAST(date AS DATE) >= DATE '2000-01-01'"""))
def q_start_date_filter(spark, sf_dir):
    """Matches on or after a start date (parameter)."""
    return R.start_date_filter(S.match_seed(shim.match_stats(spark, sf_dir)), "2000-01-01")


@register("work_list", sql(SCHED, f"""
SELECT season_id, date, match_url,
  CAST(row_number() OVER (PARTITION BY season_id, date ORDER BY match_url ASC NULLS LAST) AS INTEGER) AS url_seq
FROM ({_SEED})
WHERE NOT coalesce(lower(trim(notes)) LIKE '%match cancelled%' OR lower(trim(notes)) LIKE '%match canceled%'
                   OR lower(trim(notes)) LIKE '%match awarded%', false)
  AND match_url IS NOT NULL AND date IS NOT NULL"""))
def q_work_list(spark, sf_dir):
    """Capture work list per (season, date), cancelled/awarded and URL-less matches left out."""
    return R.work_list(S.match_seed(shim.match_stats(spark, sf_dir))).withColumn(
        "url_seq", F.col("url_seq").cast("int"))


_STORED = """stored AS (
  SELECT DISTINCT '73_' || CAST(year(l_shipdate) AS VARCHAR) AS season_id, strftime(l_shipdate, '%Y-%m-%d') AS d
  FROM lineitem)"""


@register("missing_dates", sql(SCHED + [_STORED], """
SELECT DISTINCT m.season_id, m.date FROM match_stats m
WHERE m.date IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM stored s WHERE s.season_id = m.season_id AND s.d = strftime(TRY_CAST(m.date AS DATE), '%Y-%m-%d'))"""))
def q_missing_dates(spark, sf_dir):
    """Dates with matches but no stored player file (anti join on (season, date)).

    Stored files are named after the lineitem ship dates."""
    li = shim.read_table(spark, sf_dir, "lineitem")
    season = F.concat(F.lit("73_"), F.year("l_shipdate").cast("string"))
    files = li.select(season.alias("season_id"), F.concat(
        F.lit("/raw/player_match_stats/player_match_data_"), season, F.lit("_"),
        F.date_format("l_shipdate", "yyyy-MM-dd"), F.lit(".csv")).alias("path"))
    return R.missing_date_list(shim.match_stats(spark, sf_dir), R.stored_dates(files))


_DIMS = f"""season_files AS (
  SELECT '73_' || y AS season_id, '73' AS league_id, {q(LEAGUES['73'])} AS league_name,
    y || if(y % 2 = 0, ' Season', ' Season (all)') AS season_name, {q(shim.BASE_URL + '/en/comps/73/')} || y || '/schedule/' AS url
  FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders) WHERE y % 4 <> 3)"""


@register("schedule_lookup", sql([_DIMS], f"""
SELECT
  coalesce(f.league_id, split_part(r.season_id, '_', 1)) AS league_id,
  f.league_name AS league_name,
  r.season_id,
  coalesce(f.season_name, split_part(r.season_id, '_', 2) || ' Season') AS season_name,
  coalesce(f.url, {q(shim.BASE_URL + '/en/comps/')} || split_part(r.season_id, '_', 1) || '/'
           || split_part(r.season_id, '_', 2) || '/schedule/') AS url,
  CASE WHEN f.season_id IS NOT NULL THEN 'file' ELSE 'synthesised' END AS source
FROM (SELECT DISTINCT '73_' || CAST(year(l_shipdate) AS VARCHAR) AS season_id FROM lineitem) r
LEFT JOIN season_files f ON f.season_id = r.season_id"""))
def q_schedule_lookup(spark, sf_dir):
    """Schedule row per requested season from the season files (here of even
    years), else from the consolidated table, else synthesised."""
    dims = q_season_dims(spark, sf_dir)
    year = F.col("season_year_id").cast("int")
    files = dims.filter(year % 2 == 0)
    consolidated = dims.filter(year % 4 != 3).withColumn("season_name", F.concat("season_name", F.lit(" (all)")))
    li = shim.read_table(spark, sf_dir, "lineitem")
    req = li.select(F.concat(F.lit("73_"), F.year("l_shipdate").cast("string")).alias("season_id"))
    return R.schedule_lookup(req, files, consolidated, base_url=shim.BASE_URL)


@register("latest_date", sql(SCHED, f"""
SELECT strftime(max(TRY_CAST(date AS DATE)), '%Y-%m-%d') AS latest_date
FROM match_stats WHERE season_id IN ({_LATEST})"""))
def q_latest_date(spark, sf_dir):
    """Latest match date of the latest season."""
    return R.latest_date(shim.match_stats(spark, sf_dir))


# ============================================================ sources
@register("season_dims", f"""
SELECT l.id || '_' || y AS season_id, l.id AS league_id, l.name AS league_name, y AS season_year_id,
  y || ' Season' AS season_name, {q(shim.BASE_URL + '/en/comps/')} || l.id || '/' || y || '/schedule/' AS url
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders), {_LEAGUES_SQL}""")
def q_season_dims(spark, sf_dir):
    """Season years (from the data) x configured leagues."""
    o = shim.read_table(spark, sf_dir, "orders")
    return S.season_dims(o.select(F.year("o_orderdate").cast("string").alias("season_year_id")).distinct(),
                         LEAGUES, base_url=shim.BASE_URL)


@register("table_counts", sql(PLAYERS, """
SELECT 'match_stats' AS table_name, count(*) AS row_count FROM match_stats
UNION ALL SELECT 'player_match_stats', count(*) FROM player_match_stats
UNION ALL SELECT 'schedule_capture', count(*) FROM schedule_capture"""))
def q_table_counts(spark, sf_dir):
    """Row count per loaded table, as one frame."""
    return S.table_counts({
        "match_stats": shim.match_stats(spark, sf_dir),
        "player_match_stats": shim.player_match_stats(spark, sf_dir),
        "schedule_capture": shim.schedule_capture(spark, sf_dir),
    })


# ============================================================ CSV raw layer
def _with_matches(spark, sf_dir, matches, how):
    """Player rows with the columns of ``matches`` (by ``_m``), dealt once for the keepers and them."""
    rows = shim.player_match_stats(spark, sf_dir, by_match=True)
    of, m_of = (f"{name}{dealt_to(rows)}" for name in (DEALT, "_m_of_"))
    matches = dealt(matches, F.col("_m"), dealt_to(rows), "_m_of_")
    return rows.join(matches, (rows["_match"] == matches["_m"]) & (rows[of] == matches[m_of]), how).drop("_match", "_m", of, m_of)


@register("csv_raw_roundtrip", sql(PLAYERS, """
SELECT p.* REPLACE (CASE WHEN m.season_id = '73_1995' THEN NULL ELSE p.lineup_status END AS lineup_status, p.position || chr(10) || '"x", ' AS position)
FROM player_match_stats p LEFT JOIN match_stats m ON p.match_id = m.match_id"""))
def q_csv_raw_roundtrip(spark, sf_dir):
    """S9 per-season CSV sink, then S2/S14/S5 read back by header group.

    Files of the first season are written as an older capture would have
    written them: ``tackles_wom`` for ``tackles_won`` and no ``lineup_status``
    column. Positions hold a line break, quotes and a blank at the end. The
    files go to the shared checkpoint folder, as gzip.
    """
    path = _new_folder(spark, "csv_raw")
    ms = shim.match_stats(spark, sf_dir).select(F.col("match_id").alias("_m"), "season_id")
    keyed = written_once(_with_matches(spark, sf_dir, ms, "left").withColumn("position", F.concat("position", F.lit('\n"x", '))), "player_seasons")
    old_season = F.col("season_id") == "73_1995"
    old = keyed.filter(old_season).drop("lineup_status").withColumnRenamed("tackles_won", "tackles_wom")
    new = keyed.filter(~old_season | F.col("season_id").isNull())
    S.write_partitioned(new, path, ["season_id"], packed=True)
    S.write_partitioned(old, path, ["season_id"], packed=True)   # dynamic overwrite: adds the old season only
    drop_table(keyed)
    return S.load_player_match_stats(spark, path)


# ============================================================ file layers, written and read back
def _new_folder(spark, name: str) -> str:
    from touchline.session import scratch_table_path

    return scratch_table_path(spark, name)


@register("season_file_load", f"""
SELECT l.id || '_' || y AS season_id, l.id AS league_id, l.name AS league_name, y || ' Season' AS season_name,
  {q(shim.BASE_URL + '/en/comps/')} || l.id || '/' || y || '/schedule/' AS url
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders), {_LEAGUES_SQL}""")
def q_season_file_load(spark, sf_dir):
    """S3: season files, one a season, read as the 5 columns a schedule reader needs."""
    path = _new_folder(spark, "season_files")
    dims = q_season_dims(spark, sf_dir).withColumn("season", F.col("season_id"))
    S.write_partitioned(dims, path, ["season"])
    return S.load_season_dims(spark, path)


@register("match_csv_roundtrip", sql(SCHED, "SELECT * REPLACE (CAST(date AS DATE) AS date) FROM match_stats"))
def q_match_csv_roundtrip(spark, sf_dir):
    """Match rows from per-season CSV files, typed."""
    path = _new_folder(spark, "match_csv")
    S.write_partitioned(shim.match_stats(spark, sf_dir), path, ["season_id"])
    return S.load_match_stats(spark, path)


@register("base_views", sql(SCHED, """
SELECT season_id, count(*) AS matches, count(score) AS scored FROM match_stats GROUP BY season_id"""))
def q_base_views(spark, sf_dir):
    """Pass-through views, queried by name."""
    S.register_base_views({"match_stats": shim.match_stats(spark, sf_dir), "player_match_stats": shim.player_match_stats(spark, sf_dir),
                           "season_dims": q_season_dims(spark, sf_dir)})
    return spark.sql("""SELECT m.season_id, count(*) AS matches, count(m.score) AS scored
                        FROM base_raw_match_stats m JOIN base_raw_season_dims s ON m.season_id = s.season_id GROUP BY m.season_id""")


@register("player_day_files", sql(PLAYERS, """
SELECT p.*, m.season_id AS stored_season, m.date AS stored_date
FROM player_match_stats p JOIN match_stats m ON p.match_id = m.match_id"""))
def q_player_day_files(spark, sf_dir):
    """Player rows as one directory per (season, date), read back with their partition."""
    path = _new_folder(spark, "player_days")
    ms = shim.match_stats(spark, sf_dir).select(F.col("match_id").alias("_m"), F.col("season_id").alias("stored_season"), F.col("date").alias("stored_date"))
    days = written_once(_with_matches(spark, sf_dir, ms, "inner"), "player_days")
    S.write_partitioned(days, path, ["stored_season", "stored_date"], packed=True)
    drop_table(days)
    fields = [*PLAYER_MATCH_STATS.fields, T.StructField("stored_season", T.StringType()), T.StructField("stored_date", T.StringType())]
    return S.typed(S.read_csv_by_name(spark, path, [f.name for f in fields]), T.StructType(fields))


@register("mart_export", O.with_ctes(O.SHIM_SCHEDULE, O.DIM_MATCH, select="SELECT COLUMNS(*)::VARCHAR FROM dim_match"))
def q_mart_export(spark, sf_dir):
    """A mart exported as CSV with header, read back as text."""
    path = _new_folder(spark, "mart_csv")
    S.export_mart(league_dim_match(spark, sf_dir), path)
    return spark.read.option("header", True).csv(path)


@register("header_repair", sql(SCHED, """
SELECT season_id, season_id = '73_1995' AS needs_repair, false AS not_utf8 FROM match_stats GROUP BY season_id"""))
def q_header_repair(spark, sf_dir):
    """Seasons whose files carry an old column name."""
    path = _new_folder(spark, "match_repair")
    ms = shim.match_stats(spark, sf_dir)
    S.write_partitioned(ms.filter("season_id <> '73_1995'"), path, ["season_id"])
    S.write_partitioned(ms.filter("season_id = '73_1995'").withColumnRenamed("notes", "match_notez"), path, ["season_id"])
    report = S.header_repair_report(spark, path, "match_notez").withColumn("season_id", F.regexp_extract("file", "season_id=([^/]*)", 1))
    return report.groupBy("season_id").agg((F.max("occurrences") > 0).alias("needs_repair"), F.max("not_utf8").alias("not_utf8"))


@register("season_date_order", sql(SCHED, """
SELECT order_key AS match_key, season_id, date,
  row_number() OVER (ORDER BY season_id ASC NULLS LAST, TRY_CAST(date AS DATE) ASC NULLS LAST, order_key) AS position
FROM match_stats_k"""))
def q_season_date_order(spark, sf_dir):
    """Matches in (season, date) order with their position."""
    ms = shim.match_stats(spark, sf_dir, keep_key=True).select(F.col("order_key").alias("match_key"), "season_id", "date")
    return R.positions(R.sort_by_season_date(ms, tiebreak=["match_key"]))


@register("season_overwrite", sql(SCHED, f"""
SELECT * EXCLUDE (order_key) FROM match_stats_k WHERE season_id NOT IN ({_LATEST}) OR order_key % 2 = 0"""))
def q_season_overwrite(spark, sf_dir):
    """The latest season replaced, an empty refresh that replaces nothing, the whole table read."""
    path = _new_folder(spark, "season_table")
    ms = shim.match_stats(spark, sf_dir, keep_key=True)
    R.overwrite_season(ms.drop("order_key"), path)
    stored = S.read_partitioned(spark, path, fmt="parquet")
    fresh = R.season_filter_by(ms.filter("order_key % 2 = 0").drop("order_key"), R.latest_season(stored))
    R.overwrite_season(fresh, path)
    R.overwrite_season(fresh.limit(0), path)
    return S.read_partitioned(spark, path, fmt="parquet")
