"""Mart edge cases on hand-written rows, checked against the literal SQL and by hand."""

import datetime as dt

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tools.compare import canon
from touchline import oracle as O
from touchline.operators.sides import distinct_teams, team_sides
from touchline.plans.dim_match import dim_match
from touchline.plans.match_level_player import match_level_player_data
from touchline.plans.matches_by_team import matches_by_team
from touchline.plans.playoff_champions import playoff_champions
from touchline.schemas import MATCH_STATS, PLAYER_COLUMNS, PLAYER_MATCH_STATS

M = [c for c in MATCH_STATS.fieldNames()]


def match(mid, date, home, away, score, start="19:00", rnd=None, notes=None, season="73_2021"):
    return dict(season_id=season, round=rnd, date=date, start_time=start, home_team=home, away_team=away,
                score=score, attendance="1,517", referee="R", venue="V", match_report=f"https://x/en/matches/{mid}/a",
                notes=notes, home_score=None, away_score=None, match_id=mid)


MATCHES = [
    match("m01", "2021-04-01", "A", "B", "'2-1", start="19:00"),            # home win, evening
    match("m02", "2021-04-01", "C", "A", "'0-0", start="12:00"),            # A plays twice on one date
    match("m03", "2021-04-08", "A", "C", None, start=None, notes="Match Cancelled"),   # NULL time -> late night
    match("m04", "2021-04-15", "B", "A", None, start="13:00"),              # unknown between wins
    match("m05", "2021-04-22", "A", "B", "'3-0", start="16:00"),
    match("m06", "2021-05-01", "C", "B", "'1-2", start="22:00"),
    match("m07", "2021-05-02", "B", "C", None, start="23:00", notes="match canceled: weather"),
    match("m08", "2021-05-09", "C", "A", "'1-1", start="0:30"),
    match("m09", "2021-05-09", "B", "D", "'1-1", start="17:00"),            # equal points / goal difference
    match("m10", "2021-10-01", "A", "C", "'(4) 1-1 (2)", start="20:00", rnd="Semifinals"),
    match("m11", "2021-10-08", "B", "A", "'(3) 2-2 (5)", start="20:00", rnd="Final"),   # away wins shoot-out
    match("m12", "2021-09-20", "B", "D", "'0-1", start="20:00", rnd="Quarterfinals"),
    match("m13", "2021-04-29", "D", "C", "'2-2", start="19:30"),
    match("m01", "2021-04-01", "A", "B", "'2-1", start="19:00"),            # exact duplicate row
    match("n01", "2022-04-01", "A", "B", "'1-0", season="73_2022"),         # current season
    match("n02", "2022-10-01", "A", "B", "'1-0", season="73_2022", rnd="Final"),
]


@pytest.fixture(scope="module")
def ms(spark):
    return spark.createDataFrame(pd.DataFrame(MATCHES)[M], MATCH_STATS)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.register("match_stats_df", pd.DataFrame(MATCHES)[M])
    c.sql("CREATE TABLE match_stats AS SELECT * FROM match_stats_df")
    return c


def same(df, rel):
    rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, rows) == canon(rel.columns, rel.fetchall())


def test_dim_match_matches_sql(ms, con):
    same(dim_match(ms), con.sql(O.with_ctes(O.DIM_MATCH, select="SELECT * FROM dim_match")))


def test_dim_match_cases(ms):
    d = {r["match_id"]: r for r in dim_match(ms).collect()}
    assert d["m01"]["match_result"] == "Home Win" and d["m01"]["match_time_of_day"] == "Evening Kickoff"
    assert d["m02"]["match_result"] == "Draw" and d["m02"]["match_time_of_day"] == "Morning Kickoff"
    assert d["m03"]["match_result"] == "Cancelled" and d["m03"]["match_time_of_day"] == "Late Night Kickoff"
    assert d["m04"]["match_result"] == "Unknown"
    assert d["m07"]["match_result"] == "Cancelled" and d["m07"]["match_time_of_day"] == "Late Night Kickoff"
    assert d["m06"]["match_result"] == "Away Win" and d["m06"]["match_time_of_day"] == "Night Kickoff"
    assert d["m10"]["match_result"] == "Home Win on Penalties"
    assert (d["m10"]["home_penalty_shootout_goals"], d["m10"]["away_penalty_shootout_goals"]) == (4, 2)
    assert d["m11"]["match_result"] == "Away Win on Penalties"
    assert d["m08"]["match_time"] == "00:30:00"
    assert d["m05"]["match_date"] == dt.date(2021, 4, 22) and d["m05"]["game_type"] == "Regular Season"


def test_unpivot_equals_or_join(ms):
    """The sides are the rows of a nested-loop join of all teams with all matches."""
    dm = dim_match(ms)
    t, home, away = F.col("t"), F.col("home_team_name"), F.col("away_team_name")
    j = distinct_teams(dm).select(F.col("team_name").alias("t")).join(dm, (t == home) | (t == away))
    want = j.select(t, "match_id", F.when(t == home, "Home").otherwise("Away"), F.when(t == home, away).otherwise(home),
                    F.when(t == home, F.col("home_team_score")).otherwise(F.col("away_team_score")))
    got = team_sides(dm).select("team_name", "match_id", "match_location", "opponent_team_name", "goals_scored")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_matches_by_team_matches_sql(ms, con):
    same(matches_by_team(dim_match(ms)),
         con.sql(O.with_ctes(O.DIM_MATCH, O.MATCHES_BY_TEAM, select="SELECT * FROM matches_by_team")))


def test_running_totals_share_a_date(ms):
    rows = {(r["team_name"], r["match_id"]): r for r in matches_by_team(dim_match(ms)).collect()}
    a1, a2 = rows[("A", "m01")], rows[("A", "m02")]
    assert a1["season_points"] == a2["season_points"] == 4          # RANGE frame: same date, same total
    assert {a1["match_week_number"], a2["match_week_number"]} == {1, 2}
    assert rows[("A", "m03")]["match_outcome"] == "Unknown"
    assert rows[("A", "m05")]["consecutive_win_count"] == 1          # streak reset by the unknowns
    assert rows[("A", "m04")]["consecutive_winless_count"] == 3
    assert rows[("A", "m10")]["match_points"] == 0                    # play-off: no points, week continues


def test_playoff_champions_matches_sql(ms, con):
    got = playoff_champions(matches_by_team(dim_match(ms)), as_of="2022-06-01")
    sql = O.with_ctes(O.DIM_MATCH, O.MATCHES_BY_TEAM, O.playoff_mart("2022-06-01"),
                      select="SELECT * FROM playoff_champions WHERE playoff_result <> 'Missed Playoffs'")
    same(got, con.sql(sql))
    res = {(r["team_name"], r["season_id"]): r["playoff_result"] for r in got.collect()}
    assert res[("A", "73_2021")] == "Playoff Champions"
    assert res[("B", "73_2021")] == "Lost in Final"
    assert res[("C", "73_2021")] == "Lost in Semifinals"
    assert res[("D", "73_2021")] == "Lost in Quarterfinals"
    assert not any(s == "73_2022" for _, s in res)                   # current season excluded


def player(team, pid, mid, pos, minutes, age, goals=0, name=None):
    row = {c: 0 for c in PLAYER_COLUMNS}
    row.update(team_name=team, player_url=None if pid is None else f"https://x/en/players/{pid}/P-{pid}",
               player_id=pid, match_id=mid, player=name or f"P {pid}", lineup_status="Starter",
               nationality="USA", position=pos, age=age, minutes=minutes, goals=goals,
               primary_position=pos.split(",")[0].strip(), gk_shots_on_target_against=0.0,
               gk_goals_against=0.0, gk_saves=0.0, gk_save_pct=0.0)
    return row


PLAYERS = [
    player("A", "p1", "m01", "FW", 90, "24-010", goals=1),
    player("A", "p1", "m02", "MF", 45, "24-011"),
    player("A", "p1", "m02", "FW", 45, "24-011"),                     # equal minutes in two positions
    player("A", "p1", "m05", "MF,FW", 90, "0"),
    player("A", "p1", "m05", "MF,FW", 90, "0"),                       # exact duplicate row
    player("B", "p2", "m01", "DF", 90, "19-302", goals=1),
    player("B", "p2", "m04", "DF", 30, None),
    player("Z", "p3", "m01", "GK", 90, "30-100"),                      # team matches no side
    player("A", None, "m01", "GK", 90, "31-000", name="No Link"),      # NULL player id
    player("C", "p4", "m02", "FW", 90, "22-200", goals=2, name="P 2"),  # shares a name
]


def test_match_level_player_matches_sql(spark, ms, con):
    pdf = pd.DataFrame(PLAYERS)[PLAYER_COLUMNS]
    pms = spark.createDataFrame(pdf, PLAYER_MATCH_STATS)
    con.register("pms_df", pdf)
    con.sql("CREATE OR REPLACE TABLE player_match_stats AS SELECT * FROM pms_df")
    got = match_level_player_data(pms, matches_by_team(dim_match(ms)))
    same(got, con.sql(O.with_ctes(O.DIM_MATCH, O.MATCHES_BY_TEAM, O.PLAYER_MART,
                                  select="SELECT * FROM match_level_player_data")))
    rows = got.collect()
    assert len(rows) == len(PLAYERS) - 1                               # the duplicate collapsed
    p1 = [r for r in rows if r["player_id"] == "p1"]
    assert {r["season_primary_position"] for r in p1} == {"MF"}       # 225 MF minutes vs 135 FW
    assert {r["season_primary_position_count"] for r in p1} == {2}
    z = [r for r in rows if r["team_name"] == "Z"][0]
    assert z["season_id"] is None and z["season_primary_position_count"] == 0
