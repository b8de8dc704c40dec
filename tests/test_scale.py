"""Steps whose time, disk or memory must not grow faster than their input."""

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from touchline.operators import html_rows
from touchline.operators.ingest import keeper_merge, missing_date_list, stored_dates
from touchline.operators.player_season import SEASON_TOTALS, totals_and_ranks
from touchline.plans.match_level_player import MATCH_CONTEXT, distinct_rows
from touchline.plans.matches_by_team import matches_by_team
from touchline.schemas import PLAYER_COLUMNS
from touchline.session import TASK_ROWS, drop_table, tasks_for, written_once
from touchline.sources import csv_records, shim


def plan(df, part="optimizedPlan"):
    return getattr(df._jdf.queryExecution(), part)().toString()


@pytest.fixture()
def players(spark):
    rows = [("m1", "p1", "A"), ("m1", "p1", "A"), ("m1", None, "B"), (None, "p1", "A"), (None, "p1", "A"), ("m2", "p2", "A")]
    df = spark.createDataFrame(rows, "match_id string, player_id string, team_name string")
    return df.select(*[F.col(c) if c in df.columns else F.lit("1").alias(c) for c in PLAYER_COLUMNS])


@pytest.fixture()
def context(spark):
    return spark.createDataFrame([("m1", "A", "s", 1, "2020-01-01")], f"match_id string, team_name string, {MATCH_CONTEXT[0]} string, {MATCH_CONTEXT[1]} int, {MATCH_CONTEXT[2]} string")


def test_equal_player_rows_are_counted_where_the_join_leaves_them(spark, players, context):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = distinct_rows(players, context, 9)
        shuffles = [line for line in plan(rows, "executedPlan").splitlines() if "Exchange" in line]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(shuffles) == 2 and all("hashpartitioning(" in s for s in shuffles), shuffles
    found = sorted((r["match_id"] or "", r["player_id"] or "", r["season_id"] or "", r["_times"]) for r in rows.collect())
    assert found == [("", "p1", "", 2), ("m1", "", "", 1), ("m1", "p1", "s", 2), ("m2", "p2", "", 1)]


def test_keeper_merge_reads_no_column_that_nobody_asked_for(spark, players):
    keeper = spark.createDataFrame([("m1", "p1", "3"), ("m1", None, "x"), (None, "p1", "5")], "match_id string, player_id string, gk_saves string")
    merged = keeper_merge(players.select(*[c for c in PLAYER_COLUMNS if not c.startswith("gk_")]).withColumn("minutes", F.lit(1)).withColumn("long_text", F.concat("player_url", F.lit("!"))), keeper, 3)
    assert "long_text" not in plan(merged.select("player_id", "match_id", "gk_saves"))
    found = sorted((r["match_id"] or "", r["player_id"] or "", r["gk_saves"]) for r in merged.collect())
    assert found == [("", "p1", 0.0), ("", "p1", 0.0), ("m1", "", 0.0), ("m1", "p1", 3.0), ("m1", "p1", 3.0), ("m2", "p2", 0.0)]


def test_tasks_grow_with_the_rows(spark):
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks_for(spark, 0) == own
    assert tasks_for(spark, (own + 5) * TASK_ROWS + 1) == own + 6


def test_standings_are_ranked_in_as_many_tasks_as_asked_for(spark):
    teams = spark.createDataFrame(
        [("m1", "s_1", "A", "B", 1, 0), ("m2", "s_2", "B", "A", 2, 2)], "match_id string, season_id string, home_team_name string, away_team_name string, home_team_score int, away_team_score int")
    dim = teams.select("*", F.lit("2020-01-01").cast("date").alias("match_date"), F.lit("10:00").alias("match_time"),
                       F.lit("Regular Season").alias("game_type"), F.when(F.col("match_id") == "m1", "Home Win").otherwise("Draw").alias("match_result"))
    rows = matches_by_team(dim, 37)
    shuffles = [line for line in plan(rows, "executedPlan").splitlines() if "Exchange" in line]
    assert any("season_id" in s and "match_week_number" in s and ", 37)" in s for s in shuffles), shuffles
    assert sorted(map(str, rows.collect())) == sorted(map(str, matches_by_team(dim).collect()))


def test_ranks_in_place_are_dealt_by_the_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr("touchline.session.TASK_ROWS", 1)
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = spark.range(own + 3).select(F.col("id").cast("string").alias("player_id"), F.lit("s").alias("season_id"), F.lit("t").alias("team_name"),
                                       F.col("id").cast("string").alias("player"), *[F.col("id").alias(src) for _, src in SEASON_TOTALS])
    ranked = totals_and_ranks(rows)
    assert any(f", {own + 3})" in line for line in plan(ranked, "executedPlan").splitlines() if "Exchange" in line)
    assert {r["season_goals_scored_rank"] for r in ranked.collect()} == set(range(1, own + 4))


def test_only_distinct_dates_are_looked_up(spark):
    matches = spark.createDataFrame([("s", "2020-01-01")] * 3 + [("s", "2020-01-02"), (None, "2020-01-01"), ("s", None)], "season_id string, date string")
    files = spark.createDataFrame([("s", "/x/player_match_data_s_2020-01-02.csv")] * 2 + [("s", "player_match_data_s_.csv"), ("s", None)], "season_id string, path string")
    found = missing_date_list(matches, stored_dates(files))
    text = plan(found)
    assert "Aggregate" not in text[: text.index("LeftAnti")]
    assert sorted((r["season_id"] or "", r["date"]) for r in found.collect()) == [("", "2020-01-01"), ("s", "2020-01-01")]


def test_regular_csv_records_are_parsed_at_once(monkeypatch):
    lines = ["a,old", '"1\n', '2","x ""y"""', "3,", '"",4']
    lines = "\n".join(lines).split("\n")
    batch = pa.record_batch({"value": lines, "_file": pa.array([1] * len(lines), pa.int64()), "_block": pa.array([0] * len(lines), pa.int64()),
                             "_odd": pa.array([0] * len(lines), pa.int64()), "_header": pa.array([0] * len(lines), pa.int32())})
    read = csv_records.reader(["a,old"], ["a", "new", "none"], {"old": "new"}, [])
    expected = [("1\n\n2", 'x "y"', None), ("3", None, None), (None, "4", None)]
    values = lambda b: [(r["a"], r["new"], r["none"]) for out in read(iter([b])) for r in out.to_pylist()]
    ragged = pa.record_batch([pa.array([*lines, "5"]), *[c.take([*range(len(lines)), 0]) for c in batch.columns[1:]]], names=batch.schema.names)
    assert values(ragged) == [*expected, ("5", None, None)]
    monkeypatch.setattr(csv_records, "_values", None)  # one record at a time is for the others
    assert values(batch) == expected


def test_a_table_that_nothing_reads_leaves_no_files(spark):
    table = written_once(spark.range(10), "ten")
    folder = os.path.dirname(table.inputFiles()[0].removeprefix("file://"))
    assert table.count() == 10 and os.path.isdir(folder)
    drop_table(table)
    assert not os.path.exists(folder)


def test_whole_cells_of_a_row_are_not_read_tag_by_tag(monkeypatch):
    def fail(*_):
        raise AssertionError("a whole cell was opened")

    monkeypatch.setattr(html_rows.StatsPage, "collect", fail)
    row = ("<tr><th data-stat=home_team><a href='/x?a&amp;b'>A &amp; B</a> (c) <a href='/y'>D</a></th><TD DATA-STAT=\"score\" title='a > b'>1-0\n"
           "<td data-stat='start_time'><span class='x venuetime'>10:00</span> <span>(local)</span></td><td data-stat='round'>R&amp;1</td> x <td data-stat='round'>no</td></tr>")
    page = f"<div id=all_sched><table class=stats_table><tbody>{row}</tbody></table></div>"
    keys = ["home_team", "score", "start_time", "round", "date"]
    read = html_rows._reader([("all_sched", False)], keys, ["home_team"], "start_time", "venuetime", None, "-")
    (found,) = next(read(iter([pa.record_batch({"html": [page]})]))).column("rows").to_pylist()
    assert [(r["texts"], r["hrefs"], r["linked"], r["shown"]) for r in found] == [
        (["A & B (c) D", "1-0", "10:00 (local)", "R&1", None], ["/x?a&b"], ["A & B"], "10:00")]


def test_a_cell_is_ended_by_a_cell_alone():
    cut = '<td data-stat="date>'  # never closed, so that it is text
    assert [x for x in html_rows.pieces(f"<tr><td>1{cut}") if x[4]] == []
    assert [x[4] for x in html_rows.pieces("<tr><td>1<td>2</td></tr>") if x[4]] == ["<td>1<td>2</td>"]


def dim_rows(spark):
    teams = spark.createDataFrame([("m1", "s_1", "A", "B", 1, 0), ("m2", "s_1", "B", "A", 2, 2), ("m3", "s_2", "A", "A", 1, 1), ("m4", "s_2", None, "C", 1, 3)],
                                  "match_id string, season_id string, home_team_name string, away_team_name string, home_team_score int, away_team_score int")
    return teams.select("*", F.lit("2020-01-01").cast("date").alias("match_date"), F.lit("10:00").alias("match_time"), F.lit("Regular Season").alias("game_type"),
                        F.when(F.col("match_id") == "m2", "Draw").otherwise("Home Win").alias("match_result"))


def test_player_context_takes_no_standings(spark):
    dim = dim_rows(spark)
    plain = matches_by_team(dim, 37, ranked=False)
    assert not any("match_week_number" in line for line in plan(plain, "executedPlan").splitlines() if "Exchange" in line)
    assert sorted(map(str, plain.collect())) == sorted(map(str, matches_by_team(dim, 37).select(plain.columns).collect()))


def test_running_totals_that_nobody_reads_are_not_joined(spark):
    rows = matches_by_team(dim_rows(spark), 37, ranked=False).select("match_id", "team_name", "season_id")
    assert "Join" not in plan(rows) and "Window" not in plan(rows)
    assert sorted((r["match_id"], r["team_name"]) for r in rows.collect()) == [("m1", "A"), ("m1", "B"), ("m2", "A"), ("m2", "B"), ("m3", "A"), ("m4", "C")]


@pytest.mark.parametrize("rows", [lambda s: shim.schedule_capture(s, SMALL), lambda s: shim.player_capture_raw(s, SMALL)[0]])
def test_wide_captures_have_code_of_their_own(spark, rows):
    """The widest select is not in one method with the joins (``*``) before it, which the JVM would not compile."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan shows its code when it ran
    try:
        lines = plan(rows(spark), "executedPlan").splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert lines[0].startswith("Project ") and any("*(" in line for line in lines)


def test_few_sides_are_left_to_the_session(spark, monkeypatch):
    assert shim.side_tasks(spark, SMALL) is None
    monkeypatch.setattr(shim, "TASK_ROWS", 10)
    assert shim.side_tasks(spark, SMALL) >= 1
