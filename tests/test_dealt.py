"""Wide rows that are shuffled once, for all joins of the same key, and little else beside them on disk."""

import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.test_scale import context, plan, players  # noqa: F401
from touchline import operator_queries as Q
from touchline.operators.ingest import keeper_merge
from touchline.operators.keys import dealt
from touchline.plans import match_level_player as M
from touchline.registry import REGISTRY
from touchline.schemas import PLAYER_COLUMNS, PLAYER_COUNT_COLUMNS
from touchline.sources import csv_tables as S
from touchline.sources import pages


@pytest.fixture()
def shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def shuffles(df, part="executedPlan"):
    return [line for line in plan(df, part).splitlines() if "Exchange" in line]


def merged(spark, players):  # noqa: F811
    keeper = spark.createDataFrame([("m1", "p1", "3"), ("m1", None, "x"), (None, "p1", "5")], "match_id string, player_id string, gk_saves string")
    return keeper_merge(players.drop(*[c for c in players.columns if c.startswith("gk_")]), keeper, 5, by_match=True)


def test_keepers_and_matches_join_rows_that_are_shuffled_once(spark, shuffled, players, context):  # noqa: F811
    rows = M.distinct_rows(merged(spark, players), context)
    found = shuffles(rows)
    assert len(found) == 3 and all(", 5)" in x and "_of_5" in x for x in found), found
    got = sorted((r["match_id"] or "", r["player_id"] or "", r["season_id"] or "", r["gk_saves"], r["_times"]) for r in rows.collect())
    assert got == [("", "p1", "", 0.0, 2), ("m1", "", "", 0.0, 1), ("m1", "p1", "s", 3.0, 2), ("m2", "p2", "", 0.0, 1)]


def test_small_numbers_travel_as_bytes(spark):
    values = [0, 1, 254, 255, 256, -1, None, 2**62]
    rows = [tuple(values[(i * k) % 8] if i % 2 else (i + k) % 200 for k in range(1, 19)) for i in range(40)] + [(None,) * 18, (254,) * 18]
    df = spark.createDataFrame(rows, ", ".join(f"{c} long" for c in PLAYER_COUNT_COLUMNS))
    out = dealt(df, F.col("minutes"), 3, small=PLAYER_COUNT_COLUMNS)
    assert "_word2" in plan(out) and out.dtypes[:-1] == df.dtypes
    assert sorted(map(str, out.drop("_of_3").collect())) == sorted(map(str, df.collect()))


def test_player_seasons_leave_no_shuffle_of_the_matches_beside_the_rows(spark):
    text = plan(REGISTRY["player_season_age"][0](spark, SMALL), "executedPlan")
    assert 1 <= text.count("customer.parquet") <= 2  # the matches of the rows and of the keepers


def test_season_totals_are_taken_from_a_table_of_few_columns(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(Q, "totals_and_ranks", lambda rows, keep=Q.totals_and_ranks: seen.append((rows.columns, plan(rows, "executedPlan"))) or keep(rows))
    REGISTRY["player_season_totals"][0](spark, SMALL)
    ((columns, text),) = seen
    assert "Exchange" not in text and "player_url" not in columns


@pytest.mark.parametrize("name", ["match_level_player_data", "appearance_number"])
def test_player_mart_shuffles_and_sorts_its_rows_once_for_numbers_and_figures(spark, shuffled, name):
    text = plan(REGISTRY[name][0](spark, SMALL), "executedPlan")
    assert "rangepartitioning" not in text and text.count("Exchange") == 2 and "SortMergeJoin" not in text and text.count("Sort [") == 1


def test_player_mart_numbers_large_seasons_by_range(spark, players, context):  # noqa: F811
    rows = players.withColumn("age", F.lit("20-001")).crossJoin(spark.range(30).withColumnRenamed("id", "n")).filter("coalesce(player_id, '') <> 'p2' or n < 5")
    rows = rows.select(*[F.col(c).cast("long") if c in PLAYER_COUNT_COLUMNS else F.concat("player", F.col("n") % 20).alias("player") if c == "player" else F.col(c) for c in PLAYER_COLUMNS])
    few, many = M.match_level_player_data(rows, context), M.match_level_player_data(rows, context, large=15)
    assert "_first" in plan(many) and "_first" not in plan(few)
    assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    numbers = sorted(r["season_appearances_number"] for r in many.filter("player_id is null").collect())
    assert numbers == [*range(1, len(numbers) + 1)] and len(numbers) == 20


@pytest.mark.parametrize("name", ["csv_raw_roundtrip", "player_day_files"])
def test_file_layers_shuffle_their_rows_once_and_pack_their_files(spark, shuffled, monkeypatch, name):
    tables, written = [], []
    monkeypatch.setattr(Q, "written_once", lambda df, n, keep=Q.written_once: tables.append(plan(df, "executedPlan")) or keep(df, n))
    monkeypatch.setattr(S, "write_partitioned", lambda df, path, *x, keep=S.write_partitioned, **y: written.append(path) or keep(df, path, *x, **y))
    REGISTRY[name][0](spark, SMALL)
    (text,) = tables
    assert "Exchange" not in text[: text.index("_of_")].split("SortMergeJoin", 1)[0] and text.count("Exchange shufflepartitionid") == 3
    files = [f for at, _, names in os.walk(written[0]) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_packed_files_come_back_whole(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(S, "PACKED_RECORDS", 7)
    rows = [(f"p{i}", "m", "a\n" * (i % 5) + '"q", \r\n', str(i)) for i in range(60)]
    S.write_partitioned(spark.createDataFrame(rows, "player_id string, season string, player string, goals string"), f"{tmp_dir}/z", ["season"], packed=True)
    assert len([f for f in os.listdir(f"{tmp_dir}/z/season=m") if f.endswith(".csv.gz")]) >= 8
    assert sorted(map(tuple, S.read_csv_by_name(spark, f"{tmp_dir}/z", ["player_id", "player", "goals"]).collect())) == sorted((p, x, g) for p, _, x, g in rows)


def test_pages_are_not_shuffled(spark, shuffled):
    lines = plan(pages.match_pages(spark, SMALL), "executedPlan").splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i, line in enumerate(lines):
        if "Exchange" in line:
            below = lines[i + 1 :]
            end = next((k for k, x in enumerate(below) if depth(x) <= depth(line)), len(below))
            assert not any("collect_list" in x for x in below[:end]), line
