"""Plan guards: every registered query stays JVM-side and join-safe."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from touchline.registry import REGISTRY

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF", "MapInArrow"]
# html_rows needs a stack of open elements, csv_records the quotes since a record's start.
READS_PAGES = {"schedule_html_roundtrip", "player_html_roundtrip", "page_links", "csv_raw_roundtrip", "match_csv_roundtrip", "player_day_files", "season_file_load"}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_has_no_cross_join_or_python(spark, name):
    df = REGISTRY[name][0](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan and not (f == "MapInArrow" and name in READS_PAGES)]


def test_team_mart_keeps_one_detail_shuffle_for_the_windows(spark):
    # Detail rows are shuffled once on the grain key and once for the standings;
    # every other exchange in the plan is on the small date-grain table.
    plan = REGISTRY["matches_by_team"][0](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") >= 1
    assert "SortMergeJoin" not in plan or plan.count("SortMergeJoin") <= 1


def test_playoff_mart_reads_its_input_once(spark):
    # In the plan that ran, all branches share one exchange of the rows, and no distinct count multiplies them.
    df = REGISTRY["playoff_champions"][0](spark, SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("orders.parquet") == 1
    assert "Expand" not in final and "ReusedExchange" in final


def test_player_mart_deals_no_rows_by_player_and_date(spark):
    # The captured rows are read while the positions are written, not again; no window orders detail rows.
    plan = REGISTRY["match_level_player_data"][0](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "_gk" not in plan


def test_extraction_is_page_local(spark):
    # One scan and one pass over the pages; X4 and the keeper merge need neither a shuffle nor a join.
    from touchline.operators import extract

    pages = spark.createDataFrame([(1, "u", "", "s")], "page_id long, url string, html string, season_id string")
    for rows in (extract.schedule_rows(pages), extract.player_match_rows(pages)):
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan and plan.count("MapInArrow") == 1


def test_team_ranks_in_place_and_by_range(spark):
    # The season of 600 players is ranked in place, that of 2,400 (none) by range.
    from touchline.operators.player_season import SEASON_RANKS, SEASON_TOTALS, totals_and_ranks

    n = 3000
    rows = spark.range(n).select(
        F.concat(F.lit("p"), "id").alias("player_id"), F.when(F.col("id") % 5 == 0, F.lit("1_2024")).alias("season_id"), F.lit("T").alias("team_name"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("n"), F.col("id") % 900)).alias("player"),
        *[F.when(F.col("id") % (11 + i) > 0, F.col("id") * (i + 3) % 37).alias(src) for i, (_, src) in enumerate(SEASON_TOTALS)])
    got = totals_and_ranks(rows, large=1000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "dense_rank" in plan and "_first_" in plan
    got = {r.player_id: r for r in got.collect()}
    plain = rows.collect()
    assert len(got) == n
    for (rank, total), (_, src) in zip(SEASON_RANKS, SEASON_TOTALS, strict=True):
        for season in (None, "1_2024"):
            mine = [r for r in plain if r.season_id == season]
            by = lambda r: (r[src] is None, -(r[src] or 0), r.player is None, r.player or "")  # noqa: E731, B023
            place = {k: i + 1 for i, k in enumerate(sorted({by(r) for r in mine}))}
            assert all(got[r.player_id][rank] == place[by(r)] and got[r.player_id][total] == r[src] for r in mine)
