"""Invariants of the team mart on the driver's smallest tables."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tests.conftest import SMALL
from touchline.registry import league_matches_by_team


@pytest.fixture(scope="module")
def mbt(spark):
    return league_matches_by_team(spark, SMALL).cache()


def test_at_most_two_rows_per_match(mbt):
    ided = mbt.filter(F.col("match_id").isNotNull())  # report-less matches share a NULL id
    assert ided.groupBy("match_id").count().filter("count > 2").count() == 0


def test_wins_equal_losses(mbt):
    c = {r["match_outcome"]: r["count"] for r in mbt.groupBy("match_outcome").count().collect()}
    assert c.get("Win", 0) == c.get("Loss", 0)


def test_week_numbers_dense_and_final_total_is_group_sum(mbt):
    g = mbt.groupBy("team_id", "season_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("match_week_number").alias("w"), F.sum("match_points").alias("pts"),
        F.max_by("season_points", "match_week_number").alias("last"))
    assert g.filter("n != w").count() == 0
    assert g.filter("pts != last").count() == 0


def test_standings_are_permutations(mbt):
    g = mbt.groupBy("season_id", "match_week_number").agg(
        F.count(F.lit(1)).alias("n"), F.max("current_match_week_position").alias("mx"),
        F.countDistinct("current_match_week_position").alias("d"))
    assert g.filter("n != mx OR n != d").count() == 0


def test_streaks_reset(mbt):
    # On dates where a team plays once, a win extends the previous count by one.
    per_date = Window.partitionBy("team_id", "season_id", "match_date")
    single = mbt.withColumn("n_day", F.count(F.lit(1)).over(per_date))
    w = Window.partitionBy("team_id", "season_id").orderBy("match_week_number")
    prev = (single.withColumn("p_win", F.lag("consecutive_win_count").over(w))
            .withColumn("p_date", F.lag("match_date").over(w))
            .withColumn("p_n", F.lag("n_day").over(w))
            .filter((F.col("n_day") == 1) & (F.col("p_n") == 1)))
    bad = prev.filter((F.col("match_outcome") == "Win") & (F.col("p_date") < F.col("match_date"))
                      & (F.col("consecutive_win_count") != F.col("p_win") + 1))
    assert bad.count() == 0
    assert mbt.filter((F.col("match_outcome") != "Win") & (F.col("consecutive_win_count") != 0)).count() == 0
