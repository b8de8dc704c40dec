"""Play-off outcome summary (C1-C9): one row per team-season that reached the play-offs.

One pass over the team-match mart gives both halves as aggregates (partial
aggregation on the map side, so a hot team-season never sits in one task as
raw rows); nothing is joined.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators.sides import REGULAR_SEASON

GROUP = ["team_name", "team_id", "season_id"]
CHAMPION_ROUND = "Final"
MISSED = "Missed Playoffs"


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    return F.lit(as_of)


# C1
def completed_seasons(mbt: DataFrame, as_of=None) -> Column:
    """Season year strictly before the year of ``as_of`` (default: today)."""
    return F.split_part(F.col("season_id"), F.lit("_"), F.lit(2)).cast("int") < F.year(_as_of(as_of))


# Last regular-season figures (C2): output name -> column of the team-match mart.
SEASON_END = {
    "position": "current_match_week_position",
    "points": "season_points",
    "goal_difference": "season_goal_difference",
    "goals_scored": "season_goals_scored",
    "goals_scored_rank": "current_match_week_position_goals_scored_best_offense",
    "goals_conceded": "season_goals_conceded",
    "goals_conceded_rank": "current_match_week_position_goals_conceded_best_defence",
}


def season_outcomes(mbt: DataFrame, as_of=None) -> DataFrame:
    """One row per team-season with its regular-season and its play-off figures.

    Two steps of aggregation over one scan: per match first, which makes the
    distinct matches of C6 plain counts, then per team-season. ``r`` and ``p``
    are NULL where the team-season has no row of that kind.
    """
    regular = F.col("game_type") == REGULAR_SEASON
    other = F.col("game_type") != REGULAR_SEASON
    week = F.when(regular, F.col("match_week_number"))
    # "Latest" orders by match date, ties broken by the match week number; undated rows do not count.
    when = F.when(other & F.col("match_date").isNotNull() & F.col("match_week_number").isNotNull(), F.struct("match_date", "match_week_number"))
    end = F.struct(*[F.col(c).alias(n) for n, c in SEASON_END.items()])
    leg = F.struct("match_location", "game_type", "match_outcome")
    per_match = mbt.filter(completed_seasons(mbt, as_of) & F.col("game_type").isNotNull()).groupBy(*GROUP, "match_id").agg(
        F.max(week).alias("week"), F.max_by(end, week).alias("end"),
        F.max(F.when(regular, F.col("consecutive_win_count"))).alias("streak"),
        F.max(F.when(regular, (F.col("match_outcome") == "Win").cast("int"))).alias("won"),
        F.min(when).alias("first_at"), F.min_by(leg, when).alias("first_leg"), F.max(when).alias("last_at"), F.max_by(leg, when).alias("last_leg"),
        F.max(F.when(other, (F.col("match_location") == "Home").cast("int"))).alias("home"),
        F.count_if(other).alias("others"),
    )
    known = F.col("match_id").isNotNull()
    share = lambda flag: F.try_divide(F.count_if(known & (F.col(flag) == 1)), F.count_if(known & F.col(flag).isNotNull()))
    return per_match.groupBy(*GROUP).agg(
        F.max("week").alias("match_count"), F.max_by("end", "week").alias("end"), F.max("streak").alias("streak"), share("won").alias("win_share"),
        F.min_by("first_leg", "first_at").alias("first_leg"), F.max_by("last_leg", "last_at").alias("last_leg"), share("home").alias("home_share"),
        (F.sum("others") > 0).alias("has_playoff"),
    )


def _regular_columns() -> list[Column]:
    end = F.col("end")

    def per_match(n):  # C4
        return F.try_divide(end[n], F.col("match_count")).alias(f"regular_season_end_{n}_per_match")

    out = [F.col(c) for c in GROUP] + [F.col("match_count")]
    for n in SEASON_END:
        out.append(end[n].alias(f"regular_season_end_{n}"))
        if n == "points":
            out.append(per_match(n))
        if n.endswith("_rank"):
            out.append(per_match(n.removesuffix("_rank")))
    return out + [F.col("streak").alias("regular_season_longest_consecutive_win_count"), F.col("win_share").alias("regular_season_win_percentage")]


def regular_season_summary(mbt: DataFrame, as_of=None) -> DataFrame:
    """End-of-regular-season figures per team-season."""
    return season_outcomes(mbt, as_of).filter(F.col("match_count").isNotNull()).select(*_regular_columns())


def playoff_history(mbt: DataFrame, as_of=None) -> DataFrame:
    """First venue, home share and latest round/outcome of each play-off run."""
    return season_outcomes(mbt, as_of).filter("has_playoff").select(
        *GROUP,
        F.col("first_leg.match_location").alias("first_playoff_round_match_location"),
        F.col("home_share").alias("playoff_run_home_percentage"),
        F.col("last_leg.game_type").alias("playoff_run_latest_round"),
        F.col("last_leg.match_outcome").alias("playoff_run_latest_round_match_outcome"))


def playoff_result(latest_round: Column, latest_outcome: Column) -> tuple[Column, Column]:
    champion = F.coalesce((latest_round == CHAMPION_ROUND) & (latest_outcome == "Win"), F.lit(False))
    result = (F.when(champion, F.lit("Playoff Champions"))
              .when(latest_round.isNotNull(), F.concat(F.lit("Lost in "), latest_round))
              .otherwise(F.lit(MISSED)))
    return result, F.when(champion, F.lit(1)).otherwise(F.lit(0))


def playoff_champions(mbt: DataFrame, as_of=None) -> DataFrame:
    """Team-seasons with a regular season that reached the play-offs."""
    result, champ = playoff_result(F.col("last_leg.game_type"), F.col("last_leg.match_outcome"))
    out = season_outcomes(mbt, as_of).filter(F.col("match_count").isNotNull()).select(
        *_regular_columns(),
        F.coalesce((F.col("first_leg.match_location") == "Home").cast("int"), F.lit(0)).alias("first_playoff_round_match_location_is_home"),
        F.when(F.col("has_playoff"), F.col("home_share")).alias("playoff_run_home_percentage"),
        result.alias("playoff_result"),
        champ.alias("is_playoff_champion"),
    )
    return out.filter(F.col("playoff_result") != MISSED)
