"""Match -> team rows.

The specification joins a distinct team list to matches with
``team = home OR team = away``. On Spark a literal OR join plans as a nested
loop join; since every team of the list comes from the matches themselves, the
join is exactly an *unpivot* of each match to its distinct named sides, which
is a narrow (shuffle-free) ``explode``. ``team_id`` is a pure function of the
name, so the distinct team list never has to be materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.text import surrogate_key

# Which side a result favours; "" favours neither, other results are unknown.
WINNER = {"Home Win": "Home", "Home Win on Penalties": "Home", "Away Win": "Away", "Away Win on Penalties": "Away", "Draw": ""}
POINTS = {"Win": 3, "Draw": 1}
REGULAR_SEASON = "Regular Season"

SIDE_COLUMNS = [
    "team_id", "team_name", "match_id", "match_date", "match_time", "season_id", "season", "game_type",
    "match_location", "opponent_team_name", "match_outcome", "goals_scored", "goals_conceded", "match_points",
]


def _lookup(table: dict, key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def sides_of(home: Column, away: Column, home_goals: Column, away_goals: Column) -> Column:
    """The two sides of a match as structs; null for one without a team, and for the second of a team that plays itself."""
    def side(location, team, opponent, scored, conceded):
        return F.struct(F.lit(location).alias("location"), team.alias("team"), opponent.alias("opponent"),
                        scored.alias("scored"), conceded.alias("conceded"))

    # No lambda, which Spark would not compile with the steps around it.
    return F.array(F.when(home.isNotNull(), side("Home", home, away, home_goals, away_goals)),
                   F.when(away.isNotNull() & ~away.eqNullSafe(home), side("Away", away, home, away_goals, home_goals)))


def team_sides(dim_match: DataFrame) -> DataFrame:
    """One row per (match, distinct non-NULL side): the inner unpivot."""
    sides = sides_of(*[F.col(c) for c in ("home_team_name", "away_team_name", "home_team_score", "away_team_score")])
    rows = dim_match.withColumn("side", F.explode(sides)).filter("side is not null").withColumn("winner", _lookup(WINNER, F.col("match_result")))
    outcome = (F.when(F.col("winner") == F.col("side.location"), "Win").when(F.col("winner") == "", "Draw")
               .when(F.col("winner").isNotNull(), "Loss").otherwise("Unknown"))
    rows = rows.withColumn("match_outcome", outcome)
    points = F.when(F.col("game_type") == REGULAR_SEASON, _lookup(POINTS, F.col("match_outcome")))
    made = {
        "team_id": surrogate_key("side.team"),
        "team_name": F.col("side.team"),
        "season": F.split_part(F.col("season_id"), F.lit("_"), F.lit(2)),
        "match_location": F.col("side.location"),
        "opponent_team_name": F.col("side.opponent"),
        "goals_scored": F.col("side.scored"),
        "goals_conceded": F.col("side.conceded"),
        "match_points": F.coalesce(points, F.lit(0)),
    }
    return rows.select(*[made.get(c, F.col(c)).alias(c) for c in SIDE_COLUMNS])


def distinct_teams(dim_match: DataFrame) -> DataFrame:
    """Distinct team names with their surrogate key."""
    names = dim_match.select(F.col("home_team_name").alias("team_name")).distinct().unionAll(
        dim_match.select(F.col("away_team_name").alias("team_name")).distinct())
    return names.distinct().select("team_name", surrogate_key("team_name").alias("team_id"))
