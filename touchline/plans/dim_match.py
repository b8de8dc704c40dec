"""Match dimension (D1-D8): one row per stored match, narrow projection only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import text as X

REGULAR_SEASON = "Regular Season"
# Kick-off bands by hour (upper bounds inclusive); a NULL time falls through to the last band.
KICKOFF_BANDS = [(12, "Morning Kickoff"), (16, "Afternoon Kickoff"), (19, "Evening Kickoff"), (22, "Night Kickoff")]
KICKOFF_LAST = "Late Night Kickoff"
TIME_PATTERN = "H:mm[:ss]"

DIM_MATCH_COLUMNS = [
    "match_id", "season_id", "game_type", "match_date", "match_time", "match_time_of_day",
    "home_team_name", "away_team_name", "home_team_score", "away_team_score",
    "home_penalty_shootout_goals", "away_penalty_shootout_goals", "match_result", "attendance",
    "match_referee_name", "match_venue", "match_report_url", "match_notes",
]


def kickoff_band(hour) -> F.Column:
    out = None
    for upper, label in KICKOFF_BANDS:
        out = F.when(hour <= upper, F.lit(label)) if out is None else out.when(hour <= upper, F.lit(label))
    return out.otherwise(F.lit(KICKOFF_LAST))


def match_result(h, a, hp, ap, notes) -> F.Column:
    cancelled = F.lit(False)
    for p in X.CANCEL_PHRASES:
        cancelled = cancelled | notes.ilike(f"%{p}%")
    return (
        F.when(h > a, "Home Win")
        .when(h < a, "Away Win")
        .when((h == a) & hp.isNull() & ap.isNull(), "Draw")
        .when((h == a) & (hp > ap), "Home Win on Penalties")
        .when((h == a) & (hp < ap), "Away Win on Penalties")
        .when(h.isNull() & a.isNull() & cancelled, "Cancelled")
        .otherwise("Unknown")
    )


def dim_match(match_stats: DataFrame) -> DataFrame:
    # Materialise the cleaned score first so the score parser reads a column,
    # not a re-evaluated expression.
    df = match_stats.withColumn("_score_clean", X.trim_score("score"))
    df = df.withColumn("_is_shootout", X.is_shootout("_score_clean"))
    parsed = X.parse_score("_score_clean", "_is_shootout")
    kickoff = F.to_timestamp(F.col("start_time"), TIME_PATTERN)
    df = df.select("*", *[v.alias(k) for k, v in parsed.items()], kickoff.alias("_kickoff"))
    h, a = F.col("home_team_score"), F.col("away_team_score")
    hp, ap = F.col("home_penalty_shootout_goals"), F.col("away_penalty_shootout_goals")
    return df.select(
        F.col("match_id").cast("string").alias("match_id"),
        F.col("season_id").cast("string").alias("season_id"),
        F.coalesce(F.col("round"), F.lit(REGULAR_SEASON)).alias("game_type"),
        F.col("date").cast("date").alias("match_date"),
        F.date_format("_kickoff", "HH:mm:ss").alias("match_time"),
        kickoff_band(F.hour("_kickoff")).alias("match_time_of_day"),
        F.col("home_team").alias("home_team_name"),
        F.col("away_team").alias("away_team_name"),
        h, a, hp, ap,
        match_result(h, a, hp, ap, F.col("notes")).alias("match_result"),
        "attendance",
        F.col("referee").alias("match_referee_name"),
        F.col("venue").alias("match_venue"),
        F.col("match_report").alias("match_report_url"),
        F.col("notes").alias("match_notes"),
    )
