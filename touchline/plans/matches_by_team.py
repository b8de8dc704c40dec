"""Team-match table (T1-T15): two rows per match with running totals,
match week, standings and streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from touchline.operators.running import TEAM_KEYS, season_running
from touchline.operators.sequence import GRAIN_KEY, partition_by_grain
from touchline.operators.sides import SIDE_COLUMNS, team_sides
from touchline.operators.standings import standings


def team_match_rows(dim_match: DataFrame, tasks: int | None = None) -> DataFrame:
    """Distinct side rows (T1-T8), before any window, in ``tasks`` tasks (None: the session's number)."""
    sides = team_sides(dim_match)
    # Whole-row distinct (T8). Partitioning by the (team, season, date) key
    # first lets the dedup, the per-date aggregate, the join back and the
    # in-date numbering reuse one shuffle; the key includes the date so a hot
    # team-season still spreads over many tasks.
    return partition_by_grain(sides, TEAM_KEYS, "match_date", tasks).dropDuplicates(SIDE_COLUMNS + [GRAIN_KEY])


def matches_by_team(dim_match: DataFrame, tasks: int | None = None, ranked: bool = True) -> DataFrame:
    """``ranked=False`` is for readers of no standing: the same rows without
    T14's columns and the shuffle that they need."""
    rows = season_running(team_match_rows(dim_match, tasks))
    if not ranked:
        return rows
    if tasks:
        rows = rows.repartition(tasks, "season_id", "match_week_number")
    return rows.select("*", *standings(rows))
