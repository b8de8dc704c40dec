"""Registered queries: name -> (Spark builder, oracle SQL or None).

Every builder reads the driver's tables under ``sf_dir`` (through the league
shim) so its work grows with them. ``__spark_entry__`` exposes this registry.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import oracle as O
from touchline.plans.dim_match import dim_match
from touchline.plans.match_level_player import match_level_player_data
from touchline.plans.matches_by_team import matches_by_team
from touchline.plans.playoff_champions import playoff_champions, playoff_history, regular_season_summary
from touchline.operators import extract
from touchline.sources import pages as page_src
from touchline.sources import shim

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir.rstrip("/"))

        REGISTRY[name] = (run, sql)
        return run

    return deco


# ---------------------------------------------------------------- inputs
def league_dim_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_match(shim.match_stats(spark, sf_dir))


def league_matches_by_team(spark: SparkSession, sf_dir: str, ranked: bool = True) -> DataFrame:
    return matches_by_team(league_dim_match(spark, sf_dir), shim.side_tasks(spark, sf_dir), ranked)


# ---------------------------------------------------------------- marts
@register("dim_match", O.with_ctes(O.SHIM_SCHEDULE, O.DIM_MATCH, select="SELECT * FROM dim_match"))
def q_dim_match(spark, sf_dir):
    return league_dim_match(spark, sf_dir)


@register("matches_by_team", O.with_ctes(*O.team_ctes(), select="SELECT * FROM matches_by_team"))
def q_matches_by_team(spark, sf_dir):
    return league_matches_by_team(spark, sf_dir)


@register("match_level_player_data", O.with_ctes(*O.player_ctes(), select="SELECT * FROM match_level_player_data"))
def q_match_level_player(spark, sf_dir):
    return match_level_player_data(shim.player_match_stats(spark, sf_dir, by_match=True), league_matches_by_team(spark, sf_dir, ranked=False))


@register("regular_season_summary", O.with_ctes(*O.playoff_ctes(), select="SELECT * FROM regular_season_summary"))
def q_regular_season_summary(spark, sf_dir):
    return regular_season_summary(league_matches_by_team(spark, sf_dir), O.PLAYOFF_AS_OF)


@register("playoff_history", O.with_ctes(*O.playoff_ctes(), select="SELECT * FROM playoff_history"))
def q_playoff_history(spark, sf_dir):
    return playoff_history(league_matches_by_team(spark, sf_dir), O.PLAYOFF_AS_OF)


@register("playoff_champions", O.with_ctes(
    *O.playoff_ctes(), select="SELECT * FROM playoff_champions WHERE playoff_result <> 'Missed Playoffs'"))
def q_playoff_champions(spark, sf_dir):
    return playoff_champions(league_matches_by_team(spark, sf_dir), O.PLAYOFF_AS_OF)


# ---------------------------------------------------------------- extraction
@register("schedule_html_roundtrip", O.with_ctes(O.SHIM_SCHEDULE, select="SELECT * FROM match_stats"))
def q_schedule_html_roundtrip(spark, sf_dir):
    """Render schedule pages from the capture, extract them again (X1-X7) and
    store the score spreadsheet-safe (S12, as read back)."""
    rows = extract.schedule_rows(page_src.schedule_pages(spark, sf_dir), base_url=shim.BASE_URL)
    return rows.select(*[F.when(F.col("score").isNotNull(), F.concat(F.lit("'"), F.col("score"))).alias("score")
                         if c == "score" else F.col(c) for c in rows.columns if not c.startswith("_")])


@register("player_html_roundtrip", O.with_ctes(
    O.SHIM_SCHEDULE, O.SHIM_PLAYERS,
    select="SELECT * REPLACE (coalesce(age, '0') AS age) FROM player_match_stats"))
def q_player_html_roundtrip(spark, sf_dir):
    """Render match pages, extract outfield + keeper tables and merge them.

    An empty age cell is captured as "0", so stored NULL ages come back as "0".
    """
    return extract.player_match_rows(page_src.match_pages(spark, sf_dir), base_url=shim.BASE_URL)


@register("page_links", O.PAGE_LINKS)
def q_page_links(spark, sf_dir):
    return extract.page_links(shim.read_table(spark, sf_dir, "pages")).drop("link_pos")


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


# Operator-level queries register themselves on import.
from touchline import operator_queries  # noqa: E402,F401
