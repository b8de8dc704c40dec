"""League tables derived from the driver's star schema.

The driver ships TPC-H-like tables, not league captures. This module maps them
onto the league layout with plain column arithmetic so every mart runs on data
that grows with the inputs and has an independent SQL oracle:

* one order            -> one scheduled match (season = order year, teams =
                          customer nation vs. a different nation);
* one lineitem         -> one player appearance in that match (player =
                          supplier, position = part type, minutes = quantity).

Captured text goes through the same normalisers as real captures (dash
variants, spreadsheet apostrophe, URL tokens), and the shim deliberately
produces the edge cases the marts must handle: shoot-outs won by either side,
NULL scores with and without cancel notes, NULL kick-off times, matches
without report URL, two games of a team on one date, player rows whose team
matches no side, malformed ages and players without a link.

The same definition exists as SQL in ``touchline.oracle``; keep both in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import text as X
from touchline.operators.ingest import keeper_merge
from touchline.operators.keys import DEALT, dealt
from touchline.schemas import GK_COLUMNS, MATCH_STATS_COLUMNS, PLAYER_COLUMNS
from touchline.session import TASK_ROWS, tasks_for

BASE_URL = "https://stats.example.org"
LEAGUE_ID = "73"
N_NATIONS = 25  # size of the fixed `nation` dimension


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _hex8(c):
    h = F.lower(F.hex(c))
    return F.lpad(h, F.greatest(F.lit(8), F.length(h)), "0")


def schedule_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schedule rows as captured (before score/URL normalisation)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    home = nation.select(F.col("n_nationkey").alias("h_key"), F.col("n_name").alias("home_team"))
    away = nation.select(F.col("n_nationkey").alias("a_key"), F.col("n_name").alias("away_team"))

    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    df = (
        # Orders and customers both grow, so both are shuffled on the key.
        o.join(c.hint("shuffle_hash"), o.o_custkey == c.c_custkey)
        .withColumn("a_nat", (F.col("c_nationkey") + 1 + k % 24) % N_NATIONS)
        .join(home, F.col("c_nationkey") == F.col("h_key"))
        .join(away, F.col("a_nat") == F.col("a_key"))
    )
    playoff = k % 13 == 0
    h, a = (ck % 5).cast("string"), (k % 4).cast("string")
    dash = (
        F.when(k % 4 == 0, F.lit("-"))
        .when(k % 4 == 1, F.lit(X.SCORE_DASHES[0]))
        .when(k % 4 == 2, F.lit(X.SCORE_DASHES[1]))
        .otherwise(F.lit(X.SCORE_DASHES[2]))
    )
    plain = F.concat(h, dash, a)
    shootout = F.concat(
        F.lit("("), (2 + k % 5).cast("string"), F.lit(") "), h, dash, a,
        F.lit(" ("), (2 + ck % 3).cast("string"), F.lit(")"),
    )
    scored = F.when(playoff & (ck % 5 == k % 4), shootout).otherwise(plain)
    scored = F.when(k % 7 == 0, F.concat(F.lit(" "), scored, F.lit(" "))).otherwise(scored)
    no_score = (k % 97 == 0) | (k % 89 == 0)
    mid = _hex8(k)
    slug = F.concat(F.replace(F.col("home_team"), F.lit(" "), F.lit("-")), F.lit("-"),
                    F.replace(F.col("away_team"), F.lit(" "), F.lit("-")))
    return df.select(
        F.concat(F.lit(LEAGUE_ID + "_"), F.year("o_orderdate").cast("string")).alias("season_id"),
        F.when(playoff, F.when(k % 3 == 0, F.lit("Quarterfinals")).when(k % 3 == 1, F.lit("Semifinals"))
               .otherwise(F.lit("Final"))).alias("round"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(k % 29 != 0, F.concat(F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":"),
                                     F.when(k % 2 == 0, F.lit("00")).otherwise(F.lit("30")))).alias("start_time"),
        "home_team",
        "away_team",
        X.split_code(F.when(~no_score, scored)).alias("score"),
        F.when(k % 11 != 0, F.format_number(500 + (ck * 7) % 20000, 0)).alias("attendance"),
        F.concat(F.lit("Referee "), (ck % 40).cast("string")).alias("referee"),
        F.concat(F.col("home_team"), F.lit(" Park")).alias("venue"),
        F.when(k % 211 != 0, F.concat(F.lit(BASE_URL + X.MATCH_URL_MARKER), mid, F.lit("/"), slug)).alias("match_report"),
        F.when(k % 97 == 0, F.when(k % 2 == 0, F.lit("Match Cancelled")).otherwise(F.lit("Match canceled due to weather")))
        .when(k % 89 == 0, F.when(k % 2 == 0, F.lit("Match awarded")))
        .when(k % 31 == 0, F.lit("Played behind closed doors"))
        .alias("notes"),
        k.alias("order_key"),
    )


def match_stats(spark: SparkSession, sf_dir: str, keep_key: bool = False) -> DataFrame:
    """Stored match table: capture -> score normalise (N1) -> naive split
    -> match id (N2) -> spreadsheet-safe score (S12, as read back from CSV)."""
    cols = [c for c, _ in MATCH_STATS_COLUMNS]
    # The normalised score is materialised once; later expressions reference it.
    cap = schedule_capture(spark, sf_dir).withColumn("_score", X.normalize_score("score"))
    hs, as_ = X.naive_score_split("_score")
    out = cap.select(
        *[c for c in cols if c not in ("score", "home_score", "away_score", "match_id")],
        F.when(F.col("_score").isNotNull(), F.concat(F.lit("'"), F.col("_score"))).alias("score"),
        hs.alias("home_score"),
        as_.alias("away_score"),
        X.match_id_from_url("match_report").alias("match_id"),
        "order_key",
    ).select(*cols, *(["order_key"] if keep_key else []))
    return out


def player_capture(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(outfield rows, keeper rows) as extracted from match pages."""
    outfield, keeper = player_capture_raw(spark, sf_dir)
    helpers = ["_line", "_pk", "_ok", "order_key", "page_url"]
    return outfield.drop(*helpers), keeper.drop(*[h for h in helpers if h in keeper.columns])


def player_capture_raw(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Captured rows plus helper columns (order key, page URL, line number); with
    ``tasks`` both are dealt to so many by their order, with the column that says so."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nat"), F.col("n_name").alias("s_nation"))
    m = match_stats(spark, sf_dir, keep_key=True).select("order_key", "home_team", "away_team", "match_id",
                                                         F.col("match_report").alias("page_url"))

    df = (
        # The matches come last, so that their texts are not shuffled again by part.
        li.join(part, li.l_partkey == part.p_partkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
        .join(nation, F.col("s_nationkey") == F.col("s_nat"), "left")
    )
    of_order = F.col("l_orderkey") == F.col("order_key")
    if tasks:
        df, m = dealt(df, F.col("l_orderkey"), tasks), dealt(m, F.col("order_key"), tasks, "_m_of_")
        of_order = of_order & (F.col(f"{DEALT}{tasks}") == F.col(f"_m_of_{tasks}"))
    df = df.join(m.hint("merge"), of_order)
    where = [f"{DEALT}{tasks}"] if tasks else []
    ln, pk, ok, sk = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_orderkey"), F.col("l_suppkey")
    url = F.when(pk % 53 != 0, F.concat(F.lit(BASE_URL + X.PLAYER_URL_MARKER), _hex8(sk), F.lit("/"),
                                        F.replace(F.col("s_name"), F.lit("#"), F.lit("-"))))
    team = (F.when(ln == 7, F.concat(F.col("home_team"), F.lit(" Reserves")))
            .when(ln % 2 == 1, F.col("home_team")).otherwise(F.col("away_team")))
    position = F.concat(F.col("p_type"), F.when(pk % 4 == 0, F.lit(",MF")).when(pk % 4 == 1, F.lit(",DF"))
                        .otherwise(F.lit("")))
    age = (F.when(ok % 50 == 0, F.lit("0")).when(ok % 71 == 0, F.lit(None).cast("string"))
           .otherwise(F.concat((18 + sk % 20).cast("string"), F.lit("-"), F.lpad((pk % 365).cast("string"), 3, "0"))))

    def cnt(a, b, m_):
        return ((pk * a + ok * b + ln) % m_).cast("long")

    # URL and position are built once; the derived columns read them.
    df = df.withColumn("_url", url).withColumn("_position", position)
    url, position = F.col("_url"), F.col("_position")
    base = df.select(
        team.alias("team_name"),
        url.alias("player_url"),
        X.player_id_from_url(url).alias("player_id"),
        F.col("match_id"),
        X.split_code(F.coalesce(X.name_from_slug(url), F.col("s_name"))).alias("player"),
        F.when(ln <= 4, F.lit("Starter")).otherwise(F.lit("Sub")).alias("lineup_status"),
        F.when(sk % 17 != 0, F.col("s_nation")).alias("nationality"),
        position.alias("position"),
        age.alias("age"),
        (F.col("l_quantity").cast("long") + 40).alias("minutes"),
        cnt(1, 1, 4).alias("goals"),
        cnt(1, 2, 3).alias("assists"),
        cnt(2, 1, 5).alias("pens_made"),
        cnt(3, 1, 5).alias("pens_att"),
        cnt(1, 3, 6).alias("shots"),
        cnt(2, 3, 4).alias("shots_on_target"),
        cnt(3, 2, 4).alias("cards_yellow"),
        cnt(5, 1, 9).alias("cards_red"),
        cnt(1, 5, 4).alias("fouls"),
        cnt(5, 3, 4).alias("fouled"),
        cnt(2, 5, 3).alias("offsides"),
        cnt(3, 5, 7).alias("crosses"),
        cnt(7, 1, 5).alias("tackles_won"),
        cnt(1, 7, 5).alias("interceptions"),
        cnt(7, 3, 11).alias("own_goals"),
        cnt(3, 7, 6).alias("pens_won"),
        cnt(7, 5, 8).alias("penalties_conceded"),
        X.primary_position(position).alias("primary_position"),
        ln.alias("_line"),
        pk.alias("_pk"),
        ok.alias("_ok"),
        F.col("order_key"),
        F.col("page_url"),
        *where,
    )
    outfield = base
    kpk, kok = F.col("_pk"), F.col("_ok")
    # Keeper cells are captured as text; an empty cell is coerced to 0 by the merge.
    keeper = base.filter(F.col("_line") == 1).select(
        "team_name", "player_url", "player_id", "match_id", "player", "lineup_status", "nationality",
        (kpk % 9).cast("string").alias("gk_shots_on_target_against"),
        (kok % 4).cast("string").alias("gk_goals_against"),
        (kpk % 7).cast("string").alias("gk_saves"),
        F.when(kpk % 9 != 0, ((kpk % 7) * 10).cast("string")).otherwise(F.lit("")).alias("gk_save_pct"),
        "_line", "order_key", "page_url", *where,
    )
    return outfield, keeper


def player_match_stats(spark: SparkSession, sf_dir: str, by_match: bool = False) -> DataFrame:
    """Stored player table: outfield rows with keeper stats merged.
    ``by_match`` leaves the rows dealt by match, with the columns that say so."""
    outfield, keeper = player_capture(spark, sf_dir)
    merged = keeper_merge(outfield, keeper, player_tasks(spark, sf_dir), by_match)
    return merged.select(*PLAYER_COLUMNS, *[c for c in merged.columns if c not in PLAYER_COLUMNS])


def player_tasks(spark: SparkSession, sf_dir: str) -> int:
    """Tasks for a shuffle of the player rows, one of each lineitem."""
    return tasks_for(spark, read_table(spark, sf_dir, "lineitem").count())


def side_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """Tasks for a shuffle of the matches' sides, two of each order; None, which
    lets Spark join small tasks, where one task could take them all."""
    rows = 2 * read_table(spark, sf_dir, "orders").count()
    return tasks_for(spark, rows) if rows > TASK_ROWS else None


__all__ = [
    "BASE_URL",
    "GK_COLUMNS",
    "match_stats",
    "player_capture",
    "player_match_stats",
    "player_tasks",
    "read_table",
    "schedule_capture",
    "side_tasks",
]
