"""Incremental ingest steps (R1-R11) as DataFrame operators.

The in-season refresh is expressed as set operations: the "which dates are
missing" question is an anti join, the "latest season" is an aggregate, and a
refresh replaces exactly one ``season_id`` partition.
"""

from __future__ import annotations

import datetime as _dt
import warnings

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from touchline.functions import text as X
from touchline.functions.ordering import asc
from touchline.operators.keys import DEALT, PLAYER_SPREAD, dealt, join_unique, spread_null
from touchline.schemas import GK_COLUMNS, PLAYER_COUNT_COLUMNS, SCHEDULE_REQUIRED
from touchline.session import written_once


def _player_key() -> Column:
    """``player_id`` as a plain join key: NULL is a value that no id has."""
    return F.coalesce(F.col("player_id"), F.lit("\u0000"))


# R1
def keeper_merge(outfield: DataFrame, keeper: DataFrame, tasks: int | None = None, by_match: bool = False) -> DataFrame:
    """Left-join keeper stats onto the outfield rows of the same match; others get 0.

    The merge stays within a match: ``match_id`` compares with plain equality,
    so rows without a match get 0 and never pair across matches. ``player_id``
    compares NULL-safe (a player without link still finds their keeper row).
    Keeper cells are coerced to double, non-numeric -> 0 (N10). When the keeper
    frame carries none of the keeper columns every row gets 0. ``tasks`` is the
    join's number of tasks (``session.tasks_for``; None: the session's).
    ``by_match`` deals the rows by their match alone and keeps its key
    (``_match``) and task, so that a later join by match shuffles them no more.
    """
    gk = [c for c in GK_COLUMNS if c in keeper.columns]
    keyed = outfield.withColumn("_match", spread_null(outfield, "match_id", PLAYER_SPREAD)).withColumn("_player", _player_key())
    if by_match:
        keyed = dealt(keyed, F.col("_match"), tasks, small=PLAYER_COUNT_COLUMNS)
    elif tasks and gk:
        keyed = keyed.repartition(tasks, "_match", "_player")
    out = [*outfield.columns, *(["_match", f"{DEALT}{tasks}"] if by_match else [])]
    if not gk:
        return keyed.select(*out, *[F.lit(0.0).alias(c) for c in GK_COLUMNS])
    k = keeper.select(F.col("match_id").alias("_k_match"), _player_key().alias("_k_player"), *gk)
    on = (keyed["_match"] == k["_k_match"]) & (keyed["_player"] == k["_k_player"])
    if by_match:
        k = dealt(k, F.col("_k_match"), tasks, "_k_of_")
        on = on & (keyed[f"{DEALT}{tasks}"] == k[f"_k_of_{tasks}"])
    joined = keyed.join(k, on, "left")
    gk_out = [(X.numeric_or_zero(c) if c in gk else F.lit(0.0)).alias(c) for c in GK_COLUMNS]
    return joined.select(*[keyed[c] for c in out], *gk_out)


# R2
def season_filter(df: DataFrame, season_id: str | None, col: str = "season_id") -> DataFrame:
    """Keep rows of one season (trimmed text equality); ``None`` keeps all."""
    if season_id is None:
        return df
    return df.filter(F.trim(F.col(col).cast("string")) == str(season_id).strip())


def season_filter_by(df: DataFrame, seasons: DataFrame, col: str = "season_id") -> DataFrame:
    """R2 with the seasons given as a (small) DataFrame: trimmed equality as a semi join."""
    s = seasons.select(F.trim(F.col("season_id").cast("string")).alias("_sf_season")).distinct()
    return df.filter(F.col(col).isNotNull()).join(s, F.trim(F.col(col).cast("string")) == F.col("_sf_season"),
                                                  "left_semi")


def _parse_param_date(value) -> _dt.date | None:
    """A date parameter in any layout that pandas reads; None if it reads none."""
    found = pd.to_datetime(value, errors="coerce")
    return None if pd.isna(found) else found.date()


# R3
def start_date_filter(df: DataFrame, start, col: str = "date") -> DataFrame:
    """Keep rows whose parsed date is on/after ``start``; ``None`` keeps all.

    A ``start`` that is no date keeps all rows as well, with a warning.
    """
    if start is None:
        return df
    d = _parse_param_date(start)
    if d is None:
        warnings.warn(f"start date {start!r} is no date; no rows are left out", stacklevel=2)
        return df
    return df.filter(X.try_parse_date(col) >= F.lit(d))


# R4
def sort_by_season_date(df: DataFrame, col: str = "date", tiebreak=()) -> DataFrame:
    """Order by (season, parsed date) with NULL dates last and explicit tie-breaks."""
    return df.orderBy(asc("season_id"), asc(X.try_parse_date(col)), *[asc(c) for c in tiebreak])


def positions(ordered: DataFrame, out: str = "position") -> DataFrame:
    """Number the rows of a globally sorted frame from 1, by an offset for each
    sorted partition. Written once as a table, so that numbers and offsets
    agree, also after an executor is lost; whoever reads few columns reads them
    alone. A run of equal keys of any length is spread over many tasks."""
    # The id holds the partition above bit 33 and the row's place in it below.
    rows = written_once(ordered.withColumn("_id", F.monotonically_increasing_id()), "positions")
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # A row for each partition of the sort: as many as there were tasks.
    return rows.withColumn("_part", part).join(F.broadcast(sizes), "_part").select(*ordered.columns, (F.col("_before") + place + 1).alias(out))


def numbered(df: DataFrame, keys: list[str], order: list, out: str) -> DataFrame:
    """``row_number() over (partition by keys order by order)`` where one key may
    hold any share of the rows: by range over (keys, order), a row's number is
    its position less the first one of its key."""
    by = [*map(asc, keys), *[asc(c) if isinstance(c, str) else c for c in order]]
    rows = positions(df.repartitionByRange(*by).sortWithinPartitions(*by), "_position")
    first = rows.groupBy(*keys).agg(F.min("_position").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    return join_unique(rows, first, keys, "_rows").withColumn(out, F.col("_position") - F.col("_first") + 1).drop("_position", "_first")


# R5
def work_list(matches: DataFrame, url_col: str = "match_url", date_col: str = "date") -> DataFrame:
    """Capture work list, kept flat: one row per (season, date, url).

    Rows whose notes mark a cancelled/awarded match and rows without URL are
    left out; groups (season, date) that end up empty therefore vanish, and a
    NULL date forms no group. ``url_seq`` numbers the URLs of a group in
    order, so a consumer can page through a date without collecting it.
    """
    notes = F.col("notes") if "notes" in matches.columns else F.lit(None).cast("string")
    keep = matches.filter(~X.notes_skip(notes) & F.col(url_col).isNotNull() & F.col(date_col).isNotNull())
    return numbered(keep.select("season_id", date_col, url_col), ["season_id", date_col], [url_col], "url_seq")


# R6
def season_parts(season_id_col="season_id"):
    sid = F.col(season_id_col) if isinstance(season_id_col, str) else season_id_col
    league = F.split_part(sid, F.lit("_"), F.lit(1)).try_cast("long")
    year = F.split_part(sid, F.lit("_"), F.lit(2)).try_cast("long")
    return league, year


def latest_season(df: DataFrame, col: str = "season_id") -> DataFrame:
    """The season with the greatest (league_id, year); one row (or none for empty input)."""
    league, year = season_parts(col)
    keyed = df.select(F.col(col).alias("season_id"), F.coalesce(league, F.lit(0)).alias("league_key"),
                      F.coalesce(year, F.lit(0)).alias("year_key"))
    return keyed.groupBy().agg(
        F.max_by("season_id", F.struct("league_key", "year_key", "season_id")).alias("season_id")
    ).filter(F.col("season_id").isNotNull())


# R7
def stored_dates(player_files: DataFrame, path_col: str = "path", season_col: str = "season_id") -> DataFrame:
    """(season_id, d) pairs already stored, from file names ``player_match_data_<season>_<date>.csv``."""
    d = X.date_from_player_filename("path", "season_id")
    files = player_files.select(F.col(season_col).alias("season_id"), F.col(path_col).alias("path")).distinct()  # a name is read once, however often it is listed
    return files.select("season_id", d.alias("d")).filter(F.col("d").isNotNull()).distinct()


def missing_dates(matches: DataFrame, stored: DataFrame, date_col: str = "date") -> DataFrame:
    """Match rows whose (season, date) is not stored yet (anti join); nothing stored -> all rows."""
    keyed = matches.withColumn("_d", F.date_format(X.try_parse_date(date_col), "yyyy-MM-dd"))
    s = stored.select(F.col("season_id").alias("_s_season"), F.col("d").alias("_s_d"))
    cond = (keyed["season_id"] == s["_s_season"]) & (keyed["_d"] == s["_s_d"])
    # Rows with a NULL key are never stored: they bypass the anti join (no hot NULL partition).
    has_key = F.col("season_id").isNotNull() & F.col("_d").isNotNull()
    return keyed.filter(has_key).join(s, cond, "left_anti").unionByName(keyed.filter(~has_key)).drop("_d")


def missing_date_list(matches: DataFrame, stored: DataFrame, date_col: str = "date") -> DataFrame:
    """Distinct missing dates per season (sorted by the consumer)."""
    dates = matches.select("season_id", F.col(date_col).alias("date")).filter(F.col("date").isNotNull()).distinct()
    return missing_dates(dates, stored, "date")  # few dates are looked up, not all their matches


# R8
def schedule_lookup(requested: DataFrame, season_files: DataFrame, consolidated: DataFrame | None = None,
                    base_url: str = "https://stats.example.org", league_names: DataFrame | None = None) -> DataFrame:
    """One schedule row per requested ``season_id``.

    Preference: first row in the per-season files (ordered by file, then row),
    then the consolidated table, else a row synthesised from the id
    (``<league>_<year>``) with the schedule URL built from ``base_url``.
    """
    def prep(df, prio):
        cols = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in SCHEDULE_REQUIRED]
        f = F.col("file_order").cast("long") if "file_order" in df.columns else F.lit(0).cast("long")
        r = F.col("row_order").cast("long") if "row_order" in df.columns else F.lit(0).cast("long")
        return df.select(*cols, F.lit(prio).alias("_prio"), f.alias("_file"), r.alias("_row"))

    cands = prep(season_files, 0)
    if consolidated is not None:
        cands = cands.unionByName(prep(consolidated, 1))
    cands = cands.filter(F.col("season_id").isNotNull())
    best = cands.groupBy("season_id").agg(
        F.min_by(F.struct(*[c for c in SCHEDULE_REQUIRED if c != "season_id"]),
                 F.struct("_prio", "_file", "_row")).alias("row"))
    req = requested.select("season_id").distinct()
    league = F.split_part(F.col("season_id"), F.lit("_"), F.lit(1))
    year = F.split_part(F.col("season_id"), F.lit("_"), F.lit(2))
    can_synth = F.col("season_id").contains("_")
    j = req.join(best, "season_id", "left")
    if league_names is not None:
        j = j.join(league_names.select(F.col("league_id").alias("_lid"), F.col("league_name").alias("_lname")),
                   league == F.col("_lid"), "left")
        lname = F.col("_lname")
    else:
        lname = F.lit(None).cast("string")
    found = F.col("row").isNotNull()
    out = j.select(
        F.when(found, F.col("row.league_id")).when(can_synth, league).alias("league_id"),
        F.when(found, F.col("row.league_name")).when(can_synth, lname).alias("league_name"),
        "season_id",
        F.when(found, F.col("row.season_name")).when(can_synth, F.concat(year, F.lit(" Season"))).alias("season_name"),
        F.when(found, F.col("row.url")).when(can_synth, F.concat(F.lit(base_url + "/en/comps/"), league, F.lit("/"), year,
                                                                 F.lit("/schedule/"))).alias("url"),
        F.when(found, F.lit("file")).when(can_synth, F.lit("synthesised")).alias("source"),
    )
    return out.filter(F.col("source").isNotNull())


# R9
def latest_date(matches: DataFrame, date_col: str = "date") -> DataFrame:
    """Most recent parsed match date of the latest season as ``yyyy-MM-dd`` (one row)."""
    latest = latest_season(matches)
    m = matches.join(latest, "season_id", "left_semi")
    return m.groupBy().agg(F.date_format(F.max(X.try_parse_date(date_col)), "yyyy-MM-dd").alias("latest_date"))


# R10
def overwrite_season(df: DataFrame, path: str, fmt: str = "parquet", partition_cols=("season_id",)) -> None:
    """Replace exactly the season partitions present in ``df``.

    Dynamic partition overwrite never touches other seasons, and an empty frame
    has no partition to replace, so an empty refresh writes nothing.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).format(fmt).save(path))


# R11 is a plain read of the partitioned table (see touchline.sources.csv_tables).
