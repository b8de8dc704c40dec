"""Join keys without hot NULLs, and joins of which one key may hold most rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.session import written_once

PLAYER_SPREAD = ["player_id", "team_name", "position", "primary_position", "minutes"]  # of player rows: what most readers need
DEALT = "_of_"


def spread_null(df: DataFrame, column: str, by: list[str] | None = None) -> Column:
    """``column`` for the preserved side of an outer equi-join, with NULLs as
    values that match nothing (they start with NUL, as no id does).

    Rows with a NULL key find no partner either way, but left NULL they would
    all be shuffled into one partition. They are spread by the columns ``by``
    that ``df`` has (None: by all, which a reader of few columns then pays for).
    """
    some = [c for c in by or () if c in df.columns] or df.columns
    return F.coalesce(F.col(column), F.concat(F.lit("\u0000"), F.xxhash64(*some).cast("string")))


def dealt(df: DataFrame, key: Column, tasks: int, name: str = DEALT, small: list[str] | None = None) -> DataFrame:
    """``df`` shuffled to ``tasks`` tasks by ``key``, whose hash stays in a column
    (named ``name`` and ``tasks``). Joins and groups by that column and any
    others, of tables dealt alike, shuffle nothing again. The columns ``small``
    (whole numbers that mostly fit a byte) travel as bytes."""
    own = f"{name}{tasks}"
    keyed, longs = df.withColumn(own, F.hash(key)), [c for c, t in df.dtypes if c in (small or ()) and t == "bigint"]
    if not longs:
        return keyed.repartitionById(tasks, F.col(own))
    packed = keyed.select(*[c for c in keyed.columns if c not in longs], *_as_bytes(longs)).repartitionById(tasks, F.col(own))
    values = dict(zip(longs, _of_bytes(longs), strict=True))
    return packed.select(*[values.get(c, F.col(c)).alias(c) for c in keyed.columns])


def _as_bytes(columns: list[str]) -> list[Column]:
    """Eight columns a word, a byte each, 255 for NULL; of a row with any other
    number all columns as they are, in ``_longs``."""
    fits = reduce(and_, [F.coalesce(F.col(c), F.lit(0)).between(0, 254) for c in columns])
    words = [reduce(lambda x, y: x.bitwiseOR(y), [F.shiftleft(F.coalesce(F.col(c), F.lit(255)), 8 * i) for i, c in enumerate(columns[at : at + 8])]) for at in range(0, len(columns), 8)]
    return [*[w.alias(f"_word{i}") for i, w in enumerate(words)], F.when(~fits, F.struct(*columns)).alias("_longs")]


def _of_bytes(columns: list[str]) -> list[Column]:
    byte = lambda i: F.shiftrightunsigned(f"_word{i // 8}", 8 * (i % 8)).bitwiseAND(F.lit(255))
    return [F.when(F.col("_longs").isNotNull(), F.col("_longs")[c]).when(byte(i) != 255, byte(i)) for i, c in enumerate(columns)]


def dealt_to(df: DataFrame) -> int | None:
    """To how many tasks ``df`` is dealt; None where it has no column that says so."""
    return next((int(c.removeprefix(DEALT)) for c in df.columns if c.startswith(DEALT)), None)


def join_unique(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` with the columns of ``groups``, which has one row for each of their
    keys (NULLs are keys like others) and the number of its rows in ``size``.

    Groups of more than a 256th part of all rows, 256 at most, are broadcast;
    their rows are not shuffled, so no task gets a hot key. The groups are
    written once, as three steps read them.
    """
    groups = written_once(groups, "groups")
    total = groups.agg(F.sum(size)).first()[0] or 0
    struct = F.struct(*[F.col(c) for c in keys])
    g = groups.select(struct.alias("_jk"), *[c for c in groups.columns if c not in (*keys, size)], (F.col(size) > total / 256).alias("_hot"))
    hot, common = (g.filter(c).drop("_hot") for c in (F.col("_hot"), ~F.col("_hot")))
    keyed = rows.withColumn("_jk", struct)
    is_hot = keyed.join(F.broadcast(hot.select("_jk", F.lit(True).alias("_hot"))), "_jk", "left")
    out = is_hot.filter(F.col("_hot").isNull()).join(common, "_jk").unionByName(is_hot.filter("_hot").join(F.broadcast(hot), "_jk"))
    return out.drop("_jk", "_hot")
