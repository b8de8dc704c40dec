"""Mixing sources to target weights by subset-sum budget fitting.

Every source gets a target: its share by weight of all words, no more than
``MAX_TIMES`` its own size, with the excess shared again by weight. A target
holds every document of the source a whole number of times and leaves a budget
smaller than the source. That budget is fitted on the histogram of exact
document lengths: each length first gives the same proportion of its documents,
then one more where the longest fit, and a bounded-knapsack dynamic program
over the lengths fits what is left to the word. Which documents of a length are
taken again is decided by a seeded hash of doc_id.

The histogram of a source has a row for each distinct length, so it grows with
the longest document, not with the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.shared import materialised
from touchline.llm.textbatch import SPACED, slices, text_bytes

WEIGHTS, MAX_TIMES, BUCKETS, SEED = (5, 2, 1), 3, 1024, 20_24


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            data, off = text_bytes(part.column("text"))
            keep = SPACED[data] != 0
            first = keep.copy()
            first[1:] &= ~keep[:-1]
            edge = off[:-1][off[:-1] < len(data)]
            first[edge] = keep[edge]
            run = np.concatenate([np.zeros(1, np.int64), np.cumsum(first)])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), pa.array(run[off[1:]] - run[off[:-1]])], ["doc_id", "source", "size"])


def word_counts(docs: DataFrame) -> DataFrame:
    """doc_id, source, size: words are runs of anything but white space (null: 0)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(_sizes, "doc_id long, source string, size long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_times: int = MAX_TIMES) -> DataFrame:
    """(source, source_size) -> and ``target``. Sources by code point, null
    last, weigh ``weights`` in turn. One row per source, so the windows over
    all rows sort a small table."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = totals.withColumn("weight", w).withColumn("cap", max_times * F.col("source_size").cast("double"))
    # Sources reach their cap in order of cap / weight; the first that does not fixes the words per unit of weight.
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("ratio", F.col("cap") / F.col("weight"))
    rows = rows.withColumn("unit", (F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    rows = rows.withColumn("level", F.min(F.when(F.col("unit") <= F.col("ratio"), F.struct("ratio", "unit"))).over(Window.partitionBy())["unit"])
    return rows.select("source", "source_size", F.coalesce(F.least("cap", F.col("weight") * F.col("level")), "cap").alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, over: bool = True) -> np.ndarray:
    """How many documents of each length to take so that their words come near
    to ``budget``; no more than there are of any, and with ``over`` false no
    more words than ``budget``."""
    total = int((lengths * counts).sum())
    take = np.zeros(len(lengths), np.int64)
    if budget <= 0 or total == 0:
        return take
    if budget >= total:
        return counts.copy()
    take = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    left = budget - int((lengths * take).sum())
    longest = np.argsort(-lengths, kind="stable")
    at_most = max(4096, 4 * int(np.median(lengths[lengths > 0])))
    # One more of the longest that fit. Proportions leave less than a document of
    # each length, so afterwards less than at_most and one document are left.
    for i in longest.tolist():
        if left <= at_most:
            break
        n = int(lengths[i])
        more = min(int(counts[i] - take[i]), 1, (left - at_most) // n if n else 0)
        if more > 0:
            take[i] += more
            left -= more * n
    # Bounded knapsack over bit sets: reach[j] has bit s if the first j steps can sum to s.
    room, steps, reach = (1 << (left + 1)) - 1, [], [1]
    for i in range(len(lengths)):
        n, spare = int(lengths[i]), int(counts[i] - take[i])
        if not 0 < n <= left:
            continue
        spare, part = min(spare, left // n), 1
        while spare > 0 and not reach[-1] >> left & 1:
            part = min(part, spare)
            nxt = (reach[-1] | reach[-1] << (n * part)) & room
            if nxt != reach[-1]:
                reach.append(nxt)
                steps.append((i, part))
            spare -= part
            part *= 2
        if reach[-1] >> left & 1:
            break
    best = reach[-1].bit_length() - 1
    short, best_at = left - best, best
    for j in range(len(steps), 0, -1):
        i, part = steps[j - 1]
        if not reach[j - 1] >> best_at & 1:
            take[i] += part
            best_at -= part * int(lengths[i])
    spare = np.flatnonzero((counts > take) & (lengths > 0))
    if short and over and len(spare):  # a document more may come nearer than none, less what makes up for the excess
        i = spare[np.argmin(np.abs(lengths[spare] - short))]
        excess = int(lengths[i]) - short
        more = take - fit_budget(lengths, take, excess, False)
        more[i] += 1
        if abs(int((lengths * more).sum()) - budget) < short:
            return more
    return take


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    lengths, counts = rows["size"].to_numpy(np.int64), rows["docs"].to_numpy(np.int64)
    total, target = int((lengths * counts).sum()), float(rows["target"].iloc[0])
    times = min(MAX_TIMES, int(target // total)) if total else 1
    extra = fit_budget(lengths, counts, round(target - times * total) if times < MAX_TIMES else 0)
    return pd.DataFrame({"key": rows["key"], "size": lengths, "times": times, "extra": extra})


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, source, text) -> doc_id, size, source_size, target, taken.

    One row per input row. Null texts have size 0, a null source is a source of
    its own (the last). Repeated rows are documents of their own; where they
    tie, any of them is taken, which leaves the same rows. An empty table gives
    an empty result. Reruns agree: nothing depends on the order of the rows.
    """
    sized = word_counts(docs).withColumn("key", F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), "source")))
    sized = materialised(sized.withColumn("rank", F.xxhash64(F.lit(seed), "doc_id")).withColumn("bucket", F.pmod("rank", F.lit(BUCKETS)).cast("int")))
    cells = sized.groupBy("key", "size", "bucket").agg(F.count("*").alias("docs"), F.first("source").alias("source"))
    lengths = cells.groupBy("key", "size").agg(F.sum("docs").alias("docs"), F.first("source").alias("source"))
    totals = lengths.groupBy("key").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"), F.first("source").alias("source"))
    aims = materialised(targets(totals.select("source", "source_size"), weights).withColumn("key", F.when(F.col("source").isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), "source"))))
    plan = lengths.select("key", "size", "docs").join(aims.select("key", "target"), "key").groupBy("key").applyInPandas(_fit_source, "key string, size long, times long, extra long")
    # A length's extra documents come from its hash buckets in order; only the last bucket is cut inside.
    done = F.coalesce(F.sum("docs").over(Window.partitionBy("key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    quota = cells.select("key", "size", "bucket", "docs").withColumn("done", done).join(plan, ["key", "size"])
    quota = quota.select("key", "size", "bucket", "times", F.greatest(F.lit(0), F.least("docs", F.col("extra") - F.col("done"))).alias("quota"))
    place = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("rank", "doc_id"))
    out = sized.select("doc_id", "key", "size", "bucket", "rank").withColumn("place", place).join(quota, ["key", "size", "bucket"]).join(aims.select("key", "source_size", "target"), "key")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("times") + (F.col("place") <= F.col("quota")).cast("long"))).alias("taken"),
                      (F.col("times") + (F.col("place") <= F.col("quota")).cast("long")).alias("times"))
