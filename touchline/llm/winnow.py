"""Benchmark passages in documents, found by winnowing.

Of every ``window - K + 1`` consecutive K-word hashes the (rightmost) least one
is kept, on both sides. A shared run of ``window`` words holds one such stretch
whole, and the choice depends on nothing outside it, so both sides keep the
same hash: no shared run of that length can be missed. Equal fingerprints are
joined, and each pair of a document and an item found so is extended to all
words that occurrences of the item's windows cover.

Items of fewer words than a window are one window of their own. No fingerprint
is sure to be kept inside them, so for their lengths every run of the document
is looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import bitmap, materialised, may_hold, salted_join
from touchline.llm.textbatch import ALNUM, Hasher, doc_index, grams, list_column, signed, slices, text_bytes

K = 5
_U = np.uint64


def winnowed(g: np.ndarray, goff: np.ndarray, size: int) -> np.ndarray:
    """Indices of the hashes kept: the rightmost least of any ``size`` in a row."""
    count = np.maximum(np.diff(goff) - size + 1, 0)
    if not count.sum():
        return np.empty(0, np.int64)
    n = len(g) - size + 1
    least, at = g[:n].copy(), np.zeros(n, np.int8)
    for j in range(1, size):
        x = g[j : j + n]
        lower = x <= least
        np.copyto(least, x, where=lower)
        at[lower] = j
    run = np.cumsum(count)
    valid = np.repeat(goff[:-1] - np.concatenate([np.zeros(1, np.int64), run[:-1]]), count) + np.arange(run[-1])
    kept = np.zeros(len(g), bool)
    kept[valid + at[valid]] = True
    return np.flatnonzero(kept)


def _item_rows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(ALNUM)
        for batch in batches:
            for part in slices(batch, "text"):
                h, off, _ = hasher.words(*text_bytes(part.column("text")))
                g, goff, _ = grams(h, off, K)
                kept = winnowed(g, goff, window - K + 1)
                doc = doc_index(goff)[kept] if len(kept) else np.empty(0, np.int64)
                prints, short = [], []
                for d in range(len(part)):
                    n = off[d + 1] - off[d]
                    short.append(n < window)
                    if n >= window:
                        prints.append(signed(g[kept[doc == d]]).tolist())
                    elif n:
                        prints.append(signed(grams(h[off[d] : off[d + 1]], np.array([0, n]), min(K, n))[0][:1]).tolist())
                    else:
                        prints.append([])
                yield pa.RecordBatch.from_arrays(
                    [part.column("item_id"), pa.array(np.diff(off)), list_column(signed(h), off, pa.int64()), pa.array(prints, pa.list_(pa.int64())), pa.array(short, pa.bool_())],
                    ["item_id", "n", "words", "prints", "short"])

    return run


def _doc_rows(window: int, bits: np.ndarray, short_bits: np.ndarray, short_sizes: list[int]):
    """n_words of every document; for those with a fingerprint that an item may
    have, these fingerprints and the word hashes as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(ALNUM)
        for batch in batches:
            for part in slices(batch, "text"):
                h, off, _ = hasher.words(*text_bytes(part.column("text")))
                g, goff, _ = grams(h, off, K)
                kept = winnowed(g, goff, window - K + 1)
                kept = kept[may_hold(bits, g[kept])]
                owner, prints = [doc_index(goff)[kept]] if len(kept) else [], [g[kept]] if len(kept) else []
                for k in short_sizes:
                    gk, ok, _ = (g, goff, None) if k == K else grams(h, off, k)
                    hit = np.flatnonzero(may_hold(short_bits, gk))
                    owner.append(doc_index(ok)[hit])
                    prints.append(gk[hit])
                n = len(part)
                if owner:
                    o, p = np.concatenate(owner), np.concatenate(prints)
                    order = np.lexsort((p, o))
                    o, p = o[order], p[order]
                    new = np.ones(len(o), bool)
                    new[1:] = (o[1:] != o[:-1]) | (p[1:] != p[:-1])
                    o, p = o[new], p[new]
                else:
                    o, p = np.empty(0, np.int64), np.empty(0, _U)
                per = np.bincount(o, minlength=n)
                own = np.where(per > 0, np.diff(off), 0)
                words = h[np.repeat(per > 0, np.diff(off))] if len(h) else h
                ends = lambda c: np.concatenate([np.zeros(1, np.int64), np.cumsum(c)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(off)), list_column(signed(p), ends(per), pa.int64()), list_column(signed(words), ends(own), pa.int64())],
                    ["doc_id", "n_words", "prints", "words"])

    return run


def _extended(window: int):
    """(row, words, items) -> words hit and items that occur, by exact windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hits, names, counts = [], [], [], []
            for i in range(batch.num_rows):
                h = batch.column("words")[i].values.to_numpy().view(_U)
                off = np.array([0, len(h)])
                edge = np.zeros(len(h) + 1, np.int64)
                found, cache = set(), {}
                for item in batch.column("items")[i].values.to_pylist():
                    w = np.array(item["words"], np.int64).view(_U)
                    k = min(window, len(w))
                    if k not in cache:
                        cache[k] = grams(h, off, k)[0]
                    at = np.flatnonzero(np.isin(cache[k], grams(w, np.array([0, len(w)]), k)[0]))
                    if len(at):
                        edge[at] += 1
                        edge[at + k] -= 1
                        if item["item_id"] is not None:
                            found.add(str(item["item_id"]))
                rows.append(batch.column("row")[i].as_py())
                hits.append(int((np.cumsum(edge[:-1]) > 0).sum()))
                names.append(",".join(sorted(found)))
                counts.append(len(found))
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(hits, pa.int64()), pa.array(counts, pa.int64()), pa.array(names, pa.string())], ["row", "n_hit", "n_items", "items"])

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """``docs`` (doc_id, text), ``benchmark`` (item_id, text) -> doc_id,
    n_words, n_hit, n_items, items_sha256, contaminated, items.

    One row per input row, repeated ones too; an empty table gives an empty
    result, an empty benchmark no hits. Null and empty texts have no
    words; texts of any length are read whole; items without words match nothing. Repeated items count once by id;
    an item without an id marks words but is not listed. ``items`` are the
    item_ids as strings, sorted by code point and joined with commas.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.mapInArrow(_item_rows(window), "item_id string, n long, words array<long>, prints array<long>, short boolean")
    items = materialised(items.where("n > 0").dropDuplicates(["item_id", "words"]).withColumn("item", F.monotonically_increasing_id()))
    item_prints = items.select("item", "short", "n", F.explode("prints").alias("print"))
    bits = bitmap(item_prints.where("not short"), "print")
    short_bits = bitmap(item_prints.where("short"), "print")
    sizes = [r[0] for r in items.where("short").select(F.least(F.lit(K), "n").cast("int")).distinct().collect()]  # at most K values
    rows = docs.mapInArrow(_doc_rows(window, bits, short_bits, sorted(sizes)), "doc_id long, n_words long, prints array<long>, words array<long>")
    rows = materialised(rows.withColumn("row", F.monotonically_increasing_id()))
    doc_prints = rows.where("size(prints) > 0").select("row", F.explode("prints").alias("print"))
    # A passage that most documents share is one print and one item: both joins deal such out.
    pairs = materialised(salted_join(doc_prints, item_prints.select("item", "print").distinct(), "print", "row").select("row", "item").distinct())
    listed = salted_join(pairs, items.select("item", "item_id", "words"), "item", "row").groupBy("row").agg(F.collect_list(F.struct("item_id", "words")).alias("items"))
    hits = rows.where("size(prints) > 0").select("row", "words").join(listed, "row").mapInArrow(_extended(window), "row long, n_hit long, n_items long, items string")
    out = rows.select("row", "doc_id", "n_words").join(hits, "row", "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("items", F.lit("")).alias("items"))
