"""Exact top-k inner products by a three-phase uniform threshold.

A vector is cut into ``NODES`` slices. Each node holds one slice of all vectors
and knows only its part of a score; a score is the sum over the nodes.

1. Every node gives, for each query, its ``m`` highest parts and its least part,
   with m = k + 1 (k and the query's own vector; more for an id with several
   vectors). The exact scores of the
   vectors so named have an m-th value, which no result falls below: the cutoff.
2. With parts counted from the node's least one, a vector that reaches the
   cutoff reaches at least 1 / NODES of it at some node. Each node gives all
   vectors that do.
3. The scores of these vectors are computed exactly, and the highest kept.

Queries and vectors meet in blocks of fixed size, one task each. Equal vectors
form one class with its k + 1 smallest ids, as no other can be in a result,
so groups of copies cost no more than one vector.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.shared import materialised, salted_join

NODES, QUERY_BLOCK, VECTOR_BLOCK = 2, 1024, 4096


def _ranked(df: DataFrame, by: str, order: list[Column], most: int, own: str | None = None) -> DataFrame:
    """The first ``most`` rows of each key, fewer where column ``own`` says so;
    tasks cut their rows to ``most`` first."""
    df = df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(F.col("rank") <= most)
    return df.where(F.col("rank") <= F.col(own)) if own else df


def _matrix(column: pd.Series) -> np.ndarray:
    """Integer vectors of one length; doubles where all sums are exact in them."""
    return np.stack(column.to_numpy()).astype(np.int64)


def _product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    bound = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    return (q.astype(float) @ v.astype(float).T).astype(np.int64) if bound < 2**53 else q @ v.T


def _split(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    rows = rows.sort_values("cid")
    return rows[rows["is_query"]], rows[~rows["is_query"]]


def _local_lists(rows: pd.DataFrame) -> pd.DataFrame:
    q, v = _split(rows)
    if q.empty or v.empty:
        return pd.DataFrame({"node": [], "qid": [], "m": [], "cid": [], "part": [], "least": []})
    s = _product(_matrix(q["vec"]), _matrix(v["vec"]))
    m, out = q["m"].to_numpy(), []
    for most in np.unique(m):  # one value but for ids with several vectors
        own = np.flatnonzero(m == most)
        n = min(int(most), s.shape[1])
        best = np.argpartition(-s[own], n - 1, axis=1)[:, :n].ravel()
        at = np.repeat(own, n)
        out.append(pd.DataFrame({"node": rows["node"].iloc[0], "qid": q["cid"].to_numpy()[at], "m": most, "cid": v["cid"].to_numpy()[best], "part": s[at, best], "least": s[own].min(axis=1).repeat(n)}))
    return pd.concat(out)


def _above(rows: pd.DataFrame) -> pd.DataFrame:
    q, v = _split(rows)
    if q.empty or v.empty:
        return pd.DataFrame({"qb": [], "vb": [], "qid": [], "cid": []})
    s = _product(_matrix(q["vec"]), _matrix(v["vec"]))
    i, j = np.nonzero(s * NODES >= q["cut"].to_numpy()[:, None])
    return pd.DataFrame({"qb": rows["qb"].iloc[0], "vb": rows["vb"].iloc[0], "qid": q["cid"].to_numpy()[i], "cid": v["cid"].to_numpy()[j]})


def _resolved(rows: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
    q, v = _split(rows)
    if pairs.empty or q.empty or v.empty:
        return pd.DataFrame({"qid": [], "m": [], "cid": [], "score": []})
    pairs = pairs.drop_duplicates(["qid", "cid"])
    a, b = _matrix(q["vec"]), _matrix(v["vec"])
    i, j = np.searchsorted(q["cid"].to_numpy(), pairs["qid"].to_numpy()), np.searchsorted(v["cid"].to_numpy(), pairs["cid"].to_numpy())
    score = np.concatenate([np.einsum("ij,ij->i", a[i[x : x + 65536]], b[j[x : x + 65536]]) for x in range(0, len(i), 65536)])
    out = pd.DataFrame({"qid": pairs["qid"].to_numpy(), "m": q["m"].to_numpy()[i], "cid": pairs["cid"].to_numpy(), "score": score, "first": v["first"].to_numpy()[j]})
    out = out.sort_values(["qid", "score", "first"], ascending=[True, False, True])
    return out[out.groupby("qid").cumcount() < out["m"]][["qid", "m", "cid", "score"]]


def quantised(embeddings: DataFrame) -> DataFrame:
    """vec_id, vec: floor(64 * x) of every component; vectors that are null or
    hold null or non-finite components, and rows without an id, are left out."""
    e = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    e = e.where("vec_id is not null and embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))")
    return e.select("vec_id", F.expr("transform(embedding, x -> floor(64 * x))").alias("vec"))


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """``embeddings`` (vec_id, embedding) -> query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by ``every``; candidates all
    rows but those of the query's id. Repeated rows count once; rows of one id
    with different vectors are candidates each, and queries each. Shorter vectors count as padded
    with zeros. Scores are exact while they fit 64 bits. Ties go to the smaller
    vec_id; an empty table, or one without queries, gives an empty result.
    """
    rows = quantised(embeddings).distinct()
    dims = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    # A query's own id may stand among the best once for each of its vectors; every query has its own m.
    own = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg((F.count("*") + k).alias("m"))
    most = own.agg(F.max("m")).first()[0] or k + 1
    rows = rows.withColumn("vec", F.expr(f"concat(vec, array_repeat(0L, {dims} - size(vec)))"))
    few = _ranked(rows.withColumn("key", F.col("vec")), "key", [F.col("vec_id")], k + 1)
    classes = few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    classes = materialised(classes.withColumn("cid", F.monotonically_increasing_id()))
    asked = materialised(rows.where(F.col("vec_id") % every == 0).join(own, "vec_id"))
    asked = materialised(salted_join(asked, classes.select("vec", "cid"), "vec", "vec_id").select(F.col("vec_id").alias("query_id"), F.col("cid").alias("qid"), "m"))
    queries = asked.groupBy(F.col("qid").alias("cid")).agg(F.max("m").alias("m")).join(classes, "cid").select("cid", "vec", "m")
    n_q, n_v = max(1, math.ceil(queries.count() / QUERY_BLOCK)), max(1, math.ceil(classes.count() / VECTOR_BLOCK))
    # Blocks: queries go to all vector blocks, vectors to all query blocks.
    left = queries.select(F.lit(True).alias("is_query"), F.pmod(F.xxhash64("cid"), F.lit(n_q)).alias("qb"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_v - 1).cast("long"))).alias("vb"), "cid", "vec", F.col("cid").alias("first"), "m")
    right = classes.select(F.lit(False).alias("is_query"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))).alias("qb"), F.pmod(F.xxhash64("cid"), F.lit(n_v)).alias("vb"), "cid", "vec", F.col("ids")[0].alias("first"), F.lit(0).cast("long").alias("m"))
    grid = left.union(right)
    width = max(1, math.ceil(dims / NODES))
    sliced = grid.select("is_query", "qb", "vb", "cid", "m", F.explode(F.sequence(F.lit(0), F.lit(NODES - 1))).alias("node"), "vec")
    sliced = sliced.withColumn("vec", F.expr(f"slice(vec, node * {width} + 1, {width})"))
    # 1: local lists and the cutoff
    lists = sliced.groupBy("node", "qb", "vb").applyInPandas(_local_lists, "node int, qid long, m long, cid long, part long, least long")
    lists = materialised(lists)
    least = lists.groupBy("qid", "node").agg(F.min("least").alias("least"))
    named = lists.withColumn("key", F.struct("qid", "node"))
    named = _ranked(named, "key", [F.col("part").desc(), F.col("cid")], most, "m").select("qid", "cid").distinct()
    exact = named.join(classes.select("cid", "vec"), "cid").join(queries.toDF("qid", "asked", "m"), "qid")
    exact = exact.select("qid", "m", "cid", F.expr("aggregate(zip_with(vec, asked, (x, y) -> x * y), 0L, (a, x) -> a + x)").alias("score"))
    cutoff = _ranked(exact, "qid", [F.col("score").desc()], most, "m").groupBy("qid", "m").agg(F.min("score").alias("cutoff"), F.count("*").alias("n"))
    # Fewer named vectors than asked for are all there are; then nothing is cut.
    cut = least.join(cutoff, "qid").withColumn("all", F.sum("least").over(Window.partitionBy("qid")))
    cut = cut.select(F.col("qid").alias("cid"), "node", F.when(F.col("n") >= F.col("m"), F.col("least") * NODES + F.col("cutoff") - F.col("all")).alias("cut"))
    # 2: all vectors that reach their share at a node
    asking = sliced.where("is_query").join(cut, ["cid", "node"], "left").select("is_query", "qb", "vb", "cid", "node", "vec", F.coalesce("cut", F.lit(-(2**62))).alias("cut"))
    enough = asking.union(sliced.where("not is_query").select("is_query", "qb", "vb", "cid", "node", "vec", F.lit(0).cast("long")))
    pairs = enough.groupBy("node", "qb", "vb").applyInPandas(_above, "qb long, vb long, qid long, cid long")
    # 3: exact scores
    best = grid.groupBy("qb", "vb").cogroup(pairs.groupBy("qb", "vb")).applyInPandas(_resolved, "qid long, m long, cid long, score long")
    best = _ranked(best.join(classes.select("cid", F.col("ids")[0].alias("first")), "cid"), "qid", [F.col("score").desc(), F.col("first")], most, "m")
    ids = best.select("qid", "cid", "score").join(classes.select("cid", F.explode("ids").alias("vec_id")), "cid")
    ids = salted_join(asked.drop("m"), ids.select("qid", "vec_id", "score"), "qid", "query_id").where("query_id <> vec_id")
    out = _ranked(ids.withColumn("key", F.struct("query_id", "qid")), "key", [F.col("score").desc(), F.col("vec_id")], k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
