"""Connected components by contraction.

Each round sends every node to the neighbour (or itself) of least hashed rank
and joins the edges to the new names, which shrinks any component by a constant
factor whatever its shape; duplicate edges fall away. Once the edges that are
left fit a fixed bound, one task finishes them by union-find. Both ways give
the same result; nothing is dropped. A hub or a component that holds most of
the rows is joined without a shuffle of its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.shared import materialised, small_join

FINISH_EDGES = 200_000


def _union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches if b.num_rows]
    if not parts:
        return
    a, b = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = list(range(len(nodes)))
    for x, y in zip(index[: len(a)].tolist(), index[len(a) :].tolist(), strict=True):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        while root[y] != y:
            root[y] = root[root[y]]
            y = root[y]
        if x != y:
            root[max(x, y)] = min(x, y)
    for x in range(len(root)):  # parents are smaller, so theirs are final
        root[x] = root[root[x]]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[np.array(root)])], ["node", "label"])


def connected_components(edges: DataFrame, finish_edges: int = FINISH_EDGES) -> DataFrame:
    """Edges (a, b) -> (node, component) for every node of an edge; component
    is the smallest node reachable. Self loops and repeats are allowed."""
    first = edges = materialised(edges.select("a", "b").where("a <> b").distinct())
    maps: list[DataFrame] = []
    while edges.count() > finish_edges:
        both = edges.union(edges.select("b", "a"))
        rank = lambda c: F.struct(F.xxhash64(F.lit(len(maps)), F.col(c)).alias("r"), F.col(c).alias("id"))
        step = both.groupBy(F.col("a").alias("node")).agg(F.min(rank("b")).alias("m"), F.first(rank("a")).alias("own"), F.count("*").alias("n"))
        step = materialised(step.select("node", F.least("m", "own")["id"].alias("label"), "n"))
        maps.append(step.select("node", "label"))
        named = small_join(edges, step.toDF("a", "la", "n"), "a", "n", written=True)
        named = small_join(named, step.toDF("b", "lb", "n"), "b", "n", written=True)
        edges = materialised(named.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).where("a <> b").distinct())
    last = edges.coalesce(1).mapInArrow(_union_find, "node long, label long")
    if not maps:
        return last.toDF("node", "component")
    maps.append(materialised(last))
    found = first.select(F.col("a").alias("node")).union(first.select("b")).distinct().withColumn("label", F.col("node"))
    for step in maps:
        found = materialised(found)
        sizes = found.groupBy("label").agg(F.count("*").alias("n"))
        names = sizes.join(step.toDF("label", "to"), "label", "left").select("label", F.coalesce("to", "label").alias("to"), "n")
        found = small_join(found, names, "label", "n").select("node", F.col("to").alias("label"))
    found = materialised(found)
    least = found.groupBy("label").agg(F.min("node").alias("component"), F.count("*").alias("n"))
    return small_join(found, least, "label", "n").select("node", "component")
