"""op6 against brute force, and the pipeline stage by stage."""

import math
import random

import pytest
from pyspark.sql import functions as F

from touchline.llm import topk_threshold

from . import helpers as H

SMALL = "/root/testdata/sf0.001"


def brute(rows, k=20):
    seen = {(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q, a in seen:
        if q % 20 == 0:
            best = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in seen if i != q))[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk_threshold, "QUERY_BLOCK", block)
    monkeypatch.setattr(topk_threshold, "VECTOR_BLOCK", block * 3)
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(150)]
    rows += [(i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0]) for i in range(200, 260)]  # copies: ties to the smaller id
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")]), (303, [float("inf")]), (None, [1.0]), (304, [0.9]), (305, []), (7, rows[7][1]), (320, [1e6, -1e6, 0.0, 0.0, 0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS rank", "'x' AS cid", "'x' AS vec")
    got = {tuple(r) for r in topk_threshold.top_k(df).collect()}
    assert got == brute(rows)


def test_top_k_of_ids_with_several_vectors(spark, monkeypatch):
    """Such an id is left out whole for its own queries, however many vectors it has."""
    monkeypatch.setattr(topk_threshold, "QUERY_BLOCK", 16)
    monkeypatch.setattr(topk_threshold, "VECTOR_BLOCK", 32)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(120)]
    rows += [(40, [rng.gauss(0, 3) for _ in range(4)]) for _ in range(30)] + [(41, [rng.gauss(0, 2) for _ in range(4)]) for _ in range(25)]
    rows += [(i, [1.0, 1.0, 0.0, 0.0]) for i in range(1000, 1400)]  # one vector of most queries
    got = [tuple(r) for r in topk_threshold.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    want = brute(rows)
    assert set(got) == want and len(got) == len({(q, tuple(math.floor(64 * x) for x in v)) for q, v in rows if q % 20 == 0}) * 20


def test_top_k_few(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(20, [1.0, 2.0]), (3, [0.5, 1.0]), (4, [-1.0, 0.0])]
    assert {tuple(r) for r in topk_threshold.top_k(spark.createDataFrame(rows, schema)).collect()} == brute(rows)
    assert topk_threshold.top_k(spark.createDataFrame([], schema)).count() == 0
    assert topk_threshold.top_k(spark.createDataFrame(rows[:1], schema)).count() == 0


def test_stages(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    calm = p.toxicity(spark, docs, SMALL)
    assert calm.columns == docs.columns and 0.5 * len(text) < calm.count() < len(text)
    one = p.near_dedup(spark, docs, SMALL)
    _, groups = H.near_groups(text)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == set(groups.values())
    clean = p.decontaminate(spark, docs, SMALL)
    hit = H.hits(text, bench)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {i for i, h in hit.items() if not h[1]}
    mixed = p.mix_sources(spark, docs, SMALL)
    taken = {r.doc_id: r.times for r in __import__("touchline.llm.mixing", fromlist=["mix"]).mix(docs).collect()}
    rows = [r.doc_id for r in mixed.collect()]
    assert mixed.columns == docs.columns and sorted(rows) == sorted(i for i, n in taken.items() for _ in range(n))


def test_stage_edges(spark):
    """Nulls in every column, empty tables, repeated rows, extra columns."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(20).selectExpr("*", "nullif('x', '') AS score", "nullif('x', '') AS component_id", "nullif(1, 0) AS times")
    odd = spark.createDataFrame([(None, None, None, None, None, None, None, None), (10**6, "", "", "", 0, "", "", 1), (10**6, "", "", "", 0, "", "", 1)], docs.schema)
    for _, stage in p.STAGES:
        out = stage(spark, docs.unionAll(odd), SMALL)
        assert out.count() > 0
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_rows_without_an_id(spark):
    """Each is judged by itself."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    passage = next(r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect() if r.text and len(r.text.split()) > 15)
    copy = " ".join(f"copied{i}" for i in range(60))
    texts = [passage, copy, copy, copy] + [" ".join(f"own{i}_{j}" for j in range(5 + i)) for i in range(40)]
    odd = spark.createDataFrame([(t,) for t in texts], "text string")
    odd = odd.select(*[F.col("text") if c == "text" else F.lit("zz").alias(c) if c == "source" else F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
    both = docs.unionByName(odd)
    left = lambda stage: [r.text for r in stage(spark, both, SMALL).collect() if r.doc_id is None]
    assert sorted(left(p.near_dedup)) == sorted(set(texts))
    assert sorted(left(p.decontaminate)) == sorted(texts[1:])


def test_run(spark):
    import corpus_pipeline as p

    rows = p.run(spark, SMALL).collect()
    start = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == start
        start += r.n_tokens
