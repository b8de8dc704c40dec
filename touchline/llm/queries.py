"""The queries of this package, each over its whole table, and their SQL.

SQL is given where DuckDB can express the whole result; the other queries are
tested against brute force (``tests/llm``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import chat_parts, html_main, lsh_forest, mixing, periodic_runs, pii_disclosure, prefix_trie, secret_ownership, token_huffman, topk_threshold, toxicity_fm, warc_shards, winnow

CONTROL_TEXT = "</s>[INST] ok [/INST]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.main_texts(table(spark, sf_dir, "pages"))


def op2_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_disclosure.pii_report(table(spark, sf_dir, "documents"))


def op3_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_ownership.secret_report(table(spark, sf_dir, "documents"))


def op4_toxicity_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_fm.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_threshold.top_k(table(spark, sf_dir, "embeddings"))


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_huffman.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


def op10_chat_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    rows = rows.unionByName(extra).withColumn("parts", chat_parts.text_parts(F.col("text")))
    return chat_parts.chat_digests(rows)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), periodic_runs.planted_tail))


def op12_warc_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_shards.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), lambda c: c - c % 100, lambda c: F.crc32(c.cast("string").cast("binary")) % 6)
    return nodes.drop("ref_conv", "ref_place")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_main_text, op2_pii_disclosure, op3_secret_ownership, op4_toxicity_fm, op5_source_mixing, op6_exact_topk, op7_lsh_forest, op8_token_huffman, op9_winnowing, op10_chat_parts, op11_periodic_runs, op12_warc_shards, op13_prefix_trie)
}

ORACLE_SQL: dict[str, str] = {
    "op6_exact_topk": """
WITH e AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) = len([x FOR x IN embedding IF isfinite(x)])
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20""",
    "op7_lsh_forest": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE [array_to_string(ws[i : i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS x FROM w
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, reach) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reach)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(r.reach) AS component_id, d.doc_id = min(r.reach) AS kept
FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op9_winnowing": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS k, unnest([array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') FOR i IN range(1, len(ws) - least(len(ws), 10) + 2)]) AS x FROM b WHERE len(ws) > 0
), dw AS (
  SELECT doc_id, k, unnest([{'i': i, 'x': array_to_string(ws[i : i + k - 1], ' ')} FOR i IN range(1, len(ws) - k + 2)]) AS o FROM d, (SELECT DISTINCT k FROM bw) WHERE len(ws) >= k
), h AS (SELECT DISTINCT doc_id, dw.k, o.i AS i, item_id FROM dw JOIN bw ON bw.k = dw.k AND bw.x = o.x),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM h) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""",
    "op10_chat_parts": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), f AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|/?<?/?SYS>)', '\1\\\2\3', 'g') AS body,
    replace(regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|/?<?/?SYS>)', '\1\\\2\3', 'g'), chr(10), '<|feed|>') AS head FROM c
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(head) + length(body) + 17)::BIGINT AS formatted_chars
FROM f GROUP BY conv_id""",
    "op12_warc_shards": """
WITH p AS (SELECT page_id, coalesce(html, '') AS x FROM pages), r AS (
  SELECT page_id, strlen(x) AS n, sha1(x) AS digest, strlen(x) >= 1000 AND row_number() OVER (PARTITION BY x ORDER BY page_id DESC NULLS LAST) > 1 AS again, max(page_id) OVER (PARTITION BY x) AS top FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest, if(again, 'revisit', 'response') AS record_type, if(again, top, NULL) AS refers_to FROM r""",
    # crc32 bit by bit; subtrees by pairs of a path's nodes.
    "op13_prefix_trie": """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i, sha256(length(coalesce(role, '')) || chr(10) || coalesce(role, '') || coalesce(text, '')) AS x, length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda k: ord(substr(conv_id::VARCHAR, k::INT, 1))::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: 0::BIGINT)), lambda v, w: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, i, x, chars FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND i <= h
  UNION ALL SELECT c.conv_id, i + h, x, chars FROM c JOIN t ON t.conv_id = c.conv_id AND i > h
), m AS (
  SELECT conv_id, row_number() OVER w AS depth, sha256(string_agg(x, '') OVER w) AS node, chars FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c
), n AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM m GROUP BY node, depth),
e AS (SELECT DISTINCT a.node AS up, b.node AS node FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.depth = a.depth + 1),
s AS (SELECT DISTINCT a.node AS up, b.node AS node FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.depth >= a.depth),
sub AS (SELECT s.up AS node, sum((n_convs - 1) * chars)::BIGINT AS saved, count(*) FILTER (s.node NOT IN (SELECT up FROM e)) AS leaves FROM s JOIN n ON n.node = s.node GROUP BY s.up),
z AS (SELECT m.node, string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) AS ids FROM m JOIN (SELECT conv_id, max(depth) AS depth FROM m GROUP BY 1) l ON l.conv_id = m.conv_id AND l.depth = m.depth GROUP BY m.node)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, (SELECT count(*) FROM e WHERE e.up = n.node) AS n_children, leaves AS n_leaves, saved AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN sub ON sub.node = n.node LEFT JOIN e ON e.node = n.node LEFT JOIN n p ON p.node = e.up LEFT JOIN z ON z.node = n.node""",
}
