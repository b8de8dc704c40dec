"""A corpus from raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``. doc_id is taken as a key: rows that share one are
dropped, kept and repeated together. Each row without one is judged by itself.

Null texts count as empty, a null source is a source of its own, and other
columns pass through whatever they hold or are called. Texts of any length are
read whole. An empty table gives an empty result at every stage; without labels
every score is 0.5, which rejects nothing, and without a benchmark nothing is
contaminated. Of near copies the least doc_id stays; ties elsewhere leave the
same rows (see each operator).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import lsh_forest, mixing, token_huffman, toxicity_fm, winnow
from touchline.llm.queries import table, tokenizer_path
from touchline.llm.shared import drop_folder, materialised, new_folder

TOXIC = 0.7


def _keyed(docs: DataFrame) -> DataFrame:
    """key, row (a struct of all columns): doc_id, or where it is null a number
    above every doc_id, fixed by a checkpoint of these rows alone."""
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    top = ids.agg(F.max("id").alias("high"), F.count_if(F.col("id").isNull()).alias("nulls")).first()
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.struct("*").alias("row"))
    if not top["nulls"]:
        return rows
    own = F.lit(max(top["high"] or 0, 0) + 1).cast("long") + F.monotonically_increasing_id()
    return rows.where("key is not null").unionByName(materialised(rows.where("key is null").select(own.alias("key"), "row")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score, learned from ``labels``, is below ``TOXIC``."""
    plain = docs.select("doc_id", "text")
    scored = toxicity_fm.scored_rows(docs, toxicity_fm.train(plain, table(spark, sf_dir, "labels")))
    return scored.where(F.col("score") < TOXIC).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of least doc_id."""
    rows = _keyed(docs)
    copies = lsh_forest.near_duplicates(rows.select(F.col("key").alias("doc_id"), "row.text")).where("not kept").select(F.col("doc_id").alias("key")).distinct()
    return rows.join(copies, "key", "left_anti").select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with ``benchmark``."""
    rows = _keyed(docs)
    found = winnow.contamination(rows.select(F.col("key").alias("doc_id"), "row.text"), table(spark, sf_dir, "benchmark"))
    return rows.join(found.where("contaminated").select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, once for each time."""
    rows = _keyed(docs)
    times = mixing.mix(rows.select(F.col("key").alias("doc_id"), "row.source", "row.text")).groupBy(F.col("doc_id").alias("key")).agg(F.max("times").cast("int").alias("times")).where("times > 0")
    return rows.join(times, "key").select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token file of the corpus, read back: a row for each document in it."""
    return token_huffman.token_digests(docs, tokenizer_path())


STAGES = [("toxicity", toxicity), ("minhash_near_dedup", near_dedup), ("benchmark_decontamination", decontaminate), ("source_mixing", mix_sources), ("token_output", tokens)]

#: No SQL expresses the learned scores or the token file; tests/llm checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        if before:
            drop_folder(spark, before)
        docs, before = spark.read.parquet(folder), folder
    return docs
