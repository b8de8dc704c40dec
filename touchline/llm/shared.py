"""Lineage cuts in the shared folder, and a bitmap filter of fixed size."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.session import checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; unset, a local session takes a
    folder of its warehouse and any other gets an error."""
    return checkpoint_dir(spark)


def materialised(df: DataFrame) -> DataFrame:
    """``df`` once, as a reliable checkpoint: later uses read its files, also
    after executors are lost."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


def small_join(rows: DataFrame, groups: DataFrame, key: str, size: str, how: str = "inner", written: bool = False) -> DataFrame:
    """``rows`` joined with ``groups`` (one row a ``key``, which stands for
    ``size`` rows), also where one key holds a third of all rows. The groups of
    more than a 256th part, 256 at most, are broadcast; only the rows of the
    others are shuffled. ``size`` is dropped; ``groups`` is read three times, and
    written first unless it is ``written`` already."""
    groups = groups if written else materialised(groups)
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = groups.where(F.col(size) > F.lit(total / 256)).drop(size)
    keys = F.broadcast(hot.select(key).withColumn("_hot", F.lit(True)))
    marked = rows.join(keys, key, "left")
    common = marked.where("_hot is null").drop("_hot").join(groups.where(F.col(size) <= F.lit(total / 256)).drop(size), key, how)
    return common.unionByName(marked.where("_hot").drop("_hot").join(F.broadcast(hot), key))


def salted_join(rows: DataFrame, others: DataFrame, key: str, by: str) -> DataFrame:
    """``rows`` joined with ``others``, both of which may have many rows of one
    ``key``. Where a key has more than a 256th part of ``rows`` (256 keys at
    most), these are dealt out by the hash of ``by`` over parts of that size,
    and the key's ``others`` are copied to each. ``rows`` is read three times."""
    part = rows.count() / 256
    hot = rows.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > F.lit(part))
    hot = F.broadcast(materialised(hot.select(key, F.ceil(F.col("n") / F.lit(part or 1.0)).cast("int").alias("_parts"))))
    dealt = rows.join(hot, key, "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"), F.lit(0))).drop("_parts")
    copied = others.join(hot, key, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return dealt.join(copied, [key, "_part"]).drop("_part")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete an intermediate table that nothing reads any more, on any store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bitmap(hashes: DataFrame, column: str, log2_bits: int = 23) -> np.ndarray:
    """A one-probe Bloom filter of a column of 64-bit hashes.

    Its size is fixed (2**log2_bits bits, 1 MB as it stands), so it can go to
    every task whatever the input. It only spares work: what passes is joined
    exactly, and a filter that is full lets everything through.
    """
    at = F.pmod(F.col(column), F.lit(1 << log2_bits))
    rows = (
        hashes.select(F.shiftright(at, 6).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(`{column}`, 64) as int))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    out = np.zeros(1 << (log2_bits - 6), np.int64)
    if rows.num_rows:
        out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return out


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (any 64-bit dtype) may be in the bitmap."""
    at = hashes.view(np.uint64) & np.uint64(len(bits) * 64 - 1)
    return (bits.view(np.uint64)[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0
