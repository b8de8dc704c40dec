"""Session helpers.

Library code never changes session settings that a cluster owns; the only
exception is ``spark.checkpoint.dir``-style locations, which are read from the
session and only filled in where they are unset (local tests).
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
TASK_ROWS = 100_000  # wide rows that one task sorts and groups


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "touchline") -> SparkSession:
    """Session for tests / bench on one machine. A cluster passes its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables and lineage cuts.

    The cluster's ``spark.checkpoint.dir`` where it is set. Where it is unset,
    a local session (tests) uses a folder of its warehouse; any other session
    gets an error, as its executors may share no folder.
    """
    current = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a reliable (shared) target."""
    path = checkpoint_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A new location for an intermediate table; concurrent jobs never share one."""
    return f"{checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a finished job's intermediate table, on whatever store it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Tasks for a shuffle of so many wide rows: the session's number, or more
    where a task would get more than ``TASK_ROWS``, so that its memory does not
    grow with the input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / TASK_ROWS))


def drop_shuffles(spark: SparkSession) -> None:
    """Shuffles of finished jobs are read no more. Spark deletes their files when
    the driver's JVM collects their handles, which it is asked to do at once."""
    spark._jvm.System.gc()


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a new intermediate table in the shared folder: computed once,
    and readers take the columns they need. The shuffles behind it are dropped."""
    path = scratch_table_path(df.sparkSession, name)
    df.write.parquet(path)
    drop_shuffles(df.sparkSession)
    return df.sparkSession.read.parquet(path)


def drop_table(table: DataFrame) -> None:
    """Delete the files of a ``written_once`` table that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        drop_path(table.sparkSession, folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder (reliable checkpoint).

    A lost executor's share is read from the files again instead of being
    recomputed. Checkpointed rows are in row format; a wide table of which
    consumers read few columns is better written as Parquet.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
