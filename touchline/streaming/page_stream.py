"""Structured Streaming front end for captured pages.

The reference refreshes in batches; nothing in it needs streaming state. A
capture process that drops page files into a directory can still be consumed
incrementally: a file-source stream picks up new page files, each micro-batch
is extracted with the batch operators and replaces the seasons it holds (a
capture holds a season's whole schedule). The
checkpoint (in the shared ``spark.checkpoint.dir`` unless given) makes the
stream restartable after executor or driver loss; ``availableNow`` processes
what is there and stops, which is how a scheduled refresh would run it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from touchline.operators import extract as E
from touchline.operators import ingest as R
from touchline.session import checkpoint_dir

PAGE_SCHEMA = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
    T.StructField("season_id", T.StringType()),
])


def schedule_page_stream(spark: SparkSession, pages_dir: str, out_dir: str, checkpoint: str | None = None,
                         as_of=None, base_url: str = "", available_now: bool = True):
    """Stream schedule page files (parquet) -> extracted match rows, partitioned by season.

    Returns the started ``StreamingQuery``.
    """
    pages = spark.readStream.schema(PAGE_SCHEMA).parquet(pages_dir)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        # The latest capture of a season wins: a batch replaces the seasons it
        # holds, so neither a later capture nor a replay repeats a match.
        rows = E.schedule_rows(batch, as_of=as_of, base_url=base_url)
        R.overwrite_season(rows.select(*[c for c in rows.columns if not c.startswith("_")]), out_dir)

    ckpt = checkpoint or f"{checkpoint_dir(spark)}/streams/schedule_pages"
    w = pages.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
