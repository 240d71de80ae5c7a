"""Incremental intake of log extracts with Structured Streaming.

The source re-reads whole extracts and re-runs every analysis. When extracts
land as new files, the cleaning step can run once per new file instead: a
file stream gives the names of new files only, each batch of them is read as
``read_log_csv`` reads extracts (so files may differ in their headers),
cleaned, and written as one directory of a parquet table partitioned by batch
and month. The batch queries then read that table (partition pruning on
``Month``). Progress is kept in the query's checkpoint location, so a
restarted or failed run picks up exactly the files it had not committed; a
batch that runs again replaces its own directory.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from faultline.config import LogSchema, Params
from faultline.operators.clean import clean
from faultline.sources.csv_log import read_log_csv


def stream_clean_log(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                     s: LogSchema | None = None, p: Params | None = None, header: Sequence[str] | None = None,
                     filter_po: bool = False, files_a_batch: int = 1_000, available_now: bool = True) -> StreamingQuery:
    """Start the intake stream; ``available_now`` processes what is there and
    stops. ``header``: the header of all files, where it is known."""
    s, p = s or LogSchema(), p or Params()

    def intake(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # files_a_batch names at most
        if paths:
            log = read_log_csv(batch.sparkSession, paths, names=header, null_tokens=p.null_tokens)
            (clean(log, s, p, filter_po=filter_po).write.mode("overwrite").partitionBy(s.month)
             .parquet(f"{sink_dir.rstrip('/')}/batch={number}"))

    # Only the path is read of each file, not its content.
    files = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", files_a_batch)
             .load(source_dir).select("path"))
    w = files.writeStream.foreachBatch(intake).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
