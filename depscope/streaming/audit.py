"""Audit files as they arrive: each file is read once, partial summaries add up.

The batch jobs work file by file and merge the partial results. Here the stream's
checkpoint remembers which files were read; every batch writes its own folder, so a
batch that is run again after a failure replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import audit


def ingest_new_files(
    spark: SparkSession, files: str, out: str, checkpoint: str, minutes: int = 30,
    max_files: int = 1000,
) -> StreamingQuery:
    """Start a run over the files that came since the last one; it ends by itself.

    ``files`` is a folder or glob of JSON-lines files. Events go to ``out/events`` and
    partial summaries to ``out/summary``, one folder per batch.
    """
    lines = (
        spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(files)
        .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        events_path = f"{out}/events/batch={batch_id}"
        audit.events(batch).write.mode("overwrite").parquet(events_path)
        stored = batch.sparkSession.read.parquet(events_path)
        audit.summary(stored, minutes).write.mode("overwrite").parquet(f"{out}/summary/batch={batch_id}")

    return (
        lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def merged_summary(spark: SparkSession, out: str) -> DataFrame:
    """The summary over all batches so far."""
    return audit.merge_summaries(spark.read.parquet(f"{out}/summary"))
