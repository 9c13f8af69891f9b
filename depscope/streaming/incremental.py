"""A stored summary that follows the audit files, day by day.

Each batch of new files is summed up once and merged with what is stored of the days that it
touches. Other days are not read. Late events only mean that an old day is touched again, so
nothing has to be held back or dropped behind a watermark, and what a batch needs in memory does
not grow with the history.

``out/summary/batch=N/day=D`` holds all of day D as of batch N. A day counts as its latest batch
whose write is complete (Spark's ``_SUCCESS`` file), so readers see all of a batch or nothing. A
batch that is run again after a failure is left alone if it is complete, and else written
again from the batches before it: each line counts exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..model import SUMMARY_COLUMNS
from ..operators import audit
from ..session import discard, store

_SCHEMA = ", ".join(f"`{c}` {'bigint' if c == 'cnt' else 'string'}" for c in SUMMARY_COLUMNS)
#: Rows whose time could not be read have no day.
UNTIMED = "untimed"


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    place, fs = _file_system(spark, path)
    if not fs.exists(place):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(place))


def _complete_batches(spark: SparkSession, out: str) -> dict[int, list[str]]:
    """Days of each complete batch; the driver sees folder names only."""
    found = {}
    for name in _names(spark, f"{out}/summary"):
        if name.startswith("batch="):
            inside = _names(spark, f"{out}/summary/{name}")
            if "_SUCCESS" in inside:
                found[int(name.split("=")[1])] = [n.split("=", 1)[1] for n in inside if n.startswith("day=")]
    return found


def _folders_by_day(batches: dict[int, list[str]], out: str) -> dict[str, str]:
    return {day: f"{out}/summary/batch={n}/day={day}" for n in sorted(batches) for day in batches[n]}


def _read(spark: SparkSession, folders: list[str]) -> DataFrame:
    return spark.read.schema(_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], _SCHEMA)


def _day() -> Column:
    return F.when(F.col("window_start") == "", UNTIMED).otherwise(F.substring("window_start", 1, 10))


def merge_batch(spark: SparkSession, lines: DataFrame, batch_id: int, out: str, minutes: int = 30) -> None:
    """Merge one batch of audit lines into the stored days that it touches.

    The session of a stream's batch has no adaptive execution, so only the new lines are summed up
    there; the merge runs in ``spark``.
    """
    out = out.rstrip("/")
    batches = _complete_batches(spark, out)
    if batch_id in batches:
        return
    if batches and max(batches) > batch_id:
        raise ValueError(f"{out} holds batch {max(batches)}, so batch {batch_id} belongs to another stream")
    new = store(audit.summary(audit.events(lines), minutes), "new_summary")
    parts, known = _read(spark, list(new.inputFiles())), _folders_by_day(batches, out)
    days = [r.day for r in parts.select(_day().alias("day")).distinct().collect()]  # days of a calendar
    merged = audit.merge_summaries(parts, _read(spark, [known[d] for d in days if d in known]))
    (merged.withColumn("day", _day()).hint("rebalance", "day").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").partitionBy("day").parquet(f"{out}/summary/batch={batch_id}"))
    discard(new)


def update_summary(
    spark: SparkSession, files: str, out: str, minutes: int = 30, max_files: int = 1000
) -> StreamingQuery:
    """Start a run over the JSON-lines files that came since the last one; it ends by itself.

    The stream's checkpoint lies in ``out`` too, as its batch numbers and those of the stored
    days belong together. ``minutes`` must stay the same for one ``out``.
    """
    out = out.rstrip("/")
    lines = (
        spark.readStream.format("text").option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", True).load(files)
        .select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file")))
    return (
        lines.writeStream.foreachBatch(lambda batch, number: merge_batch(spark, batch, number, out, minutes))
        .option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start())


def current_summary(spark: SparkSession, out: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The summary as of the last complete batch; with bounds (``YYYY-MM-DD``), of those days.

    Only folders of the days asked for are read, nothing is merged.
    """
    out = out.rstrip("/")
    held = _folders_by_day(_complete_batches(spark, out), out)
    asked = [f for d, f in held.items() if (first is None or first <= d) and (last is None or d <= last)]
    return _read(spark, asked)


def vacuum_summary(spark: SparkSession, out: str) -> int:
    """Remove days that a later batch has replaced; returns how many. Not while others read."""
    out = out.rstrip("/")
    batches = _complete_batches(spark, out)
    current = set(_folders_by_day(batches, out).values())
    removed = 0
    for n, days in batches.items():
        old = [f"{out}/summary/batch={n}/day={d}" for d in days]
        old = [f for f in old if f not in current]
        for folder in old:
            place, fs = _file_system(spark, folder)
            fs.delete(place, True)
            removed += 1
        if len(old) == len(days) and n != max(batches):  # the latest is what a rerun is compared with
            place, fs = _file_system(spark, f"{out}/summary/batch={n}")
            fs.delete(place, True)
    return removed
