"""Small helpers that several operators of this folder share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space that separates words: space, tab, line feed, vertical tab, form feed, return.
BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"

#: A Python task works on about so many bytes of text at once, however large a batch is.
SLICE_BYTES = 4 << 20


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    Where executors have it elsewhere (installed, or shipped with --py-files), this changes nothing.
    """
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted column names, each with underscores added until no column has it."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def quoted(name: str) -> Column:
    """A top-level column, whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def present(df: DataFrame, name: str, kind: str) -> Column:
    """The column cast to its type, or null of that type where the table lacks it."""
    return quoted(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def words_of(text: Column) -> Column:
    """Words of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANK + "+"), "")


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that a slice holds about ``limit`` bytes of text, or one longer row."""
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        size = size or 0
        if held and held + size > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size + 1
    if start < len(sizes):
        yield batch.slice(start)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """The frame marked for broadcast if it holds at most ``max_rows`` rows, else as it is.

    Counting is a job; give a frame that is stored. Rows must be of bounded width.
    """
    few = df.select(F.lit(1)).limit(max_rows + 1).agg(F.count("*").alias("n")).first().n <= max_rows
    return F.broadcast(df) if few else df
