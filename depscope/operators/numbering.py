"""Gapless places inside groups, in order, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import store


def place_in_group(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Append ``name``: 1, 2, 3 … within each ``group``, in ``order``.

    Rows are dealt to ranges of (group, order), so that a large group lies in several ranges one
    after the other. Each range numbers its own rows, and the rows of a group's earlier ranges
    are added: of those there is one count per group and range. Runs a job, which stores the
    ranges: they must stay as they are for the numbers to hold. ``order`` has to tell the rows
    of a group apart, else tied rows may change places.
    """
    inner, rows, earlier = "_range", "_rows", "_earlier"
    ranged = store(df.repartitionByRange(*group, *order).withColumn(inner, F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(inner, *group).agg(F.count("*").alias(rows))
    before = Window.partitionBy(*group).orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(inner).alias("_of"), *(F.col(c).alias(f"_of_{c}") for c in group),
        F.coalesce(F.sum(rows).over(before), F.lit(0)).alias(earlier))
    same = F.col(inner) == F.col("_of")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    inside = F.row_number().over(Window.partitionBy(inner, *group).orderBy(*order))
    placed = ranged.withColumn(name, inside.cast("bigint")).join(offsets, same)
    return placed.select(*df.columns, (F.col(name) + F.col(earlier)).alias(name))
