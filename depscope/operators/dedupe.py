"""First-wins and last-wins, as aggregates.

A window with ``row_number`` would bring every copy of a hot key into one task;
``min_by`` and ``max_by`` combine on the map side, so one row per key and task moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], chooser) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = chooser(F.struct(*rest), F.struct(*order)).alias("_row")
    picked = df.groupBy(*keys).agg(row)
    return picked.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the smallest ``order`` of each key, all columns kept."""
    return _pick(df, keys, order, F.min_by)


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` of each key, all columns kept."""
    return _pick(df, keys, order, F.max_by)


def page_counts(df: DataFrame, page: str, key: str) -> DataFrame:
    """Per page: records fetched, and records whose key no earlier page had.

    A record without a key counts as fetched and never as new.
    """
    fetched = df.groupBy(page).agg(F.count("*").alias("fetched"))
    keyed = df.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    new = (
        keyed.groupBy(key).agg(F.min(page).alias(page))
        .groupBy(page).agg(F.count("*").alias("new"))
    )
    return fetched.join(new, page, "left").select(
        page, "fetched", F.coalesce("new", F.lit(0)).cast("bigint").alias("new"))
