"""Equi-joins where one key may hold a large part of the rows, or make most of the pairs.

Keys are split by the work they make. Their parts are a table, written to the shared folder and
joined back: it may be long, and the driver only learns whether it has any rows, and whether it
is short enough to be broadcast. Counting is one job over the input's keys, so the input should
be stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..session import store

#: Rows of one key, or pairs, that one task makes.
KEY_ROWS = 1_000_000
PAIRS = 1_000_000
#: Rows that a task gets to tell apart in memory, if there are more than the usual tasks take.
TASK_ROWS = 400_000
#: Keys up to which ``sift`` broadcasts a bitmap of them, a byte for each.
SIFTED_KEYS = 50_000_000
#: A table of split keys is broadcast up to so many rows.
BROADCAST_KEYS = 100_000


def _hashable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]


def _spread(df: DataFrame) -> Column:
    # the task number also spreads rows that are copies of each other
    return F.xxhash64(*_hashable(df)) + F.spark_partition_id()


def short_or_not(parts: DataFrame) -> tuple[DataFrame, bool]:
    """The table, marked for broadcast if it is short; whether it has rows."""
    n = parts.select(F.lit(1)).limit(BROADCAST_KEYS + 1).count()
    return (F.broadcast(parts) if n <= BROADCAST_KEYS else parts), n > 0


def _same_types(left: DataFrame, right: DataFrame, on: list[str]) -> None:
    if any(left.schema[k].dataType != right.schema[k].dataType for k in on):
        raise TypeError(f"key types differ, so their hashes would: {on}")


def tasks_for(spark: SparkSession, rows: int | None) -> int:
    """The usual number of tasks, or more where one would get more than ``TASK_ROWS``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(rows or 0) // TASK_ROWS))


def _index(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(parts) - 1))


def skew_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", key_rows: int = KEY_ROWS, distinct: bool = False
) -> DataFrame:
    """Join where a key may have very many rows in ``left`` and few in ``right``.

    A key with more than ``key_rows`` left rows is dealt to parts of that size, and its
    matches on the right are repeated for each part. All other rows move once. Without such
    keys it is a plain join. ``how``: inner, left, left_semi or left_anti. ``distinct``: left rows
    that come several times are joined once; equal rows meet at the place of the join, so this
    moves nothing more, in tasks of about ``TASK_ROWS`` rows, which need no disk.
    """
    _same_types(left, right, on)
    counts = left.groupBy(*on).agg(F.count("*").alias("_rows")).where(F.col("_rows") > key_rows)
    parts, any_split = short_or_not(store(
        counts.select(*on, F.ceil(F.col("_rows") / key_rows).alias("_parts")), "key_parts"))
    tasks = tasks_for(left.sparkSession, left.count()) if distinct else 0
    if not any_split:
        return (left.repartition(tasks, *on).distinct() if distinct else left).join(right, on, how)
    one = F.coalesce("_parts", F.lit(1))
    spread = F.xxhash64(*left.columns) if distinct else _spread(left)
    salted = left.join(parts, on, "left").withColumn("_part", F.pmod(spread, one)).drop("_parts")
    if distinct:
        salted = salted.repartition(tasks, *on, "_part").distinct()
    copies = right.join(parts, on, "left").withColumn("_parts", one).withColumn("_part", _index("_parts")).drop("_parts")
    return salted.join(copies, [*on, "_part"], how).drop("_part")


def product_join(left: DataFrame, right: DataFrame, on: list[str], pairs: int = PAIRS) -> DataFrame:
    """Inner join of every left with every right row of a key.

    A key that makes more than ``pairs`` pairs is cut into a grid: the larger side into as
    many parts as cells are needed, and the smaller side too if that is not enough. Each cell
    is a task's work. All other rows move once.
    """
    _same_types(left, right, on)
    n, m = F.col("_left"), F.col("_right")
    sides = left.select(*on, F.lit(1).alias("_left"), F.lit(0).alias("_right")).unionByName(
        right.select(*on, F.lit(0).alias("_left"), F.lit(1).alias("_right")))
    sizes = sides.groupBy(*on).agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))
    cells = F.ceil(n.cast("decimal(19,0)") * m / pairs).cast("bigint")
    long = F.least(F.greatest(n, m), F.col("_cells"))
    short = F.least(F.least(n, m), F.ceil(F.col("_cells") / F.col("_long")))
    grid = (sizes.withColumn("_cells", cells).where(F.col("_cells") > 1).withColumn("_long", long)
            .withColumn("_short", short).select(
                *on, F.when(n >= m, F.col("_long")).otherwise(F.col("_short")).alias("_rows"),
                F.when(n >= m, F.col("_short")).otherwise(F.col("_long")).alias("_columns")))
    grid, any_split = short_or_not(store(grid, "pair_grid"))
    if not any_split:
        return left.join(right, on)

    def placed(df: DataFrame, own: str, other: str) -> DataFrame:
        size = {c: F.coalesce(c, F.lit(1)).cast("bigint") for c in (own, other)}
        sized = df.join(grid, on, "left").withColumns(size)
        return sized.withColumn(f"{own}_at", F.pmod(_spread(df), F.col(own))).withColumn(
            f"{other}_at", _index(other)).drop(own, other)

    cell = ["_rows_at", "_columns_at"]
    return placed(left, "_rows", "_columns").join(placed(right, "_columns", "_rows"), [*on, *cell]).drop(*cell)


def sift(df: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame | None, DataFrame]:
    """Rows of ``df`` that match none of the (stored) keys for sure, and all others: those that do, and about 5 % more.

    Found where they lie: a bitmap of the keys is broadcast, two bits for each, in slots of 32,768 bits for
    4,096 keys. If there are too many for that, no row is sure (None).
    """
    _same_types(df, keys, on)
    n = keys.count()
    if n > SIFTED_KEYS:
        return None, df
    slots = n // 4096 + 1
    slot, h = F.pmod("_hash", F.lit(slots)), F.col("_hash")
    bits = [F.shiftright(h, k).bitwiseAND(F.lit(32767)) for k in (49, 34)]
    inside = F.expr("shiftleft(1L, cast(_bit & 63 as int))")
    words = keys.select(F.xxhash64(*on).alias("_hash")).select(h, slot.alias("_slot")).repartition("_slot").select(
        "_slot", F.explode(F.array(*bits)).alias("_bit")).select("_slot", F.shiftright("_bit", 6).cast("int").alias("_word"), inside.alias("_mask"))
    # a slot's 512 words as a list; rows of zero words fill it
    blank = df.sparkSession.range(slots).select(F.col("id").alias("_slot")).repartition("_slot").select(
        "_slot", F.explode(F.sequence(F.lit(0), F.lit(511))).alias("_word"), F.lit(0).cast("bigint").alias("_mask"))
    words = words.unionByName(blank).groupBy("_slot", "_word").agg(F.bit_or("_mask").alias("_mask"))
    lists = words.groupBy("_slot").agg(F.array_sort(F.collect_list(F.struct("_word", "_mask"))).alias("_list")).select(
        "_slot", F.col("_list._mask").alias("_words"))
    tested = df.withColumn("_hash", F.xxhash64(*on)).withColumn("_slot", slot).join(F.broadcast(lists), "_slot")
    held = F.lit(True)
    for bit in bits:
        held &= F.getbit(F.get("_words", F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1
    return tested.where(~held).select(*df.columns), tested.where(held).select(*df.columns)
