"""Storage listings: text captures and database tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .position import position

# permissions, replication, owner, group, size, date, time, then the path with its blanks
_LS = r"^\s*(\S+)\s+\S+\s+(\S+)\s+(\S+)\s+\S+\s+\S+\s+\S+\s+(/[\s\S]*)$"


def parse_ls(df: DataFrame) -> DataFrame:
    """Listing lines (``line`` and others) to path, owner, group and permissions."""
    line = F.rtrim(F.col("line"), F.lit("\r\n"))
    fields = {"permissions": 1, "owner": 2, "group": 3, "path": 4}
    carried = [c for c in df.columns if c != "line"]
    parsed = df.filter(~line.startswith("Found ") & line.rlike(_LS)).select(
        *carried, *[F.regexp_extract(line, _LS, i).alias(c) for c, i in fields.items()])
    return parsed.select(*carried, "path", "owner", "group", "permissions")


def ls_listing(spark: SparkSession, *paths: str) -> DataFrame:
    """Saved output of a recursive listing."""
    text = spark.read.text(list(paths))
    return parse_ls(text.select(F.col("value").alias("line"), position().alias("pos")))


def listing_table(
    table: DataFrame,
    path: str = "file_path",
    owner: str = "owner",
    group: str = "group",
    permissions: str = "permissions",
) -> DataFrame:
    """Listing columns of any table, under their usual names; other columns stay as they are."""
    names = {path: "path", owner: "owner", group: "group", permissions: "permissions"}
    rest = [c for c in table.columns if c not in names]
    return table.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()], *rest)


def jdbc_listing(
    spark: SparkSession,
    options: dict[str, str],
    table: str = "list",
    path: str = "file_path",
    owner: str = "owner",
    group: str = "group",
    permissions: str = "permissions",
    fetch_size: int = 10000,
) -> DataFrame:
    """Listing columns of a database table. ``options``: url, user, driver, and the
    partitionColumn with its bounds and numPartitions, without which one task would read
    the whole table over one connection.

    A table has no order of its own; the columns themselves decide which row of a
    directory is first, so reruns agree.
    """
    missing = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} - set(options)
    if missing:
        raise ValueError(f"a parallel read needs the options {sorted(missing)}")
    reader = (
        spark.read.format("jdbc").options(**options)
        .option("dbtable", f'"{table}"').option("fetchsize", fetch_size)
    )
    listed = listing_table(reader.load(), path, owner, group, permissions)
    columns = ["path", "owner", "group", "permissions"]
    return listed.select(*columns, F.struct(*columns).alias("pos"))
