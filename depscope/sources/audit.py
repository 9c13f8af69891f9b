"""Audit logs in dated folders, pruned by folder name before any file is opened."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import FLAT_AUDIT_JSON
from .position import position


def date_range(
    since: str | None, until: str | None, today: dt.date, months: int = 3
) -> tuple[dt.date, dt.date]:
    """Both bounds (``YYYYMMDD``) or neither: then the last ``months`` times 30 days."""
    if bool(since) != bool(until):
        raise ValueError("give both since and until, or neither")
    if since:
        first, last = (dt.datetime.strptime(d, "%Y%m%d").date() for d in (since, until))
    else:
        first, last = today - dt.timedelta(days=30 * months), today
    if first > last:
        raise ValueError(f"since {first} is after until {last}")
    return first, last


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of a folder, in order; none if it does not exist."""
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def _in_range(name: str, first: dt.date, last: dt.date) -> bool:
    if not re.fullmatch(r"[0-9]{8}", name):
        return False
    try:
        day = dt.datetime.strptime(name, "%Y%m%d").date()
    except ValueError:
        return False  # eight digits that are no date
    return first <= day <= last


def audit_folders(
    spark: SparkSession, root: str, first: dt.date, last: dt.date, services: list[str] | None = None
) -> list[str]:
    """Date folders to read, ordered by service and date.

    ``<service>/<date>`` counts; ``<service>/<service>/<date>`` is used only for a
    service that has no date folder in range directly. The driver sees folder names
    only: one listing per service.
    """
    root = root.rstrip("/")
    wanted = {s.strip() for s in services if s.strip()} if services else None
    chosen: list[str] = []
    for service in _folders(spark, root):
        if wanted is not None and service not in wanted:
            continue
        for base in (f"{root}/{service}", f"{root}/{service}/{service}"):
            dates = [d for d in _folders(spark, base) if _in_range(d, first, last)]
            if dates:
                chosen += [f"{base}/{d}" for d in dates]
                break
    return chosen


def lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Text lines with their file and place; compressed files are read as they are."""
    text = spark.read.option("recursiveFileLookup", True).text(list(paths))
    return text.select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("source_file"),
        position().alias("pos"))


def audit_lines(
    spark: SparkSession,
    root: str,
    first: dt.date,
    last: dt.date,
    services: list[str] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Lines of the selected folders; ``max_files`` keeps the first files only."""
    folders = audit_folders(spark, root, first, last, services)
    if not folders:
        raise FileNotFoundError(f"no audit folders in {root} between {first} and {last}")
    if max_files is None:
        return lines(spark, *folders)
    listed = first_files(spark, folders, max_files)
    # a cap is a trial setting: at most max_files names come back
    return lines(spark, *[row.path for row in listed.select("path").collect()])


def audit_file_count(
    spark: SparkSession, root: str, first: dt.date, last: dt.date, services: list[str] | None = None
) -> int:
    """Number of files in the selected folders, empty ones too: one question per folder."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f) for f in audit_folders(spark, root, first, last, services)]
    return sum(p.getFileSystem(conf).getContentSummary(p).getFileCount() for p in paths)


def first_files(spark: SparkSession, folders: list[str], n: int) -> DataFrame:
    """First ``n`` files in order of service, date folder and name; contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folders)
    # by path components: as one text, a service "a-b" would come before "a"
    return listing.select("path").orderBy(F.split("path", "/")).limit(n)


def flat_audit(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON audit records for the Parquet pair; absent fields, and times that are no number,
    are null."""
    records = spark.read.schema(FLAT_AUDIT_JSON).json(list(paths))
    return records.withColumn("evtTime", F.col("evtTime").try_cast("double"))
