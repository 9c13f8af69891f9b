"""Landed responses of the history services, one JSON document per page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from ..model import JHS_PAGE, PROJECT, PROJECT_CHILD, RM_PAGE, SPARK_APP
from .damage import json_texts, parsed, sound
from .position import position


def _pages(spark: SparkSession, paths, multi_line: bool) -> DataFrame:
    """Documents as text: one per line (can be split), or one per file with ``multi_line``."""
    return json_texts(spark, *paths, multi_line=multi_line).select(
        "text", F.col("_metadata.file_path").alias("page"), position().alias("place"))


def _is_list() -> Column:
    return F.col("text").startswith("[")


def _items(pages: DataFrame, array: Column | str) -> DataFrame:
    """One row per array element; a missing wrapper or array gives none."""
    items = pages.select("page", "place", F.posexplode(array).alias("item_no", "item"))
    # an element that is no object has nothing to tell
    return items.filter(F.col("item").isNotNull()).select(
        "item.*", "page", F.struct("place.*", "item_no").alias("pos"))


def _wrapped(spark: SparkSession, schema: T.StructType, array: str, paths, multi_line: bool, bad: str) -> DataFrame:
    pages = _pages(spark, paths, multi_line)
    return _items(parsed(pages, "text", schema, bad, "page"), f"record.{array}")


def rm_apps(spark: SparkSession, *paths: str, multi_line: bool = False, bad: str = "fail") -> DataFrame:
    """Resource-manager pages ``{"apps": {"app": […]}}``. ``bad``: see ``damage.sound``."""
    return _wrapped(spark, RM_PAGE, "apps.app", paths, multi_line, bad)


def jhs_jobs(spark: SparkSession, *paths: str, multi_line: bool = False, bad: str = "fail") -> DataFrame:
    """Job-history pages ``{"jobs": {"job": […]}}``."""
    return _wrapped(spark, JHS_PAGE, "jobs.job", paths, multi_line, bad)


def _from_arrays(pages: DataFrame, record: Column, bad: str) -> DataFrame:
    """Items of the arrays in ``record``; pages without one are tested for damage."""
    rows = pages.select("*", F.inline(F.array(F.struct(record.alias("record")))))
    return _items(sound(rows, "text", F.col("record").isNull(), bad, "page"), "record")


def spark_apps(spark: SparkSession, *paths: str, multi_line: bool = False, bad: str = "fail") -> DataFrame:
    """Applications of top-level arrays; a page that is an object (an error) has none."""
    record = F.when(_is_list(), F.from_json("text", T.ArrayType(SPARK_APP)))
    return _from_arrays(_pages(spark, paths, multi_line), record, bad)


def cdsw(spark: SparkSession, kind: str, *paths: str, multi_line: bool = False, bad: str = "fail") -> DataFrame:
    """Items of one kind (projects, jobs, sessions, models, applications).

    A page is ``{"<kind>": […]}`` or a bare list; any other object, and a null list, has
    none. Items of other kinds than projects carry their ``project_id``.
    """
    item = PROJECT if kind == "projects" else PROJECT_CHILD
    wrapper = T.StructType([T.StructField(kind, T.ArrayType(item))])
    record = F.when(_is_list(), F.from_json("text", T.ArrayType(item))).otherwise(F.from_json("text", wrapper)[kind])
    return _from_arrays(_pages(spark, paths, multi_line), record, bad)
