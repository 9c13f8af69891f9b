"""Catalog sources to the shared objects table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .. import functions as fn
from ..model import (
    DATABASE_HEADERS, EXCLUDED_DATABASES, OBJECT_COLUMNS, TABLE_HEADERS,
)
from .dedupe import last_per_key
from .skew import skew_join


def object_row(service, object_type, object_id, owner="", group="", extra="") -> list[Column]:
    values = [service, object_type, object_id, owner, group, extra]
    return [
        (v if isinstance(v, Column) else F.lit(v)).alias(name)
        for v, name in zip(values, OBJECT_COLUMNS)
    ]


# --- storage listings ---

def listing_dirs(listing: DataFrame, depth: int = 3) -> DataFrame:
    """Add the shortened directory; paths that shorten to nothing or the root go."""
    return (
        listing.withColumn("dir", fn.truncate_path("path", depth))
        .filter(~F.col("dir").isin("", "/"))
    )


def from_listing(listing: DataFrame, depth: int = 3, order: list[str] | None = None) -> DataFrame:
    """One object per directory, with owner, group and permissions of its first entry."""
    first = F.min_by(
        F.struct("owner", "group", "permissions"), F.struct(*(order or ["pos"]))).alias("first")
    dirs = listing_dirs(listing, depth).groupBy("dir").agg(first)
    return dirs.select(*object_row(
        "hdfs", "hdfs_path", F.col("dir"), fn.or_empty(F.col("first.owner")),
        fn.or_empty(F.col("first.group")), fn.or_empty(F.col("first.permissions"))))


# --- catalog entities ---

ENTITY_STRUCT = ["guid", "typeName", "attributes", "uniqueAttributes"]


def from_entities(entities: DataFrame) -> DataFrame:
    """One object per entity with a qualified name; repeated entities stay."""
    e = F.struct(*ENTITY_STRUCT)
    return entities.select(*object_row(
        fn.type_to_service("typeName"), fn.or_empty("typeName"), fn.pick_qualified_name(e),
        fn.pick_owner(e))).filter(F.col("object_id") != "")


def search_hits(results: DataFrame) -> DataFrame:
    """Landed search results that have a GUID."""
    return results.filter(F.col("guid").isNotNull() & (F.col("guid") != ""))


def guids_by_type(hits: DataFrame, kind: str = "typeName", order: list[str] | None = None) -> DataFrame:
    """Distinct GUIDs of each type with the place where they were first seen.

    Rows instead of one list per type: a list of a common type would not fit a task.
    """
    place = F.struct(*order) if order else F.col("pos")
    return hits.groupBy(kind, "guid").agg(F.min(place).alias("first_pos"))


# --- Kudu ---

def from_kudu(
    tables: DataFrame, described: DataFrame | None = None, max_tables: int | None = None
) -> DataFrame:
    """Table names, with owners where descriptions are given."""
    if max_tables is not None:
        tables = tables.orderBy("pos").limit(max_tables)
    owner: Column | str = ""
    if described is not None:
        owners = last_per_key(described.select("table_name", "owner", "pos"), ["table_name"], ["pos"])
        # names are unique on both sides, so no key of this join is hot
        tables = tables.join(owners.select("table_name", "owner"), "table_name", "left")
        owner = fn.or_empty("owner")
    return tables.select(*object_row("kudu", "kudu_table", F.col("table_name"), owner))


def owner_counts(objects: DataFrame) -> DataFrame:
    return objects.agg(
        F.count_if(F.col("owner") != "").alias("with_owner"), F.count("*").alias("tables"))


# --- Hive and Impala ---

def drop_headers(df: DataFrame, column: str, words: list[str]) -> DataFrame:
    """Trim names, drop empty ones and the header words of the listing tools."""
    name = fn.strip(column)
    return df.withColumn(column, name).filter((F.col(column) != "") & ~F.lower(column).isin(words))


def select_databases(
    databases: DataFrame,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    max_databases: int | None = None,
) -> DataFrame:
    """Databases to scan. An explicit list replaces the listing, in its own order."""
    if include:
        wanted = F.array(*[F.lit(d.strip()) for d in include if d.strip()])
        databases = (
            databases.sparkSession.range(1)
            .select(F.posexplode(wanted).alias("pos", "db"))
            .select("db", F.col("pos").cast("bigint").alias("pos"))
        )
    else:
        databases = drop_headers(databases, "db", DATABASE_HEADERS)
    dropped = [d.strip().lower() for d in (EXCLUDED_DATABASES if exclude is None else exclude)]
    kept = databases.filter(~F.lower("db").isin(dropped)) if dropped else databases
    return kept.orderBy("pos").limit(max_databases) if max_databases else kept


def first_tables(tables: DataFrame, n: int | None) -> DataFrame:
    """First ``n`` tables of each database; the rank is cut before the shuffle."""
    if not n:
        return tables
    rank = F.row_number().over(Window.partitionBy("db").orderBy("pos"))
    return tables.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def hive_tables(
    databases: DataFrame,
    tables: DataFrame,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    max_databases: int | None = None,
    max_tables: int | None = None,
) -> DataFrame:
    """Tables of the selected databases (``db``, ``tbl``, ``pos``)."""
    chosen = select_databases(databases, include, exclude, max_databases).select("db").distinct()
    listed = drop_headers(tables, "tbl", TABLE_HEADERS)
    return first_tables(skew_join(listed, chosen, ["db"], "left_semi"), max_tables)


# Spellings of the description keys.
_TABLE_TYPE = ["table type", "tabletype"]
_INPUT_FORMAT = ["inputformat", "input format"]
_SERDE = ["serdelib", "serde library", "serdelibrary"]


def describe_pivot(lines: DataFrame, strict: bool = False) -> DataFrame:
    """Description lines (``db``, ``tbl``, ``line_no``, ``line``) to one row per table.

    The last line of a key wins. Storage: any mention of Kudu decides, then the input
    format, then the serde; ``strict`` looks at the storage handler and input format.
    """
    keyed = lines.select(
        "db", "tbl", "line_no", fn.describe_key("line", strict).alias("key"),
        fn.describe_value("line", strict).alias("val"),
        F.lower("line").contains("kudu").alias("mentions"))

    def last(*keys: str) -> Column:
        return fn.or_empty(F.max_by("val", F.when(F.col("key").isin(*keys), F.col("line_no"))))

    handler = (F.col("key") == "storage_handler") & F.lower("val").contains("kudu")
    kudu = F.coalesce(F.bool_or(handler if strict else F.col("mentions")), F.lit(False))
    wide = keyed.groupBy("db", "tbl").agg(
        last(*_TABLE_TYPE).alias("table_type"), last("owner").alias("owner"),
        last(*_INPUT_FORMAT).alias("input_format"), last(*_SERDE).alias("serde"),
        last("location").alias("location"), kudu.alias("kudu"))
    storage = (
        fn.storage_format_strict("input_format", F.col("kudu")) if strict
        else fn.storage_format("input_format", "serde", F.col("kudu")))
    return wide.select(
        "db", "tbl", "table_type", "owner", "input_format", "serde", "location",
        storage.alias("storage_format"))


def with_descriptions(tables: DataFrame, described: DataFrame) -> DataFrame:
    """Tables with their description; ``storage_format`` is ``error`` without one."""
    facts = ["table_type", "owner", "location", "storage_format"]
    joined = tables.select("db", "tbl").join(
        described.select("db", "tbl", *facts), ["db", "tbl"], "left")
    return joined.select(
        "db", "tbl", *[fn.or_empty(c).alias(c) for c in facts[:-1]],
        F.coalesce("storage_format", F.lit("error")).alias("storage_format"))


def from_hive(described: DataFrame, strict: bool = False) -> DataFrame:
    """Described tables to objects; ``strict`` also keeps commas out of the texts."""
    extra = fn.joined_parts(
        type=F.col("table_type"), storage=F.col("storage_format"), location=F.col("location"))
    clean = fn.comma_to_semicolon if strict else (lambda c: c)
    return described.select(*object_row(
        "impala", "hive_table", F.concat_ws(".", "db", "tbl"), clean(F.col("owner")), "",
        clean(extra)))


def from_hive_list(tables: DataFrame) -> DataFrame:
    return tables.select(*object_row("impala", "hive_table", F.concat_ws(".", "db", "tbl")))


def storage_distribution(described: DataFrame, include_errors: bool = False) -> DataFrame:
    """Tables per storage format, most frequent first."""
    rows = described if include_errors else described.filter(F.col("storage_format") != "error")
    return (
        rows.groupBy(F.col("storage_format").alias("storage")).agg(F.count("*").alias("cnt"))
        .orderBy(F.desc("cnt"), "storage")
    )


# --- projects ---

def project_keys(projects: DataFrame, max_projects: int = 0) -> DataFrame:
    """Projects with their join key, stable id and owner name."""
    if max_projects > 0:
        projects = projects.orderBy("pos").limit(max_projects)
    return projects.select(
        F.coalesce(fn.first_present("id", "project_id"), F.lit("")).alias("project_key"),
        fn.project_id("owner", "name", "slug").alias("pid"),
        fn.owner_name("owner").alias("project_owner"),
        fn.project_extra(
            "description", "default_engine_type", fn.first_present("created_at", "createdAt")
        ).alias("extra"))


def with_project(children: DataFrame, projects: DataFrame) -> DataFrame:
    """Jobs, sessions, models or applications with id and owner of their project.

    A project with very many children is split by the adaptive join; nothing runs here.
    """
    keyed = children.withColumnRenamed("project_id", "project_key")
    slim = projects.select("project_key", "pid", "project_owner")
    return keyed.join(slim, "project_key")


def project_objects(projects: DataFrame) -> DataFrame:
    return projects.select(*object_row(
        "cdsw", "cdsw_project", F.col("pid"), F.col("project_owner"), "", F.col("extra")))


def job_objects(jobs: DataFrame) -> DataFrame:
    extra = fn.joined_parts(
        script=fn.or_empty("script"),
        engine=fn.or_empty(fn.first_present("kernel", "engine_type")),
        schedule=F.translate(fn.or_empty("schedule"), "|", " "))
    name = fn.or_empty(fn.first_present("name", "title", "id"))
    return jobs.select(*object_row(
        "cdsw", "cdsw_job", F.concat_ws("/", "pid", name), F.col("project_owner"), "", extra))


def model_objects(models: DataFrame) -> DataFrame:
    name = fn.or_empty(fn.first_present("name", "id"))
    return models.select(*object_row(
        "cdsw", "cdsw_model", F.concat(F.col("pid"), F.lit("/model:"), name),
        F.col("project_owner")))


def from_cdsw(projects: DataFrame, jobs: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """Objects of projects, jobs and models. ``projects`` come from ``project_keys``."""
    parts = [project_objects(projects), job_objects(with_project(jobs, projects))]
    if models is not None:
        parts.append(model_objects(with_project(models, projects)))
    return reduce(DataFrame.unionByName, parts)


