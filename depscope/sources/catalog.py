"""Catalog exports, Kudu and Hive captures, and the session's own catalog."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import functions as fn
from ..model import ENTITY, LINEAGE
from .damage import json_texts, parsed
from .position import position

# exports end in .jsonl, and what ``sinks.write_json_by_type`` writes in .json
JSON_FILES = "*.json*"


def _json_lines(spark: SparkSession, folder: str, schema, pattern: str, bad: str) -> DataFrame:
    """Records of the JSON-lines files of a folder, with their landed text as ``raw``."""
    texts = json_texts(spark, folder, pattern=pattern)
    located = texts.select(F.col("text").alias("raw"), position().alias("pos"))
    return parsed(located, "raw", schema, bad, "pos.file").select("raw", "pos", "record.*")


def entities(spark: SparkSession, dump: str, pattern: str = JSON_FILES, bad: str = "fail") -> DataFrame:
    """Full entities of an export (``entities/*.jsonl``). ``bad``: see ``damage.sound``."""
    return _json_lines(spark, f"{dump.rstrip('/')}/entities", ENTITY, pattern, bad)


def lineage_payloads(
    spark: SparkSession, dump: str, pattern: str = JSON_FILES, bad: str = "fail"
) -> DataFrame | None:
    """Lineage payloads of an export (``lineage/*.jsonl``); None without the folder."""
    folder = f"{dump.rstrip('/')}/lineage"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    rows = _json_lines(spark, folder, LINEAGE, pattern, bad)
    return rows.drop("raw").withColumnRenamed("pos", "payload_id")


def search_results(spark: SparkSession, dump: str, pattern: str = JSON_FILES, bad: str = "fail") -> DataFrame:
    """Landed search results (``search/<type>.jsonl``), one entity per line, with the searched
    type of their file."""
    texts = json_texts(spark, f"{dump.rstrip('/')}/search", pattern=pattern)
    name = F.substring_index(fn.basename(F.col("_metadata.file_path")), ".", 1)
    located = texts.select("text", F.url_decode(name).alias("search_type"), position().alias("pos"))
    return parsed(located, "text", ENTITY, bad, "pos.file").select("search_type", "record.*", "pos")


def kudu_tables(spark: SparkSession, *paths: str) -> DataFrame:
    """One table name per line; blank lines go."""
    text = spark.read.text(list(paths))
    names = text.select(fn.strip("value").alias("table_name"), position().alias("pos"))
    return names.filter(F.col("table_name") != "")


def parse_kudu_descriptions(captures: DataFrame) -> DataFrame:
    """Owner of each capture (``table_name``, ``json``); bad JSON gives ``""``."""
    owner = fn.or_empty(F.from_json("json", "owner string")["owner"])
    return captures.select("table_name", owner.alias("owner"), "pos")


def kudu_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions saved as ``<table>.json``, one document per file."""
    text = spark.read.text(folder, wholetext=True)
    name = F.regexp_replace(fn.basename(F.col("_metadata.file_path")), r"\.json$", "")
    return parse_kudu_descriptions(text.select(
        F.url_decode(name).alias("table_name"), F.col("value").alias("json"),
        position().alias("pos")))


def hive_listing(spark: SparkSession, path: str) -> DataFrame:
    """Landed ``db<TAB>table`` lines."""
    text = spark.read.text(path)
    parts = F.split("value", "\t")
    return text.select(
        fn.strip(F.get(parts, F.lit(0))).alias("db"),
        fn.or_empty(fn.strip(F.get(parts, F.lit(1)))).alias("tbl"), position().alias("pos"))


def hive_describe_lines(spark: SparkSession, path: str) -> DataFrame:
    """Landed description lines (Parquet: ``db``, ``tbl``, ``line_no``, ``line``)."""
    return spark.read.parquet(path).select("db", "tbl", "line_no", "line")


def live_hive_listing(spark: SparkSession, databases: list[str] | None = None) -> DataFrame:
    """Databases and tables of the session's catalog.

    The metastore answers one call per database with names only; they make one table here,
    whatever the number of databases.
    """
    names = databases or [row[0] for row in spark.sql("SHOW DATABASES").collect()]
    rows = [
        (db, row.tableName) for db in names
        for row in spark.sql(f"SHOW TABLES IN `{db}`").filter("not isTemporary").collect()]
    listed = spark.createDataFrame(rows, "db string, tbl string")
    return listed.withColumn("pos", F.struct("db", "tbl"))


def live_describe(spark: SparkSession, *tables: tuple[str, str]) -> DataFrame:
    """Description lines of (database, table) pairs of the session's catalog, tab-separated.

    One call to the metastore per table; all answers make one table here. A table that
    cannot be described has no lines, as a failed capture has none.
    """
    rows = []
    for db, tbl in tables:
        try:
            facts = spark.sql(f"DESCRIBE TABLE EXTENDED `{db}`.`{tbl}`").collect()
        except AnalysisException:
            continue
        # this catalog's words for two of the keys; a Hive table also has its own input format,
        # which comes later and wins
        keys = {"Type": "Table Type", "Provider": "InputFormat"}
        rows += [(db, tbl, k, "\t".join([keys.get(f.col_name, f.col_name), f.data_type or ""])) for k, f in enumerate(facts)]
    return spark.createDataFrame(rows, "db string, tbl string, line_no long, line string")
