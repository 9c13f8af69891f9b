"""Session settings and scratch space shared by the jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results (UTC) or that every job here wants (AQE, hive-style
# partition overwrite). All can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sides that lie by some of a join's keys (lineage by payload) are not shuffled again.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # The JVM never compiles methods above 8000 bytes. Wide projections (one audit record
    # has 55 spellings) are then run by the generated projections, which are split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("depscope")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    return configure(builder.getOrCreate())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one the cluster names for checkpoints.

    Only a local session without ``spark.checkpoint.dir`` (tests, laptops) gets a
    temporary folder, recorded in the context for later calls.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="depscope-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/depscope/{uuid.uuid4().hex}/{name}"


_STORED: dict[str, list[str]] = {}


def drop_stored(spark: SparkSession) -> int:
    """Remove what this application has stored; call it when no result is needed any more."""
    paths = _STORED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return len(paths)


def discard(stored: DataFrame) -> None:
    """Remove one table that ``store`` wrote, when its last reader is done.

    The shuffle files of the jobs before go as well: Spark drops those that nothing refers to
    any more, but learns of it only when the driver collects garbage, which is asked for here.
    """
    spark = stored.sparkSession
    files = stored.inputFiles()
    for path in _STORED.get(spark.sparkContext.applicationId, []):
        folder = "/".join(path.split("/")[-2:])  # a number that no other table has, and the name
        if files and f"/{folder}/" in files[0]:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
            break
    spark._jvm.System.gc()


def store(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write a result that several later steps read, and go on from the written table.

    Survives lost executors, and later steps neither repeat the work nor read columns
    they do not need. Runs a job. ``drop_stored`` removes all such tables.
    """
    path = scratch_path(df.sparkSession, name)
    _STORED.setdefault(df.sparkSession.sparkContext.applicationId, []).append(path)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
