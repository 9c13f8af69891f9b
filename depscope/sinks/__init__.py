"""Writers for the shared tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..model import (
    ACCESS_COLUMNS, EVENT_COLUMNS, LINEAGE_COLUMNS, OBJECT_COLUMNS, SUMMARY_COLUMNS, SUMMARY_KEYS,
)
from ..operators import lineage
from ..operators.skew import sift
from ..session import store

# Minimal quoting with doubled quotes, and values kept as they are.
CSV_OPTIONS = {
    "header": "true", "escape": '"', "emptyValue": "", "nullValue": "", "lineSep": "\r\n",
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
DEPENDENCY_SORT = ["window_start", "service", "user", "do_as", "op", "object_id"]


def write_csv(df: DataFrame, path: str, sort: list[str] | None = None, compression: str = "none") -> None:
    """CSV with header; with ``sort`` the part files follow each other in order."""
    if sort:
        df = df.orderBy(*sort)
    df.write.mode("overwrite").options(**CSV_OPTIONS, compression=compression).csv(path)


def write_events(df: DataFrame, path: str | None) -> None:
    """The 20-column events table; no path, no work."""
    if path:
        write_csv(df.select(*EVENT_COLUMNS), path)


def write_summary(df: DataFrame, path: str) -> None:
    write_csv(df.select(*SUMMARY_COLUMNS), path, SUMMARY_KEYS)


def write_dependency(
    df: DataFrame, path: str, include_ip: bool = False, include_app: bool = False
) -> None:
    keys = DEPENDENCY_SORT + ["client_ip"] * include_ip + ["app_name"] * include_app
    seen = [c for c in ("first_seen", "last_seen") if c in df.columns]
    write_csv(df.select(*ACCESS_COLUMNS, *seen), path, keys)


def write_access(df: DataFrame, path: str) -> None:
    write_csv(df.select(*ACCESS_COLUMNS), path)


def write_objects(df: DataFrame, path: str, sort: list[str] | None = None) -> None:
    write_csv(df.select(*OBJECT_COLUMNS), path, sort)


def write_lineage(df: DataFrame, path: str, compression: str = "none") -> None:
    """Names and types repeat in many rows: ``gzip`` files take a small part of the room."""
    write_csv(df.select(*LINEAGE_COLUMNS), path, compression=compression)


def write_partitioned(df: DataFrame, path: str, append: bool = False) -> None:
    """Parquet by ``ds`` and ``service``.

    By default the partitions that occur in ``df`` are replaced, so a rerun gives the
    same table; ``append`` adds to them. Rebalancing gives each partition files of the
    advised size: a busy service is split over tasks, quiet days share one.
    """
    writer = df.hint("rebalance", "ds", "service").write.partitionBy("ds", "service")
    if append:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_json_by_type(df: DataFrame, path: str, type_column: str = "typeName") -> None:
    """JSON lines in one folder per type; absent fields are left out.

    The type stays in the records (the folders are named by a copy), so that
    ``sources.entities`` reads them back. Types that occur are replaced, so a rerun gives
    the same table.
    """
    copy = df.withColumn("type", F.coalesce(type_column, F.lit("")))
    writer = copy.hint("rebalance", "type").write.partitionBy("type").mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").json(path)


def write_errors(df: DataFrame, path: str) -> None:
    """Failed requests of an export, as JSON lines in its ``errors`` folder."""
    df.write.mode("overwrite").json(f"{path.rstrip('/')}/errors")


def write_guids_by_type(guids: DataFrame, path: str, type_column: str = "typeName") -> None:
    """One JSON line per type and GUID, in the order in which each type's were first seen.

    Lines in place of one document: a list of a common type would not fit a task.
    """
    ordered = guids.select(type_column, "guid", "first_pos").orderBy(type_column, "first_pos")
    ordered.select(type_column, "guid").write.mode("overwrite").json(
        f"{path.rstrip('/')}/guids_by_type")


#: Buckets of a new graph's tables, unless named; a bucket should fit a few tasks.
GRAPH_BUCKETS = 64
#: Folders of one bucket's edges, one for each load that added some, up to which a load only adds another.
EDGE_FOLDERS = 16


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _vertex_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("guid"), F.lit(buckets)).cast("int")


def _edge_bucket(content: dict) -> Column:
    """By both ends; graphs stored before that have their edges by source."""
    if content.get("edges_by") == "pair":
        return lineage.pair_bucket("src", "dst", content["buckets"])
    return F.pmod(F.xxhash64("src"), F.lit(content["buckets"])).cast("int")


def upsert_vertices(known: DataFrame, new: DataFrame) -> DataFrame:
    """Nodes after a load: a new record replaces the known one of its guid."""
    return known.join(new.select("guid"), "guid", "left_anti").unionByName(new)


class _Manifest:
    """Which folders hold each bucket of the stored graph: one of vertices, and one or several of edges.

    A manifest is one small JSON file per load, numbered; the highest number is the graph. Bucket
    folders are never changed once a manifest names them. A load writes new folders for the
    buckets that it touches and then its manifest, by one rename: readers see all of a load or
    nothing, and a load that breaks off leaves folders that no manifest names.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        place, self.fs = _path(spark, f"{self.path}/manifests")
        names = [f.getPath().getName() for f in self.fs.listStatus(place)] if self.fs.exists(place) else []
        self.number = max((int(n.split(".")[0]) for n in names if n.endswith(".json")), default=0)
        self.content = {"buckets": 0, "vertices": {}, "edges": {}}
        if self.number:
            text = spark.read.text(f"{self.path}/manifests/{self.number:012d}.json", wholetext=True).first().value
            self.content = json.loads(text)

    def folders(self, table: str, buckets: list[int] | None = None) -> list[str]:
        held = self.content[table]
        found = [held[str(b)] for b in (held if buckets is None else buckets) if str(b) in held]
        return [f"{self.path}/{f}" for x in found for f in ([x] if isinstance(x, str) else x)]

    def commit(self, content: dict) -> None:
        number = self.number + 1
        made, fs = _path(self.spark, f"{self.path}/manifests/_{number}.{uuid.uuid4().hex}")
        out = fs.create(made, True)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        target, _ = _path(self.spark, f"{self.path}/manifests/{number:012d}.json")
        if fs.exists(target) or not fs.rename(made, target):
            fs.delete(made, False)
            raise OSError(f"another load has written manifest {number} of {self.path}")
        self.number, self.content = number, content


_EDGE_SCHEMA = "src string, dst string, rel string"


def _stored(spark: SparkSession, folders: list[str], schema) -> DataFrame | None:
    return spark.read.schema(schema).parquet(*folders) if folders else None


def _write_buckets(df: DataFrame, bucket: Column, path: str, load: str, table: str, order: list[str], dealt: bool = False) -> dict[str, str]:
    """Write a table's rows in one folder per bucket; returns the folders by bucket.

    ``dealt``: the tasks have few buckets each as it is, so rows stay where they are, in the order they have.
    """
    name, rows = f"{table}/load_{load}", df.withColumn("bucket", bucket)
    if not dealt:
        rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *order)  # files are smallest in order
    rows.write.option("compression", "zstd").partitionBy("bucket").parquet(f"{path}/{name}")
    place, fs = _path(df.sparkSession, f"{path}/{name}")
    written = [f.getPath().getName() for f in fs.listStatus(place) if f.isDirectory()]
    return {n.split("=")[1]: f"{name}/{n}" for n in written if n.startswith("bucket=")}


def write_graph(nodes: DataFrame, edges: DataFrame, path: str, buckets: int = GRAPH_BUCKETS, dealt: bool = False) -> None:
    """A new graph of these tables in the place of the stored one: vertices by bucket of their
    guid, edges by bucket of both ends. Tables may be read from the graph they replace. ``dealt``: edges
    come by bucket, as ``lineage.edges_by_guid`` makes them for ``buckets``, and are not shuffled."""
    manifest, load = _Manifest(nodes.sparkSession, path), uuid.uuid4().hex
    content = {"buckets": buckets, "edges_by": "pair", "vertex_schema": nodes.schema.json()}
    content["vertices"] = _write_buckets(nodes, _vertex_bucket(buckets), manifest.path, load, "vertices", ["guid"])
    content["edges"] = _write_buckets(edges.select("src", "dst", "rel"), _edge_bucket(content), manifest.path, load, "edges", ["src", "dst", "rel"], dealt)
    manifest.commit(content)


def read_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame] | None:
    """The stored graph's vertices and edges, both of one load; None where there is none."""
    manifest = _Manifest(spark, path)
    if not manifest.number:
        return None
    schema = StructType.fromJson(json.loads(manifest.content["vertex_schema"]))
    empty = [spark.createDataFrame([], s) for s in (schema, _EDGE_SCHEMA)]
    found = [_stored(spark, manifest.folders(t), s) for t, s in (("vertices", schema), ("edges", _EDGE_SCHEMA))]
    return tuple(e if f is None else f for e, f in zip(empty, found, strict=True))


def _touched(df: DataFrame, bucket: Column) -> list[int]:
    """Buckets that have rows: as many numbers as there are buckets, at most."""
    return sorted(r.b for r in df.select(bucket.alias("b")).distinct().collect())


def upsert_graph(nodes: DataFrame, edges: DataFrame, path: str, buckets: int = GRAPH_BUCKETS) -> None:
    """Load nodes and edges into the stored graph.

    New records replace those of their guid. Of the edges, those are added that the graph lacks
    and whose both ends are nodes, known or new. Only buckets that the load touches are read; those of changed
    vertices are merged and written, and to those of edges a folder of the added ones comes. The others stay
    where they are. A load that changes nothing writes nothing. Give one record a guid; the load is stored
    first, as it is read several times.
    """
    spark, load = nodes.sparkSession, uuid.uuid4().hex
    manifest = _Manifest(spark, path)
    nodes, edges = store(nodes, "new_nodes"), store(edges.select("src", "dst", "rel").distinct(), "new_edges", compression="zstd")
    if not manifest.number:
        write_graph(nodes, lineage.connected_edges(edges, nodes), path, buckets)
        return
    content = dict(manifest.content)
    vertex_at, edge_at = _vertex_bucket(content["buckets"]), _edge_bucket(content)
    schema = StructType.fromJson(json.loads(content["vertex_schema"]))
    if sorted(nodes.columns) != sorted(schema.names):
        raise ValueError(f"the graph has columns {schema.names}")
    nodes = nodes.select(*schema.names)

    known = _stored(spark, manifest.folders("vertices", _touched(nodes, vertex_at)), schema)
    changed = nodes if known is None else nodes.join(
        known, [nodes[c].eqNullSafe(known[c]) for c in schema.names], "left_anti")
    changed = store(changed, "changed_nodes")
    content["vertices"] = dict(content["vertices"])
    parts = _touched(changed, vertex_at)
    if parts:
        known = _stored(spark, manifest.folders("vertices", parts), schema)
        merged = changed if known is None else upsert_vertices(known, changed)
        content["vertices"] |= _write_buckets(merged, vertex_at, manifest.path, load, "vertices", ["guid"])

    known = _stored(spark, manifest.folders("edges", _touched(edges, edge_at)), _EDGE_SCHEMA)
    same = ["src", "dst", "rel"]
    # known edges lie where they are but for those that may be in the load
    added = edges if known is None else edges.join(sift(known, edges, same)[1], same, "left_anti")
    added = store(added, "added_edges", compression="zstd")
    # ends are looked up where they can be: in the buckets of the load's edges, guids only
    ends = added.select(F.explode(F.array("src", "dst")).alias("guid"))
    at = _stored(spark, [f"{manifest.path}/{content['vertices'][str(b)]}" for b in _touched(ends, vertex_at) if str(b) in content["vertices"]], schema)
    added = store(lineage.connected_edges(added, at), "linked_edges") if at is not None else added.limit(0)
    if not added.isEmpty():
        content["edges"] = _with_added(content, added, edge_at, manifest, load)
    if content != manifest.content:
        manifest.commit(content)


def _with_added(content: dict, added: DataFrame, edge_at: Column, manifest: _Manifest, load: str) -> dict:
    """Folders of edges by bucket after a load. Buckets of many loads become one folder again."""
    held = {b: [f] if isinstance(f, str) else f for b, f in content["edges"].items()}
    many = [int(b) for b in (str(b) for b in _touched(added, edge_at)) if len(held.get(b, [])) >= EDGE_FOLDERS]
    if many:
        known = _stored(added.sparkSession, manifest.folders("edges", many), _EDGE_SCHEMA)
        added = added.unionByName(known)
        held = {b: f for b, f in held.items() if int(b) not in many}
    new = _write_buckets(added, edge_at, manifest.path, load, "edges", ["src", "dst", "rel"])
    return held | {b: [*held.get(b, []), f] for b, f in new.items()}


def vacuum_graph(spark: SparkSession, path: str) -> int:
    """Remove folders and manifests that the stored graph no longer needs; returns how many.

    Readers of an earlier load must have ended, and no load may be running.
    """
    manifest = _Manifest(spark, path)
    needed = {f for t in ("vertices", "edges") for f in manifest.folders(t)}
    gone = 0
    for table in ("vertices", "edges"):
        top, fs = _path(spark, f"{manifest.path}/{table}")
        for load in fs.listStatus(top) if fs.exists(top) else []:
            parts = [p.getPath() for p in fs.listStatus(load.getPath()) if p.isDirectory()]
            kept = [p for p in parts if f"{manifest.path}/{table}/{load.getPath().getName()}/{p.getName()}" in needed]
            for part in [load.getPath()] if not kept else [p for p in parts if p not in kept]:
                fs.delete(part, True)
                gone += 1
    top, fs = _path(spark, f"{manifest.path}/manifests")
    for file in fs.listStatus(top) if fs.exists(top) else []:
        if file.getPath().getName() != f"{manifest.number:012d}.json":
            fs.delete(file.getPath(), False)
            gone += 1
    return gone
