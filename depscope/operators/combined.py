"""What several producers know together: access with its objects, one row per object, one graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as fn
from ..model import OBJECT_COLUMNS
from .skew import skew_join

#: Object types whose ids are paths; what lies below a path belongs to it.
PATH_TYPES = ["hdfs_path"]
#: Producers of objects, best first for each attribute. The described table knows its owner and
#: extras, the file system its groups; a bare list of names knows neither.
PRECEDENCE = {
    "service": ["hive", "kudu", "cdsw", "storage", "catalog", "hive_list"],
    "owner": ["hive", "catalog", "kudu", "cdsw", "storage", "hive_list"],
    "group": ["storage", "hive", "catalog", "kudu", "cdsw", "hive_list"],
    "extra": ["hive", "kudu", "cdsw", "catalog", "storage", "hive_list"],
}


def plain_path(c: Column | str) -> Column:
    """A path without scheme, authority, doubled and closing slashes; the root is ``""``."""
    local = F.regexp_replace(F.trim(fn.or_empty(c)), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.regexp_replace(F.regexp_replace(local, "/+", "/"), "/$", "")


def _place(object_type: Column, object_id: Column) -> Column:
    path = object_type.isin(PATH_TYPES) & object_id.contains("/")
    return F.when(path, F.concat(F.lit("path:"), plain_path(object_id))).otherwise(F.concat(object_type, F.lit(":"), object_id))


def places(objects: DataFrame) -> DataFrame:
    """place, object: where objects are, by id and by the location in ``extra``.

    Of several objects at one place the smallest (service, type, id) stands for all.
    """
    location = F.regexp_extract("extra", r"(?:^|\|)location=([^|]*)", 1)
    own = _place(F.col("object_type"), F.col("object_id"))
    at = objects.select(
        F.explode(F.array_distinct(F.array(own, F.when(location != "", F.concat(F.lit("path:"), plain_path(location))).otherwise(own)))).alias("place"),
        F.struct("service", "object_type", "object_id", "owner").alias("object"))
    return at.groupBy("place").agg(F.min("object").alias("object"))


def enrich_access(access: DataFrame, objects: DataFrame) -> DataFrame:
    """Access rows with the object they touch: ``matched_service``, ``matched_type``,
    ``matched_id``, ``matched_owner`` and ``matched_place``, null where there is none.

    A path belongs to the deepest object whose place is the path or above it; other ids belong to
    the object of their type and id. Each access row comes once. Containment is an equi-join:
    every distinct path brings its ancestors, as many as it is deep. The root and the top folders
    are ancestors of nearly all, so hot places are split, and so are hot ids of access rows.
    """
    ids = access.select("object_type", "object_id").distinct()
    own = _place(F.col("object_type"), fn.or_empty("object_id"))
    names = F.split(F.col("own"), "/")
    above = F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.array_join(F.slice(names, 1, k), "/"))
    reached = ids.withColumn("own", own).select(
        "object_type", "object_id", F.explode(F.when(F.col("own").startswith("path:"), above).otherwise(F.array("own"))).alias("place"))
    found = skew_join(reached, places(objects), ["place"]).groupBy("object_type", "object_id").agg(
        F.max_by(F.struct("place", "object.*"), F.length("place")).alias("m"))
    matched = found.select(
        "object_type", "object_id", F.col("m.service").alias("matched_service"), F.col("m.object_type").alias("matched_type"),
        F.col("m.object_id").alias("matched_id"), F.col("m.owner").alias("matched_owner"), F.col("m.place").alias("matched_place"))
    return skew_join(access, matched, ["object_type", "object_id"], "left")


def union_objects(producers: dict[str, DataFrame], precedence: dict[str, list[str]] = PRECEDENCE) -> DataFrame:
    """The object columns and ``producers``: one row per (object_type, object_id).

    Each attribute comes from the best producer that has it (not null, not empty), by an order
    of its own; among rows of one producer the smallest text counts. One aggregate, which combines
    on the map side, so an object that very many records name is no hot group.
    """
    unknown = {name for order in precedence.values() for name in producers if name not in order}
    if unknown:
        raise ValueError(f"producers without precedence: {sorted(unknown)}")
    every = reduce(DataFrame.unionByName, [df.select(*OBJECT_COLUMNS).withColumn("producer", F.lit(name)) for name, df in producers.items()])

    def best(field: str) -> Column:
        rank = F.element_at(F.create_map(*[F.lit(x) for k, name in enumerate(precedence[field]) for x in (name, k)]), F.col("producer"))
        return F.coalesce(F.min(F.when(fn.or_empty(field) != "", F.struct(rank, field)))[field], F.lit("")).alias(field)

    names = F.array_join(F.array_sort(F.collect_set("producer")), ",").alias("producers")  # as many as producers at most
    return every.groupBy("object_type", "object_id").agg(*(best(f) for f in precedence), names).select(*OBJECT_COLUMNS, "producers")


def vertex_key(object_type: Column | str, object_id: Column | str) -> Column:
    return F.concat_ws("|", fn.or_empty(object_type), fn.or_empty(object_id))


def object_graph(objects: DataFrame, access: DataFrame, lineage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices (key, kind, id, owner, known) and edges (src, dst, rel, n) over all producers.

    Vertices are the objects, the users of access rows, and every end of an edge that no producer
    of objects has (``known`` is false there). Edges are user → object by operation, weighed
    by the rows' counts, and object → object by lineage relation; parallel ones are one edge. Ends are
    completed by an aggregate over objects and ends together, so a hub with very many edges moves as one
    row per task, and no edge lacks its vertices.
    """
    used = access.select(vertex_key(F.lit("user"), "user").alias("src"), vertex_key("object_type", "object_id").alias("dst"), F.col("op").alias("rel"),
                         F.col("cnt").alias("n"), F.lit("user").alias("src_kind"), F.col("user").alias("src_id"), F.col("object_type").alias("dst_kind"), F.col("object_id").alias("dst_id"))
    moved = lineage.select(vertex_key("from_object_type", "from_object_id").alias("src"), vertex_key("to_object_type", "to_object_id").alias("dst"),
                           F.col("relation").alias("rel"), F.lit(1).cast("bigint").alias("n"), F.col("from_object_type").alias("src_kind"),
                           F.col("from_object_id").alias("src_id"), F.col("to_object_type").alias("dst_kind"), F.col("to_object_id").alias("dst_id"))
    merged = used.unionByName(moved).groupBy("src", "dst", "rel", "src_kind", "src_id", "dst_kind", "dst_id").agg(F.sum("n").alias("n"))
    ends = merged.select(F.inline(F.array(*[F.struct(F.col(e).alias("key"), F.col(f"{e}_kind").alias("kind"), F.col(f"{e}_id").alias("id")) for e in ("src", "dst")])))
    own = objects.select(vertex_key("object_type", "object_id").alias("key"), F.col("object_type").alias("kind"), F.col("object_id").alias("id"), "owner")
    every = own.withColumn("known", F.lit(True)).unionByName(ends.withColumn("owner", F.lit("")).withColumn("known", F.col("kind") == "user"))
    vertices = every.groupBy("key").agg(F.max("kind").alias("kind"), F.max("id").alias("id"), F.max(fn.or_empty("owner")).alias("owner"), F.max("known").alias("known"))
    return vertices, merged.select("src", "dst", "rel", "n")
