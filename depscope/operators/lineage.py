"""Lineage payloads to direct edges between data sets, and to a graph."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as fn
from ..session import store
from .dedupe import last_per_key
from .objects import ENTITY_STRUCT
from .skew import PAIRS, product_join, short_or_not, sift, skew_join, tasks_for

LINK_COLUMNS = [
    "payload_id", "proc", "proc_pos", "role", "rel_pos", "guid", "object_type", "own_name",
]
#: What links in a payload's row are.
FOUND = "array<struct<proc:string,proc_pos:int,role:string,rel_pos:int,guid:string,object_type:string,own_name:string>>"
#: Relations times entities of a payload up to which its links are found within its row.
IN_ROW = 4096
#: Different links of a payload up to which ``collapse`` pairs them within its row.
PAIRED_IN_ROW = 128
#: Links of a payload up to which its pairs are made in one place: at most PAIRS of them.
PAYLOAD_LINKS = 2 * isqrt(PAIRS)
#: Tasks that make the edges of one bucket, at most.
BUCKET_PARTS = 1000


def is_process(type_name: Column | str) -> Column:
    return F.lower(fn.or_empty(type_name)).contains("process")


def _links_in_row(relations: Column, guids: Column, processes: Column, entities: Column) -> Column:
    """The links of a payload as an array, by the place ``k`` of their relation.

    ``guids`` are those of the entities, no two alike, and ``processes`` those of its processes.
    """
    def link(role: str, r: Column, proc: str, guid: str) -> Column:
        entity = F.get(entities, F.array_position(guids, r[guid]).cast("int") - 1)
        found = F.struct(r[proc].alias("proc"), F.array_position(guids, r[proc]).cast("int").alias("proc_pos"), F.lit(role).alias("role"), r["k"].alias("rel_pos"),
                         r[guid].alias("guid"), fn.or_empty(entity["object_type"]).alias("object_type"), fn.or_empty(entity["own_name"]).alias("own_name"))
        return F.when(F.array_contains(processes, r[proc]) & (r[guid] != ""), F.array(found)).otherwise(F.array().cast(FOUND))

    return F.flatten(F.transform(relations, lambda r: F.concat(link("in", r, "target", "source"), link("out", r, "source", "target"))))


def slim_payloads(payloads: DataFrame, distinct: bool = False) -> DataFrame:
    """payload_id (bigint), and of each payload its links, or (large ones) relations and entities.

    Stored: parsed once. Links of a payload with up to ``IN_ROW`` relations times entities are
    found in its row, so that nothing of it is shuffled; a larger one would take quadratic time, and one that has
    an entity several times goes with those. ``distinct``: of links in a row that differ by their place only, the first.
    """
    entity = F.transform(F.map_entries("lineage.guidEntityMap"), lambda e: F.struct(
        e["key"].alias("guid"), fn.or_empty(e["value"]["typeName"]).alias("object_type"),
        fn.pick_qualified_name(e["value"]).alias("own_name")))
    relation = F.transform("lineage.relations", lambda r: F.struct(
        fn.or_empty(r["fromEntityId"]).alias("source"), fn.or_empty(r["toEntityId"]).alias("target")))
    # through generators, so that the arrays are made once however often they are read
    parsed = payloads.select(F.monotonically_increasing_id().alias("payload_id"), F.inline(F.array(F.struct(
        relation.alias("relations"), entity.alias("entities"), F.map_keys("lineage.guidEntityMap").alias("guids")))))
    relations, entities, guids = F.col("relations"), F.col("entities"), F.col("guids")
    large = F.coalesce((F.size(relations).cast("bigint") * F.size(entities) > IN_ROW) | (F.size(F.array_distinct(guids)) < F.size(guids)), F.lit(False))
    placed = F.transform(relations, lambda r, k: F.struct(r["source"].alias("source"), r["target"].alias("target"), k.alias("k")))
    if distinct:  # equal relations make equal links but for their place
        placed = F.filter(placed, lambda r: F.array_position(relations, F.struct(r["source"].alias("source"), r["target"].alias("target"))) == r["k"] + 1)
    processes = F.transform(F.filter(entities, lambda e: is_process(e["object_type"])), lambda e: e["guid"])
    parsed = parsed.select("*", F.inline(F.array(F.struct(
        large.alias("large"), F.when(~large, placed).alias("placed"), F.when(~large, processes).alias("processes")))))
    found = _links_in_row(F.col("placed"), guids, F.col("processes"), entities)
    return store(parsed.select(
        "payload_id", F.when(~F.col("large"), found).alias("found"),
        F.when(F.col("large"), relations).alias("relations"), F.when(F.col("large"), entities).alias("entities")), "payloads", compression="zstd")


def links(payloads: DataFrame) -> DataFrame:
    """Relations at process nodes: one row per side that touches a process.

    ``role`` is ``in`` for entity → process and ``out`` for process → entity. The work grows
    with the rows, however many of them one payload has.
    """
    slim = slim_payloads(payloads)
    return slim.select("payload_id", F.inline("found")).select(*LINK_COLUMNS).unionByName(_links_by_joins(slim))


def _links_by_joins(slim: DataFrame) -> DataFrame:
    """Links of large payloads: relations and entities become rows, and meet by payload and guid."""
    slim = slim.where(F.col("relations").isNotNull())
    entities = slim.select("payload_id", F.posexplode("entities").alias("pos", "e")).select("payload_id", "pos", "e.*")
    processes = entities.filter(is_process("object_type")).select(
        "payload_id", F.col("guid").alias("proc"), (F.col("pos") + 1).alias("proc_pos"))
    relations = slim.select("payload_id", F.posexplode("relations").alias("rel_pos", "r"))

    def side(role: str, proc: str, guid: str) -> Column:
        return F.struct(F.col(f"r.{proc}").alias("proc"), F.lit(role).alias("role"), F.col(f"r.{guid}").alias("guid"))

    sides = relations.select("payload_id", "rel_pos", F.inline(F.array(side("in", "target", "source"), side("out", "source", "target"))))
    at_process = sides.filter(F.col("guid") != "").join(processes, ["payload_id", "proc"])
    linked = at_process.join(entities.drop("pos"), ["payload_id", "guid"], "left")
    return linked.withColumns({c: fn.or_empty(c) for c in ("object_type", "own_name")}).select(*LINK_COLUMNS)


def name_map(entities: DataFrame) -> DataFrame:
    """guid → qualified name of the exported entities; the last one with a name wins."""
    named = entities.select(
        "guid", fn.pick_qualified_name(F.struct(*ENTITY_STRUCT)).alias("qualified_name"), "pos"
    ).filter((fn.or_empty("guid") != "") & (F.col("qualified_name") != ""))
    return last_per_key(named, ["guid"], ["pos"]).select("guid", "qualified_name")


def with_names(links: DataFrame, names: DataFrame, own: str = "own_name", distinct: bool = False) -> DataFrame:
    """Add ``name``: the exported entity's, else the payload's own, in column ``own``.

    Done on the links, which grow with the input, and not on the pairs made of them. ``distinct``: equal
    links come out once. The name follows from the link, so names need not move to tell them apart.
    """
    joined = skew_join(links, names, ["guid"], "left", distinct=distinct)
    return joined.withColumn("name", F.coalesce("qualified_name", own)).drop("qualified_name")


def _sides(links: DataFrame) -> list[DataFrame]:
    """Inputs and outputs of processes, their columns named by the side."""
    def side(role: str, prefix: str) -> DataFrame:
        kept = links.filter(F.col("role") == role).drop("role")
        if role == "out":
            kept = kept.drop("proc_pos")  # the input side has it already
        shared = ("payload_id", "proc", "proc_pos")
        return kept.withColumnsRenamed({
            c: f"{prefix}_{c}" for c in kept.columns if c not in shared})

    return [side("in", "src"), side("out", "dst")]


def _work(links: DataFrame) -> tuple[dict[bool, int], float]:
    """Links of ordinary and of crowded payloads, and the pairs that all make at most."""
    sizes = links.groupBy("payload_id").agg(F.count("*").alias("n"), F.count_if(F.col("role") == "in").alias("ins"))
    work = sizes.groupBy((F.col("n") > PAYLOAD_LINKS).alias("crowded")).agg(
        F.sum("n").alias("n"), F.sum(F.col("ins").cast("double") * (F.col("n") - F.col("ins"))).alias("pairs"))
    rows = store(work, "link_counts").collect()  # two rows
    return {r.crowded: r.n for r in rows}, sum(r.pairs for r in rows)


def _by_payload(
    links: DataFrame, of_each: Callable[[DataFrame], DataFrame], distinct: bool = False, n: dict[bool, int] | None = None, placed: bool = False,
) -> DataFrame:
    """``of_each`` applied to the pairs of the links' processes, whole payloads at a time.

    Links move once, to a place by their payload, where all that is grouped by payload follows
    without another shuffle; ``PAYLOAD_LINKS`` of one payload make at most ``skew.PAIRS`` pairs. ``distinct``: links
    that come several times make their pairs once. ``n``: what ``_work`` counted. ``placed``: pairs have their
    place in ``_place``, and what is grouped by it follows in the same tasks.
    Payloads with more are counted first, and the pairs of their processes made by ``product_join``.
    """
    spark = links.sparkSession
    links = links.where(F.col("payload_id").isNotNull())
    n = n or _work(links)[0]
    tasks = tasks_for(spark, n.get(False))
    place = F.pmod(F.xxhash64("payload_id"), F.lit(tasks)).cast("int")

    def near(rows: DataFrame) -> DataFrame:
        if placed:
            left, right = (side.withColumn("_place", place).repartitionById(tasks, "_place") for side in _sides(rows))
        else:
            left, right = (side.repartition(tasks, "payload_id") for side in _sides(rows))
        if distinct:
            left, right = left.distinct(), right.distinct()
        return of_each(left.join(right, ["_place"] * placed + ["payload_id", "proc"]).filter(F.col("src_guid") != F.col("dst_guid")))

    if True not in n:
        return near(links)
    crowded = links.groupBy("payload_id").agg(F.count("*").alias("n")).where(F.col("n") > PAYLOAD_LINKS).select("payload_id")
    crowded, _ = short_or_not(store(crowded, "crowded"))
    many = links.join(crowded, "payload_id", "left_semi")
    far = product_join(*_sides(store(many.distinct(), "many_links") if distinct else many), ["payload_id", "proc"]).filter(F.col("src_guid") != F.col("dst_guid"))
    if placed:
        far = far.withColumn("_place", place)
    return near(links.join(crowded, "payload_id", "left_anti")).unionByName(of_each(far))


def two_hop(links: DataFrame) -> DataFrame:
    """entity → process → entity: every input of a process with every output of it.

    A process with many of both is cut into a grid of tasks by the pairs it makes.
    """
    return _by_payload(links, lambda pairs: pairs)


def both_directions(pairs: DataFrame) -> DataFrame:
    """Each (src, dst, …) as ``src WRITES_TO dst`` and ``dst READS_FROM src``.

    Columns ``src_*`` and ``dst_*`` swap with their end; ``rel`` names the direction.
    """
    ends = [c[4:] for c in pairs.columns if c.startswith("src_")]
    other = [c for c in pairs.columns if not c.startswith(("src_", "dst_"))]

    def row(a: str, b: str, rel: str) -> Column:
        return F.struct(
            *[F.col(f"{a}_{e}").alias(f"from_{e}") for e in ends],
            *[F.col(f"{b}_{e}").alias(f"to_{e}") for e in ends], F.lit(rel).alias("rel"))

    rows = F.array(row("src", "dst", "WRITES_TO"), row("dst", "src", "READS_FROM"))
    return pairs.select(*other, F.inline(rows))


def distinct_links(links: DataFrame, rows: int | None = None) -> DataFrame:
    """One link per payload, process, side and entity; fewer links make fewer pairs.

    Everything but the position depends on the entity, so it can be part of the key and
    the aggregate stays a hash aggregate. ``rows``: about how many links there are, if that is
    known; tasks then get so few of them that the aggregate needs no disk.
    """
    keys = [c for c in links.columns if c != "rel_pos"]
    if rows is not None:
        links = links.repartition(tasks_for(links.sparkSession, rows), *keys)
    return links.groupBy(*keys).agg(F.min("rel_pos").alias("rel_pos"))


def collapse(payloads: DataFrame, entities: DataFrame, dedupe: str = "triple") -> DataFrame:
    """Direct edges by qualified name, deduplicated within each payload.

    ``triple`` keeps one row per (from, to, relation). ``pair`` keeps one row per
    (from, to), whichever relation comes first, as the CSV export has it.

    Payload texts are parsed once only. Payloads of up to ``PAIRED_IN_ROW`` different links stay
    one row each: only their GUIDs move to the names, and what is found moves back. The links of
    larger ones are rows, stored before and after they get their names.
    """
    slim, names = slim_payloads(payloads, distinct=True), store(name_map(entities), "names")
    near = slim.where(F.col("found").isNotNull()).select("payload_id", "found")
    few = F.size("found") <= PAIRED_IN_ROW
    wide = near.where(~few).select("payload_id", F.inline("found")).select(*LINK_COLUMNS)
    kept = _distinct_pairs(_named_pairs(near.where(few), names), dedupe)
    large = store(distinct_links(_links_by_joins(slim)).unionByName(wide), "links")
    if not large.isEmpty():
        named = store(with_names(large, names), "named_links").filter(F.col("name") != "")
        kept = kept.unionByName(_by_payload(named, lambda pairs: _distinct_pairs(pairs, dedupe)))
    return _lineage_rows(kept, dedupe)


def _named_pairs(near: DataFrame, names: DataFrame) -> DataFrame:
    """Pairs of named links at one process, from payloads (payload_id, found)."""
    tasks = tasks_for(near.sparkSession, near.agg(F.sum(F.size("found")).alias("n")).first().n)
    guids = near.select("payload_id", F.explode(F.array_distinct(F.transform("found", lambda x: x["guid"]))).alias("guid"))
    known = skew_join(guids, names, ["guid"]).repartition(tasks, "payload_id").groupBy("payload_id").agg(
        F.map_from_entries(F.collect_list(F.struct("guid", "qualified_name"))).alias("names"))
    named = near.repartition(tasks, "payload_id").join(known, "payload_id", "left").select("payload_id", F.inline(F.array(F.struct(F.filter(F.transform(
        "found", lambda x: x.withField("name", F.coalesce(F.try_element_at("names", x["guid"]), x["own_name"]))), lambda x: x["name"] != "").alias("found")))))

    def pair(x: Column, y: Column) -> Column:
        ends = [end[c].alias(f"{prefix}_{c}") for end, prefix in ((x, "src"), (y, "dst")) for c in ("rel_pos", "guid", "object_type", "name")]
        return F.struct(x["proc_pos"].alias("proc_pos"), *ends)

    outputs = F.filter("found", lambda x: x["role"] == "out")
    pairs = F.flatten(F.transform(F.filter("found", lambda x: x["role"] == "in"), lambda x: F.transform(
        F.filter(outputs, lambda y: (y["proc"] == x["proc"]) & (y["guid"] != x["guid"])), lambda y: pair(x, y))))
    return named.select("payload_id", F.inline(pairs))


def edges_from_links(named: DataFrame, dedupe: str = "triple") -> DataFrame:
    """Named links to lineage rows; see ``collapse``.

    Pairs are deduplicated before they are turned into two rows each. In ``pair`` mode
    the first pair of two names takes both directions, whichever way round it is, so one
    aggregate on the unordered names is enough.
    """
    # a link without a name can never give a row
    return _lineage_rows(_by_payload(named.filter(F.col("name") != ""), lambda pairs: _distinct_pairs(pairs, dedupe)), dedupe)


def _distinct_pairs(pairs: DataFrame, dedupe: str) -> DataFrame:
    source, target = F.col("src_name"), F.col("dst_name")
    if dedupe == "triple":
        keys = [source.alias("a"), target.alias("b")]
    elif dedupe == "pair":
        keys = [F.least(source, target).alias("a"), F.greatest(source, target).alias("b")]
    else:
        raise ValueError(f"unknown dedupe mode: {dedupe}")
    first = F.min_by(
        F.struct("src_name", "dst_name", "src_object_type", "dst_object_type"),
        F.struct("proc_pos", "src_rel_pos", "dst_rel_pos")).alias("pair")
    return pairs.groupBy("payload_id", *keys).agg(first).select("payload_id", "pair.*")


def _lineage_rows(kept: DataFrame, dedupe: str) -> DataFrame:
    rows = both_directions(kept)
    if dedupe == "pair":
        # two data sets of one name: the reverse is the same pair again
        rows = rows.filter(~((F.col("from_name") == F.col("to_name")) & (F.col("rel") == "READS_FROM")))
    return rows.select(
        "payload_id",
        F.col("from_object_type"), F.col("from_name").alias("from_object_id"),
        F.col("to_object_type"), F.col("to_name").alias("to_object_id"),
        F.col("rel").alias("relation"))


# --- graph tables ---

def vertices(entities: DataFrame) -> DataFrame:
    """Graph nodes; the last record of a guid wins.

    ``raw`` is the landed record where the source kept it, else the known fields.
    """
    e = F.struct(*ENTITY_STRUCT)
    raw = F.substring("raw", 1, 65000) if "raw" in entities.columns else fn.json_trim(e)
    nodes = entities.select(
        "guid", "typeName", fn.pick_qualified_name(e).alias("qualifiedName"),
        fn.pick_name(e).alias("name"), raw.alias("raw"), "pos"
    ).filter(F.col("guid").isNotNull())
    return last_per_key(nodes, ["guid"], ["pos"]).drop("pos")


def pair_bucket(a: str, b: str, buckets: int) -> Column:
    """Bucket of an edge, the same for both of its directions; edges of a hub lie in all buckets."""
    return F.pmod(F.xxhash64(F.least(a, b), F.greatest(a, b)), F.lit(buckets)).cast("int")


def edges_by_guid(links: DataFrame, buckets: int | None = None) -> DataFrame:
    """Distinct (src, dst, rel) between guids, over all payloads.

    ``buckets``: each task's edges lie in one ``pair_bucket``, in tasks of about ``skew.PAIRS`` pairs, so that
    tables by bucket are written as they lie, in an order in which they are small. Pairs then are told apart where they are made first, and move once.
    """
    slim = links.select("payload_id", "proc", "role", "guid").where(F.col("payload_id").isNotNull())
    n, most = _work(slim)
    if buckets is None:
        pairs = _by_payload(slim, lambda pairs: pairs.select("src_guid", "dst_guid"), distinct=True, n=n).distinct()
    else:
        made = _by_payload(slim, lambda pairs: pairs.select("_place", "src_guid", "dst_guid").distinct(), distinct=True, n=n, placed=True)
        parts = max(1, min(-(-int(most) // (buckets * PAIRS)), BUCKET_PARTS))
        at = pair_bucket("src_guid", "dst_guid", buckets) * parts + F.pmod(F.hash("src_guid", "dst_guid"), F.lit(parts))
        pairs = made.drop("_place").withColumn("_at", at).repartitionById(buckets * parts, "_at").distinct().drop("_at").sortWithinPartitions("src_guid")
    return both_directions(pairs).select(
        F.col("from_guid").alias("src"), F.col("to_guid").alias("dst"), "rel")


def connected_links(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links whose entity is a known node. Runs jobs, over links that should be stored.

    An edge has both ends in the graph exactly if both of its links do. Links grow with
    the input and edges with its square, so the test belongs here. Most entities are known: only GUIDs
    move to find those that are not, and links stay where they are but for those that a bitmap of them lets through.
    """
    guids = nodes.select("guid").distinct()
    unknown = store(links.select("guid").distinct().join(guids, "guid", "left_anti"), "unknown_guids")
    surely, perhaps = sift(links, unknown, ["guid"])
    if surely is None:
        return skew_join(links, guids, ["guid"], "left_semi").select(*links.columns)
    # stored, since the optimizer would test all links before it sifts them
    return surely.unionByName(skew_join(store(perhaps, "links_to_test", compression="zstd"), guids, ["guid"], "left_semi"))


def graph(payloads: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges between known nodes, from payloads. The links are stored on the way."""
    slim = links(payloads).select("payload_id", "proc", "role", "guid").distinct()
    return edges_by_guid(store(connected_links(store(slim, "links", compression="zstd"), nodes), "graph_links", compression="zstd"))


def connected_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Given edges whose both ends are known nodes; hubs are split."""
    guids = nodes.select("guid").distinct()
    for end in ("src", "dst"):
        edges = skew_join(edges, guids.withColumnRenamed("guid", end), [end], "left_semi")
    return edges.select("src", "dst", "rel")
