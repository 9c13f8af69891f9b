"""Queries over several producers: enriched access, united objects, object graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import combined, lineage, objects
from .lineage_queries import OBJECTS, PAIRS_LINKS, ROWS, _named_links
from .object_queries import DESCRIBED, EXTRA, HIVE_ROW, LISTED, LISTING_OBJECTS, _described
from .registry import query

# --- the checking side ---

HIVE_OBJECTS = f"""select {HIVE_ROW}, owner, '' as "group", {EXTRA} as extra from j"""
STORED = f"""{LISTED}, lo as ({LISTING_OBJECTS.removeprefix(LISTED)}), {DESCRIBED.lstrip().removeprefix(',')}, ho as ({HIVE_OBJECTS}),
ob as (select * from lo union all select * from ho)
"""
PLAIN = "rtrim(regexp_replace(regexp_replace(trim({}), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '/+', '/', 'g'), '/')"
PLACES = STORED + f""", whereabouts as (select case when object_type = 'hdfs_path' then 'path:' || {PLAIN.format("object_id")} else object_type || ':' || object_id end as place,
    service, object_type, object_id, owner from ob
  union select 'path:' || {PLAIN.format("regexp_extract(extra, 'location=([^|]*)', 1)")}, service, object_type, object_id, owner from ob where contains(extra, 'location=')),
places as (select place, min(struct_pack(a := service, b := object_type, c := object_id, d := owner)) as o from whereabouts group by place),
ids as (select distinct object_type as t, object_id as i, case when object_type = 'hdfs_path' then 'path:' || {PLAIN.format("object_id")}
    else object_type || ':' || object_id end as own from v_touched),
best as (select t, i, arg_max(o, length(place)) as o, arg_max(place, length(place)) as place from ids join places
    on own = place or (place like 'path:%' and starts_with(own, place || '/')) group by t, i)
"""
ENRICHED = PLACES + """select usr as "user", op, object_type, object_id, cnt, o.a as matched_service, o.b as matched_type, o.c as matched_id,
  o.d as matched_owner, place as matched_place from v_touched left join best on t = object_type and i = object_id"""


def _ranked(field: str) -> str:
    order = combined.PRECEDENCE[field]
    rank = "case producer " + " ".join(f"when '{name}' then {k}" for k, name in enumerate(order)) + " end"
    return f"""coalesce(min(struct_pack(r := {rank}, v := "{field}")) filter (where coalesce("{field}", '') <> '').v, '') as "{field}\""""


UNITED = STORED + f""", every as (select *, 'storage' as producer from lo union all select *, 'hive' from ho
  union all select {HIVE_ROW}, '', '', '', 'hive_list' from v_hive_tables union all select *, 'catalog' from ({OBJECTS}))
select object_type, object_id, {', '.join(_ranked(f) for f in combined.PRECEDENCE)},
  array_to_string(list_sort(list(distinct producer)), ',') as producers from every group by object_type, object_id"""

GRAPH = STORED + f"""{PAIRS_LINKS}, li as (select distinct payload_id, {ROWS[7:]} from both_ways),
e as (select 'user' as sk, usr as si, object_type as dk, object_id as di, op as rel, cnt as n from v_touched
  union all select from_object_type, from_object_id, to_object_type, to_object_id, relation, 1 from li),
edges as (select sk || '|' || si as src, dk || '|' || di as dst, rel, sum(n)::bigint as n from e group by all),
v as (select object_type || '|' || object_id as key, owner, true as known from ob
  union all select sk || '|' || si, '', sk = 'user' from e union all select dk || '|' || di, '', dk = 'user' from e)
select 'vertex' as part, key as src, max(owner) as dst, cast(bool_or(known) as varchar) as rel, null::bigint as n from v group by key
union all select 'edge', src, dst, rel, n from edges"""


def _stored(i):
    return objects.from_listing(i.listing()), objects.from_hive(_described(i))


def _touched(i):
    return i.view("touched").withColumnRenamed("usr", "user")


# --- queries ---

@query("x_access_enrich", ENRICHED, "touched", "listing", "describe_lines=described_lines", "hive_tables")
def _(i):
    storage, hive = _stored(i)
    return combined.enrich_access(_touched(i), storage.unionByName(hive))


@query("x_union_model", UNITED, "entities", "listing", "describe_lines=described_lines", "hive_tables")
def _(i):
    storage, hive = _stored(i)
    return combined.union_objects({"storage": storage, "hive": hive, "hive_list": objects.from_hive_list(i.hive_tables()),
                                   "catalog": objects.from_entities(i.entities())})


@query("x_object_graph", GRAPH, "touched", "listing", "describe_lines=described_lines", "hive_tables", "links")
def _(i):
    storage, hive = _stored(i)
    vertices, edges = combined.object_graph(storage.unionByName(hive), _touched(i), lineage.edges_from_links(_named_links(i)))
    return vertices.select(F.lit("vertex").alias("part"), F.col("key").alias("src"), F.col("owner").alias("dst"), F.col("known").cast("string").alias("rel"),
                           F.lit(None).cast("bigint").alias("n")).unionByName(edges.select(F.lit("edge").alias("part"), "src", "dst", "rel", "n"))
