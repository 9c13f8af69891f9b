"""Audit: sources, filters, normalising, aggregates, time windows, scalars and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import functions as fn, sinks, sources
from ..operators import audit
from ..streaming import current_summary, update_summary
from .registry import query

# --- the checking side: events recomputed from the view ---

NOISE = r"""(trim(path) <> '' and (string_split(trim(path), '/')[-1] = '_SUCCESS' or regexp_matches(lower(trim(path)),
 '/_success|/\.trash/|/\.staging/|/tmp/|_spark_metadata|_temporary|\.crc$|/_committed_|\b_committed_|\.sparkstaging')))"""
DIR = r"""case when trim(path) = '' then '' when trim(path) like '%/' then trim(path)
 else regexp_replace(regexp_extract(trim(path), '^(.*/)[^/]*$', 1), '([^/])/+$', '\1/') end"""
OP = """case when lower(trim(access)) in ('write','update','create','delete','alter','drop','truncate','append',
 'rename','setpermission','setowner','mkdir','rmdir','move') or lower(trim(action)) in ('write','update','create',
 'delete','alter','drop','truncate','append','rename','setpermission','setowner','mkdir','rmdir','move') then 'WRITE'
 when lower(trim(access)) in ('read','open','list','get','getfileinfo','getfilestatus','liststatus','stat','content',
 'execute') or lower(trim(action)) in ('read','open','list','get','getfileinfo','getfilestatus','liststatus','stat',
 'content','execute') then 'READ'
 when regexp_matches(lower(access), 'write|create|delete|append|rename|alter|drop') then 'WRITE' else 'READ' end"""
RESULT = """case when trim(outcome) in ('1','true','True','allowed','ALLOW') then 'ALLOWED'
 when trim(outcome) in ('0','false','False','denied','DENY') then 'DENIED' else trim(outcome) end"""
EV = f""", ev as (select event_id, ts_form,
  case when ts_form = 0 then raw_time else iso_time end as event_ts,
  case when ts_form <> 0 then to_timestamp(evt_ms // 1000) at time zone 'UTC' end as t,
  repo as service, usr as "user", coalesce(proxy, '') as do_as, coalesce(ugi, '') as ugi, ip as client_ip,
  host as client_host, access as access_type, action, {OP} as op, {RESULT} as result,
  cast(policy as varchar) as policy_id, path as resource, {DIR} as dir, coalesce(app, '') as app_name,
  request as request_data, src as source_file from v_audit where not {NOISE})
"""
ISO = "'%Y-%m-%dT%H:%M:%SZ'"


def bucket(n: int) -> str:
    return (f"coalesce(strftime(date_trunc('hour', t) + to_minutes(cast(minute(t) - minute(t) % {n} as bigint)),"
            f" {ISO}), '')")


def short(depth: int, column: str = "dir") -> str:
    return (f"case when {column} = '' then '' else '/' || array_to_string(list_slice(string_split("
            f"trim({column}, '/'), '/'), 1, {depth}), '/') || '/' end")


OBJECT_TYPE = """case when contains(lower(service), 'hdfs') then 'hdfs_path' when contains(lower(service), 'hive')
 then 'hive_table' when contains(lower(service), 'kudu') then 'kudu_table' when contains(lower(service), 'impala')
 then 'hive_table' when contains(lower(service), 'yarn') or contains(lower(service), 'spark') then 'application'
 else 'unknown' end"""
SUMMARY = EV + f"""select {bucket(30)} as window_start, service, "user", do_as, ugi, client_ip, op, dir as resource_norm,
  min(event_ts) as first_seen, max(event_ts) as last_seen, count(*) as cnt from ev group by all"""
METADATA = "lower(trim(access_type)) not in ('getfileinfo','liststatus','getfilestatus')"


def dependency_sql(window: str, keys: str = "", shown: str = "", depth: int = 3, where: str = METADATA) -> str:
    object_id = short(depth) if depth else "dir"
    return EV + f""", d as (select {window} as window_start, *, {object_id} as object_id from ev where {where})
select window_start, service, "user", do_as, op, {OBJECT_TYPE} as object_type, object_id{shown}, count(*) as cnt
from d group by window_start, service, "user", do_as, op, object_id{keys}"""


DAILY = "coalesce(strftime(t, '%Y-%m-%d'), '')"
# the shown address and application: those of the earliest event of the group
SAMPLED = EV + f""", d as (select {DAILY} as window_start, *, {short(3)} as object_id from ev where {METADATA}),
r as (select *, row_number() over (partition by window_start, service, "user", do_as, op, object_id
    order by event_ts, source_file, client_ip, app_name) as rn,
  count(*) over (partition by window_start, service, "user", do_as, op, object_id) as cnt from d)
select window_start, service, "user", do_as, client_ip, app_name, op, {OBJECT_TYPE} as object_type, object_id, cnt
from r where rn = 1"""


# --- sources ---

FIRST, LAST = dt.date(2024, 1, 5), dt.date(2024, 1, 20)


def _landed_requests(df):
    """Where each record was found: service and date folder, and its request text."""
    folder = F.split("source_file", "/")
    found = audit.parse(df.select("line", "source_file")).filter("record is not null")
    return found.select(
        F.element_at(folder, -3).alias("service"), F.element_at(folder, -2).alias("day"),
        audit._text("request_data").alias("request"))


LANDED = "select repo as service, day8 as day, request from v_audit where "


@query("scan_audit_pruned", LANDED + "day8 between '20240105' and '20240120'", "audit")
def _(i):
    return _landed_requests(sources.audit_lines(i.spark, i.audit_root(), FIRST, LAST))


@query("scan_services_filter",
       LANDED + "day8 between '20240105' and '20240120' and repo in ('cm_hive', 'cm_yarn')", "audit")
def _(i):
    return _landed_requests(sources.audit_lines(
        i.spark, i.audit_root(), FIRST, LAST, services=["cm_hive", "cm_yarn", "CM_HDFS"]))


@query("scan_date_range_default",
       LANDED + "day8 between '20240102' and '20240201'", "audit")
def _(i):
    first, last = sources.date_range(None, None, today=dt.date(2024, 2, 1), months=1)
    return _landed_requests(sources.audit_lines(i.spark, i.audit_root(), first, last))


FIRST_FILES = """, f as (select distinct repo, day8 from v_audit where day8 between '20240105' and '20240120'
  order by repo, day8 limit 5) select repo as service, day8 as day, request from v_audit join f using (repo, day8)"""


@query("scan_max_files", FIRST_FILES, "audit")
@query("limit_max_files", FIRST_FILES, "audit")
def _(i):
    return _landed_requests(sources.audit_lines(i.spark, i.audit_root(), FIRST, LAST, max_files=5))


@query("scan_json_lines", """select request, true as good from v_audit union all
  select '' as request, false as good from v_audit where event_id % 19 = 0 union all
  select '', false from v_audit where event_id % 29 = 0""", "audit")
def _(i):
    parsed = audit.parse(i.audit_lines())
    return parsed.select(
        audit._text("request_data").alias("request"), F.col("record").isNotNull().alias("good"))


FLAT = """, flat as (select
  case when ts_form > 0 then epoch_us(ts) // 1000 end as ms,
  case when event_id % 15 <> 0 then repo end as service, usr as "user", ip as client_ip,
  case when event_id % 2 = 0 then trim(access) else access end as access_type, outcome as result,
  path as resource, request as request_data from v_audit),
fe as (select make_timestamp(ms * 1000) as event_ts, strftime(make_timestamp(ms * 1000), '%Y-%m-%d') as ds, *
  from flat)
"""


def _either(column: str, one: str, other: str, first: str | None = None) -> str:
    return (f"""case when event_id % 2 = 0 then {first or column} end as "{one}", """
            f"""case when event_id % 2 <> 0 then {column} end as "{other}\"""")


@query("scan_json_inferred", f"""select case when ts_form > 0 then cast(evt_ms as double) end as "evtTime",
  case when event_id % 15 <> 0 then repo end as "repoName", {_either("usr", "user", "reqUser")}, {_either("ip", "clientIP", "cliIP")},
  {_either("access", "accessType", "access", "trim(access)")}, {_either("outcome", "result", "accessResult")},
  {_either("path", "resourcePath", "resourceName")}, request as "requestData" from v_audit""", "audit")
def _(i):
    return i.flat_records()


# --- filters ---

@query("filter_noise_path", f"select event_id, path from v_audit where not {NOISE}", "audit")
def _(i):
    return audit.drop_noise(i.view("audit"), "path").select("event_id", "path")


@query("filter_noise_dir", f""", d as (select event_id, {DIR} as dir from v_audit)
  select event_id, dir from d where not {NOISE.replace('path', 'dir')}""", "audit")
def _(i):
    dirs = i.view("audit").select("event_id", fn.parent_dir("path").alias("dir"))
    return audit.drop_noise(dirs, "dir")


@query("filter_ops_exclude", EV + f"select event_id, access_type from ev where {METADATA}", "audit")
def _(i):
    kept = audit.exclude_ops(i.events())
    return kept.select(F.substring_index("request_data", " ", -1).cast("bigint").alias("event_id"), "access_type")


@query("filter_json_shape", """select src as source_file, count(*) as json_lines, count(*) filter (event_id % 20 = 0)
  as padded from (select src, event_id from v_audit union all
  select src, 1 as event_id from v_audit where event_id % 19 = 0 union all
  select src, 1 from v_audit where event_id % 29 = 0) group by src""", "audit")
def _(i):
    return audit.keep_json_shape(i.audit_lines()).groupBy("source_file").agg(
        F.count("*").alias("json_lines"), F.count_if(F.col("line") != fn.strip_line("line")).alias("padded"))


# --- events ---

NORMALIZED = EV + """select event_ts, service, "user", do_as, ugi, client_ip, client_host, access_type,
  action, op, result, policy_id, resource, dir as resource_dir, dir as resource_norm,
  case when dir = '' then '' else sha1(dir) end as resource_hash, app_name, request_data,
  sha1(request_data) as request_hash, source_file from ev"""


@query("audit_normalize", NORMALIZED, "audit")
def _(i):
    return audit.event_rows(i.events())


FLAT_EVENTS = FLAT + """select ds, event_ts, service, "user", client_ip, access_type, result, resource, request_data
  from fe"""


@query("audit_normalize_parquet", FLAT_EVENTS, "audit")
def _(i):
    return audit.flat_events(i.flat_records())


# --- aggregates ---

@query("agg_summary", SUMMARY, "audit")
def _(i):
    return audit.summary(i.landed_events())


@query("agg_dependency", dependency_sql(DAILY), "audit")
def _(i):
    return audit.dependency(i.landed_events()).drop("client_ip", "app_name")


@query("agg_dependency_ip", dependency_sql(DAILY, ", client_ip", ", client_ip"), "audit")
def _(i):
    return audit.dependency(i.landed_events(), include_ip=True).drop("app_name")


@query("agg_dependency_app", dependency_sql(DAILY, ", app_name", ", app_name"), "audit")
def _(i):
    return audit.dependency(i.landed_events(), include_app=True).drop("client_ip")


@query("agg_sample_value", SAMPLED, "audit")
def _(i):
    return audit.dependency(i.landed_events())


@query("agg_edges_daily", FLAT + """select ds, service, "user", client_ip, resource,
  case when lower(access_type) in ('write','update','create','delete','alter','drop','put','add') then 'WRITE'
    else 'READ' end as op, count(*) as cnt, max(event_ts) as last_seen, min(event_ts) as first_seen
  from fe group by all""", "audit")
def _(i):
    return audit.flat_edges(audit.flat_events(i.flat_records()))


@query("agg_merge_partials", SUMMARY, "audit")
def _(i):
    # one stored summary per source file, then the files together
    def write(path):
        events = i.landed_events()
        files = events.withColumn("service", F.concat_ws("\x00", "source_file", "service"))
        partial = audit.summary(files)
        named = F.split("service", "\x00")
        partial.withColumn("file", named[0]).withColumn("service", named[1]).write.parquet(path)
    return audit.merge_summaries(i.spark.read.parquet(i.landed("partials", write)))


@query("x_incremental", SUMMARY, "audit")
def _(i):
    # lines arrive in no order, so that each batch after the first touches days already stored
    def write(path):
        dealt = i.audit_json().select("line", F.pmod(F.xxhash64("line"), F.lit(3)).alias("part"))
        dealt.write.partitionBy("part").text(path)
    arrived, out = i.landed("arrived_lines", write), i.scratch("followed")
    files = i.spark.read.format("binaryFile").option("recursiveFileLookup", True).load(arrived).select("path").count()
    update_summary(i.spark, arrived, out, max_files=-(-files // 3)).awaitTermination()
    return current_summary(i.spark, out)


@query("agg_run_counters", f"""select count(*) filter (not {NOISE}) as events, count(*) filter ({NOISE}) as filtered,
  count(*) filter (event_id % 19 = 0) + count(*) filter (event_id % 29 = 0) as bad_json,
  count(distinct src) as files from v_audit""", "audit")
def _(i):
    return audit.counters(i.audit_lines())


# --- time windows ---

@query("bucket_minutes", EV + "select event_id, " + ", ".join(
    f"{bucket(n)} as every_{n}" for n in (7, 30, 45, 90)) + " from ev", "audit")
def _(i):
    return i.landed_events().select(
        F.substring_index("request_data", " ", -1).cast("bigint").alias("event_id"),
        *[fn.or_empty(fn.iso(fn.floor_minutes("event_time", n))).alias(f"every_{n}") for n in (7, 30, 45, 90)])


WINDOWS = {
    "none": "''", "daily": DAILY, "monthly": "coalesce(strftime(t, '%Y-%m'), '')",
    "1h": f"coalesce(strftime(date_trunc('hour', t), {ISO}), '')",
    "6h": f"coalesce(strftime(date_trunc('day', t) + to_hours(cast(hour(t) - hour(t) % 6 as bigint)), {ISO}), '')",
    "30m": bucket(30),
}


def _register_windows():
    for unit, sql in WINDOWS.items():
        def build(i, unit=unit):
            return audit.dependency(i.landed_events(), window=unit, depth=2).drop("client_ip", "app_name")
        query(f"bucket_dep_{unit}", dependency_sql(sql, depth=2), "audit")(build)


_register_windows()


@query("bucket_ds", "select event_id, strftime(ts, '%Y-%m-%d') as ds from v_audit", "audit")
def _(i):
    return i.view("audit").select("event_id", fn.day("ts").alias("ds"))


@query("bucket_dep_exact", dependency_sql(f"coalesce(strftime(t, {ISO}), '')", depth=0, where="true"), "audit")
def _(i):
    return audit.dependency(i.landed_events(), window="exact", depth=0, ops=[]).drop("client_ip", "app_name")


# --- sorted outputs ---

@query("sort_summary", SUMMARY, "audit")
def _(i):
    from ..model import SUMMARY_KEYS
    return audit.summary(i.landed_events()).orderBy(*SUMMARY_KEYS)


@query("sort_dependency", dependency_sql(DAILY), "audit")
def _(i):
    return audit.dependency(i.landed_events()).orderBy(*sinks.DEPENDENCY_SORT).drop("client_ip", "app_name")


# --- sinks: what a reader finds after the write ---

def _csv(i, path):
    options = {"header": "true", "escape": '"', "multiLine": "true", "lineSep": "\r\n", "inferSchema": "false"}
    return i.spark.read.options(**options).csv(path).na.fill("")


@query("sink_events_csv", NORMALIZED, "audit")
def _(i):
    path = i.scratch("events_csv")
    sinks.write_events(i.landed_events(), path)
    schema = ", ".join(f"`{c}` string" for c in sinks.EVENT_COLUMNS)
    options = {**sinks.CSV_OPTIONS, "nullValue": "\0"}
    return i.spark.read.schema(schema).options(**options).csv(path).na.fill("")


@query("sink_summary_csv", EV + f"""select {bucket(30)} as window_start, service, "user", do_as, ugi, client_ip, op,
  dir as resource_norm, min(event_ts) as first_seen, max(event_ts) as last_seen, cast(count(*) as varchar) as cnt
  from ev group by all""", "audit")
def _(i):
    path = i.scratch("summary_csv")
    sinks.write_summary(audit.summary(i.landed_events()), path)
    return _csv(i, path)


@query("sink_dependency_csv",
       SAMPLED.replace("object_id, cnt\nfrom r", "object_id, cast(cnt as varchar) as cnt\nfrom r"), "audit")
def _(i):
    path = i.scratch("dependency_csv")
    sinks.write_dependency(audit.dependency(i.landed_events()), path)
    return _csv(i, path)


@query("sink_parquet_events", FLAT_EVENTS, "audit")
def _(i):
    path = i.scratch("flat_events")
    flat = audit.flat_events(i.flat_records())
    sinks.write_partitioned(flat, path)
    sinks.write_partitioned(flat, path)  # a rerun replaces its partitions
    return i.spark.read.schema(flat.schema).parquet(path).select(flat.columns)


@query("sink_parquet_edges", FLAT + """select ds, service, "user", client_ip, resource,
  case when lower(access_type) in ('write','update','create','delete','alter','drop','put','add') then 'WRITE'
    else 'READ' end as op, count(*) as cnt, max(event_ts) as last_seen, min(event_ts) as first_seen
  from fe group by all""", "audit")
def _(i):
    path = i.scratch("flat_edges")
    edges = audit.flat_edges(audit.flat_events(i.flat_records()))
    sinks.write_partitioned(edges, path)
    return i.spark.read.schema(edges.schema).parquet(path).select(edges.columns)


# --- scalars ---

@query("fn_extract_first", "select event_id, coalesce(nullif(proxy, ''), nullif(app, ''), nullif(action, '')) as found "
       "from v_audit", "audit")
def _(i):
    return i.view("audit").select("event_id", fn.first_present("proxy", "app", "action").alias("found"))


@query("fn_safe_str", "select doc_id, substr(coalesce(text, ''), 1, 4000) as cut from documents")
def _(i):
    return i.table("documents").select("doc_id", fn.safe_str("text").alias("cut"))


@query("fn_epoch_to_iso", """select event_id,
  strftime(to_timestamp(evt_ms // 1000) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as from_ms,
  strftime(to_timestamp(event_id * 86399) at time zone 'UTC', '%Y-%m-%dT%H:%M:%SZ') as from_seconds,
  raw_time as from_text, '' as from_null from v_audit""", "audit")
def _(i):
    return i.view("audit").select(
        "event_id", fn.epoch_to_iso(F.col("evt_ms").cast("string")).alias("from_ms"),
        fn.epoch_to_iso((F.col("event_id") * 86399).cast("string")).alias("from_seconds"),
        fn.epoch_to_iso("raw_time").alias("from_text"),
        fn.epoch_to_iso(F.when(F.col("event_id") < 0, F.col("raw_time"))).alias("from_null"))


@query("fn_parse_iso_strict", """select event_id, case when ts_form = 1 then strftime(ts, '%Y-%m-%d %H:%M:%S') end as parsed
  from v_audit""", "audit")
def _(i):
    text = F.when(F.col("ts_form") == 1, F.col("iso_time")).otherwise(F.col("raw_time"))
    return i.view("audit").select(
        "event_id", F.date_format(fn.parse_iso(text), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("fn_parse_yyyymmdd", "select event_id, cast(strptime(day8, '%Y%m%d') as date) as day from v_audit", "audit")
def _(i):
    return i.view("audit").select("event_id", fn.yyyymmdd("day8").alias("day"))


@query("fn_infer_op", f"select event_id, {OP} as op from v_audit", "audit")
def _(i):
    return i.view("audit").select("event_id", fn.infer_op("access", "action").alias("op"))


@query("fn_infer_op_parquet", """select event_id, case when lower(access) in ('write','update','create','delete','alter',
  'drop','put','add') then 'WRITE' else 'READ' end as op from v_audit""", "audit")
def _(i):
    return i.view("audit").select("event_id", fn.infer_op_flat("access").alias("op"))


@query("fn_normalize_result", f"select event_id, {RESULT} as result from v_audit", "audit")
def _(i):
    return i.view("audit").select("event_id", fn.normalize_result("outcome").alias("result"))


@query("fn_reduce_to_dir", f"select event_id, {DIR} as dir from v_audit", "audit")
def _(i):
    return i.view("audit").select("event_id", fn.parent_dir("path").alias("dir"))


@query("fn_truncate_path", f""", p as (select event_id, path as dir from v_audit)
  select event_id, {short(1)} as one, {short(2)} as two, {short(5)} as five from p""", "audit")
def _(i):
    return i.view("audit").select(
        "event_id", *[fn.truncate_path("path", n).alias(name) for n, name in ((1, "one"), (2, "two"), (5, "five"))])


@query("fn_basename", """select page_id, regexp_extract(url, '([^/]*)$', 1) as base from pages""")
def _(i):
    return i.table("pages").select("page_id", fn.basename("url").alias("base"))


@query("fn_sha1", """select doc_id, case when text = '' then '' else sha1(text) end as hash from documents""")
def _(i):
    return i.table("documents").select("doc_id", fn.sha1_or_empty("text").alias("hash"))


@query("fn_infer_object_type", f""", s as (select event_id, concat(upper(repo), usr) as service from v_audit)
  select event_id, {OBJECT_TYPE} as object_type from s""", "audit")
def _(i):
    return i.view("audit").select(
        "event_id", fn.object_type(F.concat(F.upper("repo"), "usr")).alias("object_type"))

