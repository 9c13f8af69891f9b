"""Listings, Kudu, Hive and projects: objects."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn, sinks, sources
from ..model import DATABASE_HEADERS, OBJECT_COLUMNS
from ..operators import objects
from ..sources.catalog import parse_kudu_descriptions
from .registry import query

# --- the checking side ---

LISTED = """, l as (select *, '/' || array_to_string(list_slice(string_split(trim(file_path, '/'), '/'), 1, 3), '/') || '/'
    as dir from v_listing where file_path <> ''),
f as (select *, row_number() over (partition by dir order by pos) as rn from l where dir not in ('', '/'))
"""
LISTING_OBJECTS = LISTED + """select 'hdfs' as service, 'hdfs_path' as object_type, dir as object_id,
  coalesce(owner_name, '') as owner, coalesce(group_name, '') as "group", perms as extra from f where rn = 1"""
HIVE_ROW = """'impala' as service, 'hive_table' as object_type, db || '.' || tbl as object_id"""
LINES = r""", parts as (select db, tbl, line_no, trim(line) as line,
    case when contains(trim(line), chr(9)) then string_split(trim(line), chr(9))
      else string_split_regex(trim(line), '\s{2,}') end as p from v_describe_lines),
kv as (select db, tbl, line_no, line, lower(trim(rtrim(trim(p[1]), ':'))) as k, trim(p[2]) as v
  from parts where len(p) >= 2),
ranked as (select *, row_number() over (partition by db, tbl, k order by line_no desc) as rn from kv),
facts as (select t.db, t.tbl,
  coalesce((select v from ranked r where r.db = t.db and r.tbl = t.tbl and k = 'table type' and rn = 1), '') as table_type,
  coalesce((select v from ranked r where r.db = t.db and r.tbl = t.tbl and k = 'owner' and rn = 1), '') as owner,
  coalesce((select v from ranked r where r.db = t.db and r.tbl = t.tbl and k = 'inputformat' and rn = 1), '') as input_format,
  coalesce((select v from ranked r where r.db = t.db and r.tbl = t.tbl and k = 'serde library' and rn = 1), '') as serde,
  coalesce((select v from ranked r where r.db = t.db and r.tbl = t.tbl and k = 'location' and rn = 1), '') as location,
  exists (select 1 from parts r where r.db = t.db and r.tbl = t.tbl and contains(lower(line), 'kudu')) as kudu,
  exists (select 1 from ranked r where r.db = t.db and r.tbl = t.tbl and k = 'storage_handler'
    and contains(lower(v), 'kudu')) as handler
  from (select distinct db, tbl from v_describe_lines) t)
"""


def _first_word(text: str, words: list[tuple[str, str]]) -> str:
    return "case " + " ".join(f"when contains(lower({text}), '{w}') then '{n}'" for w, n in words) + " end"


LOOSE = [("kudu", "kudu"), ("parquet", "parquet"), ("orc", "orc"), ("text", "textfile"), ("rcfile", "rcfile"),
         ("avro", "avro"), ("sequencefile", "sequencefile"), ("json", "json")]
TIGHT = [("kudu", "kudu"), ("parquet", "parquet"), ("orc", "orc"), ("text", "textfile"), ("avro", "avro"),
         ("rcfile", "rcfile"), ("sequence", "sequencefile"), ("json", "json")]
STORAGE = f"case when kudu then 'kudu' else coalesce({_first_word('input_format', LOOSE)}, {_first_word('serde', LOOSE)}, 'unknown') end"
STORAGE_STRICT = f"case when handler then 'kudu' else coalesce({_first_word('input_format', TIGHT)}, 'unknown') end"
EXTRA = """concat_ws('|', 'type=' || nullif(table_type, ''), 'storage=' || nullif(storage_format, ''),
  'location=' || nullif(location, ''))"""
DESCRIBED = LINES + f""", d as (select *, {STORAGE} as storage_format from facts),
j as (select t.db, t.tbl, coalesce(table_type, '') as table_type, coalesce(owner, '') as owner,
  coalesce(location, '') as location, coalesce(storage_format, 'error') as storage_format
  from v_hive_tables t left join d on d.db = t.db and d.tbl = t.tbl)
"""
OWNER = """case owner_form when 0 then owner_user when 2 then owner_user when 3 then owner_user else '' end"""
PID = f"coalesce(nullif({OWNER}, ''), 'unknown') || '/' || coalesce(nullif(name, ''), nullif(slug, ''), 'unnamed')"
CREATED = """case when contains(created, 'T') and length(created) >= 19 then left(created, 19) || 'Z' else created end"""
PROJECT_EXTRA = f"""concat_ws('|', 'desc=' || nullif(left(replace(replace(description, '|', ' '), chr(10), ' '), 120), ''),
  'engine=' || nullif(engine, ''), 'created=' || nullif({CREATED}, ''))"""
PROJECTS = f""", pr as (select id as project_id, {PID} as pid, {OWNER} as project_owner, {PROJECT_EXTRA} as project_extra
  from v_projects)
"""
PROJECT_ROWS = """select 'cdsw' as service, 'cdsw_project' as object_type, pid as object_id, project_owner as owner,
  '' as "group", project_extra as extra from pr"""
JOB_EXTRA = """concat_ws('|', 'script=' || nullif(script, ''),
  'engine=' || coalesce(nullif(kernel, ''), nullif(engine_type, '')), 'schedule=' || nullif(replace(schedule, '|', ' '), ''))"""
JOB_ROWS = f"""select 'cdsw' as service, 'cdsw_job' as object_type,
  pid || '/' || coalesce(nullif(name, ''), nullif(title, ''), id) as object_id, project_owner as owner, '' as "group",
  {JOB_EXTRA} as extra from v_children join pr using (project_id)"""
MODEL_ROWS = """select 'cdsw' as service, 'cdsw_model' as object_type,
  pid || '/model:' || coalesce(nullif(name, ''), id) as object_id, project_owner as owner, '' as "group",
  '' as extra from v_children join pr using (project_id)"""


def _csv(i, path):
    return i.spark.read.options(header="true", escape='"', lineSep="\r\n").csv(path).na.fill("")


# --- storage listings ---

@query("scan_ls_listing", """select file_path as path, coalesce(owner_name, 'hdfs') as owner,
  coalesce(group_name, 'supergroup') as "group", perms as permissions from v_listing where file_path like '/%'""", "listing")
def _(i):
    def write(path):
        line = F.concat(
            F.col("perms"), F.lit("   3 "), F.coalesce("owner_name", F.lit("hdfs")), F.lit("  "),
            F.coalesce("group_name", F.lit("supergroup")), F.lit("     1024 2025-01-01 12:00 "), "file_path")
        noise = F.array(line, F.when(F.col("pos") % 5 == 0, "Found 3 items"),
                        F.when(F.col("pos") % 7 == 0, "ls: permission denied"), F.when(F.col("pos") % 11 == 0, ""))
        i.view("listing").select(F.explode(F.array_compact(noise)).alias("value")).write.text(path)
    return sources.ls_listing(i.spark, i.landed("ls", write)).drop("pos")


@query("scan_jdbc_listing", """select file_path as path, owner_name as owner, group_name as "group", perms as permissions,
  pos from v_listing""", "listing")
def _(i):
    return i.listing()


@query("listing_to_object", LISTING_OBJECTS, "listing")
def _(i):
    return objects.from_listing(i.listing())


@query("agg_first_per_dir", LISTED.replace("1, 3)", "1, 2)") + """select dir as object_id, coalesce(owner_name, '') as owner,
  coalesce(group_name, '') as "group", perms as extra from f where rn = 1""", "listing")
def _(i):
    return objects.from_listing(i.listing(), depth=2).select("object_id", "owner", "group", "extra")


@query("filter_root_dir", LISTED + "select file_path as path, dir from l where dir not in ('', '/')", "listing")
def _(i):
    return objects.listing_dirs(i.listing()).select("path", "dir")


@query("sort_objects", LISTING_OBJECTS, "listing")
def _(i):
    return objects.from_listing(i.listing()).orderBy("object_id")


@query("sink_objects_csv", LISTING_OBJECTS, "listing")
def _(i):
    path = i.scratch("objects_csv")
    sinks.write_objects(objects.from_listing(i.listing()), path, ["object_id"])
    return _csv(i, path).select(OBJECT_COLUMNS)


# --- Kudu ---

KUDU_OWNER = "case when p_partkey % 9 = 0 or p_size % 4 = 0 then '' else 'k' || cast(p_size as varchar) end"
KUDU_NAME = "p_brand || '.t' || cast(p_partkey as varchar)"


def _kudu_tables(i):
    def write(path):
        name = F.concat("p_brand", F.lit(".t"), F.col("p_partkey").cast("string"))
        padded = F.concat(F.lit("  "), name, F.lit(" "))
        i.table("part").orderBy("p_partkey").select(
            F.explode(F.array(padded, F.lit(" "))).alias("value")).write.text(path)
    return sources.kudu_tables(i.spark, i.landed("kudu_tables", write))


def _kudu_described(i):
    """Descriptions: every ninth is bad JSON, every fourth has no owner."""
    owner = F.concat(F.lit("k"), F.col("p_size").cast("string"))
    json = (
        F.when(F.col("p_partkey") % 9 == 0, "Not found: no such table")
        .when(F.col("p_size") % 4 == 0, '{"name": "t", "owner": null}')
        .otherwise(F.to_json(F.struct(F.lit("t").alias("name"), owner.alias("owner")))))
    name = F.concat("p_brand", F.lit(".t"), F.col("p_partkey").cast("string"))
    return parse_kudu_descriptions(i.table("part").select(
        name.alias("table_name"), json.alias("json"), F.col("p_partkey").alias("pos")))


@query("scan_kudu_tables", f"select {KUDU_NAME} as table_name from part")
def _(i):
    return _kudu_tables(i).select("table_name")


@query("kudu_to_object", f"""select 'kudu' as service, 'kudu_table' as object_type, {KUDU_NAME} as object_id, '' as owner,
  '' as "group", '' as extra from part""")
def _(i):
    return objects.from_kudu(_kudu_tables(i))


@query("join_owner_map", f"""select 'kudu' as service, 'kudu_table' as object_type, {KUDU_NAME} as object_id,
  {KUDU_OWNER} as owner, '' as "group", '' as extra from part""")
def _(i):
    return objects.from_kudu(_kudu_tables(i), _kudu_described(i))


@query("agg_nonempty_owner", f"""select count(*) filter ({KUDU_OWNER} <> '') as with_owner, count(*) as tables from part""")
def _(i):
    return objects.owner_counts(objects.from_kudu(_kudu_tables(i), _kudu_described(i)))


@query("limit_max_tables", f"select {KUDU_NAME} as object_id from part order by p_partkey limit 25")
def _(i):
    return objects.from_kudu(_kudu_tables(i), max_tables=25).select("object_id")


# --- Hive ---

@query("scan_hive_tables", "select db, tbl from v_hive_tables", "hive_tables")
def _(i):
    def write(path):
        i.hive_tables().select(F.concat_ws("\t", "db", "tbl").alias("value")).write.text(path)
    return sources.hive_listing(i.spark, i.landed("hive_listing", write)).select("db", "tbl")


@query("scan_hive_describe", "select db, tbl, cast(line_no as integer) as line_no, line from v_describe_lines",
       "describe_lines")
def _(i):
    path = i.landed("describe", lambda p: i.describe_lines().write.parquet(p))
    return sources.hive_describe_lines(i.spark, path)


FIRST_POS = ", dbs as (select db, min(pos) as pos from v_hive_tables group by db)\n"


@query("filter_header_tokens", "select db, tbl from v_hive_tables where pos % 10 > 2", "hive_tables")
def _(i):
    # header words, in any case and with blanks, where a listing tool printed its header
    n = F.col("pos") % 10
    db = F.when(n == 0, F.lit(" Name ")).when(n == 1, F.lit("DATABASE_NAME")).when(n == 2, F.lit("  ")).otherwise(F.col("db"))
    listed = i.hive_tables().withColumn("db", db)
    return objects.drop_headers(listed, "db", DATABASE_HEADERS).select("db", "tbl")


@query("filter_exclude_databases", FIRST_POS + "select db from dbs where lower(db) not in ('brand#2', 'brand#3')", "hive_tables")
@query("except_excluded_dbs", FIRST_POS + "select db from dbs where lower(db) not in ('brand#2', 'brand#3')", "hive_tables")
def _(i):
    return objects.select_databases(i.databases(), exclude=["BRAND#2", " brand#3 "]).select("db")


@query("filter_include_databases", "select db, tbl from v_hive_tables where db in ('Brand#4', 'Brand#5')", "hive_tables")
def _(i):
    return objects.hive_tables(
        i.databases(), i.hive_tables(), include=["Brand#5", "Brand#4", "Brand#6", "nowhere"],
        exclude=["brand#6"]).select("db", "tbl")


@query("limit_databases", FIRST_POS + """select db, tbl from v_hive_tables where db in
  (select db from dbs where lower(db) <> 'brand#2' order by pos limit 3)""", "hive_tables")
def _(i):
    return objects.hive_tables(
        i.databases(), i.hive_tables(), exclude=["brand#2"], max_databases=3).select("db", "tbl")


@query("topn_tables_per_db", """, r as (select *, row_number() over (partition by db order by pos) as rn from v_hive_tables)
  select db, tbl from r where rn <= 4""", "hive_tables")
def _(i):
    return objects.hive_tables(i.databases(), i.hive_tables(), max_tables=4).select("db", "tbl")


@query("hive_list_only", f"select {HIVE_ROW}, '' as owner, '' as \"group\", '' as extra from v_hive_tables", "hive_tables")
def _(i):
    return objects.from_hive_list(objects.hive_tables(i.databases(), i.hive_tables()))


@query("agg_describe_pivot", LINES + f"""select db, tbl, table_type, owner, input_format, serde, location,
  {STORAGE} as storage_format from facts""", "describe_lines")
@query("fn_infer_storage", LINES + f"""select db, tbl, table_type, owner, input_format, serde, location,
  {STORAGE} as storage_format from facts""", "describe_lines")
def _(i):
    return objects.describe_pivot(i.describe_lines())


# the shell variant splits at tabs only, so keys set apart by blanks are not seen
STRICT_LINES = (
    LINES.replace(r"string_split_regex(trim(line), '\s{2,}')", "[trim(line)]")
    # … and a key alone on its line sets an empty value
    .replace("trim(p[2]) as v", "coalesce(trim(p[2]), '') as v").replace("where len(p) >= 2", ""))


@query("fn_infer_storage_strict", STRICT_LINES + f"select db, tbl, {STORAGE_STRICT} as storage_format from facts",
       "describe_lines")
def _(i):
    return objects.describe_pivot(i.describe_lines(), strict=True).select("db", "tbl", "storage_format")


@query("fn_describe_key", LINES + "select db, tbl, line_no, k, v from kv", "describe_lines")
def _(i):
    keyed = i.describe_lines().select(
        "db", "tbl", "line_no", fn.describe_key("line").alias("k"), fn.describe_value("line").alias("v"))
    return keyed.filter(F.col("k").isNotNull())


def _described(i):
    return objects.with_descriptions(i.hive_tables(), objects.describe_pivot(i.describe_lines("described_lines")))


@query("join_describe_results", DESCRIBED + "select db, tbl, table_type, owner, location, storage_format from j",
       "describe_lines=described_lines", "hive_tables")
def _(i):
    return _described(i)


@query("hive_to_object", DESCRIBED + f"select {HIVE_ROW}, owner, '' as \"group\", {EXTRA} as extra from j",
       "describe_lines=described_lines", "hive_tables")
def _(i):
    return objects.from_hive(_described(i))


@query("fn_csv_comma_escape", STRICT_LINES + f""", d as (select *, {STORAGE_STRICT} as storage_format from facts)
  select {HIVE_ROW}, replace(owner, ',', ';') as owner, '' as "group", replace({EXTRA}, ',', ';') as extra from d""",
       "describe_lines")
def _(i):
    return objects.from_hive(objects.describe_pivot(i.describe_lines(), strict=True), strict=True)


@query("agg_storage_distribution", DESCRIBED + """select storage_format as storage, count(*) as cnt from j
  where storage_format <> 'error' group by 1""", "describe_lines=described_lines", "hive_tables")
@query("sort_storage_desc", DESCRIBED + """select storage_format as storage, count(*) as cnt from j
  where storage_format <> 'error' group by 1 order by 2 desc, 1""", "describe_lines=described_lines", "hive_tables")
def _(i):
    return objects.storage_distribution(_described(i))


@query("agg_storage_distribution_all", DESCRIBED + "select storage_format as storage, count(*) as cnt from j group by 1",
       "describe_lines=described_lines", "hive_tables")
def _(i):
    return objects.storage_distribution(_described(i), include_errors=True)


# --- projects ---

@query("cdsw_project_to_object", PROJECTS + PROJECT_ROWS, "projects")
def _(i):
    return objects.project_objects(objects.project_keys(i.projects()))


@query("fn_project_id", PROJECTS + "select project_id as id, pid from pr", "projects")
def _(i):
    return i.projects().select("id", fn.project_id("owner", "name", "slug").alias("pid"))


@query("fn_project_extra", PROJECTS + "select project_id as id, project_extra as extra from pr", "projects")
def _(i):
    return i.projects().select("id", fn.project_extra(
        "description", "default_engine_type", F.col("created_at")).alias("extra"))


@query("limit_max_projects", PROJECTS + """select pid from pr where project_id in
  (select id from v_projects order by pos limit 10)""", "projects")
def _(i):
    return objects.project_keys(i.projects(), max_projects=10).select("pid")


@query("join_project_children", PROJECTS + "select id, pid, project_owner from v_children join pr using (project_id)",
       "projects", "children")
def _(i):
    return objects.with_project(i.children(), objects.project_keys(i.projects())).select("id", "pid", "project_owner")


@query("cdsw_job_to_object", PROJECTS + JOB_ROWS, "projects", "children")
def _(i):
    return objects.job_objects(objects.with_project(i.children(), objects.project_keys(i.projects())))


@query("cdsw_model_to_object", PROJECTS + MODEL_ROWS, "projects", "children")
def _(i):
    return objects.model_objects(objects.with_project(i.children(), objects.project_keys(i.projects())))


@query("union_cdsw_objects", PROJECTS + f"{PROJECT_ROWS} union all {JOB_ROWS} union all {MODEL_ROWS}", "projects", "children")
def _(i):
    return objects.from_cdsw(objects.project_keys(i.projects()), i.children(), i.children())


@query("union_files", f"select 'kudu' as service, {KUDU_NAME} as object_id from part")
def _(i):
    # several result files of one folder, read as one
    def write(path):
        halves = objects.from_kudu(_kudu_tables(i)).withColumn("part", F.crc32("object_id") % 3)
        halves.write.partitionBy("part").options(**sinks.CSV_OPTIONS).csv(path)
    return _csv(i, i.landed("result_files", write)).select("service", "object_id")
