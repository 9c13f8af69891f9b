"""Source-shaped views of the given tables.

A view is one SELECT that Spark and the checking engine both run. ``@name@`` marks a
table and the few places where the two dialects differ.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]
SPARK_TERMS = {
    "STR": "string",
    "MS": "unix_millis(cast(ts as timestamp))",
    "DAY_MS": "unix_millis(cast(o_orderdate as timestamp))",
    "K": "get_json_object(props, '$.k')",
    "RAW_TIME": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "ISO_TIME": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")",
    "DAY8": "date_format(ts, 'yyyyMMdd')",
    "ORDER_ISO": "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\")",
    "ORDER_DAY": "date_format(o_orderdate, 'yyyy-MM-dd')",
    "ORDER_DAY8": "date_format(o_orderdate, 'yyyyMMdd')",
    "TAB": "char(9)", "NL": "char(10)", "DIV": "div",
}
CHECK_TERMS = {
    "STR": "varchar",
    "MS": "(epoch_us(ts) // 1000)",
    "DAY_MS": "(epoch_us(o_orderdate) // 1000)",
    "K": "json_extract_string(props, '$.k')",
    "RAW_TIME": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "ISO_TIME": "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')",
    "DAY8": "strftime(ts, '%Y%m%d')",
    "ORDER_ISO": "strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')",
    "ORDER_DAY": "strftime(o_orderdate, '%Y-%m-%d')",
    "ORDER_DAY8": "strftime(o_orderdate, '%Y%m%d')",
    "TAB": "chr(9)", "NL": "chr(10)", "DIV": "//",
}

VIEWS: dict[str, str] = {}

# One audit record per event. ts_form: 0 text that is no known time, 1 ISO text,
# 2-3 seconds, the others milliseconds.
VIEWS["audit"] = """
select event_id, user_id, ts, event_id % 10 as ts_form,
  @MS@ as evt_ms, @RAW_TIME@ as raw_time, @ISO_TIME@ as iso_time, @DAY8@ as day8,
  case event_id % 6 when 0 then 'cm_hdfs' when 1 then 'cm_hive' when 2 then 'cm_kudu'
    when 3 then 'cm_impala' when 4 then 'cm_yarn' else 'cm_ozone' end as repo,
  concat('u', cast(user_id % 3 as @STR@)) as usr,
  case when event_id % 5 = 0 then concat('svc', cast(user_id % 2 as @STR@)) end as proxy,
  case when event_id % 7 < 3 then concat('u', cast(user_id % 3 as @STR@), ' (auth:SIMPLE)') end as ugi,
  concat('10.0.0.', cast(user_id % 2 as @STR@)) as ip,
  concat('host', cast(user_id % 4 as @STR@)) as host,
  case event_type when 'signup' then ' Create ' when 'purchase' then 'write' when 'view' then 'read'
    when 'click' then 'getfileinfo' else 'bulk_rename' end as access,
  case event_id % 9 when 0 then 'delete' when 1 then 'open' when 2 then '' else 'select' end as action,
  case event_id % 8 when 0 then '0' when 1 then 'DENY' when 2 then 'TRUE' when 3 then ' allowed '
    when 4 then 'true' else '1' end as outcome,
  event_id % 50 as policy,
  case when event_id % 11 = 0 then concat('/tmp/x', cast(event_id as @STR@))
    when event_id % 13 = 0 then '/data/a/b.CRC'
    when event_id % 17 = 0 then '/data/out/_SUCCESS'
    when event_id % 19 = 0 then concat('/data/x._committed_', cast(event_id as @STR@))
    when event_id % 23 = 0 then '/data/a_committed_1/f'
    when event_id % 29 = 0 then 'sales/orders'
    when event_id % 31 = 0 then 'orders'
    when event_id % 37 = 0 then ' /data//deep//leaf '
    when event_id % 41 = 0 then '/'
    when event_id % 43 = 0 then ''
    when event_id % 47 = 0 then '/user/u1/.sparkStaging/app/f'
    when event_id % 53 = 0 then '/data/dir/'
    else concat('/data/', event_type, '/k', @K@, '/p', cast(event_id % 7 as @STR@), '/f.parquet') end as path,
  concat('select ', cast(event_id as @STR@)) as request,
  case when event_id % 3 = 0 then concat('app', cast(user_id % 5 as @STR@)) end as app,
  concat('part-', cast(event_id % 4 as @STR@), '.json') as src
from @events@
"""

# Relations at process nodes. Inputs and outputs share names, so both ways occur.
VIEWS["links"] = """
select distinct l_orderkey as payload_id, concat('proc', cast(l_linenumber % 2 as @STR@)) as proc,
  l_linenumber % 2 as proc_pos, 'in' as role, l_suppkey % 12 as rel_pos,
  concat('n', cast(l_suppkey % 12 as @STR@)) as guid, 'hdfs_path' as object_type
from @lineitem@
union all
select distinct l_orderkey, concat('proc', cast(l_linenumber % 2 as @STR@)), l_linenumber % 2, 'out',
  l_partkey % 12, concat('n', cast(l_partkey % 12 as @STR@)), 'hdfs_path'
from @lineitem@
"""

# The same, between suppliers and parts; and customers, whom the catalog does not know.
VIEWS["supply_links"] = """
select l_orderkey as payload_id, concat('o', cast(l_orderkey as @STR@)) as proc,
  1 as proc_pos, 'in' as role, l_linenumber as rel_pos,
  concat('s', cast(l_suppkey as @STR@)) as guid, 'hdfs_path' as object_type
from @lineitem@
union all
select l_orderkey, concat('o', cast(l_orderkey as @STR@)), 1, 'out', l_linenumber,
  concat('p', cast(l_partkey as @STR@)), 'hive_table'
from @lineitem@
union all
select o_orderkey, concat('o', cast(o_orderkey as @STR@)), 1, 'in', 1000,
  concat('c', cast(o_custkey as @STR@)), 'report'
from @orders@ where o_orderstatus = 'P'
"""

# Catalog records. Every fifth part comes a second time, later and under another name.
VIEWS["entities"] = """
select concat('p', cast(p_partkey as @STR@)) as guid,
  case p_size % 8 when 0 then 'hive_table' when 1 then 'hdfs_path' when 2 then 'kudu_table'
    when 3 then 'aws_s3' when 4 then 'process' when 5 then 'spark_application'
    when 6 then 'impala_db' else 'hive_column' end as type_name,
  case when p_partkey % 7 = 0 then null when p_partkey % 11 = 0 then ''
    else concat(p_brand, '.', p_name, '@', cast(p_partkey as @STR@)) end as qn,
  case when p_partkey % 14 = 0 then null else concat('u:', cast(p_partkey as @STR@)) end as unique_qn,
  case when p_partkey % 3 = 0 then p_name end as name,
  case when p_partkey % 4 = 0 then p_type end as display,
  case when p_partkey % 2 = 0 then concat('owner', cast(p_size as @STR@)) else '' end as owner,
  case when p_partkey % 5 < 3 then 'creator' end as creator,
  p_partkey as pos
from @part@
union all
select concat('p', cast(p_partkey as @STR@)), 'hive_table', concat('v2.', p_name, '@', cast(p_partkey as @STR@)),
  null, p_name, null, 'late', null, 1000000000 + p_partkey
from @part@ where p_partkey % 5 = 0
union all
select concat('s', cast(s_suppkey as @STR@)), 'hdfs_path', concat('/lake/', s_name), null, s_name,
  null, null, null, 2000000000 + s_suppkey
from @supplier@
"""

# Application histories. Every tenth application comes twice.
VIEWS["rm_apps"] = """
select concat('application_', cast(o_orderkey as @STR@)) as id, concat('c', cast(o_custkey as @STR@)) as user,
  case when o_orderkey % 6 = 0 then null else o_orderpriority end as name,
  case o_orderstatus when 'F' then 'FINISHED' when 'O' then 'RUNNING' else 'ACCEPTED' end as state,
  case when o_orderkey % 13 = 0 then 0 when o_orderkey % 17 = 0 then null
    else @DAY_MS@ + o_orderkey % 86400000 end as started,
  o_orderkey as pos, o_orderkey @DIV@ 1000 as page
from @orders@
union all
select concat('application_', cast(o_orderkey as @STR@)), 'again', 'again', 'FINISHED', @DAY_MS@,
  1000000000 + o_orderkey, o_orderkey @DIV@ 1000 + 1
from @orders@ where o_orderkey % 10 = 0
union all
select '', 'nobody', 'no id', 'FINISHED', @DAY_MS@, 2000000000 + o_orderkey, o_orderkey @DIV@ 1000
from @orders@ where o_orderkey % 100 = 0
"""
VIEWS["jhs_jobs"] = """
select case when o_orderkey % 4 = 0 then concat('job_h', cast(o_orderkey as @STR@))
    when o_orderkey % 9 = 0 then concat('task_job_', cast(o_orderkey as @STR@))
    else concat('job_', cast(o_orderkey as @STR@)) end as id,
  concat('c', cast(o_custkey as @STR@)) as user, o_orderpriority as name,
  case when o_orderkey % 3 = 0 then 0 when o_orderkey % 5 = 0 then null else @DAY_MS@ end as start_ms,
  @DAY_MS@ - 5000 as submit_ms, o_orderkey as pos
from @orders@
"""
VIEWS["spark_apps"] = """
select concat('app-', cast(o_orderkey as @STR@)) as id, o_orderpriority as name, o_custkey,
  @ORDER_DAY@ as day, @ORDER_ISO@ as first_start,
  case o_orderkey % 5 when 0 then concat(@ORDER_ISO@, '.123GMT') when 1 then concat(@ORDER_ISO@, 'GMT')
    when 2 then @ORDER_ISO@ when 3 then concat(@ORDER_ISO@, '+01:00') else 'bad' end as last_start,
  case o_orderkey % 7 when 0 then 0 when 1 then 1 else 2 end as attempts_n, o_orderkey as pos
from @orders@
"""

# A storage listing; database columns may be null.
VIEWS["listing"] = """
select case when p_partkey % 50 = 0 then '/' when p_partkey % 53 = 0 then '' when p_partkey % 59 = 0 then 'loose'
    else concat('/warehouse/', p_brand, '/', p_type, '/', cast(p_partkey as @STR@), ' a.parquet') end as file_path,
  case when p_size % 9 = 0 then null else concat('o', cast(p_size as @STR@)) end as owner_name,
  case when p_size % 7 = 0 then null else concat('g', cast(p_size % 3 as @STR@)) end as group_name,
  case when p_size % 2 = 0 then 'drwxr-xr-x' else '-rw-r--r--' end as perms,
  p_partkey as pos
from @part@
"""

# Projects, and what runs in them. Owners are objects or plain text.
VIEWS["projects"] = """
select cast(c_custkey as @STR@) as id,
  case when c_custkey % 9 = 0 then null else c_name end as name,
  case when c_custkey % 18 = 0 then null else concat('slug-', cast(c_custkey as @STR@)) end as slug,
  case c_custkey % 4 when 0 then concat('user', cast(c_nationkey as @STR@)) when 1 then null
    when 2 then concat('named', cast(c_nationkey as @STR@)) else 'plain' end as owner_user,
  c_custkey % 4 as owner_form,
  case when c_custkey % 3 = 0 then concat('about|', c_mktsegment, @NL@, repeat('long ', 40)) end as description,
  case when c_custkey % 2 = 0 then 'python3' else '' end as engine,
  case c_custkey % 3 when 0 then '2024-01-01T10:20:30.456Z' when 1 then '2024-01-01' end as created,
  c_custkey as pos
from @customer@
"""
VIEWS["children"] = """
select cast(o_custkey as @STR@) as project_id, cast(o_orderkey as @STR@) as id,
  case when o_orderkey % 5 = 0 then null else concat('n', o_orderpriority) end as name,
  case when o_orderkey % 10 = 0 then 'titled' end as title,
  case when o_orderkey % 3 = 0 then 'run.py' end as script,
  case when o_orderkey % 4 = 0 then 'python3' end as kernel,
  case when o_orderkey % 4 = 1 then 'r' end as engine_type,
  case when o_orderkey % 6 = 0 then '0 1|2 * *' end as schedule,
  case when o_orderkey % 7 < 3 then concat('w', cast(o_custkey % 11 as @STR@)) end as worker,
  case when o_orderkey % 2 = 0 then concat(@ORDER_ISO@, '.5Z') end as latest_at,
  case when o_orderkey % 3 <> 1 then concat(@ORDER_ISO@, 'Z') end as updated_at,
  @ORDER_DAY@ as created_at, o_orderkey as pos
from @orders@
"""

# Who touched what: tables, folders below the listed ones and below table locations, and others.
VIEWS["touched"] = """
select case l_linenumber % 4 when 0 then 'hive_table' else 'hdfs_path' end as object_type,
  case l_linenumber % 4 when 0 then concat(p_brand, '.t', cast(p_partkey as @STR@))
    when 1 then concat('/warehouse/', p_brand, '/', p_type, '/deep/', cast(l_linenumber as @STR@), '/')
    when 2 then concat('hdfs://nn//w,h/', p_type, '/', cast(l_suppkey % 5 as @STR@))
    else concat('/other/', p_brand, '/') end as object_id,
  concat('u', cast(l_suppkey % 7 as @STR@)) as usr, l_returnflag as op, count(*) as cnt
from @lineitem@ join @part@ on l_partkey = p_partkey
group by 1, 2, 3, 4
"""

# Tables of a warehouse: databases by brand, description lines per table.
VIEWS["hive_tables"] = """
select p_brand as db, concat('t', cast(p_partkey as @STR@)) as tbl, p_partkey as pos,
  case when p_partkey % 10 = 9 then true else false end as failed
from @part@
"""
VIEWS["describe_lines"] = """
select p_brand as db, concat('t', cast(p_partkey as @STR@)) as tbl, 1 as line_no,
  concat('# col_name', @TAB@, 'data_type', @TAB@, 'comment') as line from @part@
union all
select p_brand, concat('t', cast(p_partkey as @STR@)), 2,
  case when p_partkey % 6 = 0 then concat('owner', @TAB@, 'string', @TAB@, '')
    when p_partkey % 6 = 1 then concat('note', @TAB@, 'string', @TAB@, 'copied from KUDU')
    else concat('id', @TAB@, 'bigint', @TAB@, '') end from @part@
union all
select p_brand, concat('t', cast(p_partkey as @STR@)), 3,
  case when p_partkey % 4 = 0 then concat('Owner:   ', 'hive', cast(p_size as @STR@))
    when p_partkey % 4 = 1 then concat('Owner:', @TAB@, ' a,b ', @TAB@, 'NULL') else 'Owner' end
from @part@
union all
select p_brand, concat('t', cast(p_partkey as @STR@)), 4, concat('Location:', @TAB@, 'hdfs://nn/w,h/', p_type)
from @part@ where p_partkey % 3 <> 0
union all
select p_brand, concat('t', cast(p_partkey as @STR@)), 5,
  concat('Table Type:', @TAB@, case when p_size % 2 = 0 then 'MANAGED_TABLE' else 'EXTERNAL_TABLE' end)
from @part@
union all
select p_brand, concat('t', cast(p_partkey as @STR@)), 6,
  concat('SerDe Library:', @TAB@, case p_size % 3 when 0 then 'org.example.JsonSerDe' when 1 then 'org.example.AvroSerDe' else 'none' end)
from @part@
union all
select p_brand, concat('t', cast(p_partkey as @STR@)), 7,
  concat('InputFormat:', @TAB@, case p_size % 5 when 0 then 'io.TextInputFormat' when 1 then 'io.MapredParquetInputFormat'
    when 2 then 'io.OrcInputFormat' when 3 then 'io.SequenceFileInputFormat' else 'other' end)
from @part@
union all
select p_brand, concat('t', cast(p_partkey as @STR@)), 8,
  concat('storage_handler', @TAB@, 'org.example.KuduStorageHandler')
from @part@ where p_partkey % 8 = 3
"""


# The same where every tenth table could not be described.
VIEWS["described_lines"] = ("select * from (" + VIEWS["describe_lines"]
                            + ") d where cast(substr(tbl, 2) as bigint) % 10 <> 9")


def _fill(sql: str, terms: dict[str, str]) -> str:
    return re.sub(r"@(\w+)@", lambda m: terms[m.group(1)], sql)


def spark_view(spark: SparkSession, sf_dir: str, name: str, dealt: dict[str, str] | None = None, tasks: int = 0) -> DataFrame:
    """``dealt`` names tables that are read dealt to ``tasks`` tasks by a key, which grouping by it then finds in place."""
    terms = SPARK_TERMS | {t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in TABLES}
    for t, key in (dealt or {}).items():
        terms[t] = f"(select /*+ repartition({tasks}, {key}) */ * from {terms[t]})"
    return spark.sql(_fill(VIEWS[name], terms))


def check_sql(body: str, *views: str) -> str:
    """A checking query over views: ``with v_audit as (…) <body>``; ``a=b`` puts view b in a's place."""
    terms = CHECK_TERMS | {t: t for t in TABLES}
    ctes = [f"v_{v.split('=')[0]} as ({_fill(VIEWS[v.split('=')[-1]], terms)})" for v in views]
    if not ctes:
        return body
    joiner = ", " if body.lstrip().startswith(",") else " "
    return "with " + ",\n".join(ctes) + joiner + body.lstrip().lstrip(",")
