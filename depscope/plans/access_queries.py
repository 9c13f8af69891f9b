"""Application histories and project activity: accesses."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn, sinks, sources
from ..model import ACCESS_COLUMNS, APP_STATES
from ..operators import access, objects
from ..operators.dedupe import page_counts
from .object_queries import PROJECTS
from .registry import query

# --- the checking side ---

ISO_MS = "coalesce(strftime(make_timestamp(nullif({0}, 0) * 1000), '%Y-%m-%dT%H:%M:%SZ'), '')"
CNT = "cast(1 as bigint) as cnt"
STATES = "('FINISHED', 'KILLED', 'FAILED', 'RUNNING')"
RM = f""", rm as (select *, row_number() over (partition by id order by pos) as rn from v_rm_apps
    where state in {STATES} and id <> '')
"""
RM_ROWS = f"""select {ISO_MS.format('started')} as window_start, 'yarn' as service, coalesce("user", '') as "user",
  '' as do_as, '' as client_ip, coalesce(name, '') as app_name, 'SUBMIT' as op, 'application' as object_type,
  id as object_id, {CNT} from rm where rn = 1"""
JHS = RM + """, jh as (select *, case when id like 'job\\_%' escape '\\' then 'application_' || substr(id, 5) else id end as app_id,
    coalesce(nullif(start_ms, 0), submit_ms) as started from v_jhs_jobs),
left_over as (select * from jh where app_id not in (select id from rm))
"""
JHS_ROWS = f"""select {ISO_MS.format('started')} as window_start, 'yarn' as service, "user", '' as do_as, '' as client_ip,
  name as app_name, 'SUBMIT' as op, 'application' as object_type, app_id as object_id, {CNT} from left_over"""
HISTORY_TS = """case when {0} like '%+01:00' then left({0}, 19) || 'Z' when {0} = 'bad' or {0} = '' then {0}
  else left({0}, 19) || 'Z' end"""
SPARK_ROWS = f"""select case when attempts_n = 0 then '' else {HISTORY_TS.format('last_start')} end as window_start,
  'spark' as service, case when attempts_n = 0 then '' else 'c' || cast(o_custkey as varchar) end as "user", '' as do_as,
  '' as client_ip, name as app_name, 'SUBMIT' as op, 'application' as object_type, id as object_id, {CNT}
  from v_spark_apps"""


def safe_ts(c: str) -> str:
    return f"case when contains({c}, 'T') and length({c}) >= 19 then left({c}, 19) || 'Z' else coalesce({c}, '') end"


def project_rows(started: str, user: str, app: str, op: str) -> str:
    return f"""select {safe_ts(started)} as window_start, 'cdsw' as service, {user} as "user", '' as do_as, '' as client_ip,
  {app} as app_name, '{op}' as op, 'cdsw_project' as object_type, pid as object_id, {CNT}
  from v_children join pr using (project_id)"""


JOBS = project_rows("coalesce(latest_at, updated_at, created_at)", "project_owner", "coalesce(name, title, '')", "JOB")
SESSIONS = project_rows("created_at", "coalesce(worker, project_owner)",
                        "'session:' || coalesce(kernel, engine_type, '')", "SESSION")
MODELS = project_rows("coalesce(updated_at, created_at)", "project_owner", "coalesce(name, '')", "MODEL")
APPLICATIONS = project_rows("coalesce(updated_at, created_at)", "project_owner", "coalesce(name, '')", "APPLICATION")
ALL_KINDS = PROJECTS + " union all ".join([JOBS, SESSIONS, MODELS, APPLICATIONS])


# --- sources: landed pages, one document per line ---

def _rm_pages(i):
    def write(path):
        app = F.struct("id", "user", "name", "state", "startedTime")
        doc = F.struct(F.struct(F.array(app).alias("app")).alias("apps"))
        i.rm_apps().select(F.explode(F.array(
            F.to_json(doc), F.lit('{"apps": null}'), F.lit("{}"))).alias("value")).write.text(path)
    return sources.rm_apps(i.spark, i.landed("rm_pages", write))


def _jhs_pages(i):
    def write(path):
        job = F.struct("id", "user", "name", "startTime", "submitTime")
        doc = F.struct(F.struct(F.array(job).alias("job")).alias("jobs"))
        i.jhs_jobs().select(F.explode(F.array(F.to_json(doc), F.lit('{"jobs": {}}'))).alias("value")).write.text(path)
    return sources.jhs_jobs(i.spark, i.landed("jhs_pages", write))


def _spark_pages(i):
    def write(path):
        i.spark_apps().select(F.explode(F.array(
            F.to_json(F.array(F.struct("id", "name", "attempts"))), F.lit('{"error": "busy"}'))).alias("value")
        ).write.text(path)
    return sources.spark_apps(i.spark, i.landed("spark_pages", write))


def _cdsw_pages(i, kind):
    """Pages as wrapped lists, and every other one as a bare list; owners as real objects."""
    def write(path):
        items = i.projects() if kind == "projects" else i.children()
        owner = F.when(F.col("owner").startswith("{"), F.col("owner")).otherwise(F.to_json(F.array("owner")))
        text = F.regexp_extract(owner, r"^\[(.*)\]$", 1)
        typed = F.parse_json(F.when(owner.startswith("{"), owner).when(F.col("owner").isNull(), "null").otherwise(text))
        fields = [c for c in items.columns if c not in ("owner", "pos")]
        item = F.struct(*fields, typed.alias("owner"))
        bare, wrapped = F.to_json(F.array(item)), F.to_json(F.struct(F.array(item).alias(kind)))
        items.select(F.when(F.col("pos") % 2 == 0, bare).otherwise(wrapped).alias("value")).write.text(path)
    return sources.cdsw(i.spark, kind, i.landed(f"cdsw_{kind}", write))


@query("scan_rm_apps", """select id, "user", name, state, started as "startedTime" from v_rm_apps""", "rm_apps")
def _(i):
    return _rm_pages(i).select("id", "user", "name", "state", "startedTime")


@query("scan_jhs_jobs", """select id, "user", name, start_ms as "startTime", submit_ms as "submitTime" from v_jhs_jobs""",
       "jhs_jobs")
def _(i):
    return _jhs_pages(i).select("id", "user", "name", "startTime", "submitTime")


@query("scan_spark_apps", "select id, name, cast(attempts_n as integer) as attempts from v_spark_apps", "spark_apps")
def _(i):
    apps = access.with_id(_spark_pages(i))
    return apps.select("id", "name", F.size("attempts").alias("attempts"))


@query("scan_cdsw", PROJECTS + ALL_KINDS.removeprefix(PROJECTS), "projects", "children")
def _(i):
    kids = _cdsw_pages(i, "jobs")
    others = {k: _cdsw_pages(i, k) for k in ("sessions", "models", "applications")}
    return access.from_cdsw(objects.project_keys(_cdsw_pages(i, "projects")), kids, **others)


# --- filters ---

@query("filter_app_states", f"""select id, state, pos from v_rm_apps where state in {STATES}""", "rm_apps")
def _(i):
    return access.in_states(i.rm_apps(), APP_STATES).select("id", "state", "pos")


BEGIN, END = 788918400000, 883612799000  # 1995-01-01 to 1997-12-31, in ms


@query("filter_started_range", f"select id, started, pos from v_rm_apps where started between {BEGIN} and {END}", "rm_apps")
def _(i):
    kept = access.started_between(i.rm_apps(), BEGIN, END, F.col("startedTime"))
    return kept.select("id", F.col("startedTime").alias("started"), "pos")


@query("filter_missing_id", "select id, pos from v_rm_apps where id <> ''", "rm_apps")
def _(i):
    return access.with_id(i.rm_apps()).select("id", "pos")


@query("filter_skip_kinds", PROJECTS + f"{JOBS} union all {MODELS}", "projects", "children")
def _(i):
    return access.from_cdsw(objects.project_keys(i.projects()), i.children(), models=i.children())


# --- applications ---

@query("rm_app_to_access", RM + RM_ROWS, "rm_apps")
def _(i):
    return access.from_yarn(_rm_pages(i), states=APP_STATES)


@query("jhs_job_to_access", f""", jh as (select *, case when id like 'job\\_%' escape '\\' then 'application_' || substr(id, 5)
    else id end as app_id, coalesce(nullif(start_ms, 0), submit_ms) as started from v_jhs_jobs)
  {JHS_ROWS.replace('left_over', 'jh')}""", "jhs_jobs")
def _(i):
    return access.jhs_access(access.with_app_id(_jhs_pages(i)))


@query("spark_app_to_access", SPARK_ROWS, "spark_apps")
def _(i):
    return access.from_spark_history(_spark_pages(i))


@query("last_attempt", """select id, case when attempts_n = 0 then null else last_start end as started
  from v_spark_apps""", "spark_apps")
def _(i):
    return access.last_attempt(i.spark_apps()).select("id", F.col("attempt.startTime").alias("started"))


@query("anti_join_jhs_rm", JHS + "select app_id, pos from left_over", "rm_apps", "jhs_jobs")
def _(i):
    return access.jobs_not_in_rm(i.jhs_jobs(), access.in_states(i.rm_apps(), APP_STATES)).select("app_id", "pos")


@query("union_rm_jhs", JHS + f"{RM_ROWS} union all {JHS_ROWS}", "rm_apps", "jhs_jobs")
def _(i):
    return access.from_yarn(i.rm_apps(), i.jhs_jobs(), states=APP_STATES)


@query("dedup_by_id", """, r as (select *, row_number() over (partition by id order by pos) as rn from v_rm_apps where id <> '')
  select id, "user", name, state, started, pos from r where rn = 1""", "rm_apps")
def _(i):
    return access.dedup_by_id(i.rm_apps()).select(
        "id", "user", "name", "state", F.col("startedTime").alias("started"), "pos")


@query("agg_window_cap_check", """select day, count(*) as fetched from v_spark_apps group by day having count(*) >= 7""",
       "spark_apps")
def _(i):
    return access.capped_days(i.spark_apps(), limit=7)


@query("agg_page_new_counts", """, firsts as (select id, min(page) as page from v_rm_apps where id <> '' group by id),
  n as (select page, count(*) as c from firsts group by page)
  select page, count(*) as fetched, coalesce(max(n.c), 0) as new from v_rm_apps left join n using (page) group by page""",
       "rm_apps")
def _(i):
    return page_counts(i.rm_apps(), "page", "id")


# --- projects ---

@query("cdsw_children_to_access", ALL_KINDS, "projects", "children")
@query("union_cdsw", ALL_KINDS, "projects", "children")
def _(i):
    c = i.children()
    return access.from_cdsw(objects.project_keys(i.projects()), c, c, c, c)


@query("sink_access_csv", JHS + f"select * replace (cast(cnt as varchar) as cnt) from ({RM_ROWS} union all {JHS_ROWS})",
       "rm_apps", "jhs_jobs")
def _(i):
    path = i.scratch("access_csv")
    sinks.write_access(access.from_yarn(i.rm_apps(), i.jhs_jobs(), states=APP_STATES), path)
    back = i.spark.read.options(header="true", escape='"', lineSep="\r\n").csv(path)
    return back.na.fill("").select(ACCESS_COLUMNS)


# --- scalars ---

@query("fn_epoch_ms_to_iso", f"select id, pos, {ISO_MS.format('started')} as iso from v_rm_apps", "rm_apps")
def _(i):
    return i.rm_apps().select("id", "pos", fn.ms_to_iso("startedTime").alias("iso"))


@query("fn_history_ts_to_iso", f"select id, {HISTORY_TS.format('last_start')} as iso from v_spark_apps", "spark_apps")
def _(i):
    return i.view("spark_apps").select("id", fn.history_ts("last_start").alias("iso"))


@query("fn_safe_ts", f"select id, {safe_ts('latest_at')} as latest, {safe_ts('created_at')} as created from v_children",
       "children")
def _(i):
    return i.view("children").select(
        "id", fn.safe_ts("latest_at").alias("latest"), fn.safe_ts("created_at").alias("created"))


@query("fn_date_to_epoch_ms", """select o_orderkey, cast(epoch_ms(cast(strptime(strftime(o_orderdate, '%Y%m%d'), '%Y%m%d')
  as timestamp)) as bigint) as ms from orders""")
def _(i):
    return i.table("orders").select(
        "o_orderkey", fn.date_to_ms(F.date_format("o_orderdate", "yyyyMMdd")).alias("ms"))


@query("fn_job_to_app_id", """select id, case when id like 'job\\_%' escape '\\' then 'application_' || substr(id, 5)
  else id end as app_id from v_jhs_jobs""", "jhs_jobs")
def _(i):
    return i.jhs_jobs().select("id", fn.job_to_app_id("id").alias("app_id"))
