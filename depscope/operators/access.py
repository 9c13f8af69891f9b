"""Application histories and project activity to the shared access table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as fn
from ..model import ACCESS_COLUMNS
from .dedupe import first_per_key
from .objects import with_project


def access_row(window_start, service, user, app_name, op, object_type, object_id) -> list[Column]:
    """One access; these sources know no proxy user or address and count one each."""
    values = [window_start, service, user, "", "", app_name, op, object_type, object_id,
              F.lit(1).cast("bigint")]
    return [
        (v if isinstance(v, Column) else F.lit(v)).alias(name)
        for v, name in zip(values, ACCESS_COLUMNS)
    ]


def with_id(df: DataFrame, column: str = "id") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def dedup_by_id(df: DataFrame, column: str = "id", order: list[str] | None = None) -> DataFrame:
    """First record of each id; records without an id go."""
    return first_per_key(with_id(df, column), [column], order or ["pos"])


def in_states(apps: DataFrame, states: list[str] | None) -> DataFrame:
    return apps.filter(F.col("state").isin(states)) if states else apps


def started_between(df: DataFrame, begin: int | None, end: int | None, column: Column) -> DataFrame:
    """Keep starts within the bounds (epoch ms, both inclusive)."""
    if begin is not None:
        df = df.filter(column >= begin)
    if end is not None:
        df = df.filter(column <= end)
    return df


def job_start() -> Column:
    return F.coalesce(F.nullif("startTime", F.lit(0)), F.col("submitTime"))


def rm_access(apps: DataFrame) -> DataFrame:
    return apps.select(*access_row(
        fn.ms_to_iso("startedTime"), "yarn", fn.or_empty("user"), fn.or_empty("name"),
        "SUBMIT", "application", F.col("id")))


def with_app_id(jobs: DataFrame) -> DataFrame:
    return jobs.withColumn("app_id", fn.job_to_app_id(fn.or_empty("id")))


def jhs_access(jobs: DataFrame) -> DataFrame:
    return jobs.select(*access_row(
        fn.ms_to_iso(job_start()), "yarn", fn.or_empty("user"), fn.or_empty("name"),
        "SUBMIT", "application", F.col("app_id")))


def jobs_not_in_rm(jobs: DataFrame, apps: DataFrame) -> DataFrame:
    """History jobs that the resource manager does not know.

    Both sides are deduplicated by id first, so no key of the join is hot.
    """
    unique = dedup_by_id(with_app_id(jobs), "app_id")
    known = with_id(apps).select(F.col("id").alias("app_id")).distinct()
    return unique.join(known, "app_id", "left_anti")


def from_yarn(
    apps: DataFrame,
    jobs: DataFrame | None = None,
    states: list[str] | None = None,
    begin: int | None = None,
    end: int | None = None,
) -> DataFrame:
    """Resource-manager applications, then history jobs it does not have."""
    chosen = started_between(in_states(apps, states), begin, end, F.col("startedTime"))
    rows = rm_access(dedup_by_id(chosen))
    if jobs is None:
        return rows
    in_range = started_between(jobs, begin, end, job_start())
    return rows.unionByName(jhs_access(jobs_not_in_rm(in_range, chosen)))


def last_attempt(apps: DataFrame) -> DataFrame:
    return apps.withColumn("attempt", F.try_element_at("attempts", F.lit(-1)))


def spark_access(apps: DataFrame) -> DataFrame:
    return last_attempt(apps).select(*access_row(
        fn.history_ts("attempt.startTime"), "spark", fn.or_empty("attempt.sparkUser"),
        fn.or_empty("name"), "SUBMIT", "application", F.col("id")))


def from_spark_history(apps: DataFrame) -> DataFrame:
    return spark_access(dedup_by_id(apps))


def capped_days(apps: DataFrame, limit: int, day: str = "day") -> DataFrame:
    """Days that returned as many applications as were asked for, so may be incomplete."""
    counted = apps.groupBy(day).agg(F.count("*").alias("fetched"))
    return counted.filter(F.col("fetched") >= limit)


# --- projects ---

def _project_access(children: DataFrame, started, user, app_name, op: str) -> DataFrame:
    return children.select(*access_row(
        fn.safe_ts(started), "cdsw", user, app_name, op, "cdsw_project", F.col("pid")))


def job_access(jobs: DataFrame) -> DataFrame:
    started = fn.first_present(F.col("latest.started_at"), "updated_at", "created_at")
    name = fn.or_empty(fn.first_present("name", "title"))
    return _project_access(jobs, started, F.col("project_owner"), name, "JOB")


def session_access(sessions: DataFrame) -> DataFrame:
    user = F.coalesce(fn.present(fn.owner_name("owner")), F.col("project_owner"))
    kernel = fn.or_empty(fn.first_present("kernel", "engine_type"))
    return _project_access(
        sessions, fn.first_present("created_at", "createdAt"), user,
        F.concat(F.lit("session:"), kernel), "SESSION")


def _named_access(children: DataFrame, op: str) -> DataFrame:
    started = fn.first_present("updated_at", "created_at")
    return _project_access(
        children, started, F.col("project_owner"), fn.or_empty("name"), op)


def model_access(models: DataFrame) -> DataFrame:
    return _named_access(models, "MODEL")


def application_access(applications: DataFrame) -> DataFrame:
    return _named_access(applications, "APPLICATION")


def from_cdsw(
    projects: DataFrame,
    jobs: DataFrame,
    sessions: DataFrame | None = None,
    models: DataFrame | None = None,
    applications: DataFrame | None = None,
) -> DataFrame:
    """Accesses of all kinds; a kind that is not given is left out."""
    kinds = [
        (jobs, job_access), (sessions, session_access), (models, model_access),
        (applications, application_access)]
    return reduce(
        DataFrame.unionByName,
        [make(with_project(df, projects)) for df, make in kinds if df is not None])
