"""Names of the registered queries, and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from .inputs import Inputs
from .views import check_sql

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None, *views: str):
    """Register a query on ``Inputs``; ``sql`` is its check over the named views."""
    def register(build: Callable[[Inputs], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Inputs(configure(spark), sf_dir))

        _QUERIES[name] = run
        if sql is not None:
            _CHECKS[name] = check_sql(sql, *views)
        return build
    return register


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import access_queries, audit_queries, combined_queries, lineage_queries, object_queries  # noqa: F401
    return dict(_QUERIES)


def all_checks() -> dict[str, str]:
    all_queries()
    return dict(_CHECKS)
