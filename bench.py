"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

python bench.py [name …] times other queries instead; ``all`` times every one.
"""

from __future__ import annotations

import json
import os
import sys
import time

from depscope.plans.registry import all_queries
from depscope.session import local_session

HEADLINE = [
    "scan_audit_pruned", "audit_normalize", "audit_normalize_parquet", "agg_summary",
    "agg_dependency", "agg_dependency_ip", "agg_edges_daily", "agg_merge_partials",
    "agg_run_counters", "listing_to_object", "hive_to_object", "entity_to_object",
    "join_owner_map", "union_rm_jhs", "spark_app_to_access", "union_cdsw",
    "join_guid_to_name", "join_lineage_two_hop", "lineage_collapse_triple",
    "dedup_lineage_pair", "join_edges_to_nodes", "sort_summary", "agg_sample_value",
    "sink_graph_edges", "scan_cdsw",
]


def seconds(build, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    registered = all_queries()
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(registered)
    spark = local_session(cores, cores)
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        # the first run lands the input files and compiles the plan; the better of two is kept
        first = seconds(registered[name], spark, sf_dir)
        timings[name] = min(first, seconds(registered[name], spark, sf_dir))
        print(f"{name}: {first} then {timings[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cores,
    }))


if __name__ == "__main__":
    main()
