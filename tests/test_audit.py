"""Audit pipeline: strict parsing, quirks, properties, folders, sinks and the stream."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from depscope import sinks, sources
from depscope.model import SUMMARY_KEYS
from depscope.operators import audit
from depscope.streaming import ingest_new_files, merged_summary


def lines(spark, *texts):
    return spark.createDataFrame([(t, "f") for t in texts], "line string, source_file string")


def record(**fields):
    return json.dumps(fields)


def sample(n=400):
    """Records over few users, hours and folders, so that groups hold several."""
    return [record(
        evtTime=1704067200000 + i * 613000 if i % 9 else "yesterday", repoName="cm_hdfs", reqUser=f"u{i % 3}",
        cliIP=f"10.0.0.{i % 2}", accessType=["read", "write", "getfileinfo"][i % 3],
        resourcePath=f"/data/d{i % 4}/e/f/g{i}.parquet", app=f"app{i}") for i in range(n)]


def test_strict_json(spark):
    good = ['{"user": "a"}', ' {"user": "a", "user": "b"}\t', '{}', '{"user": {"x": 1}}']
    bad = ['{"a":1} trailing}', '{"a":1}}', "{'a':1}", '{"a":1},{"b":2}', '{bad}', '{"a": 01}']
    skipped = ["", "   ", "text", "[1]", '{"open": 1']
    parsed = audit.parse(lines(spark, *good, *bad, *skipped)).select("record.user", F.col("record").isNull().alias("bad"))
    rows = parsed.collect()
    assert [r.user for r in rows if not r.bad] == ["a", "b", None, '{"x":1}']
    assert sum(r.bad for r in rows) == len(bad)
    # without the shape test, other lines are bad JSON; blank ones are still dropped
    assert audit.parse(lines(spark, *skipped), skip_nonjson=False).count() == 3


def test_first_spelling_with_a_value_wins(spark):
    e = audit.events(lines(spark, record(
        repoName="", repo="hive", user=None, reqUser="u", allowed=False, isAllowed="", evtTime=0, policyId=0,
        resource="db/t"))).first()
    assert (e.service, e.user, e.result, e.policy_id) == ("hive", "u", "DENIED", "0")
    assert e.event_ts == "1970-01-01T00:00:00Z" and e.resource_norm == "db/" and e.do_as == ""


def test_texts_are_cut(spark):
    e = audit.events(lines(spark, record(user="u" * 300, requestData="q" * 17000, resource="/r" * 5000))).first()
    assert len(e.user) == 256 and len(e.request_data) == 16000 and len(e.resource) == 8000


def test_times_that_do_not_parse(spark):
    df = audit.summary(audit.events(lines(
        spark, record(evtTime="noon"), record(evtTime="dusk"), record(), record(evtTime="2024-01-01T10:31:00Z"))))
    got = {r.window_start: (r.first_seen, r.last_seen, r.cnt) for r in df.collect()}
    assert got == {"": ("dusk", "noon", 3), "2024-01-01T10:30:00Z": ("2024-01-01T10:31:00Z",) * 2 + (1,)}


def test_counters(spark):
    row = audit.counters(lines(spark, record(resource="/a/b"), record(resource="/tmp/x"), "{x}", "", "text")).first()
    assert (row.events, row.filtered, row.bad_json, row.files) == (1, 1, 1, 1)


def test_summary_properties(spark):
    events = audit.events(lines(spark, *sample()))
    summary = audit.summary(events, 60)
    assert summary.agg(F.sum("cnt")).first()[0] == events.count() == 400
    assert audit.dependency(events, ops=[]).count() <= summary.count()
    # partial summaries merged give the same as one go, and input order does not matter
    even = events.filter(F.crc32("app_name") % 2 == 0)
    odd = events.filter(F.crc32("app_name") % 2 == 1)
    merged = audit.merge_summaries(audit.summary(even, 60), audit.summary(odd, 60))
    shuffled = audit.summary(events.orderBy(F.desc("app_name")).repartition(5), 60)
    rows = sorted(map(tuple, summary.collect()))
    assert rows == sorted(map(tuple, merged.collect())) == sorted(map(tuple, shuffled.collect()))


def test_dependency_options(spark):
    events = audit.events(lines(spark, *sample()))
    kept = events.filter(F.col("access_type") != "getfileinfo").count()
    for options in ({}, {"include_ip": True}, {"include_app": True}, {"depth": 0}, {"window": "none"}):
        assert audit.dependency(events, **options).agg(F.sum("cnt")).first()[0] == kept
    assert audit.dependency(events, ops=[]).agg(F.sum("cnt")).first()[0] == 400
    row = audit.dependency(events, window="none", depth=1, with_seen=True).filter("user = 'u1'").first()
    assert row.object_id == "/data/" and row.object_type == "hdfs_path" and row.first_seen < row.last_seen
    # address and application come from the same, earliest event
    first = events.filter("user = 'u1'").orderBy("event_ts").first()
    assert (row.client_ip, row.app_name) == (first.client_ip, first.app_name)


def write_tree(root, tree):
    for folder, texts in tree.items():
        (root / folder).mkdir(parents=True)
        for k, text in enumerate(texts):
            (root / folder / f"{k}.json").write_text(text + "\n")


def test_folders(spark, tmp_path):
    write_tree(tmp_path, {
        "hdfs/20240101": ["{}"], "hdfs/20240102": ["{}", "{}"], "hdfs/hdfs/20240102": ["{}"], "hdfs/20249999": ["{}"],
        "hive/hive/20240103": ["{}"], "hive/hive/20240201": ["{}"], "kudu/other/20240101": ["{}"]})
    root, day = str(tmp_path), dt.date
    found = sources.audit_folders(spark, root, day(2024, 1, 1), day(2024, 1, 31))
    assert [f[len(root) + 1:] for f in found] == ["hdfs/20240101", "hdfs/20240102", "hive/hive/20240103"]
    assert sources.audit_folders(spark, root, day(2024, 1, 2), day(2024, 1, 2), ["hdfs", "x"]) == [
        f"{root}/hdfs/20240102"]
    assert sources.audit_lines(spark, root, day(2024, 1, 1), day(2024, 1, 31)).count() == 4
    assert sources.audit_lines(spark, root, day(2024, 1, 1), day(2024, 1, 31), max_files=2).select(
        "source_file").distinct().count() == 2
    with pytest.raises(FileNotFoundError):
        sources.audit_lines(spark, root, day(2020, 1, 1), day(2020, 1, 2))


def test_date_range():
    today = dt.date(2024, 3, 31)
    assert sources.date_range(None, None, today) == (dt.date(2024, 1, 1), today)
    assert sources.date_range("20240101", "20240102", today) == (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    for bad in (("20240101", None), (None, "20240101"), ("20240102", "20240101")):
        with pytest.raises(ValueError):
            sources.date_range(*bad, today)


def test_csv_form(spark, tmp_path):
    df = spark.createDataFrame(
        [("s", "t", ' lead,"q"', "", None, "a|b")], "service string, object_type string, object_id string, owner string, `group` string, extra string")
    sinks.write_objects(df, str(tmp_path / "o"))
    # each part file has a header; a task without rows leaves only that
    parts = [p.read_bytes().decode() for p in sorted((tmp_path / "o").glob("part-*"))]
    header = 'service,object_type,object_id,owner,group,extra\r\n'
    assert all(p.startswith(header) for p in parts)
    assert "".join(p.removeprefix(header) for p in parts) == 's,t," lead,""q""",,,a|b\r\n'


def test_sorted_csv(spark, tmp_path):
    summary = audit.summary(audit.events(lines(spark, *sample())))
    sinks.write_summary(summary, str(tmp_path / "s"))
    rows = []
    for part in sorted((tmp_path / "s").glob("part-*")):
        rows += part.read_text().split("\n")[1:-1]
    keys = [tuple(r.split(",")[:len(SUMMARY_KEYS)]) for r in rows]
    assert keys == sorted(keys) and len(keys) == summary.count()


def test_events_are_optional(spark):
    sinks.write_events(spark.range(1), None)


def test_partitioned_rerun(spark, tmp_path):
    day = spark.createDataFrame(
        [(1704067200000, "a"), (1704153600000, "a"), (None, "b")], "evtTime bigint, repoName string")
    names = ["user", "reqUser", "clientIP", "cliIP", "accessType", "access", "result", "accessResult",
             "resourcePath", "resourceName", "requestData"]
    flat = audit.flat_events(day.select("*", *[F.lit(None).cast("string").alias(n) for n in names]))
    path = str(tmp_path / "e")
    sinks.write_partitioned(flat, path)
    sinks.write_partitioned(flat.filter("ds = '2024-01-01'"), path)
    assert spark.read.parquet(path).count() == 3
    sinks.write_partitioned(flat, path, append=True)
    assert spark.read.parquet(path).count() == 6


def test_service_default_of_flat_events(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"evtTime": 1704067200123, "cliIP": "i", "access": "PUT"}\n')
    flat = audit.flat_events(sources.flat_audit(spark, str(tmp_path)), service="given")
    row = audit.flat_edges(flat).first()
    assert (row.ds, row.service, row.user, row.client_ip, row.op, row.cnt) == (
        "2024-01-01", "given", None, "i", "WRITE", 1)


def test_stream_equals_batch(spark, tmp_path):
    landing, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    landing.mkdir()
    texts = sample()
    for k in range(3):
        (landing / f"{k}.json").write_text("\n".join(texts[k::3]) + "\n")
        ingest_new_files(spark, str(landing), out, state).awaitTermination()
    batch = audit.summary(audit.events(lines(spark, *texts)))
    assert sorted(map(tuple, merged_summary(spark, out).collect())) == sorted(map(tuple, batch.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_aggregates_scan_once_and_hash_events(spark, tmp_path):
    path = str(tmp_path / "events")
    audit.events(lines(spark, *sample(20))).write.parquet(path)
    events = spark.read.parquet(path)
    for df in (audit.summary(events), audit.dependency(events), audit.dependency(events, with_seen=True)):
        plan = _plan(df)
        assert plan.count("FileScan parquet") == 1
        # what stands between the scan and the first exchange hashes
        below = plan[plan.rindex("Exchange"):]
        assert "HashAggregate" in below and "SortAggregate" not in below
        assert "request_data" not in plan and "resource_hash" not in plan
    parsed = audit.events(lines(spark, *sample(5)))._jdf.queryExecution().optimizedPlan().toString()
    assert parsed.count("from_json") == 1


def test_counters_of_a_run(spark, tmp_path):
    day = tmp_path / "hdfs" / "20240101"
    day.mkdir(parents=True)
    (day / "a.json").write_text("\n".join(sample(5)) + "\nnot json\n")
    (day / "empty.json").write_text("")
    span = (dt.date(2024, 1, 1), dt.date(2024, 1, 2))
    found = sources.audit_lines(spark, str(tmp_path), *span)
    assert audit.counters(found).first().files == 1
    counted = audit.counters(found, files=sources.audit_file_count(spark, str(tmp_path), *span)).first()
    assert counted.files == 2 and counted.events == audit.counters(found).first().events
    rows = audit.output_rows(events=audit.events(found), nothing=spark.range(0))
    assert {r.output: r.rows for r in rows.collect()} == {"events": counted.events, "nothing": 0}
