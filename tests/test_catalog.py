"""Listings, Kudu, Hive, projects, histories, lineage and graph on small hand-made inputs."""

import itertools
import json
from pathlib import Path
import random

import pytest
from pyspark.sql import functions as F

from depscope import sinks, sources
from depscope.model import LINEAGE, LINEAGE_COLUMNS, OBJECT_COLUMNS
from depscope.operators import access, lineage, objects
from depscope.operators.dedupe import first_per_key, last_per_key, page_counts
from depscope.operators.skew import product_join, skew_join
from depscope.sources.catalog import parse_kudu_descriptions
from depscope.sources.listing import parse_ls


def test_ls_lines(spark):
    texts = [
        "Found 3 items", "drwxr-xr-x   - hdfs supergroup          0 2025-01-01 12:00 /user",
        "-rw-r--r--   3 spark  spark   12 2025-01-01 12:00 /user/a  b.parquet", "too short", "",
        "-rw-r--r-- 3 o g 1 2025-01-01 12:00 relative/path", "\r"]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    assert [tuple(r) for r in parse_ls(df).collect()] == [
        ("/user", "hdfs", "supergroup", "drwxr-xr-x"), ("/user/a  b.parquet", "spark", "spark", "-rw-r--r--")]


def test_first_entry_of_a_directory(spark):
    df = spark.createDataFrame(
        [("/a/b/c/d", "o2", None, "p2", 2), ("/a/b/c/e", None, "g1", "p1", 1), ("/", "r", "r", "r", 0), ("", "", "", "", 3)],
        "path string, owner string, `group` string, permissions string, pos int")
    rows = sorted(tuple(r) for r in objects.from_listing(df).collect())
    # the root path shortens to a double slash, which the root filter does not catch
    assert rows == [("hdfs", "hdfs_path", "//", "r", "r", "r"), ("hdfs", "hdfs_path", "/a/b/c/", "", "g1", "p1")]


def test_files_keep_their_order(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"{k}.txt").write_text("".join(
            f"-rw-r--r-- 3 o{k}{j} g 1 2025-01-01 12:00 /a/b{j}/c/f\n" for j in range(3)))
    got = {r.object_id: r.owner for r in objects.from_listing(sources.ls_listing(spark, str(tmp_path))).collect()}
    assert got == {f"/a/b{j}/c/": f"o0{j}" for j in range(3)}


def test_kudu(spark, tmp_path):
    (tmp_path / "t.txt").write_text(" b \n\na\nb\n")
    tables = sources.kudu_tables(spark, str(tmp_path / "t.txt"))
    captures = spark.createDataFrame(
        [("a", '{"owner": "x"}', 1), ("b", "no json", 1)], "table_name string, json string, pos int")
    rows = [(r.object_id, r.owner) for r in objects.from_kudu(tables, parse_kudu_descriptions(captures)).collect()]
    assert sorted(rows) == [("a", "x"), ("b", ""), ("b", "")]
    assert [r.object_id for r in objects.from_kudu(tables, max_tables=1).collect()] == ["b"]


def test_hive(spark):
    dbs = spark.createDataFrame([("name", 0), ("sys", 1), ("B", 2), ("a", 3)], "db string, pos int")
    tables = spark.createDataFrame(
        [("B", "t2", 1), ("B", "tab_name", 0), ("B", "t1", 2), ("a", "x", 1), ("sys", "s", 1)],
        "db string, tbl string, pos int")

    def listed(**options):
        return sorted(tuple(r)[:2] for r in objects.hive_tables(dbs, tables, **options).select("db", "tbl").collect())
    assert listed() == [("B", "t1"), ("B", "t2"), ("a", "x")]
    assert listed(max_databases=1, max_tables=1) == [("B", "t2")]
    assert listed(include=["a", "sys"], exclude=[]) == [("a", "x"), ("sys", "s")]
    facts = [("B", "t1", k, line) for k, line in enumerate([
        "owner\tstring\tcolumn", "Owner:\tme\tNULL", "Location:\thdfs://x/a,b", "InputFormat:\tx.OrcInputFormat",
        "comment\tfrom Kudu"])]
    described = spark.createDataFrame(facts, "db string, tbl string, line_no int, line string")
    loose = objects.with_descriptions(tables.filter("db = 'B' and tbl <> 'tab_name'"), objects.describe_pivot(described))
    assert sorted((r.object_id, r.owner, r.extra) for r in objects.from_hive(loose).collect()) == [
        ("B.t1", "me", "storage=kudu|location=hdfs://x/a,b"), ("B.t2", "", "storage=error")]
    strict = objects.from_hive(objects.describe_pivot(described, strict=True), strict=True).first()
    assert strict.extra == "storage=orc|location=hdfs://x/a;b"


def test_yarn(spark):
    apps = spark.createDataFrame(
        [("application_1", "u", None, "FINISHED", 1000, 1), ("application_1", "late", "n", "FINISHED", 1, 2),
         (None, "u", "n", "FINISHED", 1, 3), ("application_2", "u", "n", "NEW", 1000, 4)],
        "id string, user string, name string, state string, startedTime bigint, pos int")
    jobs = spark.createDataFrame(
        [("job_1", "j", "n", 1000, 900, 1), ("job_2", "j", "n", 0, 2000, 2), ("job_2", "again", "n", 1, 1, 3)],
        "id string, user string, name string, startTime bigint, submitTime bigint, pos int")
    rows = sorted((r.object_id, r.user, r.window_start) for r in access.from_yarn(apps, jobs, states=["FINISHED"]).collect())
    assert rows == [("application_1", "u", "1970-01-01T00:00:01Z"), ("application_2", "j", "1970-01-01T00:00:02Z")]
    assert access.from_yarn(apps, begin=500, end=1000).count() == 2


def test_spark_history(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([
        {"id": "a1", "name": "n", "attempts": [{"startTime": "x", "sparkUser": "o"},
                                               {"startTime": "2024-01-01T00:00:00.1GMT", "sparkUser": "u"}]},
        {"id": "a2", "attempts": []}, {"id": "a1", "name": "copy"}, {"name": "no id"}], indent=1))
    (tmp_path / "b.json").write_text('{"error": "busy"}')
    apps = sources.spark_apps(spark, str(tmp_path), multi_line=True)
    rows = sorted((r.object_id, r.window_start, r.user, r.app_name) for r in access.from_spark_history(apps).collect())
    assert rows == [("a1", "2024-01-01T00:00:00Z", "u", "n"), ("a2", "", "", "")]


def test_pages(spark, tmp_path):
    (tmp_path / "1.json").write_text('{"apps": {"app": [{"id": "x"}, {"id": "y"}]}}\n{"apps": null}\n')
    (tmp_path / "2.json").write_text('{"apps": {"app": [{"id": "y"}, {"id": "z"}, {"id": ""}]}}\n')
    counts = page_counts(sources.rm_apps(spark, str(tmp_path)), "page", "id")
    assert [tuple(r)[1:] for r in counts.orderBy("page").collect()] == [(2, 2), (3, 1)]


def test_projects(spark, tmp_path):
    (tmp_path / "p.json").write_text(
        '{"projects": [{"id": 1, "name": "p", "owner": {"username": "u"}}]}\n[{"id": 2, "slug": "s", "owner": "plain"}]\n')
    (tmp_path / "j.json").write_text(
        '{"jobs": [{"project_id": 1, "id": 7, "script": "a.py", "schedule": "1|2", "latest": {"started_at": "2024-01-01T00:00:00.9Z"}}]}\n')
    (tmp_path / "s.json").write_text(
        '[{"project_id": 2, "kernel": "py", "owner": {"name": "w"}, "createdAt": "2024"}, {"project_id": 2}]\n')
    projects = objects.project_keys(sources.cdsw(spark, "projects", str(tmp_path / "p.json")))
    jobs = sources.cdsw(spark, "jobs", str(tmp_path / "j.json"))
    sessions = sources.cdsw(spark, "sessions", str(tmp_path / "s.json"))
    rows = sorted((r.object_type, r.object_id, r.owner, r.extra) for r in objects.from_cdsw(projects, jobs).collect())
    assert rows == [("cdsw_job", "u/p/7", "u", "script=a.py|schedule=1 2"), ("cdsw_project", "plain/s", "plain", ""),
                    ("cdsw_project", "u/p", "u", "")]
    rows = sorted((r.op, r.user, r.app_name, r.window_start) for r in access.from_cdsw(projects, jobs, sessions).collect())
    assert rows == [("JOB", "u", "", "2024-01-01T00:00:00Z"), ("SESSION", "plain", "session:", ""),
                    ("SESSION", "w", "session:py", "2024")]


# --- lineage, against the rules written out as loops ---

def payload(seed):
    """A random payload with several processes, shared entities, copies and gaps."""
    rnd = random.Random(seed)
    data = [f"d{k}" for k in range(5)]
    procs = [f"q{k}" for k in range(3)]
    entities = {g: {"typeName": rnd.choice(["hive_table", "hdfs_path"]), "attributes": {"qualifiedName": rnd.choice([f"own-{g}", None, "same"])}}
                for g in rnd.sample(data, 4)}
    entities.update({g: {"typeName": "spark_Process"} for g in procs})
    items = list(entities.items())
    rnd.shuffle(items)
    relations = []
    for _ in range(12):
        a, b = rnd.choice(data), rnd.choice(procs)
        pair = (a, b) if rnd.random() < .5 else (b, a)
        relations.append({"fromEntityId": pair[0], "toEntityId": rnd.choice([pair[1]] * 9 + [None])})
    return {"seedGuid": f"s{seed}", "lineage": {"guidEntityMap": dict(items), "relations": relations}}


def expected_rows(p, names, by_relation):
    entities, relations = p["lineage"]["guidEntityMap"], p["lineage"]["relations"]

    def name(g):
        own = (entities.get(g, {}).get("attributes") or {}).get("qualifiedName")
        return names.get(g) or own or ""
    kind = {g: e["typeName"] for g, e in entities.items()}
    seen, rows = set(), []
    ends = [(r["fromEntityId"], r["toEntityId"]) for r in relations if r["toEntityId"]]
    for mid in entities:
        if "process" not in kind[mid].lower():
            continue
        for src, dst in itertools.product([f for f, t in ends if t == mid], [t for f, t in ends if f == mid]):
            if src == dst or not name(src) or not name(dst):
                continue
            for a, b, rel in ((src, dst, "WRITES_TO"), (dst, src, "READS_FROM")):
                key = (name(a), name(b), rel) if by_relation else (name(a), name(b))
                if key not in seen:
                    seen.add(key)
                    rows.append((kind.get(a, ""), name(a), kind.get(b, ""), name(b), rel))
    return rows


@pytest.fixture(scope="module")
def dump(tmp_path_factory):
    root = tmp_path_factory.mktemp("dump")
    for part in ("entities", "lineage"):
        (root / part).mkdir()
    payloads = [payload(k) for k in range(60)]
    (root / "lineage" / "a.jsonl").write_text("\n".join(json.dumps(p) for p in payloads[:30]) + "\n\n")
    (root / "lineage" / "b.jsonl").write_text("\n".join(json.dumps(p) for p in payloads[30:]))
    records = [
        {"guid": "d1", "typeName": "hive_table", "attributes": {"qualifiedName": "first"}},
        {"guid": "d1", "typeName": "hive_table", "attributes": {"qualifiedName": "global-1", "name": "n", "extra": 1}},
        {"guid": "d1", "typeName": "hive_table", "attributes": {"qualifiedName": ""}},
        {"guid": "d2", "typeName": "aws_s3", "attributes": None, "uniqueAttributes": {"qualifiedName": "global-2"}},
        {"guid": "d3", "typeName": "process"}]
    (root / "entities" / "e.jsonl").write_text("\n".join(json.dumps(r) for r in records))
    return str(root), payloads


@pytest.mark.parametrize("dedupe", ["pair", "triple"])
def test_collapse(spark, dump, dedupe):
    path, payloads = dump
    names = {"d1": "global-1", "d2": "global-2"}
    want = [r for p in payloads for r in expected_rows(p, names, dedupe == "triple")]
    df = lineage.collapse(sources.lineage_payloads(spark, path), sources.entities(spark, path), dedupe)
    assert sorted(map(tuple, df.select(LINEAGE_COLUMNS).collect())) == sorted(want) and len(want) > 200


def test_both_ways_keep_two_or_four_rows(spark):
    rows = [(1, "P", 1, "in", 0, "A"), (1, "P", 1, "out", 1, "B"), (1, "Q", 2, "in", 2, "B"), (1, "Q", 2, "out", 3, "A")]
    links = spark.createDataFrame(rows, "payload_id int, proc string, proc_pos int, role string, rel_pos int, guid string") \
        .withColumn("object_type", F.lit("t")).withColumn("own_name", F.col("guid")).withColumn("name", F.col("guid"))
    assert lineage.edges_from_links(links, "pair").count() == 2
    assert lineage.edges_from_links(links, "triple").count() == 4
    with pytest.raises(ValueError):
        lineage.edges_from_links(links, "other")


def test_graph(spark, dump, tmp_path):
    path, payloads = dump
    nodes = lineage.vertices(sources.entities(spark, path))
    by_guid = {r.guid: r for r in nodes.collect()}
    assert set(by_guid) == {"d1", "d2", "d3"} and by_guid["d1"].qualifiedName == ""
    assert by_guid["d1"].name == "d1" and json.loads(by_guid["d2"].raw)["attributes"] is None
    want = set()
    for p in payloads:
        ends = [(r["fromEntityId"], r["toEntityId"]) for r in p["lineage"]["relations"] if r["toEntityId"]]
        for mid in ("q0", "q1", "q2"):
            for s, d in itertools.product([f for f, t in ends if t == mid], [t for f, t in ends if f == mid]):
                if s != d and {s, d} <= set(by_guid):
                    want |= {(s, d, "WRITES_TO"), (d, s, "READS_FROM")}
    edges = lineage.graph(sources.lineage_payloads(spark, path), nodes)
    assert sorted(map(tuple, edges.collect())) == sorted(want)
    loaded = sinks.upsert_vertices(nodes, nodes.withColumn("name", F.lit("new")))
    assert {r.name for r in loaded.collect()} == {"new"}
    where = str(tmp_path / "g")
    assert sinks.read_graph(spark, where) is None
    sinks.write_graph(nodes, edges, where)
    assert sinks.read_graph(spark, where)[1].count() == len(want)
    # changed records, loaded into the graph that is read meanwhile
    before = sinks.read_graph(spark, where)
    changed = before[0].limit(2).withColumn("name", F.lit("changed"))
    for _ in range(2):
        sinks.upsert_graph(changed, edges, where)
    stored, linked = sinks.read_graph(spark, where)
    assert sorted(r.guid for r in stored.collect()) == sorted(by_guid) and linked.count() == len(want)
    assert stored.filter("name = 'changed'").count() == 2
    assert before[0].filter("name = 'changed'").count() == 0  # readers of the earlier load go on


def _files(path):
    return {p: p.stat().st_size for p in path.rglob("*.parquet")}


@pytest.fixture
def graph(spark, tmp_path):
    """A graph of 20,000 vertices in 40 buckets, and its edges."""
    nodes = spark.range(20_000).select(F.concat(F.lit("g"), "id").alias("guid"), F.lit("t").alias("typeName"), F.lit("first").alias("name"))
    edges = spark.range(20_000).select(F.concat(F.lit("g"), "id").alias("src"), F.concat(F.lit("g"), (F.col("id") * 7) % 20_000).alias("dst"), F.lit("R").alias("rel"))
    sinks.write_graph(nodes, edges, str(tmp_path / "g"), buckets=40)
    return nodes, edges, tmp_path / "g"


def test_load_writes_touched_buckets_only(spark, graph):
    nodes, edges, path = graph
    first = _files(path)
    few = nodes.limit(2).withColumn("name", F.lit("changed"))
    new = spark.createDataFrame([("g1", "g2", "NEW"), ("g1", "nobody", "NEW"), ("x", "g1", "NEW"), ("g3", "g21", "R")], "src string, dst string, rel string")
    sinks.upsert_graph(few, new, str(path))
    second = _files(path)
    added = {p: n for p, n in second.items() if p not in first}
    assert {p: second[p] for p in first} == first and 0 < sum(added.values()) < 0.15 * sum(first.values())
    stored, linked = sinks.read_graph(spark, str(path))
    assert stored.count() == 20_000 and stored.filter("name = 'changed'").count() == 2
    assert linked.count() == 20_001 and [tuple(r) for r in linked.filter("rel = 'NEW'").collect()] == [("g1", "g2", "NEW")]
    # the same load again changes nothing and writes nothing
    sinks.upsert_graph(few, new, str(path))
    assert _files(path) == second and len(list(path.glob("manifests/0*.json"))) == 2
    assert sinks.vacuum_graph(spark, str(path)) > 0
    stored, linked = sinks.read_graph(spark, str(path))
    assert stored.count() == 20_000 and linked.count() == 20_001
    assert sum(_files(path).values()) < 1.2 * sum(first.values())


def test_new_nodes_and_edges_between_them(spark, graph):
    _, _, path = graph
    new = spark.createDataFrame([("n1", "t", None), ("n2", None, "b")], "guid string, typeName string, name string")
    edges = spark.createDataFrame([("n1", "n2", "R"), ("n2", "g5", "R"), ("n2", "n2", "R")] * 2, "src string, dst string, rel string")
    for _ in range(2):
        sinks.upsert_graph(new, edges, str(path))
    stored, linked = sinks.read_graph(spark, str(path))
    assert stored.count() == 20_002 and linked.filter("src like 'n%'").count() == 3 and linked.count() == 20_003
    sinks.upsert_graph(new.limit(0), edges.limit(0), str(path))
    assert len(list(path.glob("manifests/0*.json"))) == 2
    empty = str(path) + "_empty"
    sinks.upsert_graph(new.limit(0), edges.limit(0), empty)
    assert [t.count() for t in sinks.read_graph(spark, empty)] == [0, 0]
    sinks.upsert_graph(new, edges, empty)
    assert [t.count() for t in sinks.read_graph(spark, empty)] == [2, 2]


def test_broken_load_leaves_the_graph(spark, graph, monkeypatch):
    nodes, edges, path = graph

    def fail(*_):
        raise OSError("lost")
    monkeypatch.setattr(sinks._Manifest, "commit", fail)
    with pytest.raises(OSError):
        sinks.upsert_graph(nodes.limit(50).withColumn("name", F.lit("changed")), edges.limit(0), str(path))
    monkeypatch.undo()
    stored, linked = sinks.read_graph(spark, str(path))
    assert stored.filter("name = 'changed'").count() == 0 and stored.count() == 20_000 and linked.count() == 20_000
    # of two loads that start from one state the second fails
    late = sinks._Manifest(spark, str(path))
    sinks.upsert_graph(nodes.limit(5).withColumn("name", F.lit("changed")), edges.limit(0), str(path))
    with pytest.raises(OSError):
        late.commit(late.content)
    assert sinks.read_graph(spark, str(path))[0].filter("name = 'changed'").count() == 5


def test_no_lineage_folder(spark, tmp_path):
    assert sources.lineage_payloads(spark, str(tmp_path)) is None


# --- hot keys ---

@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("copies", [False, True])
def test_skew_join(spark, how, copies):
    """A third of the rows has one key; with ``copies`` these rows are all the same."""
    value = F.lit(0) if copies else F.col("id")
    left = spark.range(3000).repartition(4).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 != 1, F.col("id")).alias("k"), value.alias("v"))
    right = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).union(
        spark.sql("select 1L, 5L")).union(spark.sql("select 1L, 6L"))
    joined = skew_join(left, right, ["k"], how, key_rows=100)
    assert "_part" in joined._jdf.queryExecution().optimizedPlan().toString()
    plain = left.join(right, ["k"], how)
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.collect()))


@pytest.mark.parametrize("key_rows", [100, 10**6])
def test_skew_join_of_distinct_rows(spark, monkeypatch, key_rows):
    """Equal rows are joined once, without a shuffle of their own, in tasks of a bounded number of rows."""
    from depscope.operators import skew
    monkeypatch.setattr(skew, "TASK_ROWS", 500)
    left = spark.range(6000).repartition(4).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 != 1, F.col("id") % 900).alias("k"), (F.col("id") % 1800).alias("v"))
    right = spark.range(0, 900, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    joined = skew_join(left, right, ["k"], "left", key_rows=key_rows, distinct=True)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ", 12), REPARTITION_BY_NUM" in plan and plan.count("HashAggregate") <= 2
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, left.distinct().join(right, ["k"], "left").collect()))


def test_join_without_hot_keys_is_plain(spark):
    left = spark.range(5000).withColumnRenamed("id", "k")
    assert "_part" not in skew_join(left, left, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    with pytest.raises(TypeError):
        skew_join(left, left.select(F.col("k").cast("int")), ["k"])


@pytest.mark.parametrize("pairs", [7, 100, 10**6])
def test_product_join(spark, pairs):
    left = spark.range(400).select((F.col("id") % 7 * (F.col("id") % 3)).alias("k"), F.col("id").alias("a"))
    right = spark.range(300).select((F.col("id") % 5).alias("k"), F.lit(1).alias("b"))
    joined = product_join(left, right, ["k"], pairs)
    assert ("_rows" in joined._jdf.queryExecution().optimizedPlan().toString()) == (pairs < 10**6)
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, left.join(right, ["k"]).collect()))


def test_hot_process_is_cut_into_even_tasks(spark):
    """One process with 3,000 inputs and outputs among ordinary ones: no task makes most pairs."""
    hot = [(1, "P", r, k, f"{r}{k}") for r in ("in", "out") for k in range(3000)]
    cold = [(k, "P", r, 0, f"{r}{k}") for r in ("in", "out") for k in range(2, 3000)]
    df = spark.createDataFrame(hot + cold, "payload_id long, proc string, role string, rel_pos int, guid string").withColumn("proc_pos", F.lit(1))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        made = lineage.two_hop(df).groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    counts = sorted(r.n for r in made)
    assert sum(counts) == 3000 * 3000 + 2998 and counts[-1] <= 4_000_000 and len([n for n in counts if n > 500_000]) >= 4


def test_large_payload_takes_linear_time(spark):
    """Four times the relations take about four times as long at most."""
    import time

    def seconds(n):
        entities = {f"e{k}": {"typeName": "hive_table"} for k in range(n)} | {"q": {"typeName": "spark_process"}}
        relations = [{"fromEntityId": f"e{k}", "toEntityId": "q"} for k in range(n)]
        text = json.dumps({"lineage": {"guidEntityMap": entities, "relations": relations}})
        df = spark.createDataFrame([(text,)], "t string").select(F.inline(F.array(F.from_json("t", LINEAGE))))
        began = time.time()
        assert lineage.links(df).count() == n
        return time.time() - began
    seconds(1000)
    assert seconds(32_000) <= 4 * max(1.5, seconds(8_000))


def test_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 1, "z")], "k string, n int, v string")
    assert sorted(map(tuple, first_per_key(df, ["k"], ["n"]).collect())) == [("a", 1, None), ("b", 1, "z")]
    assert sorted(map(tuple, last_per_key(df, ["k"], ["n"]).collect())) == [("a", 2, "x"), ("b", 1, "z")]


def test_live_catalog(spark):
    spark.range(1).write.mode("overwrite").format("parquet").saveAsTable("default.depscope_t")
    try:
        tables = sources.live_hive_listing(spark, ["default"])
        assert ("default.depscope_t",) in [tuple(r) for r in objects.from_hive_list(tables).select("object_id").collect()]
        facts = objects.describe_pivot(sources.live_describe(spark, ("default", "no_such"), ("default", "depscope_t"))).first()
        assert (facts.table_type, facts.storage_format) == ("MANAGED", "parquet")
    finally:
        spark.sql("drop table default.depscope_t")


def test_object_columns(spark, dump):
    assert objects.from_entities(sources.entities(spark, dump[0])).columns == OBJECT_COLUMNS


# --- damaged and unexpected input ---

ODD_PAGES = '{"error": "busy"}\n{}\n{"projects": null}\n[]\n{"apps": {"app": null}}\n{"jobs": null}\n[{"id": "a1"}, null]\n{"id": "lone", "name": "object"}\n'


def test_unexpected_pages_invent_nothing(spark, tmp_path):
    (tmp_path / "p.json").write_text(ODD_PAGES + '{"projects": [{"id": 1}]}\n{"apps": {"app": [{"id": "r"}]}}\n{"jobs": {"job": [{"id": "j"}]}}\n')
    read = {kind: [r.id for r in f(spark, str(tmp_path)).collect()] for kind, f in (
        ("rm", sources.rm_apps), ("jhs", sources.jhs_jobs), ("spark", sources.spark_apps),
        ("cdsw", lambda s, p: sources.cdsw(s, "projects", p)))}
    assert read == {"rm": ["r"], "jhs": ["j"], "spark": ["a1"], "cdsw": ["a1", "1"]}
    assert sources.damaged(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("reader", [
    sources.rm_apps, sources.jhs_jobs, sources.spark_apps, lambda s, p, **o: sources.cdsw(s, "jobs", p, **o)])
def test_cut_off_pages_are_told(spark, tmp_path, reader):
    whole = '{"apps": {"app": [{"id": "r"}]}, "jobs": {"job": [{"id": "j"}]}}\n[{"id": "s"}]\n'
    (tmp_path / "a.json").write_text(whole + '[{"id": "x"}, {"id"\n{"apps": {"app": [{"id": "y"}\n\n')
    with pytest.raises(Exception, match="damaged JSON in"):
        reader(spark, str(tmp_path)).collect()
    (tmp_path / "sound").mkdir()
    (tmp_path / "sound" / "a.json").write_text(whole)
    assert reader(spark, str(tmp_path / "a.json"), bad="skip").select("id").collect() == reader(spark, str(tmp_path / "sound")).select("id").collect()
    assert sources.damaged(spark, str(tmp_path / "a.json")).count() == 2
    with pytest.raises(ValueError):
        reader(spark, str(tmp_path), bad="other")


def test_cut_off_export_lines_are_told(spark, tmp_path):
    for part in ("entities", "lineage", "search"):
        (tmp_path / part).mkdir()
        (tmp_path / part / "hive_table.jsonl").write_text('{"guid": "g", "attributes": 7}\n{"guid": "h", "attri\n')
    for reader in (sources.entities, sources.lineage_payloads, sources.search_results):
        with pytest.raises(Exception, match="damaged JSON in"):
            reader(spark, str(tmp_path)).collect()
        assert reader(spark, str(tmp_path), bad="skip").count() == 1
    found = sources.search_results(spark, str(tmp_path), bad="skip").first()
    assert (found.search_type, found.guid) == ("hive_table", "g")
    assert sources.damaged(spark, str(tmp_path / "entities"), pattern="*.jsonl").count() == 1


def test_export_round_trip(spark, dump, tmp_path):
    entities = sources.entities(spark, dump[0]).drop("raw", "pos")
    for _ in range(2):
        sinks.write_json_by_type(entities, str(tmp_path / "entities"))
    back = sources.entities(spark, str(tmp_path)).drop("raw", "pos")
    assert sorted(map(str, back.select(entities.columns).collect())) == sorted(map(str, entities.collect()))
    sinks.write_errors(spark.createDataFrame([("g", "HTTP 500")], "guid string, error string"), str(tmp_path))
    assert spark.read.json(str(tmp_path / "errors")).first().error == "HTTP 500"
    (tmp_path / "search").mkdir()
    (tmp_path / "search" / "t.jsonl").write_text("".join(f'{{"guid": "{g}"}}\n' for g in ("c", "a", "", "c", "b")))
    guids = objects.guids_by_type(objects.search_hits(sources.search_results(spark, str(tmp_path))), "search_type")
    sinks.write_guids_by_type(guids, str(tmp_path), "search_type")
    lines = [json.loads(x) for p in sorted((tmp_path / "guids_by_type").glob("part-*")) for x in p.read_text().splitlines()]
    assert [x["guid"] for x in lines] == ["c", "a", "b"]


def test_stored_tables_can_be_dropped(spark):
    from depscope.session import drop_stored, store
    drop_stored(spark)
    kept = store(spark.range(3), "x")
    assert kept.count() == 3 and drop_stored(spark) == 1 and drop_stored(spark) == 0


def test_kudu_descriptions_by_file(spark, tmp_path):
    (tmp_path / "db.t 1.json").write_text('{"owner": "x",\n "columns": []}')
    (tmp_path / "db.t2.json").write_text("no json")
    described = sources.kudu_descriptions(spark, str(tmp_path))
    assert sorted((r.table_name, r.owner) for r in described.collect()) == [("db.t 1", "x"), ("db.t2", "")]
    tables = spark.createDataFrame([("db.t 1", 1), ("db.t2", 2)], "table_name string, pos int")
    assert objects.owner_counts(objects.from_kudu(tables, described)).first() == (1, 2)


def test_jdbc_listing_is_read_in_parallel(spark):
    with pytest.raises(ValueError, match="numPartitions"):
        sources.jdbc_listing(spark, {"url": "jdbc:none"})


@pytest.mark.parametrize("dedupe", ["pair", "triple"])
def test_small_payloads_stay_one_row(spark, dump, monkeypatch, dedupe):
    """Links are found without a shuffle, the same as by joins; so are pairs, whichever way they go."""
    path, _ = dump

    def found():
        return lineage.links(sources.lineage_payloads(spark, path)).drop("payload_id")

    def rows():
        made = lineage.collapse(sources.lineage_payloads(spark, path), sources.entities(spark, path), dedupe)
        return sorted(map(repr, made.drop("payload_id").collect()))
    near = lineage.links(sources.lineage_payloads(spark, path)).drop("payload_id").collect()
    slim = lineage.slim_payloads(sources.lineage_payloads(spark, path))
    assert slim.where("relations is not null").isEmpty()
    want = rows()
    monkeypatch.setattr(lineage, "PAIRED_IN_ROW", 2)
    assert rows() == want
    monkeypatch.setattr(lineage, "IN_ROW", 12)
    assert sorted(map(repr, found().collect())) == sorted(map(repr, near)) and rows() == want and len(near) > 100
    monkeypatch.setattr(lineage, "PAYLOAD_LINKS", 3)
    assert rows() == want


def test_pairs_need_one_shuffle_of_links(spark):
    rows = [(p, "P", 1, r, k, f"{r}{k}") for p in range(50) for r in ("in", "out") for k in range(3)]
    df = spark.createDataFrame(rows, "payload_id long, proc string, proc_pos int, role string, rel_pos int, guid string") \
        .withColumn("object_type", F.lit("t")).withColumn("name", F.col("guid"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = lineage.edges_from_links(df)
        assert len(edges.collect()) == 50 * 18
        plan = edges._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 2  # inputs and outputs, each once
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_landed_dump_is_compressed(spark, tmp_path):
    from depscope.plans.inputs import Inputs
    li = spark.range(3000).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"),
                                  F.lit("R").alias("l_returnflag"))
    li.write.parquet(str(tmp_path / "lineitem.parquet"))
    payloads = Inputs(spark, str(tmp_path)).payloads()
    size = payloads.select(F.sum(F.length(F.to_json(F.struct("seedGuid", "typeName", "lineage"))))).first()[0]
    part = spark.createDataFrame([(1, 1, "b", "n", "t")], "p_partkey long, p_size int, p_brand string, p_name string, p_type string")
    part.write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1, "n")], "s_suppkey long, s_name string").write.parquet(str(tmp_path / "supplier.parquet"))
    path = Inputs(spark, str(tmp_path)).catalog_dump()
    landed = list(Path(path.removeprefix("file:")).glob("lineage/part-*"))
    assert 0 < sum(f.stat().st_size for f in landed) < size / 5
    assert sources.lineage_payloads(spark, path, pattern="*.txt.gz").count() == 3000


def test_known_links_are_found_once(spark, tmp_path):
    """Pairs read the links at known nodes several times; the join with the nodes runs once."""
    from depscope.plans.registry import all_queries
    spark.createDataFrame([(1, 1, 1, 1), (1, 2, 9, 1), (2, 1, 1, 2)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, 5, "P")], "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame([(1, 1, "b", "n", "t")], "p_partkey long, p_size int, p_brand string, p_name string, p_type string") \
        .write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(1, "n")], "s_suppkey long, s_name string").write.parquet(str(tmp_path / "supplier.parquet"))
    edges = all_queries()["join_edges_to_nodes"](spark, str(tmp_path))
    assert "LeftSemi" not in edges._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, edges.collect())) == [("p1", "s1", "READS_FROM"), ("s1", "p1", "WRITES_TO")]


def _order_tables(spark, path, rows, orders=((1, 5, "P"),)):
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long").repartition(5).write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame(list(orders), "o_orderkey long, o_custkey long, o_orderstatus string").write.parquet(f"{path}/orders.parquet")


def test_links_land_payload_by_payload(spark, tmp_path):
    """The links of one payload are in one file, in which they stand together; null keys and repeated rows too."""
    from depscope.plans.inputs import Inputs
    rows = [(k % 300 if k % 50 else None, k % 7, k % 11, k % 13) for k in range(3000)]
    _order_tables(spark, tmp_path, rows + rows[:100], [(k, k, "P") for k in range(40)])
    for view in ("links", "supply_links"):
        i = Inputs(spark, str(tmp_path))
        landed = i.links(view).drop("own_name", "name")
        plain = lineage.distinct_links(i.view(view)).select(*landed.columns)
        assert sorted(map(repr, landed.collect())) == sorted(map(repr, plain.collect()))
        at = landed.select("payload_id", F.input_file_name().alias("file")).collect()
        assert len({r.file for r in at}) > 1
        runs = [r for k, r in enumerate(at) if not k or at[k - 1] != r]
        assert len(runs) == len({r.payload_id for r in at}) > 290


def test_sift(spark):
    """No matching row is sure, whatever its key, and few others are in doubt."""
    from depscope.operators import skew
    df = spark.range(100_000).select(F.concat(F.lit("k"), "id").alias("k"), F.when(F.col("id") % 9 != 0, F.col("id") % 5).alias("m")).union(spark.sql("select null, 1L"))
    keys = df.where(F.hash("k") % 10 == 0).union(spark.sql("select null, 1L"))
    surely, perhaps = skew.sift(df, keys, ["k", "m"])
    n = surely.count()
    assert n + perhaps.count() == 100_001 and n > 0.9 * (100_001 - keys.count())
    assert surely.join(keys, [surely.k.eqNullSafe(keys.k), surely.m.eqNullSafe(keys.m)], "left_semi").isEmpty()
    assert skew.sift(df, keys.limit(0), ["k", "m"])[1].isEmpty()


@pytest.mark.parametrize("limit", [10**6, 3])
def test_connected_links_stay_where_they_are(spark, monkeypatch, limit):
    """Only GUIDs move, and the links that a bitmap of unknown ones lets through."""
    from depscope import session
    from depscope.operators import skew
    monkeypatch.setattr(skew, "SIFTED_KEYS", limit)
    links = spark.range(20_000).select((F.col("id") % 500).alias("payload_id"), F.when(F.col("id") % 100 != 7, F.concat(F.lit("g"), F.col("id") % 1000)).alias("guid"))
    nodes = spark.range(990).select(F.concat(F.lit("g"), "id").alias("guid")).union(spark.sql("select 'g1'"))
    found = lineage.connected_links(links, nodes)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, links.join(nodes.distinct(), "guid", "left_semi").select(links.columns).collect()))
    if limit > 3:
        stored = [p for p in session._STORED[spark.sparkContext.applicationId] if p.endswith("links_to_test")]
        assert 0 < spark.read.parquet(stored[-1]).count() < 2000


# --- loads into a stored graph ---

def test_load_adds_edges_without_writing_known_ones(spark, graph):
    """A few edges in every bucket: known edges stay in their files, and loads add up to a bounded number of folders."""
    _, edges, path = graph
    first = _files(path)
    for k in range(20):
        new = spark.range(150).select(F.concat(F.lit("g"), F.col("id") * 3 + k).alias("src"), F.concat(F.lit("g"), F.col("id") * 7).alias("dst"), F.lit(f"N{k}").alias("rel"))
        sinks.upsert_graph(spark.createDataFrame([], "guid string, typeName string, name string"), new.union(edges.limit(500)), str(path))
        if not k:
            second = _files(path)
            assert {p: second[p] for p in first} == first
            known = sum(n for p, n in first.items() if "edges" in str(p))
            assert 0 < sum(n for p, n in second.items() if p not in first) < 0.5 * known
    linked = sinks.read_graph(spark, str(path))[1]
    assert linked.count() == linked.distinct().count() == edges.count() + 20 * 150
    held = sinks._Manifest(spark, str(path)).content["edges"]
    assert max(len(f) for f in held.values()) <= sinks.EDGE_FOLDERS
    sinks.vacuum_graph(spark, str(path))
    assert sinks.read_graph(spark, str(path))[1].count() == linked.count()


def test_load_into_a_graph_by_source(spark, graph, monkeypatch):
    """A graph stored before edges lay by both ends, in one folder a bucket, is loaded as it is."""
    nodes, edges, path = graph
    old = str(path) + "_old"
    plain = sinks._edge_bucket
    monkeypatch.setattr(sinks, "_edge_bucket", lambda content: plain({"buckets": content["buckets"]}))
    sinks.write_graph(nodes, edges, old, buckets=40)
    monkeypatch.undo()
    manifest = sinks._Manifest(spark, old)
    content = dict(manifest.content)
    del content["edges_by"]
    manifest.commit(content)
    new = spark.createDataFrame([("g1", "g2", "NEW"), ("g2", "g1", "NEW")], "src string, dst string, rel string")
    sinks.upsert_graph(nodes.limit(0), new.union(edges.limit(300)), old)
    linked = sinks.read_graph(spark, old)[1]
    assert linked.count() == linked.distinct().count() == edges.count() + 2


def test_edges_come_by_bucket(spark, tmp_path):
    """Each task's edges are in one bucket, and are written where they lie."""
    rows = [(k % 90, "P", r, f"{r}{k % 31}" if k % 5 else f"x{k % 7}") for k in range(900) for r in ("in", "out")] + [(None, "P", "in", "a"), (3, None, "in", "a")]
    links = spark.createDataFrame(rows, "payload_id long, proc string, role string, guid string")
    edges = lineage.edges_by_guid(links, 8)
    assert sorted(map(tuple, edges.collect())) == sorted(map(tuple, lineage.edges_by_guid(links).collect()))
    tasks = edges.select(F.spark_partition_id().alias("t"), lineage.pair_bucket("src", "dst", 8).alias("b")).distinct().collect()
    assert len(tasks) == len({r.t for r in tasks}) == 8
    nodes = edges.select(F.col("src").alias("guid")).distinct()
    path = str(tmp_path / "g")
    sinks.write_graph(nodes, edges, path, buckets=8, dealt=True)
    assert sorted(map(tuple, sinks.read_graph(spark, path)[1].collect())) == sorted(map(tuple, edges.collect()))
    assert len(list(Path(path).glob("edges/*/bucket=*/*.parquet"))) == 8


def test_links_of_a_row_are_told_apart_once(spark, monkeypatch):
    """Stored links of a payload are distinct, with the first place of each, and those that joins would find."""
    rng = random.Random(7)
    texts = []
    for _ in range(60):
        names = [rng.choice("abpq") + str(rng.randrange(3)) for _ in range(rng.randrange(7))]  # some twice
        entities = ", ".join(json.dumps(x) + ": " + json.dumps({"typeName": "Hive_Process" if x[0] in "pq" else rng.choice(["t", None, "u"]), "attributes": {"qualifiedName": rng.choice(["n" + x, "", None])}}) for x in names)
        ends = [*names, "zz", "", None]
        relations = json.dumps([{"fromEntityId": rng.choice(ends), "toEntityId": rng.choice(ends)} for _ in range(rng.randrange(25))])
        texts.append((f'{{"lineage": {{"guidEntityMap": {{{entities}}}, "relations": {relations}}}}}',))
    texts += [('{"lineage": {"relations": [{"fromEntityId": "a"}]}}',), ('{"lineage": {"guidEntityMap": {"p": {"typeName": "process"}}}}',), ('{"lineage": null}',)]
    df = spark.createDataFrame(texts, "t string").coalesce(1).select(F.inline(F.array(F.from_json("t", LINEAGE))))
    columns = lineage.LINK_COLUMNS
    plain = lineage.links(df).select(*columns)
    once = lineage.slim_payloads(df, distinct=True).select("payload_id", F.inline("found")).select(*columns)
    in_rows = {r.payload_id for r in lineage.slim_payloads(df).where("relations is null").select("payload_id").collect()}
    want = [r for r in map(tuple, lineage.distinct_links(plain).select(*columns).collect()) if r[0] in in_rows]
    assert len(in_rows) > 20 and sorted(want) == sorted(map(tuple, once.collect())) and len(want) < plain.count()
    monkeypatch.setattr(lineage, "IN_ROW", -1)
    assert sorted(map(tuple, lineage.links(df).select(*columns).collect())) == sorted(map(tuple, plain.collect()))


def test_lineage_csv_in_small_files(spark, tmp_path):
    rows = [("hive_table", f"d{k % 9}, \"x\"", "hdfs_path", f" n{k % 5}", "WRITES_TO") for k in range(3000)]
    df = spark.createDataFrame(rows, LINEAGE_COLUMNS)
    for kind in ("none", "gzip"):
        sinks.write_lineage(df, str(tmp_path / kind), compression=kind)
        back = spark.read.options(header="true", escape='"', lineSep="\r\n", multiLine="true").csv(str(tmp_path / kind))
        assert sorted(map(tuple, back.collect())) == sorted(rows)
    plain, small = (sum(f.stat().st_size for f in (tmp_path / kind).glob("part-*")) for kind in ("none", "gzip"))
    assert small < plain / 5 and list((tmp_path / "none").glob("part-*.csv")) and list((tmp_path / "gzip").glob("part-*.csv.gz"))
