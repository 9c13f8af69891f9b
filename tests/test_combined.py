"""Access with its objects, united objects and the object graph on small inputs by hand."""

import pytest
from pyspark.sql import functions as F

from depscope.model import OBJECT_COLUMNS
from depscope.operators import combined, skew

OBJECTS = [
    ("hdfs", "hdfs_path", "/a/", "top", "g", ""), ("hdfs", "hdfs_path", "/a/b//c/", "deep", "g", ""), ("hdfs", "hdfs_path", "/", "root", "", ""),
    ("hive", "hive_table", "db.t", "owner", "", "type=X|location=hdfs://nn:8020/w/t/|storage=orc"), ("hive", "hive_table", "db.u", "second", "", "location=/w/t"),
    ("kudu", "kudu_table", "db.t", "k", "", ""),
]


def objects(spark, rows=OBJECTS):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in OBJECT_COLUMNS))


def access(spark, rows):
    return spark.createDataFrame(rows, "object_type string, object_id string, user string, op string, cnt bigint")


@pytest.mark.parametrize("key_rows", [skew.KEY_ROWS, 3])
def test_deepest_object_wins(spark, monkeypatch, key_rows):
    monkeypatch.setattr(combined, "skew_join", lambda a, b, on, how="inner": skew.skew_join(a, b, on, how, key_rows))
    want = {
        ("hdfs_path", "/a/b/c/d/e"): "/a/b//c/", ("hdfs_path", "/a/b/c"): "/a/b//c/", ("hdfs_path", "/a/b/cc/"): "/a/", ("hdfs_path", "hdfs://x/a/"): "/a/", ("hdfs_path", "nothing"): None,
        ("hdfs_path", "/w/t/part=1/"): "db.t", ("hdfs_path", "/zz/"): "/", ("hdfs_path", "/"): "/", ("hive_table", "db.t"): "db.t", ("kudu_table", "db.t"): "db.t",
        ("hive_table", "db.none"): None, ("hive_table", None): None, (None, "/a/"): None, ("hdfs_path", ""): None,
    }
    rows = [(t, o, "u", "READ", 1) for t, o in want] + [("hdfs_path", "/a/b/c/d/e", "u", "READ", 1)] * 20
    got = combined.enrich_access(access(spark, rows), objects(spark)).collect()
    assert len(got) == len(rows)
    assert {(r.object_type, r.object_id): r.matched_id for r in got} == want
    assert {r.matched_service for r in got if r.object_id == "db.t"} == {"hive", "kudu"}
    assert combined.enrich_access(access(spark, rows), objects(spark, [])).filter("matched_id is null").count() == len(rows)
    assert combined.enrich_access(access(spark, []), objects(spark)).count() == 0


def test_no_theta_join(spark):
    plan = combined.enrich_access(access(spark, [("hdfs_path", "/a/", "u", "r", 1)]), objects(spark))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_best_producer_of_each_attribute(spark):
    a = objects(spark, [("hive", "hive_table", "t", "", None, "x"), ("hive", "hive_table", "t", "", "", "w"), ("hive", "hive_table", None, "n", "", "")])
    b = objects(spark, [("catalog", "hive_table", "t", "bob", "", "y"), ("catalog", "hive_table", "only", "", "", "")])
    c = objects(spark, [("hdfs", "hive_table", "t", "ann", "grp", "z")])
    got = {r.object_id: tuple(r) for r in combined.union_objects({"storage": c, "catalog": b, "hive": a}).collect()}
    assert got["t"] == ("hive", "hive_table", "t", "bob", "grp", "w", "catalog,hive,storage")
    assert got["only"] == ("catalog", "hive_table", "only", "", "", "", "catalog") and got[None][3] == "n"
    with pytest.raises(ValueError):
        combined.union_objects({"unheard": a})


def test_graph_has_all_ends(spark):
    lineage = spark.createDataFrame([("hive_table", "db.t", "hdfs_path", "/new/", "WRITES_TO")] * 3, "from_object_type string, from_object_id string, to_object_type string, to_object_id string, relation string")
    used = access(spark, [("hive_table", "db.t", "u", "READ", 4), ("hive_table", "db.t", "u", "READ", 5), ("kudu_table", "gone", "v", "WRITE", 1)])
    vertices, edges = combined.object_graph(objects(spark), used, lineage)
    v = {r.key: r for r in vertices.collect()}
    assert {(r.src, r.dst, r.rel, r.n) for r in edges.collect()} == {
        ("user|u", "hive_table|db.t", "READ", 9), ("user|v", "kudu_table|gone", "WRITE", 1), ("hive_table|db.t", "hdfs_path|/new/", "WRITES_TO", 3)}
    assert edges.filter(~(F.col("src").isin(list(v)) & F.col("dst").isin(list(v)))).count() == 0
    assert len(v) == len(OBJECTS) + 4 and not v["hdfs_path|/new/"].known and v["user|u"].known and v["hive_table|db.t"].owner == "owner"
