"""Hand-derived values of every scalar."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from depscope import functions as fn


def test_truncate_path(apply):
    paths = ["/user/spark/data/2024/01/file.parquet", "/", "", "/a//b", "a", None]
    assert apply(lambda c: fn.truncate_path(c, 3), paths) == [
        "/user/spark/data/", "//", "", "/a//b/", "/a/", ""]
    assert apply(lambda c: fn.truncate_path(c, 2), paths[:1]) == ["/user/spark/"]
    assert apply(lambda c: fn.truncate_path(c, 0), paths[:3]) == ["/", "/", ""]


def test_parent_dir(apply):
    cases = {
        "/a//b": "/a/", "/a/": "/a/", "a": "", "//x": "//", "default/orders": "default/", "": "",
        "/a//": "/a//", "  /a/b ": "/a/", "/": "/", "///a/b": "///a/", "x//y": "x/", "   ": ""}
    assert apply(fn.parent_dir, list(cases)) == list(cases.values())
    assert apply(fn.parent_dir, [None]) == [""]


def test_noise(apply):
    noisy = ["/a/_SUCCESS", "_SUCCESS", "/tmp/x", "/a/b.CRC", "b.crc ", "x._committed_1", "/_committed_2",
             "_committed_3", "/u/.Trash/x", "/u/.staging/j", "/a/_temporary/0", "/a/_spark_metadata/1",
             "/user/x/.sparkStaging/app", "/a/_success_file"]
    clean = ["/tmp", "a_committed_1", "", None, "_success", "/a/b.crcx", "/a/trash/x", "é_committed_1"]
    assert apply(fn.is_noise, noisy) == [True] * len(noisy)
    assert apply(fn.is_noise, clean) == [False] * len(clean)


def test_epoch(apply):
    cases = {
        "1700000000": "2023-11-14T22:13:20Z", "1700000000999": "2023-11-14T22:13:20Z",
        "0": "1970-01-01T00:00:00Z", "abc": "abc", "-1": "1969-12-31T23:59:59Z",
        "9999999999": "2286-11-20T17:46:39Z", "10000000000": "1970-04-26T17:46:40Z",
        "1.7E12": "2023-11-14T22:13:20Z", "99999999999999999999": "99999999999999999999",
        "253402300800000": "253402300800000", " 17 ": "1970-01-01T00:00:17Z",
        "2024-01-01 00:00:00.123": "2024-01-01 00:00:00.123", "x" * 70: "x" * 64}
    assert apply(fn.epoch_to_iso, list(cases)) == list(cases.values())
    assert apply(fn.epoch_to_iso, [None]) == [""]


def test_ms_to_iso(apply):
    assert apply(fn.ms_to_iso, [1700000000999, 0, None, 10**18], "bigint") == [
        "2023-11-14T22:13:20Z", "", "", ""]


def test_history_time(apply):
    cases = {
        "2024-01-01T00:00:00.123GMT": "2024-01-01T00:00:00Z", "2024-01-01T00:00:00GMT": "2024-01-01T00:00:00Z",
        "2024-01-01T00:00:00.5": "2024-01-01T00:00:00Z", "2024-01-01T00:00:00": "2024-01-01T00:00:00Z",
        "2024-01-01T00:00:00+01:00": "2024-01-01T00:00:00Z", "bad": "bad", "": "",
        "2024-13-01T00:00:00GMT": "2024-13-01T00:00:00Z"}
    assert apply(fn.history_ts, list(cases)) == list(cases.values())


def test_safe_ts(apply):
    assert apply(fn.safe_ts, ["2024-01-01T10:20:30.456Z", "2024-01-01", "T1", None, ""]) == [
        "2024-01-01T10:20:30Z", "2024-01-01", "T1", "", ""]


def test_parse_iso(apply):
    got = apply(lambda c: fn.iso(fn.parse_iso(c)), [
        "2024-01-31T13:30:00Z", "2024-01-31 13:30:00", "2024-02-31T00:00:00Z", "", None, "2024-1-1T1:2:3Z"])
    assert got == ["2024-01-31T13:30:00Z", None, None, None, None, "2024-01-01T01:02:03Z"]


def test_dates(apply):
    assert apply(fn.date_to_ms, ["20240101", "20241399"]) == [1704067200000, None]
    assert apply(fn.yyyymmdd, ["20240229", "20230229"]) == [dt.date(2024, 2, 29), None]


@pytest.mark.parametrize("n, expected", [(30, "13:30"), (7, "13:42"), (45, "13:45"), (90, "13:00"), (60, "13:00")])
def test_floor_minutes(spark, n, expected):
    t = F.lit("2024-01-01T13:47:59Z")
    got = spark.range(1).select(fn.iso(fn.floor_minutes(fn.parse_iso(t), n))).first()[0]
    assert got == f"2024-01-01T{expected}:00Z"


@pytest.mark.parametrize("unit, expected", [
    ("none", ""), ("daily", "2024-01-01"), ("monthly", "2024-01"), ("1h", "2024-01-01T13:00:00Z"),
    ("6h", "2024-01-01T12:00:00Z"), ("30m", "2024-01-01T13:30:00Z"), ("exact", "2024-01-01T13:47:59Z")])
def test_dep_window(spark, unit, expected):
    t = fn.parse_iso(F.lit("2024-01-01T13:47:59Z"))
    assert spark.range(1).select(fn.dep_window(t, unit)).first()[0] == expected


def test_unknown_window_is_refused():
    with pytest.raises(ValueError):
        fn.dep_window(F.lit(None).cast("timestamp"), "2h")


def test_infer_op(spark):
    rows = [("create", "", "WRITE"), ("insert", "", "READ"), ("getfileinfo", "", "READ"), ("read", "delete", "WRITE"),
            ("hive_drop", "", "WRITE"), (" MKDIR ", None, "WRITE"), (None, None, "READ"), ("select", "", "READ"),
            ("bulk_rename", "open", "READ")]
    df = spark.createDataFrame(rows, "a string, b string, want string")
    assert df.filter(fn.infer_op("a", "b") != F.col("want")).count() == 0
    flat = {"add": "WRITE", "truncate": "READ", "Put": "WRITE", None: "READ"}
    df = spark.createDataFrame(list(flat.items()), "a string, want string")
    assert df.filter(fn.infer_op_flat("a") != F.col("want")).count() == 0


def test_result(apply):
    cases = {"1": "ALLOWED", "true": "ALLOWED", "0": "DENIED", "DENY": "DENIED", "TRUE": "TRUE", "1.0": "1.0",
             " allowed ": "ALLOWED", "y" * 70: "y" * 64}
    assert apply(fn.normalize_result, list(cases)) == list(cases.values())
    assert apply(fn.normalize_result, [None]) == [""]


def test_object_type(apply):
    assert apply(fn.object_type, ["cm_hdfs", "cm_impala", "cm_ozone", "HIVE_spark", "spark", None]) == [
        "hdfs_path", "hive_table", "unknown", "hive_table", "application", "unknown"]


def test_ids_and_hashes(apply):
    assert apply(fn.job_to_app_id, ["job_1_2", "x_job_1", "application_1"]) == [
        "application_1_2", "x_job_1", "application_1"]
    assert apply(fn.sha1_or_empty, ["a", "", None]) == ["86f7e437faa5a7fce15d1ddcb9eaeaea377667b8", "", ""]
    assert apply(fn.type_to_service, ["hdfs_path", "aws_s3", "process", None, "hive_db"]) == [
        "hdfs", "aws", "unknown", "unknown", "hive"]
    assert apply(fn.basename, ["/a/b", "b", "/a/"]) == ["b", "b", ""]


def test_text(apply):
    assert apply(fn.strip, ["\t a b \n", " x　", ""]) == ["a b", "x", ""]
    assert apply(lambda c: fn.safe_str(c, 3), ["äöüß", None]) == ["äöü", ""]
    assert apply(lambda c: fn.first_present(c, F.lit("z")), ["", None, "0", "false"]) == ["z", "z", "0", "false"]


def test_storage(spark):
    def loose(fmt, serde, kudu=False):
        return spark.range(1).select(fn.storage_format(F.lit(fmt), F.lit(serde), F.lit(kudu))).first()[0]
    assert loose("x.TextInputFormat", "x.JsonSerDe") == "textfile"
    assert loose("x.OrcInputFormat", "", True) == "kudu"
    assert loose("", "x.AvroSerDe") == "avro"
    assert loose("", "") == "unknown"
    strict = spark.range(1).select(fn.storage_format_strict(F.lit("x.SequenceFile"), F.lit(False))).first()[0]
    assert strict == "sequencefile"


def test_describe_line(apply):
    lines = ["Owner:\thive\tNULL", "Owner:   hive", "Owner", "InputFormat::\t x ", "a b\tc"]
    assert apply(fn.describe_key, lines) == ["owner", "owner", None, "inputformat", "a b"]
    assert apply(fn.describe_value, lines) == ["hive", "hive", None, "x", "c"]
    strict = apply(lambda c: fn.describe_key(c, strict=True), lines)
    assert strict == ["owner", "owner: hive", "owner", "inputformat:", "a b"]


def test_project(spark):
    def pid(owner, name, slug):
        return spark.range(1).select(fn.project_id(*[F.lit(v).cast("string") for v in (owner, name, slug)])).first()[0]
    assert pid('{"username": "u", "name": "n"}', "p", None) == "u/p"
    assert pid('{"username": "", "name": "n"}', "", "s") == "n/s"
    assert pid("plain", None, None) == "plain/unnamed"
    assert pid(None, "p", None) == "unknown/p"
    extra = spark.range(1).select(fn.project_extra(
        F.lit("a|b\n" + "c" * 200), F.lit(""), F.lit("2024-01-01T00:00:00.1Z"))).first()[0]
    assert extra == "desc=a b " + "c" * 116 + "|created=2024-01-01T00:00:00Z"
