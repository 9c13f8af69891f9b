"""The stored summary that follows the audit files, and places numbered by ranges."""

import json
import pathlib
import shutil

import pytest
from pyspark.sql import functions as F

from depscope import sources
from depscope.operators import audit
from depscope.operators.numbering import place_in_group
from depscope.streaming import current_summary, update_summary, vacuum_summary

DAY = 86_400_000
START = 1704067200000  # 2024-01-01


def record(time, k):
    return json.dumps(dict(
        evtTime=time, repoName="cm_hdfs", reqUser=f"u{k % 3}", cliIP="10.0.0.1", accessType="read",
        resourcePath=f"/data/d{k % 4}/f{k}.parquet"))


BATCHES = [
    [record(START + k * 3_600_000, k) for k in range(48)],                                  # two days
    [record(START + 2 * DAY + k * 600_000, k) for k in range(30)] + [record("soon", k) for k in range(5)] + ["no json"],
    [record(START + 600_000, k) for k in range(7)] + [record(START + 2 * DAY, 1)] * 4,      # late, and repeated
]


def rows(df):
    return sorted(map(tuple, df.collect()))


def one_shot(spark, *batches):
    texts = [(t, "f") for b in batches for t in b]
    return rows(audit.summary(audit.events(spark.createDataFrame(texts, "line string, source_file string"))))


def arrive(spark, tmp_path, k):
    landing = tmp_path / "in"
    landing.mkdir(exist_ok=True)
    (landing / f"{k}.json").write_text("\n".join(BATCHES[k]) + "\n")
    follow(spark, tmp_path)


def follow(spark, tmp_path):
    update_summary(spark, str(tmp_path / "in"), str(tmp_path / "out")).awaitTermination()


def days(tmp_path, batch):
    return sorted(p.name for p in (tmp_path / "out" / "summary" / f"batch={batch}").glob("day=*"))


def files(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "summary").rglob("*.parquet")}


def test_each_batch_rewrites_the_days_it_touches(spark, tmp_path):
    out = str(tmp_path / "out")
    assert rows(current_summary(spark, out)) == []
    for k in range(3):
        arrive(spark, tmp_path, k)
        assert rows(current_summary(spark, out)) == one_shot(spark, *BATCHES[:k + 1])
    assert days(tmp_path, 1) == ["day=2024-01-03", "day=untimed"]
    assert days(tmp_path, 2) == ["day=2024-01-01", "day=2024-01-03"]
    second = rows(current_summary(spark, out, "2024-01-02", "2024-01-02"))
    assert second == [r for r in one_shot(spark, *BATCHES) if r[0].startswith("2024-01-02")] != []
    before = files(tmp_path)
    follow(spark, tmp_path)  # nothing new
    assert files(tmp_path) == before


def test_a_batch_run_again_counts_once(spark, tmp_path):
    out, commits = str(tmp_path / "out"), tmp_path / "out" / "checkpoint" / "commits"

    def forget_last():
        last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
        for name in (f"{last}", f".{last}.crc"):
            (commits / name).unlink(missing_ok=True)
        return last

    for k in range(3):
        arrive(spark, tmp_path, k)
    want = one_shot(spark, *BATCHES)
    before = files(tmp_path)
    # merged, but the stream ended before it knew
    assert forget_last() == 2
    follow(spark, tmp_path)
    assert rows(current_summary(spark, out)) == want and files(tmp_path) == before
    # broken off while writing: readers see the batch before, and the batch is written again
    forget_last()
    folder = tmp_path / "out" / "summary" / "batch=2"
    for p in folder.glob("*_SUCCESS*"):
        p.unlink()
    shutil.rmtree(folder / "day=2024-01-01")
    assert rows(current_summary(spark, out)) == one_shot(spark, *BATCHES[:2])
    follow(spark, tmp_path)
    assert rows(current_summary(spark, out)) == want


def test_vacuum_keeps_what_counts(spark, tmp_path):
    for k in range(3):
        arrive(spark, tmp_path, k)
    out = str(tmp_path / "out")
    assert vacuum_summary(spark, out) == 2  # the first day of batch 0, the third of batch 1
    assert rows(current_summary(spark, out)) == one_shot(spark, *BATCHES)
    assert vacuum_summary(spark, out) == 0
    BATCHES.append([record(START + DAY, 3)])
    try:
        arrive(spark, tmp_path, 3)
        assert rows(current_summary(spark, out)) == one_shot(spark, *BATCHES)
    finally:
        BATCHES.pop()


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_places_of_a_large_group(spark, coalesce):
    kind = F.when(F.col("id") % 10 == 0, F.col("id") % 7).when(F.col("id") % 10 < 9, F.lit(3)).cast("string")
    df = spark.range(20_000).select(kind.alias("k"), F.struct(F.xxhash64("id").alias("a"), "id").alias("at"), F.lit(1).alias("row"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    try:
        found = place_in_group(df, ["k"], ["at"], "place")
        assert found.columns == ["k", "at", "row", "place"]
        got = found.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    groups = {}
    for r in got:
        groups.setdefault(r.k, []).append((r.place, tuple(r["at"])))
    assert len(got) == 20_000 and None in groups and len(groups["3"]) > 16_000
    for members in groups.values():
        members.sort()
        assert [p for p, _ in members] == list(range(1, len(members) + 1))
        assert [a for _, a in members] == sorted(a for _, a in members)
    assert place_in_group(df.limit(0), ["k"], ["at"], "place").count() == 0


def test_search_files_in_parts(spark, tmp_path):
    folder = pathlib.Path(tmp_path) / "search"
    folder.mkdir()
    for k, guids in enumerate(["ab", "ca", "d"]):
        (folder / f"t.{k:05d}.jsonl").write_text("".join(f'{{"guid": "{g}"}}\n' for g in guids))
    found = sources.search_results(spark, str(tmp_path))
    placed = place_in_group(found, ["search_type"], ["pos"], "place").orderBy("place").collect()
    assert [(r.search_type, r.guid, r.place) for r in placed] == [("t", g, n) for n, g in enumerate("abcad", 1)]
