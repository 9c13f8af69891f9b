"""Sharding by balanced label propagation.

Rows of one group (equal texts) are linked. Rows without links wait until the end, when they
fill the shards up. Linked rows start on evenly dealt shards and move in rounds: each group
counts its rows by shard, and rows elsewhere ask to move to the shard that holds most of them.
Between two shards as many rows move one way as the other way, and beyond that as many as the
quota has room for. A group never needs a list of its pairs. Groups larger than a shard
are cut into parts of half that size first. In the end every shard has N / shards rows, or one
more: rows beyond a quota go with those without links.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import store
from .common import present

SHARDS = 40
ROUNDS = 10
#: During the rounds a shard may hold so much more than its quota, so that full shards can swap.
SLACK_PERCENT = 10
#: Numbering splits a group into so many hash buckets at least, which are numbered side by side,
#: and into more where they would hold more rows than this; where rows of one kind are to stay
#: together, each bucket is split again.
BUCKETS = 1024
BUCKET_ROWS = 1_000_000
SUB_BUCKETS = 64


def number(df: DataFrame, group: list[str], order: list[str], name: str, spread: list[str] | None = None,
           buckets: int = BUCKETS) -> DataFrame:
    """Append ``name``: 0, 1, 2 … without gaps within each ``group`` (columns without nulls).

    Rows are dealt to hash buckets of ``order``, numbered inside them and shifted by the rows
    of earlier buckets, so that no task gets a whole large group. Rows that agree in ``spread``
    stay near each other. ``df`` is read twice; give a stored one. ``order`` has to tell rows
    apart.
    """
    bucket = F.pmod(F.xxhash64(*(spread or order)), F.lit(buckets))
    if spread:
        bucket = bucket * SUB_BUCKETS + F.pmod(F.xxhash64(*order), F.lit(SUB_BUCKETS))
    dealt = df.withColumn("_bucket", bucket)
    keys = [*group, "_bucket"]
    sizes = dealt.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return dealt.withColumn(name, inside).join(offsets, keys).withColumn(name, F.col(name) + F.col("_offset")).drop("_bucket", "_offset")


def buckets_for(total: int) -> int:
    return max(BUCKETS, total // BUCKET_ROWS)


def _pick(values: list[int], index: Column) -> Column:
    return F.get(F.array(*(F.lit(v).cast("bigint") for v in values)), index)


def _allowed(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many rows may move from one shard to another: swaps, and what fits besides."""
    swaps = {(a, b): min(n, asked.get((b, a), 0)) for (a, b), n in asked.items()}
    allowed = dict(swaps)
    for b, free in enumerate(room):
        rest = {a: n - swaps[a, b] for (a, to), n in asked.items() if to == b and n > swaps[a, b]}
        wanted = sum(rest.values())
        for a, n in sorted(rest.items()):
            given = min(n, -(-max(0, free) * n // wanted))
            allowed[a, b] += given
            free, wanted = free - given, wanted - n
    return allowed


def assign(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Append ``shard`` to ``rows`` (row bigint, unique; group, never null), which is stored.

    The driver sees the sizes of the shards once a round, nothing that grows with the rows.
    """
    total = rows.count()
    quota = [total // shards + (k < total % shards) for k in range(shards)]
    sizes = rows.groupBy("group").agg(F.count("*").alias("group_n"))
    sized = store(rows.select("row", "group").join(store(sizes.where("group_n > 1"), "groups"), "group", "left"), "sized")
    most = max(1, total // shards)
    part_size = max(1, most // 2)  # two parts can share a shard, and one leaves room for small groups
    large = sized.where(F.col("group_n") > most)  # only what no shard can hold is cut
    parts = number(large, ["group"], ["row"], "k", buckets=buckets_for(total)).withColumn("part", F.floor(F.col("k") / part_size)).drop("k")
    linked = parts.unionByName(sized.where(F.col("group_n") <= most).withColumn("part", F.lit(0).cast("bigint")))
    linked = store(linked.select("row", "group", "part"), "linked")
    placed = store(number(linked, [], ["row"], "k", buckets=buckets_for(total)).select("row", "group", "part", (F.col("k") % shards).cast("int").alias("shard")), "placed")

    for _ in range(rounds):
        votes = placed.groupBy("group", "part", "shard").agg(F.count("*").alias("own"))
        # ties go either way, so that rows can be swapped
        best = store(votes.groupBy("group", "part").agg(
            F.max_by("shard", F.struct("own", F.xxhash64("group", "part", "shard"))).alias("to")), "votes")
        moves = store(votes.join(best, ["group", "part"]).where(F.col("to") != F.col("shard")), "moves")
        wished = store(placed.join(moves.select("group", "part", "shard", "to"), ["group", "part", "shard"], "left"), "wished")
        held, asked = [0] * shards, {}
        for r in wished.groupBy("shard", "to").agg(F.count("*").alias("n")).collect():  # shards x shards rows at most
            held[r.shard] += r.n
            if r.to is not None:
                asked[r.shard, r.to] = r.n
        allowed = _allowed(asked, [q + q * SLACK_PERCENT // 100 - n for q, n in zip(quota, held, strict=True)])
        if not any(allowed.values()):
            break
        ranked = number(wished.where("to is not null"), ["shard", "to"], ["group", "part", "row"], "k", spread=["group", "part"])
        limit = _pick([allowed.get((a, b), 0) for a in range(shards) for b in range(shards)], F.col("shard") * shards + F.col("to"))
        moved = ranked.withColumn("shard", F.when(F.col("k") < limit, F.col("to")).otherwise(F.col("shard")))
        columns = ["row", "group", "part", "shard"]
        placed = store(moved.select(*columns).unionByName(wished.where("to is null").select(*columns)), "placed")

    ranked = store(number(placed, ["shard"], ["group", "part", "row"], "k", spread=["group", "part"]).withColumn(
        "fits", F.col("k") < _pick(quota, F.col("shard"))), "ranked")
    stay = ranked.where("fits").select("row", "shard")
    held = [0] * shards
    for r in stay.groupBy("shard").agg(F.count("*").alias("n")).collect():
        held[r.shard] = r.n
    # the others fill what is left, shard by shard
    ends, end = [], 0
    for q, n in zip(quota, held, strict=True):
        end += q - n
        ends.append(end)
    pool = store(sized.where("group_n is null").select("row", "group").unionByName(ranked.where(~F.col("fits")).select("row", "group")), "pool")
    filled = number(pool, [], ["group", "row"], "k", spread=["group"], buckets=buckets_for(total)).select("row", F.size(F.filter(
        F.array(*(F.lit(e).cast("bigint") for e in ends)), lambda e: e <= F.col("k"))).alias("shard"))
    return rows.join(stay.unionByName(filled), "row")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard; one row for each row of ``docs``.

    ``law`` is rows: counts of shards differ by one at most. Slots number a shard's rows from 0
    without gaps. ``grown_shard`` is null under this law. A null text counts as empty (and
    equals an empty one); null and repeated ids are kept as rows of their own. Other columns are
    not looked at. The text is read once; all rounds run on its digest. An empty table gives an
    empty result, and fewer rows than shards leave shards empty.
    """
    text = F.coalesce(present(docs, "text", "string"), F.lit("")).cast("binary")
    rows = store(docs.select(
        F.monotonically_increasing_id().alias("row"), present(docs, "doc_id", "bigint").alias("doc_id"),
        (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.sha2(text, 256).alias("group")), "rows")
    placed = store(assign(rows, shards, rounds).select("row", "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard")), "shards")
    slots = number(placed, ["shard"], ["row"], "slot", buckets=buckets_for(placed.count()))
    return slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"))
