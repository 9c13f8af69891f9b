"""Hard negatives by threshold joins over an inverted index of vector dimensions.

Anchors meet the rows block by block, each two blocks in one task. A task orders the dimensions
by their energy, cuts them into groups and keeps the norm of what is left of each vector from
each group on: a product gains at most the product of the two norms there. For a threshold, a
row is listed for its leading groups only, up to where the norm of its rest times the largest
such norm of the anchors is below the threshold; a row that is listed nowhere cannot reach it.
Partial products accumulate group by group, and a pair is dropped once its partial product plus
the remaining norms is below the threshold (or, minus them, above the window's upper end); whole
products of the others decide. Thresholds start high and are lowered for the anchors whose window
is not full, down to the window's lower end. What a first block of rows has found is a lower
bound for all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import store
from .common import present

#: Rows and anchors of a block; both blocks are held by one task.
BLOCK_ROWS = 16_384
BLOCK_ANCHORS = 1_024
#: Components beyond this are taken as this; products of 2,048 dimensions then fit 64 bits.
LIMIT = 1 << 26
#: Dimensions of a group; pairs are pruned after each.
STEP = 8
#: Anchors that a task follows side by side, until so few pairs are left; then each by itself.
TOGETHER = 64
SPARSE = 0.05
#: Thresholds are lowered by these parts of the way from the highest possible score to the window's end.
LOWERINGS = (0.15, 0.25, 0.35, 0.5, 1.0)
#: Ends of windows without a bound.
NO_BOUND = 1 << 62
#: Stands for a null id while rows are ordered.
NO_ID = (1 << 63) - 1


def quantised(vectors: DataFrame, scale: int = 256, turn_every: int | None = None, n_labels: int = 10) -> DataFrame:
    """row, vec_id, label, q (array<int>) of the rows that take part. Stored.

    A row with a null label or vector, or a null or non-finite component, takes no part. Each
    component becomes floor(scale * x), cut to +-LIMIT. With ``turn_every``, the label of a row
    whose id it divides becomes (label + 1) % n_labels. A row without id is never an anchor and
    stands behind others of its score.
    """
    rows = vectors.select(present(vectors, "vec_id", "bigint").alias("vec_id"), present(vectors, "label", "bigint").alias("label"),
                          present(vectors, "embedding", "array<double>").alias("v"))
    sound = rows.where("label is not null and v is not null").where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    label = F.col("label")
    if turn_every:
        label = F.when(F.col("vec_id") % turn_every == 0, (F.col("label") + 1) % n_labels).otherwise(F.col("label"))
    # clipped before the floor, as bigint has no room for every double
    q = F.transform("v", lambda x: F.floor(F.greatest(F.least(x * scale, F.lit(float(LIMIT))), F.lit(-float(LIMIT)))).cast("int"))
    return store(sound.select(F.monotonically_increasing_id().alias("row"), "vec_id", label.alias("label"), q.alias("q")), "quantised")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    lists = column.combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy().astype(np.float64)
    found = np.zeros((len(size), width))
    found[np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return found


class _Index:
    """Inverted lists of a block of rows, by groups of dimensions in the order of their energy."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray) -> None:
        energy = (rows ** 2).sum(axis=0) * np.maximum((anchors ** 2).sum(axis=0), 1)
        order = np.argsort(-energy, kind="stable")
        fill = ((0, 0), (0, -len(order) % STEP))
        self.rows, self.anchors = np.pad(rows[:, order], fill), np.pad(anchors[:, order], fill)
        self.groups = self.rows.shape[1] // STEP
        # what is left from each group on; nothing behind the last
        self.row_rest, self.anchor_rest = (np.sqrt(np.append(np.cumsum((m ** 2)[:, ::-1], axis=1)[:, ::-1][:, ::STEP], np.zeros((len(m), 1)), axis=1))
                                           for m in (self.rows, self.anchors))
        self.reach = self.anchor_rest[:, 0] * self.row_rest[:, 0].max(initial=0)
        # sums of doubles are exact while all products stay below 2^53; beyond that, integers
        peak = max(np.abs(rows).max(initial=0), np.abs(anchors).max(initial=0))
        self.exact = peak * peak * max(1, rows.shape[1]) < 2 ** 53
        self.slack = 1e-9 * self.reach.max(initial=0) + 1e-6

    def candidates(self, own: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(position in ``own``, rows, products) for those rows that the bounds leave.

        ``own`` are anchors, ``low`` and ``high`` their ranges; all rows within are among them.
        """
        # groups that list a row: those where its rest could still reach the lowest threshold
        listed = (self.row_rest[:, :-1] * self.anchor_rest[own, :-1].max(axis=0) + self.slack >= low.min()).sum(axis=1)
        known = np.argsort(-listed, kind="stable")[: np.count_nonzero(listed)]  # then a group's list is the first rows
        listed = listed[known]
        partial, alive = np.zeros((len(own), len(known))), np.ones((len(own), len(known)), bool)
        first = 0
        while first < self.groups and (first == 0 or np.count_nonzero(alive) > SPARSE * alive.size):
            n = int(np.searchsorted(-listed, -first, side="left"))  # the others' lists have ended, they wait for the exact product
            at = slice(first * STEP, (first + 1) * STEP)
            sums = partial[:, :n]
            sums += self.anchors[own, at] @ self.rows[known[:n], at].T
            first += 1
            rest = np.outer(self.anchor_rest[own, first], self.row_rest[known[:n], first]) + self.slack
            alive[:, :n] &= (sums + rest >= low[:, None]) & (sums - rest <= high[:, None])
        for k, anchor in enumerate(own):
            left = np.flatnonzero(alive[k])
            rows, sums, length = known[left], partial[k, left], listed[left]
            for g in range(first, self.groups):
                on = length > g
                if not on.any():
                    break
                at = slice(g * STEP, (g + 1) * STEP)
                sums[on] += self.rows[rows[on], at] @ self.anchors[anchor, at]
                end = np.minimum(length, g + 1)
                rest = self.anchor_rest[anchor, end] * self.row_rest[rows, end] + self.slack
                keep = (sums + rest >= low[k]) & (sums - rest <= high[k])
                rows, sums, length = rows[keep], sums[keep], length[keep]
            if self.exact:
                yield k, rows, (self.rows[rows] @ self.anchors[anchor]).astype(np.int64)
            else:
                yield k, rows, self.rows[rows].astype(np.int64) @ self.anchors[anchor].astype(np.int64)


def _first(score: np.ndarray, vec_id: np.ndarray, k: int) -> np.ndarray:
    """Positions of the first k by score, then by id."""
    if len(score) > 4 * k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= least)
        return near[np.lexsort((vec_id[near], -score[near]))[:k]]
    return np.lexsort((vec_id, -score))[:k]


def search_block(rows: dict[str, np.ndarray], anchors: dict[str, np.ndarray], same_label: bool, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position of the anchor, positions of rows, scores): the first k rows of each range.

    ``rows``: row, vec_id, label, q. ``anchors``: also low and high, the range of scores. Only
    rows of the anchor's label count, or only others; never the anchor itself.
    """
    index = _Index(rows["q"], anchors["q"])
    low, high = anchors["low"].astype(np.float64), anchors["high"].astype(np.float64)
    most, floor = np.minimum(high, index.reach + 1), np.maximum(low, -index.reach - 1)
    waiting = np.flatnonzero(floor <= most)
    waiting = waiting[np.argsort(anchors["row"][waiting], kind="stable")]
    for part in LOWERINGS if index.exact else LOWERINGS[-1:]:
        unfilled = []
        least = np.ceil(most - part * (most - floor))
        # the windows of an anchor share its products
        each, start = np.unique(anchors["row"][waiting], return_index=True)
        windows = np.split(waiting, start[1:])
        for at in range(0, len(each), TOGETHER):
            near = windows[at : at + TOGETHER]
            own = np.array([w[0] for w in near])
            for n, known, products in index.candidates(own, np.array([least[w].min() for w in near]), np.array([high[w].max() for w in near])):
                usable = (rows["label"][known] == anchors["label"][own[n]]) == same_label
                usable &= rows["row"][known] != anchors["row"][own[n]]
                known, products = known[usable], products[usable]
                for a in near[n].tolist():
                    fits = (products >= anchors["low"][a]) & (products <= anchors["high"][a])
                    if part < 1:
                        fits &= products >= least[a]
                    found, score = known[fits], products[fits]
                    if len(found) < k and part < 1:
                        unfilled.append(a)
                        continue
                    best = _first(score, rows["vec_id"][found], k)
                    yield a, found[best], score[best]
        waiting = np.array(unfilled, np.int64)


_FOUND = "anchor bigint, window int, row bigint, vec_id bigint, score bigint"


def _met(rows: DataFrame, anchors: DataFrame, n_blocks: int, n_parts: int, width: int, same_label: bool, k: int) -> DataFrame:
    """The first k rows of each window within each two blocks."""
    def blocks(df: DataFrame, salt: int, own: str, n: int, other: str, m: int) -> DataFrame:
        spread = df.withColumn(own, F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")) if own not in df.columns else df
        return spread.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["anchor", "window", "row", "vec_id", "score"]
        schema = pa.schema([(n, pa.int32() if n == "window" else pa.int64()) for n in names])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        sides = []
        for table, columns in ((left, ("row", "vec_id", "label")), (right, ("row", "vec_id", "label", "window", "low", "high"))):
            side = {c: (table.column(c).fill_null(NO_ID) if c == "vec_id" else table.column(c)).to_numpy() for c in columns}
            sides.append(side | {"q": _matrix(table.column("q"), width)})
        rows, anchors = sides
        out = [[] for _ in names]
        for a, found, score in search_block(rows, anchors, same_label, k):
            for held, x in zip(out, (np.full(len(found), anchors["row"][a]), np.full(len(found), anchors["window"][a]),
                                     rows["row"][found], rows["vec_id"][found], score), strict=True):
                held.append(x)
        if not out[0]:
            return schema.empty_table()
        return pa.Table.from_arrays([pa.array(np.concatenate(x), f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    left = blocks(rows, 1, "block", n_blocks, "part", n_parts)
    right = blocks(anchors, 2, "part", n_parts, "block", n_blocks)
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInArrow(run, _FOUND)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The first k of each window over all blocks, with rank from 1. A rank limit is also applied before the shuffle."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("vec_id", F.nullif("vec_id", F.lit(NO_ID)))


def search(rows: DataFrame, anchors: DataFrame, same_label: bool, k: int, block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """anchor (row), window, row, vec_id, score, rank: the first k rows of each window.

    ``rows`` and ``anchors`` are stored; anchors have a window number and its range (low, high).
    Blocks are at most as large as named, and smaller where cores would idle.
    """
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("width")).first()
    n_anchors = anchors.count()
    n_parts = max(1, -(-n_anchors // block_anchors))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(1, -(-size.n // block_rows), -(-cores // n_parts))
    of = rows.withColumn("block", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(n_blocks)).cast("int"))
    width = max(1, size.width or 0)
    first = store(_met(of.where("block = 0"), anchors, n_blocks, n_parts, width, same_label, k), "first_block")
    if n_blocks == 1:
        return _ranked(first, k)
    # with k rows found, nothing below the last of them can be among the first k
    reached = first.groupBy("anchor", "window").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") == k)
    raised = anchors.alias("a").join(reached.alias("r"), (F.col("a.row") == F.col("r.anchor")) & (F.col("a.window") == F.col("r.window")), "left").select(
        "a.row", "a.vec_id", "a.label", "a.q", "a.window", F.greatest("a.low", F.coalesce("r.least", "a.low")).alias("low"), "a.high")
    rest = _met(of.where("block > 0"), raised, n_blocks, n_parts, width, same_label, k)
    return _ranked(first.unionByName(rest), k)


def mine(vectors: DataFrame, anchor_every: int = 100, n_positives: int = 5, n_negatives: int = 10, low_percent: int = 30, high_percent: int = 90,
         turn_every: int | None = None, block_rows: int = BLOCK_ROWS, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are rows whose vec_id is divisible by ``anchor_every``; a positive is one of the
    first rows of the anchor's label, a negative one of the first rows of another label whose
    score is between ``low_percent`` and ``high_percent`` of the positive's. Higher scores come
    first, ties by vec_id, null ids last. A window of a negative score is empty. Rows that take
    no part: see ``quantised``. Missing dimensions count as zero. Repeated rows, and rows that
    share an id, are rows of their own. Columns other than vec_id, embedding and label are not
    looked at. An empty table gives an empty result.
    """
    rows = quantised(vectors, turn_every=turn_every)
    anchors = store(rows.where(F.col("vec_id") % anchor_every == 0).withColumn("window", F.lit(0)).withColumn("low", F.lit(-NO_BOUND)).withColumn("high", F.lit(NO_BOUND)), "anchors")
    positives = store(search(rows, anchors, True, n_positives, block_rows, block_anchors).withColumnRenamed("vec_id", "positive_id")
                      .withColumnRenamed("score", "positive_score").drop("row", "window"), "positives")
    # 100 s is compared with low s' and high s' in whole numbers
    scaled = F.col("positive_score").cast("decimal(25,0)")
    windows = store(anchors.drop("window", "low", "high").join(positives, F.col("row") == F.col("anchor")).select(
        "row", "vec_id", "label", "q", F.col("rank").cast("int").alias("window"),
        F.ceil(scaled * low_percent / 100).cast("bigint").alias("low"), F.floor(scaled * high_percent / 100).cast("bigint").alias("high")).where("low <= high"), "windows")
    negatives = search(rows, windows, False, n_negatives, block_rows, block_anchors).select(
        "anchor", F.col("window").alias("of"), F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    ids = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return negatives.join(positives.withColumnRenamed("rank", "of"), ["anchor", "of"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
