"""SimHash near-dedup by a self-join of the binary trie of fingerprints.

Two nodes of one depth are visited together. The bits in which their prefixes differ add up,
and the pair is dropped once they exceed the budget; below that, children meet children. So
that the visits run in parallel without a common top, the fingerprint's bits are cut into
budget + 1 blocks: two linked fingerprints agree in one block at least. For each block there is
a trie that reads this block first, and only pairs below one common first block are visited.
Equal fingerprints are one node from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import store
from .common import free_name, present, quoted, text_slices
from .components import components

SHINGLE_WORDS = 4
SEED = 42
BITS = 64
BUDGET = 4
#: Fingerprints below one first block that a task visits at once; larger groups are split into
#: sets, and each two sets are visited by a task of their own.
GROUP_LIMIT = 200_000
#: Node pairs held at once while the tries are visited.
FRONTIER = 100_000

_BLANK = regex.compile(rb"[\x20\x09-\x0D]")
_BLOCK_BYTES = 4 << 20


def _word_blocks(data: bytes) -> Iterator[list[bytes]]:
    at = 0
    while at < len(data):
        end = at + _BLOCK_BYTES
        m = _BLANK.search(data, end) if end < len(data) else None
        end = m.start() if m else len(data)
        yield data[at:end].split()  # bytes split at exactly these six blanks
        at = end


def fingerprint(data: bytes) -> int:
    """The fingerprint of a text given as UTF-8 bytes."""
    ones, n, carried = np.zeros(BITS, np.int64), 0, []
    for words in _word_blocks(data.lower()):
        words = carried + words
        carried = words[max(0, len(words) - SHINGLE_WORDS + 1) :]
        if len(words) < SHINGLE_WORDS:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[: len(words) - SHINGLE_WORDS] + 1).tolist()]
        hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)]
        n += len(hashes)
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, BITS // 8)
        for k in range(0, len(octets), 65_536):
            ones += np.unpackbits(octets[k : k + 65_536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    if n == 0:
        return xxhash.xxh64_intdigest(b" ".join(carried), SEED) if carried else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of a set of hashes (uint64); zero without any."""
    ones, octets = np.zeros(BITS, np.int64), hashes.astype("<u8").view(np.uint8).reshape(-1, BITS // 8)
    for k in range(0, len(octets), 65_536):
        ones += np.unpackbits(octets[k : k + 65_536], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and fp (the 64 bits as a bigint) of each row's ``text``; null counts as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                fps = np.array([fingerprint(t or b"") for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), pa.array(fps)], [*keys, "fp"])

    return docs.select(*keys, "text").mapInArrow(run, ", ".join(f"{k} bigint" for k in keys) + ", fp bigint")


def blocks(budget: int = BUDGET) -> list[tuple[int, int]]:
    """(lowest bit, width) of the budget + 1 blocks of a fingerprint."""
    edges = [BITS * k // (budget + 1) for k in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


class _Forest:
    """Spanning forest of the links found so far, over positions of an array."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, x: np.ndarray) -> np.ndarray:
        while not np.array_equal(up := self.parent[x], x):
            x = up
        return x

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            a, b = np.maximum(a, b), np.minimum(a, b)
            a, b = a[a != b], b[a != b]
            np.minimum.at(self.parent, a, b)


def trie_links(values: np.ndarray, left: np.ndarray, right: np.ndarray, top: int, budget: int) -> np.ndarray:
    """Visit pairs of trie nodes; returns for each position the root of its spanning tree.

    ``values`` (uint64) holds the groups one after the other, each sorted. ``left`` and
    ``right`` are the (begin, end) ranges to compare, a range with itself for a self-join. The
    first ``top`` bits are known to agree.
    """
    forest, ones = _Forest(len(values)), {}
    stack = [(top, np.column_stack([left, right, np.zeros(len(left), np.int64)]).astype(np.int64))]
    while stack:
        depth, pairs = stack.pop()
        if len(pairs) > FRONTIER:
            stack += [(depth, pairs[k : k + FRONTIER]) for k in range(0, len(pairs), FRONTIER)]
            continue
        a0, a1, b0, b1, d = pairs.T
        size_a, size_b = a1 - a0, b1 - b0
        small = (size_a * size_b <= 16) | (depth >= BITS)
        if small.any():
            sa, sb = size_a[small], size_b[small]
            n = sa * sb
            # below the last bit a node is one value, met once with itself and once with others
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            i = np.repeat(a0[small], n) + k // np.repeat(sb, n)
            j = np.repeat(b0[small], n) + k % np.repeat(sb, n)
            near = (np.bitwise_count(values[i] ^ values[j]) <= budget) & (i != j)
            forest.link(i[near], j[near])
        pairs = pairs[~small]
        if not len(pairs):
            continue
        a0, a1, b0, b1, d = pairs.T
        if depth not in ones:
            bit = (values >> np.uint64(BITS - 1 - depth)) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        am, bm = a1 - (ones[depth][a1] - ones[depth][a0]), b1 - (ones[depth][b1] - ones[depth][b0])
        same = (a0 == b0) & (a1 == b1)
        made = [np.column_stack(x) for x in ((a0, am, b0, bm, d), (am, a1, bm, b1, d), (a0, am, bm, b1, d + 1))]
        made.append(np.column_stack((am, a1, b0, bm, d + 1))[~same])  # of a node with itself it is the mirror image
        children = np.concatenate(made)
        children = children[(children[:, 0] < children[:, 1]) & (children[:, 2] < children[:, 3]) & (children[:, 4] <= budget)]
        if len(children):
            stack.append((depth + 1, children))
    return forest.roots(np.arange(len(values)))


def _visit(frame: dict[str, np.ndarray], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (a spanning forest) of the whole groups in ``frame``."""
    parts = blocks(budget)
    found_u, found_v = [], []
    for r, (low, width) in enumerate(parts):
        own = np.flatnonzero(frame["block"] == r)
        fp = frame["fp"][own].view(np.uint64)
        turn = np.uint64((BITS - low - width) % BITS)
        turned = (fp << turn) | (fp >> np.uint64((BITS - int(turn)) % BITS)) if turn else fp
        order = np.lexsort((turned, frame["side"][own], frame["j"][own], frame["i"][own], frame["first"][own]))
        own, values = own[order], turned[order]
        keys = np.column_stack([frame[k][own] for k in ("first", "i", "j", "side")])
        begin = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(own) else np.zeros(0, np.int64)
        end = np.concatenate([begin[1:], [len(own)]]).astype(np.int64) if len(own) else begin
        ranges, head = np.column_stack([begin, end]), keys[begin]
        alone = head[:, 1] == head[:, 2]
        two = np.flatnonzero((head[:-1, :3] == head[1:, :3]).all(axis=1)) if len(head) else np.zeros(0, np.int64)
        left = np.concatenate([ranges[alone], ranges[two]])
        right = np.concatenate([ranges[alone], ranges[two + 1]])
        roots = trie_links(values, left, right, width, budget)
        off = np.flatnonzero(roots != np.arange(len(roots)))
        found_u.append(frame["fp"][own][off])
        found_v.append(frame["fp"][own][roots[off]])
    return np.concatenate(found_u), np.concatenate(found_v)


def links(nodes: DataFrame, budget: int = BUDGET, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """u, v: links between different fingerprints of ``nodes`` (fp, distinct), enough of them
    to connect all that are linked.

    Each fingerprint goes to one group for each block. Group sizes are counted first; there are
    at most (budget + 1) x 2^width groups (40,960), whatever the input, and the driver gets
    only those above the limit. Group members are visited as they stream in, sorted by group.
    """
    def first(low: int, width: int) -> Column:
        return F.shiftrightunsigned("fp", low).bitwiseAND((1 << width) - 1)

    parts = [F.struct(F.lit(r).cast("bigint").alias("block"), first(low, width).alias("first")) for r, (low, width) in enumerate(blocks(budget))]
    members = nodes.select("fp", F.explode(F.array(*parts)).alias("g")).select("fp", "g.block", "g.first")
    sizes = members.groupBy("block", "first").agg(F.count("*").alias("n")).where(F.col("n") > group_limit)
    sets = {(row.block, row.first): -(-row.n // group_limit) for row in sizes.collect()}
    n_sets: Column = F.lit(1)
    if sets:
        code = F.col("block") * (1 << BITS // budget) + F.col("first")
        entries = [F.lit(x) for (b, f), n in sets.items() for x in (b * (1 << BITS // budget) + f, n)]
        n_sets = F.coalesce(F.create_map(*entries)[code], F.lit(1))
    own = members.withColumn("set", F.pmod(F.xxhash64("fp"), n_sets).cast("bigint"))
    tasks = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), n_sets.cast("bigint") - 1))).select(
        "fp", "block", "first", F.least("set", "other").alias("i"), F.greatest("set", "other").alias("j"),
        F.when(F.col("set") > F.col("other"), 1).otherwise(0).cast("bigint").alias("side"))
    group = ["block", "first", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def visit(table: pa.Table) -> pa.RecordBatch:
            frame = {c: table.column(c).to_numpy() for c in table.column_names}
            u, v = _visit(frame, budget)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < group_limit:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = np.column_stack([table.column(c).to_numpy() for c in group])
            last = np.flatnonzero((keys != keys[-1]).any(axis=1))
            whole = int(last[-1]) + 1 if len(last) else 0
            if whole:
                yield visit(table.slice(0, whole))
            held = table.slice(whole).to_batches()
        if held:
            yield visit(pa.Table.from_batches(held).combine_chunks())

    dealt = tasks.repartition(*group).sortWithinPartitions(*group)
    return dealt.mapInArrow(run, "u bigint, v bigint")


def labels(marked: DataFrame, budget: int = BUDGET, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """fp, root, component_id (smallest doc_id) for each fingerprint of ``marked`` (doc_id, fp).

    Null ids are passed over; a component of null ids only has none. Stored.
    """
    nodes = store(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "nodes")
    of = components(links(nodes.select("fp"), budget, group_limit)).withColumnRenamed("node", "fp")
    rooted = nodes.join(of, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return store(rooted.select("fp", "root").join(least, "root").select("fp", "root", "component_id"), "labels")


def near_duplicates(docs: DataFrame, budget: int = BUDGET, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id; one row for each row of ``docs``.

    A text without words (null, empty, blank) has fingerprint zero and links like any other.
    Repeated rows and repeated or null ``doc_id`` are kept. Columns other than doc_id and text
    are not looked at. An empty table gives an empty result.
    """
    docs = docs.select(present(docs, "doc_id", "bigint").alias("doc_id"), present(docs, "text", "string").alias("text"))
    marked = store(fingerprints(docs, ["doc_id"]), "fingerprints")
    joined = marked.join(labels(marked, budget, group_limit), "fp")
    return joined.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, budget: int = BUDGET, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """One row of each component, with the columns of ``docs``.

    It is the row with the component's smallest doc_id; among rows that share it, the first of
    the table as stored. Rows without an id are left only where no row of the component has one.
    """
    row, = free_name(docs, "row")
    numbered = store(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    keyed = numbered.select(quoted(row).alias("row"), present(numbered, "doc_id", "bigint").alias("doc_id"),
                            present(numbered, "text", "string").alias("text"))
    marked = store(fingerprints(keyed, ["row", "doc_id"]), "fingerprints")
    candidates = marked.join(labels(marked, budget, group_limit), "fp").where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = candidates.groupBy("root").agg(F.min("row").alias(row)).select(row)
    return numbered.join(kept, row, "left_semi").select(*(quoted(c) for c in docs.columns))
