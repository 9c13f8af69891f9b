"""Near-duplicates by SimHash and the exact Jaccard similarity of 5-word shingles.

Texts with equal shingle sets are one node. First come pairs whose fingerprints, taken of the
sets, are equal or linked by the trie of ``simhash``; verified on the whole sets, they connect
most near copies. Fingerprints of sets of a similarity of 0.8 differ in more bits than a trie can
be visited with, so the rest is found by a prefix filter, which compares only what the links by
fingerprint leave apart. Two sets of similarity 0.8 or more share a shingle
among the first ``n - ceil(0.8 n) + 1`` of each, in any order that holds for all sets (prefix
filter), so no pair is missed. The order puts shingles that a sample finds often at the end;
the sample decides how many candidates there are, never which pairs are found. The prefixes are
shuffled once: each group of sets that share a shingle comes to one task in a row, sorted, and
streams through it; groups of one leave nothing. All of a group are compared with its pivot, the
set that comes first in an order of all sets, so that groups of the same texts share their pivot.
Groups that this does not connect get three pivots more; where they stay in parts, those outside
the largest one are compared with others there: two sets only at the first shingle that they share, where
neither may have more rare ones before it than two similar sets of their sizes have, and in large groups by
classes of size. Each candidate is verified on the whole sets before components are formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import discard, store
from . import simhash
from .common import bounded_broadcast, free_name, present, quoted, text_slices
from .components import components
from .simhash import SEED, _word_blocks

SHINGLE_WORDS = 5
#: Similarity of a link, in tenths: intersection * (10 + 8) >= 8 * (size + size).
TENTHS = 8
#: One text in so many is sampled for frequent shingles; those seen so often go to the end of
#: the order, the most frequent so many at most (the order's only effect is on the work done).
SAMPLE = 16
SAMPLE_SEEN = 4
SAMPLE_KEPT = 50_000
#: A shingle that the sample expects in more texts than this is dealt to several groups.
HOT_ROWS = 100_000
#: Groups of more rows that stay in parts are compared by classes of size, so many for sizes in the ratio of a link.
DIRECT_ROWS = 64
CLASSES = 4
#: Row numbers are broadcast up to so many.
BROADCAST_ROWS = 1_000_000
#: Texts and sets come to Python in batches of about so many bytes, or one longer row.
BATCH_BYTES = 4 << 20
#: Fingerprints that a task visits at once (see ``simhash.GROUP_LIMIT``).
PRINTS = 50_000
#: A task works on so many bytes of text at once: hashes take more room than texts.
SLICE = 1 << 20


def shingles(data: bytes) -> np.ndarray:
    """The sorted set of hashed shingles of a text given as UTF-8 bytes.

    ASCII letters count as lower case. A text of fewer than five words is one shingle, and a
    text without words has none.
    """
    found, carried = [], []
    for words in _word_blocks(data.lower()):
        words = carried + words
        carried = words[max(0, len(words) - SHINGLE_WORDS + 1) :]
        if len(words) < SHINGLE_WORDS:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[: len(words) - SHINGLE_WORDS] + 1).tolist()]
        hashes = [xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)]
        found.append(np.unique(np.array(hashes, np.uint64)))
    if found:
        return np.unique(np.concatenate(found))
    return np.array([xxhash.xxh64_intdigest(b" ".join(carried), SEED)] if carried else [], np.uint64)


def prefix(own: np.ndarray, often: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The shingles of which two similar sets share one: rare ones first, then by hash."""
    if len(often):
        at = np.minimum(np.searchsorted(often, own), len(often) - 1)
        own = own[np.lexsort((own, np.where(often[at] == own, seen[at], 0)))]
    return own[: len(own) - -(-TENTHS * len(own) // 10) + 1] if len(own) else own


def sketch(own: np.ndarray) -> np.ndarray:
    """How many shingles fall into each of about as many buckets as there are shingles."""
    width = 1 << max(8, len(own).bit_length())
    return np.minimum(np.bincount((own & np.uint64(width - 1)).astype(np.int64), minlength=width), 255).astype(np.uint8)


def _may_be_similar(a: np.ndarray, b: np.ndarray) -> bool:
    """By sketches: sets share no more of a bucket than either has there."""
    if a.max() == 255 or b.max() == 255:  # full counters say nothing
        return True
    width = min(len(a), len(b))
    a, b = (x.reshape(-1, width).sum(axis=0, dtype=np.int64) for x in (a, b))
    return bool(np.minimum(a, b).sum() * (10 + TENTHS) >= TENTHS * (a.sum() + b.sum()))


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(a) + len(b) - len(np.union1d(a, b))
    return both * (10 + TENTHS) >= TENTHS * (len(a) + len(b))


def _sets(rows: DataFrame, column: str, value: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """row, and in ``column`` the ``value`` (as bytes) of the shingle set of each row's ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE):
                found = [value(shingles(t or b"")).tobytes() for t in part.column("text").cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found, pa.binary())], ["row", column])

    return rows.select("row", "text").mapInArrow(run, f"row bigint, {column} binary")


def _pass(pairs: DataFrame, sets: DataFrame, column: str, kind: type, test: Callable[[np.ndarray, np.ndarray], bool]) -> DataFrame:
    """The ``pairs`` (u, v) whose values in ``column`` of ``sets`` pass the test."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [test(np.frombuffer(a.as_py(), kind), np.frombuffer(b.as_py(), kind)) for a, b in zip(batch.column("a"), batch.column("b"), strict=True)]
            yield batch.select(["u", "v"]).filter(pa.array(near, pa.bool_()))

    left, right = sets.select(F.col("row").alias("u"), F.col(column).alias("a")), sets.select(F.col("row").alias("v"), F.col(column).alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b").mapInArrow(run, "u bigint, v bigint")


def _often(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that the sample has often, sorted, and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE):
                for text in part.column("text").cast(pa.binary()).to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array(shingles(text or b"").view(np.int64))], ["h"])

    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0).select("text")
    counted = sample.mapInArrow(run, "h bigint").groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= SAMPLE_SEEN)
    top = counted.orderBy(F.desc("n"), "h").limit(SAMPLE_KEPT).collect()
    often = np.array([r.h for r in top], np.int64).view(np.uint64)
    order = np.argsort(often)
    return often[order], np.array([r.n for r in top], np.int64)[order]


def _marked(rows: DataFrame, often: np.ndarray, seen: np.ndarray) -> DataFrame:
    """row, doc_id, key (digest of the set), n (its size), fp (its fingerprint), prefix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE):
                sets = [shingles(t or b"") for t in part.column("text").cast(pa.binary()).to_pylist()]
                first = [prefix(s, often, seen).view(np.int64) for s in sets]
                ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc_id"), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()), pa.array(np.array([simhash.majority(s) for s in sets], np.uint64).view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(first)))],
                    ["row", "doc_id", "key", "n", "fp", "prefix"])

    return rows.select("row", "doc_id", "text").mapInArrow(run, "row bigint, doc_id bigint, key binary, n int, fp bigint, prefix array<bigint>")


def _possible(a: str, b: str) -> Column:
    """Whether two sets that share a shingle at these places of their order can be similar."""
    n, m, i, j = (F.col(c) for c in (f"{a}n", f"{b}n", f"{a}pos", f"{b}pos"))
    most = F.least(i, j) + 1 + F.least(n - i - 1, m - j - 1)
    return (F.least(n, m) * 10 >= F.greatest(n, m) * TENTHS) & (most * (10 + TENTHS) >= (n + m) * TENTHS)


def _first_shared(a: str, b: str) -> Column:
    """Whether two sets can be similar if the shingle at these places is the first that they share.

    All shared ones stand there or behind, in both. Similar sets meet at their first one.
    """
    n, m, i, j = (F.col(c) for c in (f"{a}n", f"{b}n", f"{a}pos", f"{b}pos"))
    return (F.least(n, m) * 10 >= F.greatest(n, m) * TENTHS) & (F.least(n - i, m - j) * (10 + TENTHS) >= (n + m) * TENTHS)


def _by_size(split: DataFrame) -> DataFrame:
    """Rows of ``split`` with the class of their own size (own) and, one row for each, of the sizes
    (other) that a similar set can have whose first shared shingle is this one.

    All rows of a group of at most ``DIRECT_ROWS`` have class 0, and meet each other.
    """
    def of(size: Column) -> Column:  # never falls as sizes grow
        return F.floor(F.log(size) * (CLASSES / np.log(10 / TENTHS))).cast("int")

    n, large = F.col("n").cast("bigint"), F.col("size") > DIRECT_ROWS
    least = F.floor((n * TENTHS + 9) / 10)
    most = F.floor(F.least(n * 10, (n - F.col("pos")) * (10 + TENTHS) - n * TENTHS) / TENTHS)
    others = F.when(large, F.sequence(of(least), of(F.greatest(least, most)))).otherwise(F.array(F.lit(0)))
    return split.withColumn("own", F.when(large, of(n)).otherwise(0)).withColumn("other", F.explode(others))


def _across(split: DataFrame) -> DataFrame:
    """u, v: pairs of nodes in different components of a group (see ``_split``) that can be similar.

    Similar ones are among them, whichever groups they share. One of the two is outside the largest component.
    """
    rows = _by_size(split).select("h", "node", "n", "pos", "root", "most", "own", "other")
    loose = rows.where("root <> most").select("h", F.col("own").alias("other"), F.col("other").alias("own"),
                                              *(F.col(c).alias(f"l_{c}") for c in ("node", "n", "pos", "root")))
    rest = rows.join(loose, ["h", "own", "other"]).where(
        (F.col("root") != F.col("l_root")) & ((F.col("root") == F.col("most")) | (F.col("node") < F.col("l_node"))) & _first_shared("", "l_"))
    return rest.select(F.greatest("node", "l_node").alias("u"), F.least("node", "l_node").alias("v"))


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The ``pairs`` (u, v) whose ends the ``known`` links leave in different components."""
    roots = store(components(known), "roots")
    for end in ("u", "v"):
        pairs = pairs.join(roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")), end, "left")
    return pairs.where(F.coalesce("u_root", "u") != F.coalesce("v_root", "v")).select("u", "v")


def _verified(pairs: DataFrame, rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """u, v of those ``pairs`` (u, v: rows) whose sets are similar, but for pairs that the
    ``known`` links connect. Stored."""
    pairs = store(pairs.distinct(), "pairs")
    if known is not None:
        every, pairs = pairs, store(_apart(pairs, known), "apart")
        discard(every)

    def ends(of: DataFrame) -> DataFrame:
        needed = store(of.select(F.col("u").alias("row")).union(of.select("v")).distinct(), "needed")
        return rows.join(bounded_broadcast(needed, BROADCAST_ROWS), "row", "left_semi")

    # most pairs are told apart by their sketches; only what then is left needs whole sets, which
    # take more room than the texts they come from
    sketches = store(_sets(ends(pairs), "sketch", sketch), "sketches")
    close = store(_pass(pairs, sketches, "sketch", np.uint8, _may_be_similar), "close")
    discard(pairs)
    discard(sketches)  # and the moved sketches, before whole sets are moved
    sets = store(_sets(ends(close), "own", lambda own: own), "sets")
    found = store(_pass(close, sets, "own", np.uint64, _similar), "links")
    discard(sets)
    discard(close)
    return found


def _by_fingerprint(prints: DataFrame, rows: DataFrame) -> DataFrame:
    """u, v: similar nodes among those whose fingerprints are equal or linked. Stored.

    ``prints`` (node, fp) is stored. Nodes of one fingerprint meet the first of them, and linked
    fingerprints meet by their first nodes; what this misses is left to the prefix filter.
    """
    firsts = store(prints.groupBy("fp").agg(F.min("node").alias("first")), "firsts")
    same = prints.join(firsts, "fp").where("node <> first").select(F.col("node").alias("u"), F.col("first").alias("v"))
    linked = simhash.links(firsts.select("fp"), group_limit=PRINTS)
    for end in ("u", "v"):
        linked = linked.join(firsts.select(F.col("fp").alias(end), F.col("first").alias(f"{end}_node")), end)
    across = linked.select(F.greatest("u_node", "v_node").alias("u"), F.least("u_node", "v_node").alias("v"))
    return _verified(same.unionByName(across), rows)


_MEMBER = "h bigint, salt int, node bigint, place bigint, p_node bigint, p_place bigint"


def _grouped(nodes: DataFrame, hot: dict[int, int]) -> DataFrame:
    """Members of each group of two or more (h, salt, node, place) next to its pivot (p_node, p_place).

    ``place`` holds the size of the set and the position of the shingle in its order, in one
    number. Shingles in ``hot`` are dealt to so many groups, whose numbers are their ``salt``; it is
    -1 elsewhere. All members of such a group come out.
    """
    spread = nodes.select("node", "n", F.posexplode("prefix").alias("pos", "h")).select(
        "h", F.xxhash64("node").alias("mark"), "node", (F.shiftleft(F.col("n").cast("bigint"), 32) + F.col("pos")).alias("place"))
    salt = F.lit(-1)
    if hot:
        parts = nodes.sparkSession.createDataFrame(list(hot.items()), "h bigint, parts int")  # at most SAMPLE_KEPT rows
        spread = spread.join(F.broadcast(parts), "h", "left")
        salt = F.coalesce(F.pmod("mark", F.col("parts")).cast("int"), salt)
    dealt = spread.withColumn("salt", salt).repartition("h", "salt").sortWithinPartitions("h", "salt", "mark", "node").select("h", "salt", "node", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = np.zeros((0, 4), np.int64)  # the last row, which may go on
        pivot: np.ndarray | None = None  # of the group it belongs to, if it is not the first there
        for batch in batches:
            rows = np.concatenate([carried, np.column_stack([c.to_numpy().astype(np.int64) for c in batch.columns])])
            if len(rows):
                out, pivot = _next_to_pivots(rows, pivot, last=False)
                carried = rows[-1:]
                yield out
        if len(carried):
            yield _next_to_pivots(carried, pivot, last=True)[0]

    return dealt.mapInArrow(run, _MEMBER)


def _next_to_pivots(rows: np.ndarray, pivot: np.ndarray | None, last: bool) -> tuple[pa.RecordBatch, np.ndarray | None]:
    """Rows (h, salt, node, place) of groups next to their pivots; the last row waits for what
    follows it, unless it is the end. ``pivot`` is that of the first row, if it is not its own."""
    begin = np.append([True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1))
    first = np.maximum.accumulate(np.where(begin, np.arange(len(rows)), 0))
    of = rows[first]
    many = (np.bincount(first, minlength=len(rows))[first] > 1) | (rows[:, 1] >= 0)
    if pivot is not None:
        of[first == 0], many[first == 0] = pivot, True
    out = np.column_stack([rows, of[:, 2:]])[: len(rows) if last else -1][many[: len(rows) if last else -1]]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
    batch = pa.RecordBatch.from_arrays([pa.array(c.astype(k.to_pandas_dtype()), k) for c, k in zip(out.T, kinds, strict=True)],
                                       ["h", "salt", "node", "place", "p_node", "p_place"])
    return batch, of[-1] if many[-1] and (len(rows) - first[-1] > 1 or pivot is not None and first[-1] == 0) else None


def _members(nodes: DataFrame, hot: dict[int, int]) -> DataFrame:
    """``_grouped`` with places taken apart. Stored."""
    parts = [F.shiftright(c, 32).cast("int").alias(n) for c, n in (("place", "n"), ("p_place", "p_n"))]
    parts += [F.col(c).bitwiseAND(0xFFFFFFFF).cast("int").alias(n) for c, n in (("place", "pos"), ("p_place", "p_pos"))]
    return store(_grouped(nodes, hot).select("h", "salt", "node", "p_node", *parts), "members")


def links(members: DataFrame, rows: DataFrame, hot: dict[int, int], known: DataFrame) -> DataFrame:
    """u, v: links between nodes, enough of them to connect all that are similar.

    ``members`` (stored, see ``_grouped``) is removed. ``rows`` (row, text) has the texts;
    ``hot`` tells into how many groups a frequent shingle was dealt. The ``known`` links are
    among those returned, and what they connect is not compared.
    """
    stars = members.where("node <> p_node").select("node", "n", "pos", "p_node", "p_n", "p_pos")
    if hot:  # the pivots of a shingle's groups meet the first of them
        pivots = members.where("salt >= 0 and node = p_node").select("h", "node", "n", "pos")
        top = pivots.groupBy("h").agg(F.min_by(F.struct(F.col("node").alias("p_node"), F.col("n").alias("p_n"), F.col("pos").alias("p_pos")), F.xxhash64("node")).alias("top"))
        stars = stars.unionByName(pivots.join(top, "h").select("node", "n", "pos", "top.*").where("node <> p_node"))
    stars = stars.where(_possible("", "p_"))
    found = known.unionByName(_verified(stars.select(F.greatest("node", "p_node").alias("u"), F.least("node", "p_node").alias("v")), rows, known))

    split = _split(members.select("h", "node", "n", "pos"), found, members)

    # groups that are still in parts get three pivots more: the set that is in most groups, one that
    # differs from group to group, and the one with the fewest shingles before the shared one, as the
    # original of many edited copies is
    degree = split.groupBy("node").agg(F.count("*").alias("degree"))
    own = F.struct(*(F.col(c).alias(f"p_{c}") for c in ("node", "n", "pos", "root")))
    tops = split.join(degree, "node").groupBy("h").agg(F.min_by(own, F.struct(-F.col("degree"), F.xxhash64("node"))).alias("hub"),
                                                       F.min_by(own, F.xxhash64("h", "node")).alias("any"),
                                                       F.min_by(own, F.struct("pos", F.xxhash64("node"))).alias("plain"))
    stars = split.join(tops.select("h", F.explode(F.array_distinct(F.array("hub", "any", "plain"))).alias("p")), "h").select("node", "n", "pos", "root", "p.*")
    stars = stars.where((F.col("root") != F.col("p_root")) & _possible("", "p_"))
    found = found.unionByName(_verified(stars.select(F.greatest("node", "p_node").alias("u"), F.least("node", "p_node").alias("v")), rows))
    split = _split(split.select("h", "node", "n", "pos"), found, split)

    more = _verified(_across(split), rows)
    discard(split)
    return found.unionByName(more)


def _split(members: DataFrame, found: DataFrame, before: DataFrame) -> DataFrame:
    """h, node, n, pos, root, size (rows of the group), most (its largest component) of those groups that
    the links leave in several components. Stored; the table ``before`` that ``members`` reads is removed."""
    rooted = store(members.join(store(components(found), "roots"), "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted")
    discard(before)
    sizes = rooted.groupBy("h", "root").agg(F.count("*").alias("k"))
    most = sizes.groupBy("h").agg(F.count("*").alias("roots"), F.sum("k").alias("size"), F.max_by("root", F.struct("k", "root")).alias("most"))
    most = most.where("roots > 1").select("h", "size", "most")
    split = store(rooted.join(most, "h"), "split")
    discard(rooted)
    return split


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component, with the columns of ``docs``.

    It is the row with the component's smallest doc_id; among rows that share it, the first of
    the table as stored. Rows without an id are left only where no row of the component has one.
    Other columns may have any names. Very long texts are cut into blocks of words; their sets are
    held whole. An empty table gives an empty result. Texts without words (null, empty, blank) are equal to each other and to nothing else.
    """
    conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    usual = conf.get(name)
    conf.set(name, str(BATCH_BYTES))  # every batch is read before this returns
    try:
        return _one_of_each(docs)
    finally:
        conf.set(name, usual)


def _one_of_each(docs: DataFrame) -> DataFrame:
    row, = free_name(docs, "row")
    numbered = store(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    keyed = numbered.select(quoted(row).alias("row"), present(numbered, "doc_id", "bigint").alias("doc_id"),
                            present(numbered, "text", "string").alias("text"))
    often, seen = _often(keyed)
    hot = {int(h): -(-int(k) * SAMPLE // HOT_ROWS) for h, k in zip(often.view(np.int64), seen, strict=True) if int(k) * SAMPLE > HOT_ROWS}
    marked = store(_marked(keyed, often, seen), "shingles")
    ids = store(marked.select("row", "doc_id", "key").join(marked.groupBy("key").agg(F.min("row").alias("node")), "key").drop("key"), "nodes")
    copies = store(ids.where("row <> node").select("row"), "copies")
    nodes = marked.join(bounded_broadcast(copies, BROADCAST_ROWS), "row", "left_anti").select(F.col("row").alias("node"), "n", "fp", "prefix")
    prints = store(nodes.where("n > 0").select("node", "fp"), "prints")
    members = _members(nodes, hot)
    discard(marked)
    found = links(members, keyed, hot, _by_fingerprint(prints, keyed))
    rooted = store(ids.join(components(found), "node", "left").select("row", "doc_id", F.coalesce("root", "node").alias("root")), "labels")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    kept = rooted.join(least, "root").where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("row").alias("row"))
    # few rows go, so that they are told rather than those that stay
    gone = store(rooted.select("row").join(kept.select("row"), "row", "left_anti").withColumnRenamed("row", row), "gone")
    return numbered.join(bounded_broadcast(gone, BROADCAST_ROWS), row, "left_anti").select(*(quoted(c) for c in docs.columns))
