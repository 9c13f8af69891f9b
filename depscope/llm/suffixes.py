"""Removal of byte strings that occur earlier, by a sparse suffix array.

Of all suffixes, those at anchors are sorted: the leftmost place of the smallest fingerprint of
``LEAD`` bytes in each window of ``LENGTH`` bytes. Equal windows have equal anchors at the same
offset, so that a window can only repeat below one anchor fingerprint, and never in its own
block: neighbouring windows of one anchor form a block, one record of the array.

1. Records are dealt to ranges of the leading fingerprint by splitters from a sample, and
   sorted in each range by fingerprint, then by the whole block's, then by place. A block with
   an equal one before it is removed whole. A fingerprint that fills whole ranges is spread over
   them, and its blocks are compared across these ranges in step 2.
2. Blocks that share a fingerprint with different ones may share some windows only. Their bytes
   are fetched, and the windows sorted by leading bytes and compared byte by byte: in one task
   for an anchor with few blocks, else in ranges of (window, place) whose boundaries are compared.
3. Removed stretches are put together by document.

Fingerprints of 64 bits choose what is compared; blocks are taken as equal if both the leading
and the whole fingerprint agree (128 bits), windows only if their bytes do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import store
from .common import present

LENGTH = 100
LEAD = 32
#: Documents whose anchors give the splitters, for each range.
SAMPLE_PER_RANGE = 50
#: Anchors with more different blocks have their windows compared in ranges of their own.
GROUP_LIMIT = 2_000
#: Window starts worked on at once: small arrays stay in the processor's cache.
WORK = 1 << 17
#: Rows of a sorted range held in Python at once, beyond the group they end in.
HELD_ROWS = 200_000

# An odd base and its inverse modulo 2^64; the constants of a mixing step.
_BASE = 0x9E3779B97F4A7C15
_MIX = (0x7FB5D329728EA185, 0x81DADEF4BC2DD44D)

_TAG_BITS, _COUNT_BITS = 24, 7
#: Splitters are found as floating-point numbers, which hold so many bits less.
_SPLIT_SHIFT = 11
#: Low digits of a print that hold a place among the bytes worked on at once.
_PLACE = np.uint64((1 << 18) - 1)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[1])
    return x ^ (x >> np.uint64(33))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(10, int(n + 1).bit_length())
    if size not in _powers:
        pair = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            pair.append(np.multiply.accumulate(steps))
        _powers[size] = pair[0], pair[1]
    return _powers[size]


class Prints:
    """Fingerprints of any stretch of a byte string, by sums of prefixes."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _powers_to(len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[begin]) * self.down[begin])

    def all(self, length: int) -> np.ndarray:
        n = max(0, len(self.sums) - length)
        return _mix((self.sums[length:] - self.sums[:n]) * self.down[:n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


def _units(sizes: list[int], length: int) -> Iterator[list[tuple[int, int, int]]]:
    """(text, first byte, end) of stretches worked on together; long texts overlap by length - 1."""
    unit, held = [], 0
    for k, size in enumerate(sizes):
        for at in range(0, size - length + 1, WORK):
            end = min(size, at + WORK + length - 1)
            if held and held + end - at > WORK:
                yield unit
                unit, held = [], 0
            unit.append((k, at, end))
            held += end - at
    if unit:
        yield unit


def find_blocks(texts: list[bytes], length: int = LENGTH, lead: int = LEAD) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of text number, first window, windows, anchor print and block print."""
    width = length - lead + 1
    for unit in _units([len(t) for t in texts], length):
        data = np.frombuffer(b"".join(texts[k][a:e] for k, a, e in unit), np.uint8)
        ends = np.cumsum([e - a for _, a, e in unit])
        prints = Prints(data)
        leads = prints.all(lead)
        # the place takes the low digits: of equal prints the leftmost is the anchor
        place = _least((leads & ~_PLACE) | np.arange(len(leads), dtype=np.uint64), width) & _PLACE
        part = np.repeat(np.arange(len(unit)), np.diff(ends, prepend=0))[: len(place)]
        inside = np.arange(len(place)) + length <= ends[part]
        first = _starts(place, part, inside)
        at = np.flatnonzero(first)
        count = np.diff(at, append=len(place))
        keep = inside[at]
        at, count = at[keep], count[keep]
        block = prints.of(at, at + count + length - 1)
        base = np.array([a for _, a, _ in unit]) - np.concatenate([[0], ends[:-1]])
        owner = np.array([k for k, _, _ in unit])
        yield owner[part[at]], at + base[part[at]], count, leads[place[at].astype(np.int64)], _mix(block + count.astype(np.uint64))


def _starts(*columns: np.ndarray) -> np.ndarray:
    """True where any of the columns differs from the row before."""
    first = np.ones(len(columns[0]), bool)
    first[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return first


def _keyed(docs: DataFrame) -> DataFrame:
    """doc (never null), tag, data, doc_id: the bytes of each text and what tells rows apart."""
    text = F.coalesce(present(docs, "text", "string"), F.lit(""))
    doc_id = present(docs, "doc_id", "bigint")
    return docs.select(
        doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(-(1 << 63)).cast("bigint")).alias("doc"),
        F.xxhash64(text).bitwiseAND((1 << _TAG_BITS) - 1).alias("tag"), text.cast("binary").alias("data"))


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Sorted rows as column arrays, cut only where ``keys`` change."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < HELD_ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        columns = [table.column(k).to_numpy() for k in keys]
        changes = np.flatnonzero(np.any([c != c[-1] for c in columns], axis=0))
        whole = int(changes[-1]) + 1 if len(changes) else 0
        if whole:
            yield _arrays(table.slice(0, whole))
        held = table.slice(whole).to_batches()
    if held:
        yield _arrays(pa.Table.from_batches(held).combine_chunks())


def _arrays(table: pa.Table) -> dict[str, np.ndarray]:
    return {c: table.column(c).to_numpy() for c in table.column_names}


def _splitters(keyed: DataFrame, ranges: int, anchors: Callable, total: int) -> np.ndarray:
    """Upper ends of all ranges but the last, from a sample that follows their number."""
    share = min(1.0, SAMPLE_PER_RANGE * ranges / max(1, total))
    sample = keyed.sample(share, seed=7).mapInArrow(anchors, "anchor bigint")
    points = [k / ranges for k in range(1, ranges)]
    leading = F.shiftright("anchor", _SPLIT_SHIFT)
    found = sample.agg(F.percentile_approx(leading, points, 10_000).alias("p")).first().p if points else []
    return np.array(found or [], np.int64)


def _records(keyed: DataFrame, length: int, lead: int, ranges: int) -> DataFrame:
    """range, spread, anchor, block, doc, place (start, windows and tag in one number)."""
    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            sizes = pa.compute.binary_length(batch.column("data")).to_numpy(zero_copy_only=False)
            step = max(1, int(batch.num_rows * WORK * 8 / max(1, sizes.sum())))
            for k in range(0, batch.num_rows, step):
                part = batch.slice(k, step)
                doc, tag = (part.column(c).to_numpy() for c in ("doc", "tag"))
                for owner, at, count, anchor, block in find_blocks(part.column("data").to_pylist(), length, lead):
                    place = (((at << _COUNT_BITS) | count) << _TAG_BITS) | tag[owner]
                    yield anchor.view(np.int64), block.view(np.int64), doc[owner], place

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchor, *_ in arrays(batches):
            yield pa.RecordBatch.from_arrays([pa.array(anchor)], ["anchor"])

    split = _splitters(keyed, ranges, anchors, keyed.count())

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchor, block, doc, place in arrays(batches):
            low, high = (np.searchsorted(split, anchor >> _SPLIT_SHIFT, end) for end in ("left", "right"))
            # an anchor that is the end of several ranges fills them by itself
            spread = high - low > 1
            turn = _mix(doc.view(np.uint64) ^ place.astype(np.uint64)) % np.maximum(high - low, 1).astype(np.uint64)
            at = np.where(spread, low + turn.astype(np.int64), low)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at.astype(np.int32)), pa.array(spread), *map(pa.array, (anchor, block, doc, place))],
                ["range", "spread", "anchor", "block", "doc", "place"])

    return keyed.mapInArrow(records, "range int, spread boolean, anchor bigint, block bigint, doc bigint, place bigint")


def _compare_blocks(records: DataFrame, ranges: int, length: int) -> DataFrame:
    """doc, tag, start, size, and for blocks to look into: windows, anchor, n_blocks (else null)."""
    order = ["anchor", "block", "doc", "place"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _grouped(batches, ["anchor"]):
            anchor, doc, place = rows["anchor"], rows["doc"], rows["place"]
            first = _starts(anchor, rows["block"])
            start, count, tag = place >> (_COUNT_BITS + _TAG_BITS), (place >> _TAG_BITS) & ((1 << _COUNT_BITS) - 1), place & ((1 << _TAG_BITS) - 1)
            lead = np.flatnonzero(first)[np.cumsum(first) - 1]
            later = (doc != doc[lead]) | (start != start[lead])  # a repeated row is no earlier place
            group = np.cumsum(_starts(anchor)) - 1
            n_blocks = np.bincount(group, first).astype(np.int64)[group]
            n_blocks = np.where(rows["spread"].astype(bool), np.iinfo(np.int64).max, n_blocks)
            look = ~later & (n_blocks > 1)
            out = later | look
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[out]), pa.array(tag[out]), pa.array(start[out]), pa.array((count + length - 1)[out]),
                 *(pa.array(x[out], pa.int64(), mask=~look[out]) for x in (count, anchor, n_blocks))],
                ["doc", "tag", "start", "size", "windows", "anchor", "n_blocks"])

    dealt = records.repartitionById(ranges, F.col("range")).drop("range").sortWithinPartitions(*order)
    return dealt.mapInArrow(compare, "doc bigint, tag bigint, start bigint, size bigint, windows bigint, anchor bigint, n_blocks bigint")


def _by_document(keyed: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Documents with what was found in them; texts travel compressed."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                data = pa.array([press.compress(x) for x in part.column("data").to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "doc", "tag")), data], ["doc_id", "doc", "tag", "data"])

    packed = keyed.mapInArrow(pack, "doc_id bigint, doc bigint, tag bigint, data binary")
    return packed.join(found, ["doc", "tag"], how)


def _block_bytes(keyed: DataFrame, look: DataFrame) -> DataFrame:
    """anchor, n_blocks, doc, tag, start, data: the bytes of each block to look into."""
    wanted = look.groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "size", "anchor", "n_blocks")).alias("blocks"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches:
            for k in range(batch.num_rows):
                data = press.decompress(batch.column("data")[k].as_py())
                blocks = batch.column("blocks")[k].values
                start, size = (blocks.field(c).to_pylist() for c in ("start", "size"))
                n = len(start)
                yield pa.RecordBatch.from_arrays(
                    [blocks.field("anchor"), blocks.field("n_blocks"), pa.array([batch.column("doc")[k].as_py()] * n, pa.int64()),
                     pa.array([batch.column("tag")[k].as_py()] * n, pa.int64()), blocks.field("start"),
                     pa.array([data[s : s + z] for s, z in zip(start, size, strict=True)], pa.binary())],
                    ["anchor", "n_blocks", "doc", "tag", "start", "data"])

    return _by_document(keyed, wanted, "inner").mapInArrow(
        cut, "anchor bigint, n_blocks bigint, doc bigint, tag bigint, start bigint, data binary")


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one big-endian number."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = np.zeros(len(data), np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[k : k + len(data)]
    return words


def later_windows(group: np.ndarray, blocks: list[bytes], doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, window) of each window that stands at an earlier place of its group as well.

    Windows are sorted by their leading eight bytes, ties by a print of the rest, ties by
    place; neighbours are compared byte by byte.
    """
    data = np.frombuffer(b"".join(blocks), np.uint8)
    sizes = np.array([len(b) for b in blocks])
    counts = sizes - length + 1
    block = np.repeat(np.arange(len(blocks)), counts)
    window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(np.cumsum(sizes) - sizes, counts) + window
    words, prints = _words(data), Prints(data).of(at, at + length)
    order = np.lexsort((start[block] + window, doc[block], prints, words[at], group[block]))
    block, window, at, prints = block[order], window[order], at[order], prints[order]
    same = np.zeros(len(at), bool)
    same[1:] = (group[block[1:]] == group[block[:-1]]) & (prints[1:] == prints[:-1])
    for k in [*range(0, length - 8, 8), length - 8]:
        same[1:] &= words[at[1:] + k] == words[at[:-1] + k]
    lead = np.flatnonzero(~same)[np.cumsum(~same) - 1] if len(at) else np.zeros(0, np.int64)
    later = same & ((doc[block] != doc[block[lead]]) | (start[block] + window != start[block[lead]] + window[lead]))
    return block[later], window[later]


def _small_groups(contents: DataFrame, length: int) -> DataFrame:
    """doc, tag, start, size of repeated stretches below anchors with few blocks."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _grouped(batches, ["anchor"]):
            # groups are compared some at a time, so that the windows of a step stay few
            group = np.cumsum(_starts(whole["anchor"])) - 1
            edges = [0]
            for b in [*np.flatnonzero(_starts(group))[1:].tolist(), len(group)]:
                if b - edges[-1] >= GROUP_LIMIT or b == len(group):
                    edges.append(b)
            for a, b in zip(edges, edges[1:], strict=False):
                rows = {c: v[a:b] for c, v in whole.items()}
                block, window = later_windows(group[a:b], list(rows["data"]), rows["doc"], rows["start"], length)
                order = np.lexsort((window, block))
                block, window = block[order], window[order]
                # neighbouring windows make one stretch
                first = np.ones(len(block), bool)
                first[1:] = (block[1:] != block[:-1]) | (window[1:] != window[:-1] + 1)
                head = np.flatnonzero(first)
                size = np.diff(head, append=len(block)) + length - 1
                own = block[head]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["doc"][own]), pa.array(rows["tag"][own]), pa.array(rows["start"][own] + window[head]), pa.array(size.astype(np.int64))],
                    ["doc", "tag", "start", "size"])

    dealt = contents.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(compare, "doc bigint, tag bigint, start bigint, size bigint")


def _large_groups(contents: DataFrame, length: int) -> DataFrame:
    """The same below anchors with many blocks: windows in ranges, boundaries compared."""
    starts = F.sequence(F.lit(0), F.octet_length("data") - length)
    windows = contents.select("doc", "tag", "start", "data", F.explode(starts).alias("k")).select(
        F.expr(f"substring(data, k + 1, {length})").alias("bytes"), "doc", (F.col("start") + F.col("k")).alias("start"), "tag")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, first_run, lead = TaskContext.get().partitionId(), None, True, None
        for batch in batches:
            out = []
            for data, doc, start, tag in zip(*(batch.column(c).to_pylist() for c in ("bytes", "doc", "start", "tag")), strict=True):
                if data != last:
                    first_run, last, lead = last is None, data, (doc, start)
                    if first_run:
                        out.append((doc, tag, start, data, part, None))
                elif (doc, start) != lead:
                    out.append((doc, tag, start, None, part, None))
                elif first_run:  # another row of the same id at the same place: as early, and as late, as the first
                    out.append((doc, tag, start, data, part, None))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("doc", "tag", "start", "head", "part", "tail"), r, strict=True)) for r in out], schema)
        if last is not None:
            yield pa.RecordBatch.from_pylist([{"doc": None, "tag": None, "start": None, "head": None, "part": part, "tail": last}], schema)

    schema = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("head", pa.binary()), ("part", pa.int32()), ("tail", pa.binary())])
    place = ["bytes", "doc", "start"]
    sorted_rows = windows.repartitionByRange(*place).sortWithinPartitions(*place)
    found = store(sorted_rows.mapInArrow(compare, "doc bigint, tag bigint, start bigint, head binary, part int, tail binary"), "windows")
    # one row a range: its last window; the first of the next range may continue it
    tails = found.where("tail is not null").select(F.lead("part").over(Window.orderBy("part")).alias("part"), F.col("tail").alias("before"))
    heads = found.where("head is not null").join(tails, "part").where(F.col("head") == F.col("before"))
    repeats = found.where("doc is not null and head is null").select("doc", "tag", "start").unionByName(heads.select("doc", "tag", "start"))
    return repeats.withColumn("size", F.lit(length).cast("bigint"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, lead: int = LEAD, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, n_bytes, spans (array of begin, end), kept (binary); one row for each row of ``docs``.

    A byte is removed if it lies in a string of ``length`` bytes that also begins earlier: in a
    smaller doc_id, or in the same one at a smaller offset. Strings are those of the input.
    Null texts count as empty; a null doc_id is smaller than all others. Rows that share an id
    count as one document when places are compared, so that a repeated row is not a repeat of
    itself. Other columns are not looked at. Nothing of a document beyond its own row is
    gathered in one task.
    """
    if not 8 <= lead < length or length - lead + 1 >= 1 << _COUNT_BITS:
        raise ValueError("lead must be at least 8 and less than length, with fewer than 128 places for it")
    keyed = _keyed(docs)
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = store(_compare_blocks(_records(keyed, length, lead, ranges), ranges, length), "blocks")
    look = found.where("windows is not null")
    contents = store(_block_bytes(keyed, look.select("doc", "tag", "start", "size", "anchor", "n_blocks")), "contents")
    repeats = found.where("windows is null").select("doc", "tag", "start", "size").unionByName(
        _small_groups(contents.where(F.col("n_blocks") <= group_limit), length))
    large = contents.where(F.col("n_blocks") > group_limit)
    if large.limit(1).count():
        repeats = repeats.unionByName(_large_groups(large, length))
    code = F.shiftleft(F.col("start"), 31).bitwiseOR(F.col("size"))
    stretches = repeats.groupBy("doc", "tag").agg(F.collect_set(code).alias("stretches"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                sizes, spans, kept = [], [], []
                for packed, codes in zip(part.column("data").to_pylist(), part.column("stretches"), strict=True):
                    data = press.decompress(packed)
                    begin, end = _merged(codes.values.to_numpy() if codes.is_valid else np.zeros(0, np.int64))
                    edges = [0, *(x for pair in zip(begin, end, strict=True) for x in pair), len(data)]
                    sizes.append(len(data))
                    spans.append([{"begin": a, "end": b} for a, b in zip(begin, end, strict=True)])
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"])

    return _by_document(keyed, stretches, "left").mapInArrow(
        cut, "doc_id bigint, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")


def _merged(codes: np.ndarray) -> tuple[list[int], list[int]]:
    """Begins and ends of the maximal stretches; those that touch are one."""
    codes = np.sort(codes)
    begin, end = codes >> 31, (codes >> 31) + (codes & ((1 << 31) - 1))
    reach = np.maximum.accumulate(end) if len(end) else end
    first = np.ones(len(begin), bool)
    first[1:] = begin[1:] > reach[:-1]
    last = np.append(np.flatnonzero(first)[1:] - 1, len(begin) - 1) if len(begin) else np.zeros(0, np.int64)
    return begin[first].tolist(), reach[last].tolist()


def digests(kept: DataFrame) -> DataFrame:
    """Counts and the digest of what is left."""
    return kept.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
