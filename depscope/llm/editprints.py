"""Fingerprints of whole texts that compare edit distances.

Shared random walks: at time t the walk stands at one character of a text and reads it; a coin
that depends on t and the character says whether it moves on to the next one. What is read over
time is the embedded text. Two walks over similar texts fall into step again behind an edit,
because from then on equal characters at equal times throw equal coins; so texts at a small edit
distance have embeddings at a small Hamming distance. A fingerprint samples the embedding: each
of its bytes has a random order of all times and takes the character read at the first of them
that lies within the embedding. Texts of similar length thus sample the same times, whatever the
length. The share of equal bytes estimates the likeness of two texts.

Banding: fingerprints that agree in all bytes of a band are candidates, verified by their
likeness. A group of candidates is compared within tasks, large ones as pairs of bounded sets,
and each task gives only links that connect.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import store
from .common import present, text_slices
from .components import components

#: Walks, and bytes of a fingerprint sampled from each.
WALKS = 2
BYTES = 64
#: Bytes of a band. A likeness of 0.8 shares one of the 25 bands with probability 0.99995.
BAND = 5
#: Links: so many hundredths of the bytes are equal.
NEAR_PERCENT = 80
#: The coins repeat after so many steps; characters share coins by classes.
PERIOD = 4096
CLASSES = 64
#: Times are ordered up to here; a longer embedding samples its beginning, 2^40 steps.
HORIZON_BITS = 40
#: Fingerprints of a band that a task compares at once; larger groups are split into sets.
GROUP_LIMIT = 4_000
#: So many texts at least walk side by side.
TOGETHER = 24
SEED = 0x5EED


def _coins() -> list[list[bytes]]:
    """For each walk, class and time (modulo the period): steps until the walk moves on."""
    found = []
    for walk in range(WALKS):
        heads = np.random.Generator(np.random.PCG64([SEED, walk])).integers(0, 2, (CLASSES, PERIOD)).astype(bool)
        heads[:, -1] = True
        ahead = np.tile(heads, 2)
        nearest = np.where(ahead, np.arange(2 * PERIOD), 2 * PERIOD)
        nearest = np.minimum.accumulate(nearest[:, ::-1], axis=1)[:, ::-1][:, :PERIOD]
        found.append([(row - np.arange(PERIOD) + 1).astype(np.uint8).tobytes() for row in nearest])
    return found


def _firsts() -> list[np.ndarray]:
    """For each walk, a row for each byte: the times that are the first in order among all times
    up to them; rows are filled up with the horizon.

    The first of a random order among the times below n is the last such time below n. There are
    about ln n of them: behind a time of rank m (0 to 1), a time is smaller with probability m.
    """
    found = []
    for walk in range(WALKS):
        own = []
        for slot in range(BYTES):
            rng = np.random.Generator(np.random.PCG64([SEED, walk, 1, slot]))
            times, rank = [0], rng.random()
            while (at := times[-1] + int(rng.geometric(rank))) < 1 << HORIZON_BITS:
                times.append(at)
                rank *= rng.random()
            own.append(times)
        most = max(map(len, own))
        found.append(np.array([t + [1 << HORIZON_BITS] * (most - len(t)) for t in own], np.int64))
    return found


_TABLES: list = []


def _tables() -> tuple[list[list[bytes]], list[np.ndarray]]:
    if not _TABLES:
        _TABLES.append((_coins(), _firsts()))
    return _TABLES[0]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _left_at(codes: list[np.ndarray], starts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text, walks x characters: the time at which a walk leaves each character.

    ``starts`` has the times at which the walks reach the first one. Texts walk side by side, the
    longest first; where few are left, each goes on alone.
    """
    coins, last = _tables()[0], PERIOD - 1
    order = np.argsort([-len(c) for c in codes], kind="stable")
    size = np.array([len(codes[k]) for k in order], np.int64)
    joint = int(size[TOGETHER - 1]) if len(size) >= TOGETHER else 0  # characters that so many texts have
    own = np.minimum(size, joint)
    active = np.searchsorted(-own, -np.arange(joint), side="left")  # texts longer than i
    offset = np.concatenate([[0], np.cumsum(active)])
    place = [offset[:n] + k for k, n in enumerate(own.tolist())]  # of each text's characters, laid out by step
    classes = [((codes[k].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)).astype(np.uint8) for k in order]
    laid = np.zeros(offset[-1], np.uint8)
    for at, c in zip(place, classes, strict=True):
        laid[at] = c[: len(at)]
    laid = laid.astype(np.int64) * PERIOD
    found: list[np.ndarray] = [None] * len(codes)
    # both walks in one table, one behind the other
    steps = np.frombuffer(b"".join(row for rows in coins for row in rows), np.uint8)
    table = (np.arange(WALKS) * (CLASSES * PERIOD))[:, None]
    times = np.zeros((WALKS, offset[-1]), np.int64)
    t = np.array([starts[k] for k in order], np.int64).reshape(-1, WALKS).T
    edges = offset.tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        t = t[:, : b - a]
        t = t + steps.take((t & last) + table + laid[a:b])
        times[:, a:b] = t
    for k, at, c in zip(order.tolist(), place, classes, strict=True):
        left = times[:, at]
        rest = c[len(at) :].tobytes()
        if rest:
            more = []
            for walk, rows in enumerate(coins):
                t = int(left[walk, -1]) if len(at) else int(starts[k][walk])
                more.append([t := t + rows[x][t & last] for x in rest])
            left = np.concatenate([left, np.array(more, np.int64)], axis=1)
        found[k] = left
    return found


def _sampled(codes: np.ndarray, left: np.ndarray) -> bytes:
    """``WALKS * BYTES`` bytes of a walked text; zeros for an empty one."""
    if not len(codes):
        return bytes(WALKS * BYTES)
    out = []
    for ends, firsts in zip(left, _tables()[1], strict=True):
        times = firsts[np.arange(BYTES), (firsts < ends[-1]).sum(axis=1) - 1]
        read = codes[np.searchsorted(ends, times, side="right")].astype(np.uint64)
        # one byte for the time and the character, never zero
        mixed = (times.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) ^ read * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        out.append(((mixed >> np.uint64(32)) % np.uint64(255) + 1).astype(np.uint8))
    return np.concatenate(out).tobytes()


class Walked:
    """A text with its walks and its fingerprint."""

    def __init__(self, text: str, codes: np.ndarray, left: np.ndarray) -> None:
        self.text, self.codes, self.left, self.print = text, codes, left, _sampled(codes, left)


def walked(texts: list[str]) -> list[Walked]:
    codes = [_codes(t) for t in texts]
    left = _left_at(codes, [np.zeros(WALKS, np.int64)] * len(texts))
    return [Walked(*x) for x in zip(texts, codes, left, strict=True)]


def fingerprint(text: str | None) -> bytes:
    return walked([text or ""])[0].print


def likeness(a: bytes, b: bytes) -> float:
    """Share of equal bytes; that of equal fingerprints is 1."""
    return float(np.mean(np.frombuffer(a, np.uint8) == np.frombuffer(b, np.uint8)))


def edited(rows: list[Walked], following: list[Walked]) -> list[Walked]:
    """Each text with its last third replaced by as much of the beginning of the one that follows.

    The walks over the part that stays are those of the text itself.
    """
    cut = [len(r.codes) // 3 for r in rows]
    stays = [len(r.codes) - n for r, n in zip(rows, cut, strict=True)]
    tails = [f.codes[:n] for f, n in zip(following, cut, strict=True)]
    starts = [r.left[:, n - 1] if n else np.zeros(WALKS, np.int64) for r, n in zip(rows, stays, strict=True)]
    more = _left_at(tails, starts)
    return [Walked(r.text[:n] + f.text[:c], np.concatenate([r.codes[:n], tail]), np.concatenate([r.left[:, :n], left], axis=1))
            for r, f, n, c, tail, left in zip(rows, following, stays, cut, tails, more, strict=True)]


_ROW = pa.schema([("place", pa.string()), ("part", pa.int32()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("n_chars", pa.int64()),
                  ("edited_sha256", pa.string()), ("fingerprint", pa.binary()), ("edited_fingerprint", pa.binary()),
                  ("near_edited", pa.float64()), ("near_next", pa.float64()), ("text", pa.string())])
_ROW_SQL = ("place string, part int, doc_id bigint, tie bigint, n_chars bigint, edited_sha256 string, fingerprint binary, "
            "edited_fingerprint binary, near_edited double, near_next double, text string")


def _finished(keys: list[dict], rows: list[Walked], following: list[Walked]) -> Iterator[dict]:
    for key, own, behind, changed in zip(keys, rows, following, edited(rows, following), strict=True):
        yield {**key, "place": "row", "text": None, "n_chars": len(own.codes), "edited_sha256": hashlib.sha256(changed.text.encode()).hexdigest(),
               "fingerprint": own.print, "edited_fingerprint": changed.print,
               "near_edited": likeness(own.print, changed.print), "near_next": likeness(own.print, behind.print)}


def _in_order(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (doc_id, text) with all that their successor gives, as far as it is in
    the same range; the first row of each range ('head') and its last ('tail') bring their text.

    The ranges are by descending id, then by a hash of the text; rows that agree in both are alike
    and may fall into several ranges. Rows stream through, a slice at a time.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("tie"), F.monotonically_increasing_id().alias("salt"), "text")
    order = [F.col("doc_id").desc_nulls_last(), F.col("tie"), F.col("salt")]
    ranges = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "doc_id", "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[dict] = []  # the last row, whose successor is still to come, and then those of a slice
        held: list[Walked] = []
        for batch in batches:
            for part in text_slices(batch):
                out = []
                if not held and part.num_rows:
                    out.append({**part.slice(0, 1).to_pylist()[0], "place": "head"})
                keys += part.to_pylist()
                held += walked(part.column("text").to_pylist())
                yield pa.RecordBatch.from_pylist([*out, *_finished(keys[:-1], held[:-1], held[1:])], schema=_ROW)
                keys, held = keys[-1:], held[-1:]
        if held:
            yield pa.RecordBatch.from_pylist([{**keys[0], "place": "tail"}], schema=_ROW)

    return ranges.mapInArrow(run, _ROW_SQL)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of each row.

    The tail of a range meets the head of the next one, and the last tail the first head. There
    are as many of them as ranges; only their keys are ordered in one place.
    """
    stored = store(_in_order(docs), "in_order")
    # ranges are in the order of their numbers; empty ones have no rows
    heads, tails = (stored.where(F.col("place") == p).select("part", "doc_id", "text") for p in ("head", "tail"))
    parts = sorted(r.part for r in heads.select("part").collect())
    after = {a: b for a, b in zip(parts, parts[1:] + parts[:1], strict=True)}
    successors = docs.sparkSession.createDataFrame(list(after.items()), "part int, after int")
    met = tails.join(successors, "part").join(heads.select(F.col("part").alias("after"), F.col("text").alias("following")), "after").select(
        "part", "doc_id", "text", "following")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                out = _finished([{"doc_id": d} for d in part.column("doc_id").to_pylist()], walked(part.column("text").to_pylist()), walked(part.column("following").to_pylist()))
                yield pa.RecordBatch.from_pylist(list(out), schema=_ROW)

    columns = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return stored.where("place = 'row'").select(columns).unionByName(met.mapInArrow(run, _ROW_SQL).select(columns))


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of a, which rows of b are near it."""
    return (a[:, None, :] == b[None, :, :]).sum(axis=2) * 100 >= NEAR_PERCENT * a.shape[1]


def _links_within(prints: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links in a set (side 0 only) or between two sets."""
    root = np.arange(len(prints))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    right = right if len(right) else left
    found = []
    for at in range(0, len(left), 64):
        own = left[at : at + 64]
        for i, j in zip(*np.nonzero(np.concatenate([_near(prints[own], prints[right[k : k + 1024]]) for k in range(0, len(right), 1024)], axis=1)), strict=True):
            a, b = find(own[i]), find(right[j])
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((own[i], right[j]))
    return found


def links(prints: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """u, v: links between rows of ``prints`` (node bigint, fingerprint; distinct), enough of
    them to connect all that share a band and are near. Stored input.

    Bands are counted first. Of bands with the same members one is compared. A band with more
    fingerprints than the limit is dealt to sets, and each two sets are compared by a task of
    their own.
    """
    n_bands = WALKS * BYTES // BAND
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(n_bands - 1)), lambda k: F.xxhash64(k, F.substring("fingerprint", k * BAND + 1, F.lit(BAND)))))
    members = prints.select("node", band.alias("band"))
    # members as sums of two hashes, whatever their order
    sums = [F.sum(F.xxhash64("node", F.lit(salt)).cast("decimal(20,0)")).alias(f"sum_{salt}") for salt in (1, 2)]
    sizes = members.groupBy("band").agg(F.count("*").alias("n"), *sums).where("n > 1")
    sizes = store(sizes.groupBy("n", "sum_1", "sum_2").agg(F.min("band").alias("band")).select("band", "n"), "bands")
    n_sets = F.ceil(F.col("n") / group_limit).cast("int")
    own = members.join(sizes, "band").withColumn("sets", n_sets).withColumn("own", F.pmod(F.xxhash64("node"), F.col("sets")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sets") - 1))).select(
        "band", "node", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") > F.col("other"), 1).otherwise(0).alias("side"))
    ready = dealt.join(prints, "node").repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compared(table: pa.Table) -> pa.RecordBatch:
            keys = np.column_stack([table.column(c).to_numpy() for c in ("band", "i", "j")])
            begin = np.flatnonzero(np.append([True], (keys[1:] != keys[:-1]).any(axis=1)))
            node, side = table.column("node").to_numpy(), table.column("side").to_numpy()
            prints_here = np.frombuffer(b"".join(table.column("fingerprint").to_pylist()), np.uint8).reshape(len(node), -1)
            u, v = [], []
            for a, b in zip(begin, np.append(begin[1:], len(node)), strict=True):
                if keys[a, 1] != keys[a, 2] and side[a:b].min() == side[a:b].max():
                    continue  # one of two sets is empty
                for x, y in _links_within(prints_here[a:b], side[a:b]):
                    u.append(node[a + x])
                    v.append(node[a + y])
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < group_limit:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = np.column_stack([table.column(c).to_numpy() for c in ("band", "i", "j")])
            change = np.flatnonzero((keys != keys[-1]).any(axis=1))
            whole = int(change[-1]) + 1 if len(change) else 0
            if whole:
                yield compared(table.slice(0, whole))
            held = table.slice(whole).to_batches()
        if held:
            yield compared(pa.Table.from_batches(held))

    return ready.select("band", "i", "j", "side", "node", "fingerprint").mapInArrow(run, "u bigint, v bigint")


def classes(prints: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """fingerprint, class_id (smallest doc_id) for the distinct fingerprints of ``prints`` (doc_id, fingerprint)."""
    nodes = store(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")).withColumn("node", F.monotonically_increasing_id()), "prints")
    of = components(links(nodes.select("node", "fingerprint"), group_limit))
    rooted = nodes.join(of, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return rooted.select("fingerprint", "root").join(least, "root").select("fingerprint", "class_id")


def edit_fingerprints(docs: DataFrame, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hex), near_edited, near_next, class_id.

    One row for each row of ``docs``. The edited text ends with the beginning of the next
    document's, by descending doc_id, those without one last; after the last comes the first.
    Rows that share an id follow in the order of a hash of their texts. A null text counts as
    empty and has zeros as its fingerprint, so empty texts are alike. ``class_id`` is the smallest
    doc_id that is reached over near fingerprints which share a band. Repeated rows are
    documents of their own. Columns other than doc_id and text are not looked at. A single row is
    its own successor. An empty table gives an empty result. Whole texts are walked, whatever
    their length; one text is held at a time, besides the one before.
    """
    docs = docs.select(present(docs, "doc_id", "bigint").alias("doc_id"), F.coalesce(present(docs, "text", "string"), F.lit("")).alias("text"))
    found = store(with_next(docs), "edit_fingerprints")
    of = classes(found.select("doc_id", "fingerprint"), group_limit)
    return found.join(of, "fingerprint").select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fingerprint")).alias("fingerprint"), F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited", "near_next", "class_id")
