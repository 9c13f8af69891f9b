"""Links between the tokens of two tokenizers, counted over the corpus by inverted bitmaps.

A document's text is encoded by both. Byte offsets at which tokens of both end cut the text into
groups, and every A token of a group is linked with every B token of it. For each id pair there
is an inverted list of the documents that hold it: documents are numbered, and a container has
the documents of one number range (a chunk) as sorted 16-bit numbers or, where they are many, as
a bitmap. How often a document holds the pair is written in planes: plane k lists the documents
whose number of links has bit k set. The OR of the planes says which documents hold the pair;
its population counts are the document counts, and those of the planes, times 2^k, the link
counts. Scores go back to the documents by running through the postings of each chunk.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, functions as F

from ..session import store
from .bpe import _encode_texts
from .common import present, text_slices

#: A chunk has 2^16 document numbers.
CHUNK_BITS = 16
#: From so many documents on, a container is a bitmap of 8192 bytes; shorter ones are lists.
DENSE = 4096
#: Distinct (pair, document) entries held before they are written as containers.
HELD_ENTRIES = 4_000_000
#: Links expanded at once; groups of more links are counted by distinct ids.
BLOCK_LINKS = 1_000_000
GROUP_LINKS = 256
#: Text worked on at once.
SLICE = 1 << 20
#: Longer texts are pre-tokenised outside the library, see ``bpe``.
LONG_CHARS = 65_536

_LOADED: dict[tuple[bytes, bytes, str], "_Tokenizers"] = {}
#: How byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on.
_PLAIN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
_BYTE_OF = {chr(b): b for b in _PLAIN} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


class _Tokenizers:
    """Both tokenizers of one worker: ids of texts, and the bytes of each id."""

    def __init__(self, a_json: bytes, b_model: bytes, pattern: str) -> None:
        model = json.loads(a_json)
        special = {t["content"] for t in model.get("added_tokens", [])}  # plain text here, so their entries are no tokens
        vocab = {bytes(_BYTE_OF[c] for c in t): i for t, i in model["model"]["vocab"].items() if t not in special}
        # merging by id is merging in the file's order only if ids follow that order
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        made = [model["model"]["vocab"]["".join(m)] for m in merges]
        if model.get("normalizer") or made != sorted(made) or len(made) + 256 != len(vocab):
            raise ValueError("the JSON file is no byte-level BPE whose ids follow its merges")
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=vocab, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = token
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # the ids as text, each with the sign behind it: within a side, and at the side's end
        self.signs = [b"%d%s" % (i, s) for i in range(len(self.a_bytes)) for s in (b",", b"|")]
        self.b_signs = len(self.signs)
        self.signs += [b"%d%s" % (i, s) for i in range(len(self.b_bytes)) for s in (b",", b";")]

    def ids(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none on either where the tokens do not spell the text."""
        a = _encode_texts(self.a, [" " + t for t in texts], self.pattern, LONG_CHARS)
        b = self.b.encode(texts, num_threads=1)
        for k, text in enumerate(texts):
            data = b" " + text.encode()
            same = text and b"".join(map(self.b_bytes.__getitem__, b[k])) == data and self.a_size[a[k]].sum() == len(data) \
                and b"".join(map(self.a_bytes.__getitem__, a[k].tolist())) == data
            if not same:
                a[k], b[k] = np.zeros(0, np.uint32), []
        return [x.astype(np.int64) for x in a], [np.array(x, np.int64) for x in b]


def tokenizers(a_json: bytes, b_model: bytes, pattern: str) -> _Tokenizers:
    key = a_json, b_model, pattern
    if key not in _LOADED:
        _LOADED[key] = _Tokenizers(*key)
    return _LOADED[key]


def load(path: str) -> bytes:
    """A vocabulary file as it is; it has a fixed size and travels with the tasks."""
    with open(path, "rb") as f:
        return f.read()


class _Aligned:
    """Groups and links of some documents, laid end to end."""

    def __init__(self, tk: _Tokenizers, a: list[np.ndarray], b: list[np.ndarray]) -> None:
        n = len(a)
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate([np.zeros(0, np.int64), *side]) for side in (a, b))
        ends_a, ends_b = np.cumsum(tk.a_size[self.a]), np.cumsum(tk.b_size[self.b])
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        self.group_a, self.group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        self.in_a, self.in_b = np.bincount(self.group_a, minlength=len(common)), np.bincount(self.group_b, minlength=len(common))
        self.links = self.in_a * self.in_b
        sizes = np.array([tk.a_size[x].sum() for x in a], np.int64)
        self.doc = np.searchsorted(np.cumsum(sizes), common)  # a document without tokens ends where the one before does
        self.n_groups = np.bincount(self.doc, minlength=n)
        self.n_links = np.zeros(n, np.int64)
        np.add.at(self.n_links, self.doc, self.links)

    def digests(self, tk: _Tokenizers) -> list[str]:
        """Lowercase hex of each document's ids by group; '' without tokens."""
        before_a, before_b = np.cumsum(self.in_a), np.cumsum(self.in_b) - self.in_b
        last_a = np.append(self.group_a[1:] != self.group_a[:-1], [True] * (len(self.a) > 0))
        last_b = np.append(self.group_b[1:] != self.group_b[:-1], [True] * (len(self.b) > 0))
        signs = np.zeros(len(self.a) + len(self.b), np.int64)
        signs[np.arange(len(self.a)) + before_b[self.group_a]] = 2 * self.a + last_a
        signs[np.arange(len(self.b)) + before_a[self.group_b]] = tk.b_signs + 2 * self.b + last_b
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        found, at = [], 0
        for end in ends:
            text = b"".join(map(tk.signs.__getitem__, signs[at:end].tolist()))[:-1]
            found.append(hashlib.sha256(text).hexdigest() if end > at else "")
            at = end
        return found

    def entries(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(pair, position of the document, links), in blocks; pairs may come again."""
        start_a, start_b = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        large = np.flatnonzero(self.links > GROUP_LINKS)
        for g in large.tolist():
            ua, ca = np.unique(self.a[start_a[g] : start_a[g] + self.in_a[g]], return_counts=True)
            ub, cb = np.unique(self.b[start_b[g] : start_b[g] + self.in_b[g]], return_counts=True)
            step = max(1, BLOCK_LINKS // len(ub))
            for k in range(0, len(ua), step):
                pair = (ua[k : k + step, None] << 16 | ub[None, :]).ravel()
                yield pair, np.full(len(pair), self.doc[g]), (ca[k : k + step, None] * cb[None, :]).ravel()
        reps = np.where(self.links > GROUP_LINKS, 0, self.in_b)[self.group_a]  # B tokens that an A token meets
        upto = np.cumsum(reps)
        at, n = 0, len(reps)
        while at < n:
            end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BLOCK_LINKS, side="right")))
            own = reps[at:end]
            left = np.repeat(np.arange(at, end), own)
            step = np.arange(len(left)) - np.repeat(np.cumsum(own) - own, own)
            group = self.group_a[left]
            yield self.a[left] << 16 | self.b[start_b[group] + step], self.doc[group], np.ones(len(left), np.int64)
            at = end


def _summed(keys: list[np.ndarray], links: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted keys and their links."""
    key, count = np.concatenate(keys), np.concatenate(links)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.append([True] * (len(key) > 0), key[1:] != key[:-1]))
    return key[first], np.add.reduceat(count, first) if len(first) else count


def containers(key: np.ndarray, links: np.ndarray) -> Iterator[tuple[np.ndarray, int, np.ndarray, np.ndarray, pa.Array]]:
    """(pair, plane, documents first seen in this plane, links, container) of sorted entries.

    ``key`` is pair << 16 | number within the chunk. A document counts in its lowest plane, so
    the counts add up to the population of the OR of all planes.
    """
    low = links & -links
    for plane in range(int(links.max()).bit_length() if len(links) else 0):
        here = np.flatnonzero(links >> plane & 1)
        if not len(here):
            continue
        pair, number = key[here] >> CHUNK_BITS, (key[here] & 0xFFFF).astype("<u2")
        first = np.flatnonzero(np.append([True], pair[1:] != pair[:-1]))
        size = np.diff(np.append(first, len(pair)))
        fresh = np.add.reduceat((low[here] == 1 << plane).astype(np.int64), first)
        dense = size >= DENSE
        parts, widths, at = [], np.where(dense, 1 << CHUNK_BITS >> 3, 2 * size), 0
        for k in np.flatnonzero(dense).tolist():
            bits = np.zeros(1 << CHUNK_BITS, bool)
            bits[number[first[k] : first[k] + size[k]]] = True
            parts += [number[at : first[k]].tobytes(), np.packbits(bits, bitorder="little").tobytes()]
            at = first[k] + size[k]
        data = b"".join([*parts, number[at:].tobytes()])
        ends = np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)
        held = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends), pa.py_buffer(data)])
        yield pair[first], plane, fresh, size << plane, held


def documents_of(container: bytes) -> np.ndarray:
    """Numbers within the chunk that a container holds, sorted."""
    if len(container) == 1 << CHUNK_BITS >> 3:
        return np.flatnonzero(np.unpackbits(np.frombuffer(container, np.uint8), bitorder="little"))
    return np.frombuffer(container, "<u2").astype(np.int64)


_SCHEMA = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                     ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("chunk", pa.int64()), ("pair", pa.int64()), ("plane", pa.int32()),
                     ("docs_here", pa.int64()), ("links_here", pa.int64()), ("container", pa.binary())])


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA)


def encoded(docs: DataFrame, a_json: bytes, b_model: bytes, pattern: str) -> DataFrame:
    """Counts of each row of ``docs`` (row, doc_id, text), and the containers of each chunk.

    Rows of documents have no ``container``. A chunk is filled by one task; a task that holds
    ``HELD_ENTRIES`` writes them out, so a pair may have several containers of a chunk, which
    hold different documents.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tk, keys, links, chunk = tokenizers(a_json, b_model, pattern), [], [], None

        def written() -> Iterator[pa.RecordBatch]:
            if keys:
                for pair, plane, docs_here, links_here, held in containers(*_summed(keys, links)):
                    yield _batch(chunk=np.full(len(pair), chunk), pair=pair, plane=np.full(len(pair), plane, np.int32),
                                 docs_here=docs_here, links_here=links_here, container=held)
            keys.clear()
            links.clear()

        for batch in batches:
            for part in text_slices(batch, limit=SLICE):
                rows = part.column("row").to_numpy()
                found = _Aligned(tk, *tk.ids(part.column("text").to_pylist()))
                yield _batch(row=rows, doc_id=part.column("doc_id"), n_a=found.n_a, n_b=found.n_b, n_groups=found.n_groups,
                             n_links=found.n_links, groups_sha256=found.digests(tk))
                for pair, doc, count in found.entries():
                    owner = rows[doc]
                    for own in np.unique(owner >> CHUNK_BITS).tolist():
                        if own != chunk:
                            yield from written()
                            chunk = own
                        here = owner >> CHUNK_BITS == own
                        key, n = _summed([pair[here] << CHUNK_BITS | owner[here] & 0xFFFF], [count[here]])
                        keys.append(key)
                        links.append(n)
                        if sum(map(len, keys)) >= HELD_ENTRIES:
                            yield from written()
        yield from written()

    kinds = {pa.int64(): "bigint", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
    return docs.select("row", "doc_id", "text").mapInArrow(run, ", ".join(f"{f.name} {kinds[f.type]}" for f in _SCHEMA))


def pair_counts(postings: DataFrame) -> DataFrame:
    """pair, a_id, b_id, n_docs, n_links, is_best (no pair of the A id is in more documents)."""
    counted = postings.groupBy("pair").agg(F.sum("docs_here").alias("n_docs"), F.sum("links_here").alias("n_links"))
    ids = counted.withColumn("a_id", F.shiftright("pair", 16)).withColumn("b_id", F.col("pair").bitwiseAND(0xFFFF))
    counts = store(ids, "pairs")
    best = counts.groupBy("a_id").agg(F.max("n_docs").alias("most"))
    return counts.join(best, "a_id").select("pair", "a_id", "b_id", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("is_best"))


def scores(postings: DataFrame, pairs: DataFrame) -> DataFrame:
    """row, n_best, count_sum of each document that has links.

    The scores of a chunk's pairs and the containers of the chunk meet in one task, sorted by
    pair, and stream through it; it holds two sums for each of the chunk's 65,536 numbers.
    """
    known = postings.where("docs_here > 0").select("chunk", "pair").join(pairs.select("pair", "n_docs", "is_best"), "pair")
    both = known.select("chunk", "pair", F.lit(-1).alias("plane"), "n_docs", "is_best", F.lit(None).cast("binary").alias("container")).unionByName(
        postings.select("chunk", "pair", "plane", "container"), allowMissingColumns=True)
    dealt = both.repartition("chunk").sortWithinPartitions("chunk", "pair", "plane")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, carry = None, None, (-1, 0, False)

        def summed() -> pa.RecordBatch:
            own = np.flatnonzero(held[0])
            return pa.RecordBatch.from_arrays([pa.array((chunk << CHUNK_BITS) + own), pa.array(held[1][own]), pa.array(held[0][own])],
                                              ["row", "n_best", "count_sum"])

        for batch in batches:
            owner, pair, plane = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("chunk", "pair", "plane"))
            n_docs = batch.column("n_docs").fill_null(0).to_numpy()
            best = batch.column("is_best").fill_null(False).to_numpy(zero_copy_only=False)
            # each container takes the values of the last score row before it
            at = np.maximum.accumulate(np.where(plane < 0, np.arange(len(pair)), -1))
            count, is_best, known = (np.where(at < 0, c, x[at]) for c, x in zip(carry[1:] + carry[:1], (n_docs, best, pair), strict=True))
            if (known != pair).any():
                raise RuntimeError("a pair without its count")
            carry = int(pair[-1]), int(count[-1]), bool(is_best[-1])
            for own in np.unique(owner).tolist():
                if own != chunk:
                    if held is not None:
                        yield summed()
                    chunk, held = own, np.zeros((2, 1 << CHUNK_BITS), np.int64)
                here = np.flatnonzero((owner == own) & (plane >= 0))
                data = batch.column("container").take(pa.array(here)).to_pylist()
                dense = np.array([len(d) == 1 << CHUNK_BITS >> 3 for d in data], bool)
                weight = count[here] << plane[here]
                links = is_best[here].astype(np.int64) << plane[here]
                for k in np.flatnonzero(dense).tolist():
                    number = documents_of(data[k])
                    held[0][number] += weight[k]
                    held[1][number] += links[k]
                size = np.array([0 if d else len(x) >> 1 for d, x in zip(dense, data, strict=True)], np.int64)
                number = np.frombuffer(b"".join([x for d, x in zip(dense, data, strict=True) if not d]), "<u2")
                np.add.at(held[0], number, np.repeat(weight, size))
                np.add.at(held[1], number, np.repeat(links, size))
        if held is not None:
            yield summed()

    return dealt.mapInArrow(run, "row bigint, n_best bigint, count_sum bigint")


def align(docs: DataFrame, a_json: bytes, b_model: bytes, pattern: str) -> tuple[DataFrame, DataFrame]:
    """Documents and id pairs.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, one row for
    each row of ``docs``. Null and empty texts, and those whose tokens do not spell them, have no
    tokens: zeros and ''. Repeated rows and repeated or null ``doc_id`` are documents of their own.
    Very long texts are encoded whole, their links in blocks. Columns other than doc_id and text
    are not looked at. An empty table gives empty results. Pairs: see ``pair_counts``.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), present(docs, "doc_id", "bigint").alias("doc_id"),
                       F.coalesce(present(docs, "text", "string"), F.lit("")).alias("text"))
    found = store(encoded(rows, a_json, b_model, pattern), "aligned")
    postings = found.where("container is not null")
    pairs = store(pair_counts(postings), "pair_counts")
    summed = scores(postings, pairs)
    counts = found.where("container is null").select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("bigint")
    return counts.join(summed, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"), pairs
