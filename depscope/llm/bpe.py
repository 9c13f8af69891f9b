"""Byte-level BPE encoding and decoding.

Texts longer than a chunk are cut into overlapping chunks that are rows of their own. Each
chunk is split into pre-tokens in parallel. Two neighbours are stitched at the first pre-token
start in their overlap that both have found and that no text further left or right can move.
The pieces between stitches are encoded in parallel and their ids put together in order. An
overlap without such a start (one pre-token longer than the overlap) stitches nothing: the
chunks on both sides form one piece. Shorter texts are one piece from the start.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from .common import present, text_slices

#: Characters of a chunk, and of the part it shares with the next one.
CHUNK_CHARS = 65_536
OVERLAP_CHARS = 2_048

# A pre-token ends before these places in any context: no alternative of the pattern spans
# them. A quote mark before a letter is left out, as it may begin a contraction.
_FIXED_START = regex.compile(
    r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})"
    r"|(?<=[^\s\p{L}\p{N}])(?=[\s\p{N}])|(?<=[^\s\p{L}\p{N}'])(?=\p{L})"
)

# What the end of a match may depend on: so many characters behind it.
_LOOK_AHEAD = 3

_ENCODINGS: dict[tuple[bytes, str], tiktoken.Encoding] = {}


def load_ranks(path: str) -> bytes:
    """The rank file as it is; it has a fixed size and travels with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file, built once in each Python process."""
    if (ranks, pattern) not in _ENCODINGS:
        pairs = (line.split() for line in ranks.splitlines() if line)
        _ENCODINGS[ranks, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
    return _ENCODINGS[ranks, pattern]


def _list_array(arrays: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int64).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def _encode_texts(enc: tiktoken.Encoding, texts: list[str | None], pattern: regex.Pattern, chunk: int) -> list[np.ndarray]:
    found = []
    for text in texts:
        if text is None or not text:
            found.append(np.zeros(0, np.uint32))
        elif len(text) <= 2 * chunk:
            found.append(enc.encode_to_numpy(text, disallowed_special=()))
        else:
            # a piece of several chunks is mostly one huge pre-token, which the library's own
            # pattern matcher may not get through
            ids = [i for m in pattern.finditer(text) for i in enc._encode_single_piece(m.group())]
            found.append(np.array(ids, np.uint32))
    return found


def encode(docs: DataFrame, ranks: bytes, pattern: str, chunk_chars: int = CHUNK_CHARS,
           overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """Token ids of whole texts: doc_id bigint, ids array<int>, one row for each row of ``docs``.

    A null or empty text has no ids. Repeated rows and repeated or null ``doc_id`` are kept as
    they are. Columns other than doc_id and text are not looked at. A document's ids meet in
    one row, as its text did; nothing else is gathered by document.
    """
    if not 0 < overlap_chars < chunk_chars:
        raise ValueError("overlap_chars must be positive and less than chunk_chars")
    docs = docs.select(present(docs, "doc_id", "bigint").alias("doc_id"), present(docs, "text", "string").alias("text"))
    is_long = F.length("text") > chunk_chars + overlap_chars

    def encode_rows(keys: list[str]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            enc, split = encoding(ranks, pattern), regex.compile(pattern)
            for batch in batches:
                for part in text_slices(batch):
                    ids = _encode_texts(enc, part.column("text").to_pylist(), split, chunk_chars)
                    yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), _list_array(ids)], [*keys, "ids"])
        return run

    short = docs.where(F.coalesce(~is_long, F.lit(True))).mapInArrow(encode_rows(["doc_id"]), "doc_id bigint, ids array<int>")
    pieces = stitched(chunks(docs.where(is_long), chunk_chars, overlap_chars), pattern, overlap_chars)
    encoded = pieces.mapInArrow(encode_rows(["row", "doc_id", "piece"]), "row bigint, doc_id bigint, piece int, ids array<int>")
    in_order = F.array_sort(F.collect_list(F.struct("piece", "ids")))
    whole = encoded.groupBy("row", "doc_id").agg(F.flatten(F.transform(in_order, lambda p: p.ids)).alias("ids"))
    return short.unionByName(whole.select("doc_id", "ids"))


def chunks(docs: DataFrame, chunk_chars: int, overlap_chars: int) -> DataFrame:
    """Overlapping chunks as rows: row, doc_id, part, at (offset), text; each spread for itself."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row, doc_id, text = (batch.column(c)[i].as_py() for c in ("row", "doc_id", "text"))
                starts = range(0, max(1, len(text) - overlap_chars), chunk_chars)
                for part, at in enumerate(starts):
                    yield pa.RecordBatch.from_pydict({
                        "row": pa.array([row], pa.int64()), "doc_id": pa.array([doc_id], pa.int64()),
                        "part": pa.array([part], pa.int32()), "at": pa.array([at], pa.int64()),
                        "text": [text[at : at + chunk_chars + overlap_chars]]})

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    cut_rows = rows.mapInArrow(cut, "row bigint, doc_id bigint, part int, at bigint, text string")
    return cut_rows.repartition("row", "part")


def stitched(chunk_rows: DataFrame, pattern: str, overlap_chars: int) -> DataFrame:
    """Pieces that can be encoded one by one: row, doc_id, piece, text."""
    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        for batch in batches:
            heads, tails = [], []
            for at, text in zip(batch.column("at").to_pylist(), batch.column("text").to_pylist(), strict=True):
                head, tail = [], []
                from_tail, to_tail = len(text) - overlap_chars, len(text) - _LOOK_AHEAD
                for m in split.finditer(text):
                    s = m.start()
                    if s < overlap_chars:
                        head.append(at + s)
                    if from_tail <= s <= to_tail and _FIXED_START.match(text, s):
                        tail.append(at + s)
                heads.append(head)
                tails.append(tail)
            places = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(heads, places), pa.array(tails, places)],
                                             [*batch.schema.names, "head", "tail"])

    w = Window.partitionBy("row").orderBy("part")
    found = chunk_rows.mapInArrow(
        starts, "row bigint, doc_id bigint, part int, at bigint, text string, head array<bigint>, tail array<bigint>")
    cuts = found.withColumn("cut", F.array_min(F.array_intersect("head", F.lag("tail").over(w)))).drop("head", "tail")
    # where nothing fits, the neighbours' parts meet at the chunk's offset, inside one piece
    begun = cuts.withColumn("begin", F.coalesce("cut", "at")).withColumn(
        "piece", F.count("cut").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))
    own = begun.withColumn("end", F.lead("begin").over(w))
    length = F.coalesce(F.col("end") - F.col("begin"), F.length("text"))
    parts = own.withColumn("text", F.substring(F.col("text"), (F.col("begin") - F.col("at") + 1).cast("int"), length.cast("int")))
    in_order = F.array_sort(F.collect_list(F.struct("part", "text")))
    return parts.groupBy("row", "doc_id", "piece").agg(F.concat_ws("", F.transform(in_order, lambda p: p.text)).alias("text"))


def decode(encoded: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """Append ``data`` (binary): the bytes of the ids put together. Null ids give no bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks, pattern)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                data = [enc.decode_bytes(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else b"" for x in part.column("ids")]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(data, pa.binary())], ["doc_id", "ids", "data"])

    rows = encoded.select("doc_id", "ids")
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>, data binary")


def digests(decoded: DataFrame, *more: str) -> DataFrame:
    """doc_id, ``more``, counts and digests: of decimal ids joined by commas, and of the bytes."""
    return decoded.select(
        "doc_id", *more, F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"))
