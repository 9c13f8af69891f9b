"""Token counts of whole texts by a SentencePiece BPE model.

Texts longer than a chunk are cut into overlapping chunks, encoded with offsets in parallel and
spliced at a boundary that both neighbours share. A boundary between two characters is stable
if no piece of the vocabulary holds the two next to each other: merges only make pieces of the
vocabulary, so none ever spans it, whatever stands further left or right. An overlap that has
no stable boundary is doubled until it has one or the text ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .common import present, text_slices

#: Characters of a chunk, and of the part it shares with the next one (doubled as needed).
CHUNK_CHARS = 65_536
OVERLAP_CHARS = 256

_MODELS: dict[bytes, tuple[sentencepiece.SentencePieceProcessor, frozenset[str]]] = {}


def load_model(path: str) -> bytes:
    """The model file as it is; it has a fixed size and travels with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def processor(model: bytes) -> tuple[sentencepiece.SentencePieceProcessor, frozenset[str]]:
    """The processor, and every two characters that some piece holds next to each other."""
    if model not in _MODELS:
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)))
        _MODELS[model] = sp, frozenset(p[i : i + 2] for p in pieces for i in range(len(p) - 1))
    return _MODELS[model]


def stable_start(text: str, begin: int, end: int, inside: frozenset[str]) -> int | None:
    """The first place in ``begin`` … ``end - 1`` that no token can span, or None."""
    seen = text[begin - 1 : end].replace(" ", "▁")
    return next((begin + i for i in range(len(seen) - 1) if seen[i : i + 2] not in inside), None)


def plan_chunks(text: str, chunk_chars: int, overlap_chars: int, inside: frozenset[str]) -> Iterator[tuple[int, int, int, int]]:
    """Chunks of a text as (first character, end, left splice, right splice), in order."""
    at = left = 0
    while True:
        seam = at + chunk_chars
        overlap, right = overlap_chars, None
        while seam + 1 < len(text) and right is None:
            right = stable_start(text, seam + 1, min(seam + overlap, len(text)), inside)
            if right is None and seam + overlap >= len(text):
                break
            if right is None:
                overlap *= 2
        if right is None:
            yield at, len(text), left, len(text)
            return
        yield at, min(seam + overlap, len(text)), left, right
        at, left = seam if right < seam + chunk_chars else right - 1, right


def count_between(sp: sentencepiece.SentencePieceProcessor, text: str, left: int, right: int) -> int:
    """Tokens of ``text`` that begin in left … right - 1 (characters)."""
    begins = [p.begin for p in sp.encode(text, return_type="proto").pieces]
    low, high = (len(text[:x].encode()) for x in (left, right))
    if left and low not in begins or right < len(text) and high not in begins:
        raise RuntimeError("a splice is not a token boundary: the model is no plain BPE model")
    return int(np.sum((np.array(begins) >= low) & (np.array(begins) < high)))


def token_counts(docs: DataFrame, model: bytes, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
                 limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens (bigint), over_limit; one row for each row of ``docs``.

    A null text counts as empty: no bytes, no tokens. Repeated rows and repeated or null
    ``doc_id`` are kept as they are. Columns other than doc_id and text are not looked at.
    """
    docs = docs.select(present(docs, "doc_id", "bigint").alias("doc_id"),
                       F.coalesce(present(docs, "text", "string"), F.lit("")).alias("text"))
    is_long = F.length("text") > chunk_chars + overlap_chars
    keys = ["doc_id", "n_bytes"]

    def count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, _ = processor(model)
        for batch in batches:
            for part in text_slices(batch):
                n = [len(x) for x in sp.encode(part.column("text").to_pylist(), num_threads=1)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), pa.array(n, pa.int64())], [*keys, "n_tokens"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, inside = processor(model)
        for batch in batches:
            for i in range(batch.num_rows):
                row, doc_id, n_bytes, text = (batch.column(c)[i].as_py() for c in ("row", "doc_id", "n_bytes", "text"))
                for part, (at, end, left, right) in enumerate(plan_chunks(text, chunk_chars, overlap_chars, inside)):
                    yield pa.RecordBatch.from_pydict(
                        {"row": [row], "doc_id": pa.array([doc_id], pa.int64()), "n_bytes": [n_bytes],
                         "part": pa.array([part], pa.int32()), "text": [text[at:end]],
                         "left": pa.array([left - at], pa.int32()), "right": pa.array([right - at], pa.int32())})

    def count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp, _ = processor(model)
        for batch in batches:
            n = [count_between(sp, *(batch.column(c)[i].as_py() for c in ("text", "left", "right"))) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("row", *keys)), pa.array(n, pa.int64())], ["row", *keys, "n_tokens"])

    sized = docs.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text")
    short = sized.where(~is_long).mapInArrow(count_rows, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    rows = sized.where(is_long).withColumn("row", F.monotonically_increasing_id())
    parts = rows.mapInArrow(cut, "row bigint, doc_id bigint, n_bytes bigint, part int, text string, left int, right int")
    counted = parts.repartition("row", "part").mapInArrow(count_chunks, "row bigint, doc_id bigint, n_bytes bigint, n_tokens bigint")
    whole = counted.groupBy("row", *keys).agg(F.sum("n_tokens").alias("n_tokens"))
    return short.unionByName(whole.drop("row")).withColumn("over_limit", F.col("n_tokens") > limit)
