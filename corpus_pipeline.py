"""From raw documents to token ids: quality, lines, near-duplicates, benchmark leaks, encoding.

Each stage works on all that the one before kept. All but the last return the columns of
``documents``; ``n_chars`` follows the text where lines are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from depscope.llm import bpe, decontaminate, jaccard, lines, quality
from depscope.llm.common import importable, quoted, table
from depscope.session import configure, store

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
#: Rows come to Python in batches of about so many bytes, or one longer row: workers of several
#: stages, and the executor's own buffers, share an executor's memory.
BATCH_BYTES = 2 << 20


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their group's fences."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the boilerplate lines of their source."""
    found = lines.drop_boilerplate(docs)
    dropped = quoted(found.columns[-1]) > 0
    length = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return found.select(*(F.when(dropped, length).otherwise(quoted(c)).alias(c) if c == "n_chars" else quoted(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Two texts are linked if their sets of 5-word shingles have a Jaccard similarity of 0.8 or
    more. SimHash fingerprints find most links, and a prefix filter those that they miss; all are
    verified on the sets. The query op5_simhash_groups has a rule of its own.
    """
    return jaccard.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, and the counts and digests of the round trip.

    The ids are stored before they are decoded, so that a task has one Python worker at a time.
    """
    ranks = bpe.load_ranks(public_tokenizers.path(RANK_FILE))
    encoded = store(bpe.encode(docs, ranks, public_tokenizers.PATTERN), "encoded")
    decoded = bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    return bpe.digests(decoded, "ids")


def _ready(stage):
    """The session's settings hold, and workers find the package, whoever calls a stage."""
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        configure(spark).conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        return stage(importable(spark), docs, sf_dir)
    return run_stage


STAGES = [
    ("quality rules", _ready(quality_rules)),
    ("line dedup", _ready(line_dedup)),
    ("SimHash near-dedup", _ready(near_dedup)),
    ("benchmark decontamination", _ready(benchmark_decontamination)),
    ("byte-level BPE", _ready(bpe_encoding)),
]

#: SQL has neither the fingerprints nor the encoding; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), f"stage_{k}")
    return docs
