import pathlib
import random
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    from depscope.llm.common import importable
    from depscope.session import configure
    return importable(configure(spark))


@pytest.fixture(scope="session")
def real_docs(llm):
    return [(r.doc_id, r.text, r.lang, r.source) for r in llm.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def messy(llm):
    """Rows with nulls, blanks, repeats, ties and a long text; and the same with clashing columns."""
    rng = random.Random(5)
    words = ["alpha", "beta,", "Gamma", "delté", "中文", "x1", "don't", "#tag"]
    long_text = "\n".join(" ".join(rng.choice(words) + str(rng.randrange(90)) for _ in range(12)) for _ in range(400))
    rows = [
        (1, "Once upon a time there was a small house in the wood.\nNobody lived there.", "en", "a"),
        (1, "Once upon a time there was a small house in the wood.\nNobody lived there.", "en", "a"),
        (1, "another text under the same id with a few more words in it than ten", "en", "b"),
        (2, None, "en", "a"), (3, "", None, None), (4, "  \n\t \n ", "de", "a"), (None, "no id at all but some words here and there to read", "en", None),
        (None, None, None, None), (5, long_text, "en", "b"), (6, long_text + " end", "en", "b"), (7, "\n".join(["same line"] * 6), "en", "b"),
    ]
    plain = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    names = ["row", "hashes", "words", "lines", "carry", "doc", "tag", "data", "host", "pages", "fp", "root", "k", "part", "piece", "seed", "at",
             "item", "group", "shard", "slot", "kept", "n_lines", "n_dropped", "list_host", "list_lines", "ids", "n_tokens", "text_key", "bad_id",
             "bad_key", "turn_", "a.b", "we`ird", "Row", "size", "range"]
    from pyspark.sql import functions as F
    taken, wide = set(plain.columns), plain
    for n in names:
        if n.lower() not in {c.lower() for c in taken}:
            taken.add(n)
            wide = wide.withColumn(n, F.lit("clash"))
    return rows, plain, wide
