import public_tokenizers
import pytest

from brute import sha
from depscope.llm import bpe, counts
from depscope.llm.queries import BPE_FILE, PIECE_FILE

PATTERN = public_tokenizers.PATTERN
HARD = [
    (1, None), (None, ""), (7, "x" * 5000), (8, " " * 3000 + "a"), (9, "it's we'll " * 300), (10, "中文字。" * 900), (11, "don't\n\n\n  z" * 200),
    (12, "a1b2c3" * 500), (13, "don'" + "t" * 700), (14, "   \t" * 400), (15, "é" * 301), (11, "don't\n\n\n  z" * 200), (16, "'s" * 900),
]


@pytest.fixture(scope="module")
def frame(llm, real_docs):
    rows = [(d, t) for d, t, *_ in real_docs[:60]] + HARD
    return rows, llm.createDataFrame(rows, "doc_id long, text string")


def by_key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, *map(str, r)))


@pytest.mark.parametrize("chunk, overlap", [(300, 60), (64, 40), (65_536, 2_048)])
def test_codec_equals_library(frame, chunk, overlap):
    rows, df = frame
    ranks = bpe.load_ranks(public_tokenizers.path(BPE_FILE))
    enc = bpe.encoding(ranks, PATTERN)
    got = [tuple(r) for r in bpe.digests(bpe.decode(bpe.encode(df, ranks, PATTERN, chunk, overlap), ranks, PATTERN)).collect()]
    want = [(d, len(ids := enc.encode_ordinary(t or "")), sha(",".join(map(str, ids)).encode()), sha((t or "").encode())) for d, t in rows]
    assert by_key(got) == by_key(want)


def test_one_huge_pretoken(llm):
    text = "q" * 20_000 + " end"
    df = llm.createDataFrame([(1, text)], "doc_id long, text string")
    ranks = bpe.load_ranks(public_tokenizers.path(BPE_FILE))
    ids = bpe.encode(df, ranks, PATTERN, 1000, 100).first().ids
    assert ids == bpe.encoding(ranks, PATTERN).encode_ordinary(text)


@pytest.mark.parametrize("chunk, overlap", [(300, 4), (300, 60), (65_536, 256)])
def test_counts_equal_library(frame, chunk, overlap):
    rows, df = frame
    model = counts.load_model(public_tokenizers.path(PIECE_FILE))
    sp, _ = counts.processor(model)
    got = [tuple(r) for r in counts.token_counts(df, model, chunk, overlap).collect()]
    want = [(d, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for d, t in rows]
    assert by_key(got) == by_key(want)


def test_overlap_is_widened():
    _, inside = counts.processor(counts.load_model(public_tokenizers.path(PIECE_FILE)))
    text = "abc " * 5 + "er" * 300 + " tail " * 40
    plan = list(counts.plan_chunks(text, 50, 4, inside))
    assert plan[0][1] > 54 and plan[0][2] == 0 and plan[-1][3] == len(text)
    assert all(a[3] == b[2] for a, b in zip(plan, plan[1:]))


def test_messy(messy):
    rows, plain, wide = messy
    ranks = bpe.load_ranks(public_tokenizers.path(BPE_FILE))
    model = counts.load_model(public_tokenizers.path(PIECE_FILE))
    for op in (lambda d: bpe.digests(bpe.decode(bpe.encode(d, ranks, PATTERN), ranks, PATTERN)), lambda d: counts.token_counts(d, model)):
        a, b = (by_key(map(tuple, op(d).collect())) for d in (plain, wide))
        assert a == b and len(a) == len(rows)
        assert op(plain.limit(0)).count() == 0
