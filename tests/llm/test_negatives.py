"""Hard negatives against all products."""

import math
import random

import pytest

from depscope.llm import negatives


def plain(rows, turn=7, every=100, n_pos=5, n_neg=10):
    own = []
    for i, (v, label, e) in enumerate(rows):
        if label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        own.append((i, v, (label + 1) % 10 if v is not None and v % turn == 0 else label, [math.floor(256 * x) for x in e]))
    out = []
    for i, v, label, q in own:
        if v is None or v % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(q, q2)), v2 is None, v2 or 0, j, l2) for j, v2, l2, q2 in own if j != i))
        positives = [s for s in scored if s[4] == label][:n_pos]
        for p in positives:
            fit = [s for s in scored if s[4] != label and 30 * -p[0] <= 100 * -s[0] <= 90 * -p[0]][:n_neg]
            out += [(v, None if p[1] else p[2], k + 1, None if s[1] else s[2], -p[0], -s[0]) for k, s in enumerate(fit)]
    return sorted(out, key=repr)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
KIND = "vec_id long, label int, embedding array<float>"


def found(df, **settings):
    return sorted((tuple(r) for r in negatives.mine(df, turn_every=7, **settings).select(COLUMNS).collect()), key=repr)


def clustered(n, width, rng, scale=1.0):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(12)]
    rows = []
    for k in range(n):
        c = centres[k % 12]
        v = [x + rng.gauss(0, 0.6) for x in c]
        norm = math.sqrt(sum(x * x for x in v)) / scale
        rows.append((k, rng.randrange(10), [float(f"{x / norm:.6f}") for x in v]))
    return rows


def as_floats(rows):
    import numpy as np
    return [(v, label, e if e is None else [None if x is None else float(np.float32(x)) for x in e]) for v, label, e in rows]


@pytest.mark.parametrize("width,blocks", [(64, {}), (64, {"block_rows": 150, "block_anchors": 3}), (13, {"block_rows": 400}), (3, {})])
def test_equals_all_products(llm, width, blocks):
    rows = as_floats(clustered(900, width, random.Random(width)))
    want = plain(rows)
    assert len(want) > 50
    assert found(llm.createDataFrame(rows, KIND).repartition(4), **blocks) == want


def test_hard_rows(llm):
    rng = random.Random(3)
    rows = clustered(420, 8, rng)
    copy = rows[100]
    rows += [(100, *copy[1:])] * 3 + [(700, 3, [0.0] * 8), (None, 1, rows[0][2]), (801, None, rows[1][2]), (802, 1, None), (803, 2, [float("nan")] * 8),
                                      (804, 2, [float("inf")] + [0.1] * 7), (805, 2, [None] + [0.1] * 7), (900, 2, [-x for x in rows[5][2]]),
                                      (1000, 4, rows[7][2][:5]), (1001, 4, [])]
    rows += [(2000 + k, 6, rows[0][2]) for k in range(200)]  # ties
    rows = as_floats(rows)
    df = llm.createDataFrame(rows, KIND)
    want = plain(rows)
    assert found(df, block_rows=64, block_anchors=2) == want
    from pyspark.sql import functions as F
    wide = df.withColumn("row", F.lit("x")).withColumn("window", F.lit(1)).withColumn("q", F.lit(2)).withColumn("score", F.lit(2)).withColumn("block", F.lit(9))
    assert found(wide) == want
    assert found(df.limit(0)) == []


def test_large_components(llm):
    """Products beyond 2^53 are summed as integers; components are cut at +-2^26."""
    rng = random.Random(9)
    rows = as_floats([(k, rng.randrange(3), [rng.uniform(-2e5, 2e5) for _ in range(16)]) for k in range(300)])
    assert found(llm.createDataFrame(rows, KIND)) == plain(rows)
    huge = as_floats([(k, k % 2, [3e38 if k % 3 else -1.0, 1.0]) for k in range(0, 300, 50)])
    cut = [(v, label, [min(x, 2.0 ** 18) for x in e]) for v, label, e in huge]
    assert found(llm.createDataFrame(huge, KIND)) == plain(cut)


def test_bounds_drop_work(monkeypatch):
    """The index omits dimensions and rows, and most pairs are dropped before their whole product."""
    import numpy as np
    rng = np.random.default_rng(0)
    rows = np.floor(rng.normal(size=(3000, 64)) * np.exp(-np.arange(64) / 6) * 100)
    index = negatives._Index(rows, rows[:10])
    low = np.full(10, 0.8 * (rows[:10] ** 2).sum(axis=1).min())
    whole = sum(len(r) for _, r, _ in index.candidates(np.arange(10), low, np.full(10, 1e18)))
    true = int(((rows[:10] @ rows.T) >= low[:, None]).sum())
    assert true <= whole < 3 * true + 100
    listed = (index.row_rest[:, :-1] * index.anchor_rest[:10, :-1].max(axis=0) >= low.min()).sum(axis=1)
    assert (listed < index.groups).mean() > 0.9
