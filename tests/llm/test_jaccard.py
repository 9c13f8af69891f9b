"""The near-duplicate stage against the Jaccard similarity of all pairs."""

import random

import numpy as np

import brute
import corpus_pipeline
from conftest import SF
from depscope.llm import jaccard
from depscope.session import store


def shingle_set(text):
    words = brute.WORD.findall(brute.re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def kept_ids(rows):
    """The smallest id of each component, by all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] == sets[b] or both * 18 >= 8 * (len(sets[a]) + len(sets[b])):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    groups = {}
    for k, (d, _) in enumerate(rows):
        groups.setdefault(root(k), []).append(d)
    return sorted(min(ids) for ids in groups.values())


def near_rows():
    """Copies with edits that leave similarities on both sides of 0.8, and a common passage."""
    rng = random.Random(11)
    rows, passage = [], " ".join(f"common{k}" for k in range(25))
    for base in range(12):
        words = [f"w{rng.randrange(4000)}" for _ in range(120)]
        for _ in range(14):
            copy = list(words)
            for at in rng.sample(range(120), rng.randrange(6)):
                copy[at] = f"n{rng.randrange(9000)}"
            rows.append((len(rows), " ".join(copy) + (" " + passage if rng.random() < 0.5 else "")))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE\ttwo"), (905, "one two three"), (906, passage), (907, passage)]
    return rows


def test_stage_finds_all_pairs(llm):
    rows = near_rows()
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(r.doc_id for r in corpus_pipeline.near_dedup(llm, df, SF).collect())
    assert got == kept_ids(rows)
    assert 12 < len(got) < len(rows) - 50


def test_order_and_broadcasts_change_nothing(llm, monkeypatch):
    rows = near_rows()
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name, value in (("SAMPLE", 1), ("SAMPLE_SEEN", 2), ("SAMPLE_KEPT", 40), ("BROADCAST_ROWS", 0)):
        monkeypatch.setattr(jaccard, name, value)
    assert sorted(r.doc_id for r in jaccard.drop_near_duplicates(df).collect()) == kept_ids(rows)


def test_hot_shingles_are_dealt(llm, monkeypatch):
    """All texts share all shingles but a few, so that the sample's order cannot avoid frequent ones."""
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(150):
        copy = list(words)
        for at in rng.sample(range(60), rng.randrange(4)):
            copy[at] = f"n{k % 11}"
        rows.append((k, " ".join(copy)))
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for name, value in (("SAMPLE", 1), ("SAMPLE_SEEN", 2), ("HOT_ROWS", 7)):
        monkeypatch.setattr(jaccard, name, value)
    assert sorted(r.doc_id for r in jaccard.drop_near_duplicates(df).collect()) == kept_ids(rows)


def test_fingerprints_link_close_texts(llm):
    """Of copies with few edits most meet by their fingerprints; what these link is not compared again."""
    rng = random.Random(5)
    rows = [(0, ""), (1, "far from all others, and alone")]
    for base in range(5):
        words = [f"v{rng.randrange(4000)}" for _ in range(400)]
        rows += [(10 + 10 * base + k, " ".join(words[:40 * k] + [f"n{k}"] + words[40 * k + 1:])) for k in range(8)]
    keyed = store(llm.createDataFrame([(d, d, t) for d, t in rows], "row long, doc_id long, text string").repartition(3), "keyed")
    none = np.zeros(0, np.uint64)
    prints = store(jaccard._marked(keyed, none, none.view(np.int64)).where("n > 0").selectExpr("row as node", "fp"), "prints")
    links = jaccard._by_fingerprint(prints, keyed)
    pairs = {(r.u, r.v) for r in links.collect()}
    assert len(pairs) > 20 and all(u > v > 1 and u // 10 == v // 10 for u, v in pairs)
    some = max(pairs)
    asked = llm.createDataFrame([some, some[::-1], (20, 10), (1, 0)], "u long, v long")
    assert {(r.u, r.v) for r in jaccard._apart(asked, links).collect()} == {(20, 10), (1, 0)}


def test_fingerprint_of_a_set():
    from depscope.llm import simhash
    text = b"one two three four five six"
    own = jaccard.shingles(text)
    bits = [2 * sum(int(h) >> k & 1 for h in own) > len(own) for k in range(64)]
    assert simhash.majority(own) == sum(1 << k for k, b in enumerate(bits) if b)
    assert simhash.majority(own[:0]) == 0 and simhash.majority(own[:1]) == int(own[0])


def test_pivots_in_any_batches():
    rng = np.random.default_rng(0)
    rows = np.column_stack([np.sort(rng.integers(0, 40, 200)), np.full(200, -1), np.arange(200), np.arange(200) * 7])
    first = {h: k for k, h in reversed(list(enumerate(rows[:, 0].tolist())))}
    size = np.bincount(rows[:, 0])
    want = [(h, -1, n, p, first[h], first[h] * 7) for h, _, n, p in rows.tolist() if size[h] > 1]
    for step in (1, 2, 3, 50, 200):
        got, carried, pivot = [], rows[:0], None
        for at in range(0, 200, step):
            part = np.concatenate([carried, rows[at:at + step]])
            out, pivot = jaccard._next_to_pivots(part, pivot, last=False)
            carried = part[-1:]
            got += zip(*(c.to_pylist() for c in out.columns))
        got += zip(*(c.to_pylist() for c in jaccard._next_to_pivots(carried, pivot, last=True)[0].columns))
        assert got == want, step


def test_block_edges_of_long_texts(monkeypatch):
    from depscope.llm import simhash
    text = " ".join(f"w{k % 57}" for k in range(900)).encode()
    whole = jaccard.shingles(text)
    monkeypatch.setattr(simhash, "_BLOCK_BYTES", 100)
    assert len(whole) == 57 and (jaccard.shingles(text) == whole).all()


def test_edited_copies_are_not_compared_all_with_all(llm, monkeypatch):
    """Copies with one edit are linked to the original only, those with two to nothing; all share most shingles."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(60)]
    rows, n = [], 240
    for k in range(n):
        copy = list(words)
        for at in rng.sample(range(5, 55, 5), 1 + k % 2):
            copy[at] = f"n{k}at{at}"
        rows.append((k, " ".join(copy)))
    rows.append((n, " ".join(words)))
    compared, verified = [], jaccard._verified

    def counted(pairs, *rest):
        compared.append(pairs.count())
        return verified(pairs, *rest)
    for name, value in (("SAMPLE", 1), ("SAMPLE_SEEN", 5), ("_verified", counted)):
        monkeypatch.setattr(jaccard, name, value)
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(r.doc_id for r in jaccard.drop_near_duplicates(df).collect()) == kept_ids(rows)
    assert compared[-1] < 4 * n  # the rest, which was nearly all pairs


def test_pairs_across_components_miss_none(llm, monkeypatch):
    """All sets are components of their own; sizes differ, so that similar ones are of several classes."""
    rng = random.Random(4)
    sets = []
    for family in range(6):
        base = [rng.randrange(1 << 40) for _ in range(60)]
        sets += [sorted(set(rng.sample(base, rng.randrange(40, 61)) + [rng.randrange(1 << 40) for _ in range(rng.randrange(5))])) for _ in range(60)]
    near = {(a, b) for a in range(len(sets)) for b in range(a) if len(set(sets[a]) & set(sets[b])) * 18 >= 8 * (len(sets[a]) + len(sets[b]))}
    none = np.zeros(0, np.uint64)
    rows = [(int(h), k, len(s), p, k) for k, s in enumerate(sets) for p, h in enumerate(jaccard.prefix(np.array(s, np.uint64), none, none))]
    size, most = {}, {}
    for h, k, *_ in rows:
        size[h], most[h] = size.get(h, 0) + 1, k
    split = llm.createDataFrame([(*r, size[r[0]], most[r[0]]) for r in rows], "h long, node long, n int, pos int, root long, size long, most long")
    for limit in (0, 20, 10**6):
        monkeypatch.setattr(jaccard, "DIRECT_ROWS", limit)
        pairs = {(r.u, r.v) for r in jaccard._across(split).collect()}
        assert len(near) > 1000 and near <= pairs, limit
