import random

import numpy as np
import pytest

import brute
from depscope.llm import components, lines, simhash, suffixes


def test_simhash_against_all_pairs(llm, real_docs):
    rows = [(d, t) for d, t, *_ in real_docs] + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "one two"), (905, "Ünë TWO three Four five")]
    fps, group = brute.near_groups(rows)
    least = {g: min(d for (d, _), h in zip(rows, group) if h == g) for g in group}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: (f"{f:016x}", least[g]) for (d, _), f, g in zip(rows, fps, group)}


@pytest.mark.parametrize("limit", [5, 40, 200_000])
def test_trie_links(llm, limit):
    """Clouds of close fingerprints, so that first blocks are shared by many and groups split."""
    rng = random.Random(3)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            v = centre
            for b in rng.sample(range(64), rng.randrange(6)):
                v ^= 1 << b
            values.add(v)
    values = sorted(values)
    df = llm.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    links = [(a % (1 << 64), b % (1 << 64)) for a, b in simhash.links(df, group_limit=limit).collect()]
    assert all((a ^ b).bit_count() <= 64 for a, b in links)

    def classes(pairs):
        parent = {v: v for v in values}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in pairs:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
        return {v: root(v) for v in values}
    assert classes(links) == classes((a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 4)


def test_components(llm):
    chain = [(k, k + 1) for k in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 250), (250, 225)]
    got = {tuple(r) for r in components.components(llm.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {(k, 0) for k in range(1, 41)} | {(101, 100), (250, 200), (225, 200)}
    assert components.components(llm.createDataFrame([], "u long, v long")).count() == 0


def test_one_row_of_each_group(messy):
    rows, plain, wide = messy
    kept = simhash.drop_near_duplicates(wide)
    assert kept.columns == wide.columns
    _, group = brute.near_groups([(d, t) for d, t, *_ in rows])
    got = [r.doc_id for r in kept.collect()]
    assert len(got) == len(set(group))
    ids = {g: [d for (d, *_), h in zip(rows, group) if h == g and d is not None] for g in group}
    assert sorted(d for d in got if d is not None) == sorted(min(x) for x in ids.values() if x)
    assert simhash.drop_near_duplicates(plain.limit(0)).count() == 0
    assert simhash.near_duplicates(plain).count() == len(rows)


def test_block_edges_of_long_texts(monkeypatch):
    text = " ".join(f"w{k % 57}" for k in range(900)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_BLOCK_BYTES", 100)
    assert simhash.fingerprint(text) == whole == brute.fingerprint(text.decode())


def suffix_rows(df, length, lead, limit):
    found = suffixes.digests(suffixes.remove_repeats(df, length, lead, limit)).collect()
    return sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)


def test_suffixes_on_documents(llm, real_docs):
    rows = [(d, t) for d, t, *_ in real_docs[:120]]
    assert suffix_rows(llm.createDataFrame(rows, "doc_id long, text string"), 100, 32, 2000) == brute.repeats(rows, 100)


@pytest.mark.parametrize("limit", [1, 2000])
def test_suffixes_on_hard_cases(llm, limit, monkeypatch):
    rng = random.Random(1)
    rows = [(k, "".join(rng.choice("ab") for _ in range(rng.choice([0, 5, 30, 90, 200])))) for k in range(60)]
    base = "".join(rng.choice("abcdefgh ") for _ in range(300))
    for k in range(60, 120):
        a = rng.randrange(200)
        rows.append((k, f"x{k}é" + base[a:a + rng.randrange(20, 100)] + f"y{k}"))
    rows += [(3, None), (None, "q" * 100), (None, base), (7, base), (7, base), (7, base[50:] + "zz"), (200, "z" * 500), (201, "z" * 300), (202, "")]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert suffix_rows(df, 20, 8, limit) == brute.repeats(rows, 20)


def test_suffixes_spread_over_ranges(llm):
    """One text in most rows: its anchors fill several ranges each."""
    base = "".join(random.Random(2).choice("abcdefgh ") for _ in range(40))
    rows = [(k, base) for k in range(300)] + [(k, base[3:] + str(k)) for k in range(300, 330)]
    assert suffix_rows(llm.createDataFrame(rows, "doc_id long, text string"), 30, 10, 5) == brute.repeats(rows, 30)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_suffixes_of_repeated_ids_at_range_boundaries(llm, seed):
    """Ranges stay apart, so that rows of one id with one beginning stand first in a range."""
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdefgh ") for _ in range(22))  # three windows: each is an end of what goes, but one
    rows = [(k, base + "".join(rng.choice("ijklmnop") for _ in range(40))) for k in range(60) for _ in range(3)]
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = suffix_rows(llm.createDataFrame(rows, "doc_id long, text string"), 20, 8, 1)
    finally:
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute.repeats(rows, 20)


def test_long_texts_in_stretches(monkeypatch):
    rng = np.random.default_rng(4)
    text = bytes(rng.integers(97, 123, 3000, dtype=np.uint8))

    def windows():
        return sorted((int(a) + j, int(p)) for _, at, n, lead, _ in suffixes.find_blocks([text]) for a, c, p in zip(at, n, lead) for j in range(int(c)))
    whole = windows()
    monkeypatch.setattr(suffixes, "WORK", 250)
    assert windows() == whole and [w for w, _ in whole] == list(range(len(text) - 99))


def test_suffixes_messy(messy):
    rows, plain, wide = messy
    want = brute.repeats([(d, t) for d, t, *_ in rows], 100)
    assert suffix_rows(plain, 100, 32, 2000) == want == suffix_rows(wide, 100, 32, 2000)
    assert suffixes.remove_repeats(plain.limit(0)).count() == 0


def test_lines(llm, real_docs):
    rows = [(d, t, s) for d, t, _, s in real_docs] + [(900 + k, "  menu home\t\n\nreal " + str(k) + "\r", "hot") for k in range(9)] + [(999, None, "hot"), (998, "x", None)]
    bad = brute.boilerplate([(t, s) for _, t, s in rows], 100, 5)
    assert ("hot", "menu home") in bad
    df = lines.drop_boilerplate(llm.createDataFrame(rows, "doc_id long, text string, source string"))
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in df.collect()}
    for d, t, s in rows:
        want = brute.without(t, s, bad)
        n = 0 if t is None else t.count("\n") + 1
        dropped = sum((s, x.strip(brute.BLANKS)) in bad for x in (t or "").split("\n"))
        assert got[d] == (want, n, dropped)


def test_lines_messy(messy):
    rows, plain, wide = messy
    found = lines.drop_boilerplate(wide, min_pages=1)
    assert found.columns == [*wide.columns, "n_lines_", "n_dropped_"]
    assert found.count() == len(rows)
    assert lines.drop_boilerplate(plain.limit(0)).count() == 0
    shuffled = sorted(map(str, lines.drop_boilerplate(plain, min_pages=1).select("doc_id", "text").collect()))
    assert shuffled == sorted(map(str, found.select("doc_id", "text").collect()))
