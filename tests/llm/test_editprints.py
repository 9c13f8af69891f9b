"""Edit fingerprints: the law of successors, likeness against edit distance, classes against all pairs."""

import hashlib
import random

import pytest

from depscope.llm import editprints


def plain(rows):
    """Rows sorted as contracted: by descending id; ties only in tests where they are alike."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (d, t) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 3
        changed = t[:len(t) - cut] + following[:cut]
        own, other, behind = (editprints.fingerprint(x) for x in (t, changed, following))
        out.append((d, len(t), hashlib.sha256(changed.encode()).hexdigest(), own.hex(), other.hex(), editprints.likeness(own, other), editprints.likeness(own, behind)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def found(df, **settings):
    got = editprints.edit_fingerprints(df, **settings).collect()
    return sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr), {r.doc_id: r.class_id for r in got}


def test_real_rows(llm, real_docs):
    rows = [r[:2] for r in real_docs]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, _ = found(df)
    assert got == plain(rows)
    near = [r[5] for r in got if r[1] > 300]
    assert sum(near) / len(near) > 0.6 and sum(r[6] for r in got) / len(got) < 0.2


def test_order_in_many_ranges(llm):
    llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(k * 3, f"text number {k} " * (k % 5)) for k in range(40)] + [(None, "none")]
        assert found(llm.createDataFrame(rows, "doc_id long, text string").repartition(4))[0] == plain(rows)
        few = rows[:2]
        assert found(llm.createDataFrame(few, "doc_id long, text string"))[0] == plain(few)
    finally:
        llm.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_messy_rows(llm, messy):
    rows, first, wide = messy
    for df in (first, wide):
        got, _ = found(df)
        assert len(got) == len(rows)
        assert sorted(r[3] for r in got) == sorted(editprints.fingerprint(t).hex() for _, t, *_ in rows)
        assert sorted(r[1] for r in got) == sorted(len(t or "") for _, t, *_ in rows)
    assert found(first.limit(0))[0] == []
    one = llm.createDataFrame([(1, "alone in the table")], "doc_id long, text string")
    assert found(one)[0] == plain([(1, "alone in the table")])


def test_hot_id(llm):
    rows = [(7, "the same text")] * 300 + [(8, "before"), (6, "after it")]
    assert found(llm.createDataFrame(rows, "doc_id long, text string").repartition(6))[0] == plain(rows)


@pytest.mark.parametrize("n", [400, 6000])
def test_likeness_follows_edits(n):
    rng = random.Random(n)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(2, 9))) for _ in range(600)]
    text = " ".join(rng.choice(words) for _ in range(n // 5))
    own, kept = editprints.fingerprint(text), []
    for edits in (0, 2, n // 20, n // 4):
        chars = list(text)
        for _ in range(edits):
            at = rng.randrange(len(chars))
            chars[at:at + 1] = rng.choice([[], [chars[at], "x"], ["y"]])
        kept.append(editprints.likeness(own, editprints.fingerprint("".join(chars))))
    assert kept[0] == 1 and kept[1] > 0.6 and kept == sorted(kept, reverse=True) and kept[-1] < 0.5
    other = " ".join(rng.choice(words) for _ in range(n // 5))
    assert editprints.likeness(own, editprints.fingerprint(other)) < 0.25


def test_texts_walk_alike_alone_and_together(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdé 中😀") for _ in range(rng.randrange(0, 5000) if k % 9 else k)) for k in range(90)]
    alone = [editprints.fingerprint(t) for t in texts]
    for together in (1, 7, 64, 500):
        monkeypatch.setattr(editprints, "TOGETHER", together)
        rows = editprints.walked(texts)
        assert [r.print for r in rows] == alone
        after = rows[1:] + rows[:1]
        changed = editprints.edited(rows, after)
        assert [c.text for c in changed] == [t[:len(t) - len(t) // 3] + f.text[:len(t) // 3] for t, f in zip(texts, after)]
        assert [c.print for c in changed] == [editprints.fingerprint(c.text) for c in changed]


def near_classes(rows):
    prints = {d: editprints.fingerprint(t) for d, t in rows}
    parent = {d: d for d in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    width = editprints.BAND
    for d in prints:
        for e in prints:
            a, b = prints[d], prints[e]
            banded = any(a[k:k + width] == b[k:k + width] for k in range(0, len(a) - width + 1, width))
            if banded and editprints.likeness(a, b) * 100 >= editprints.NEAR_PERCENT:
                x, y = root(d), root(e)
                parent[max(x, y)] = min(x, y)
    return {d: root(d) for d in prints}


@pytest.mark.parametrize("limit", [editprints.GROUP_LIMIT, 7])
def test_classes_equal_all_pairs(llm, limit):
    rng = random.Random(1)
    rows = []
    for base in range(8):
        text = " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(60))
        for copy in range(12):
            chars = list(text)
            for _ in range(rng.randrange(4) * (copy > 2)):
                chars[rng.randrange(len(chars))] = "z"
            rows.append((len(rows) + 5, "".join(chars)))
    rows += [(900, ""), (901, None), (902, "x")]
    want = near_classes(rows)
    assert 8 < len(set(want.values())) < 60
    assert found(llm.createDataFrame(rows, "doc_id long, text string").repartition(3), group_limit=limit)[1] == want


def test_long_text():
    text = "".join(random.Random(4).choice("abcd efgh") for _ in range(400_000))
    assert len(editprints.fingerprint(text)) == editprints.WALKS * editprints.BYTES
    assert editprints.likeness(editprints.fingerprint(text), editprints.fingerprint(text[:-1000] + "q" * 1000)) > 0.9
