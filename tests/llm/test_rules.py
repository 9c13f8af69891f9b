import itertools
import random
from collections import Counter, defaultdict

import brute
from depscope.llm import decontaminate, lines, quality, shards


def test_base_counts(llm, real_docs, messy):
    rows = [*real_docs, *[(5000 + k, *r[1:]) for k, r in enumerate(messy[0])]]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in quality.assess(docs, [docs.doc_id]).collect()}
    assert len(found) == len(rows)
    for d, text, *_ in rows:
        want = brute.base_counts(text)
        assert tuple(found[d][c] for c in quality.BASE) == want
        assert found[d].base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (found[d].base_failed and found[d].kept)


def test_fences_follow_the_group(llm):
    """Symbols are normal in one source and reject in another; a small source follows its language."""
    def text(k, symbols):
        return " ".join(f"word{chr(97 + (k * 7 + j) % 26)}{j}" + "#" * symbols for j in range(20))
    rows = [(k, text(k, 1 if k % 2 else 2), "en", "code") for k in range(120)] + [(200 + k, text(k, 0), "en", "news") for k in range(150)]
    rows += [(400, text(1, 1), "en", "news"), (401, text(1, 0), "en", "small"), (402, text(2, 30), "en", "code"), (403, text(2, 0), None, None)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.keep_good(docs).collect()}
    assert {0, 1, 200, 201, 401, 403} <= kept and not {400, 402} & kept
    assert quality.keep_good(docs).columns == docs.columns


def test_sketches_merge_in_any_order(llm):
    rows = [(k, "w " * 3 + "x" * (k % 13) + " a b c d e f g h i j", "en" if k % 3 else "de", f"s{k % 5}") for k in range(300)]
    docs = llm.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    seen = [sorted(map(str, quality.fences(quality.sketches(quality.measure(docs.repartition(n), [docs.doc_id]))).collect())) for n in (1, 7)]
    assert seen[0] == seen[1]


def test_buckets(llm):
    values = [0, 1, 1023, 1024, 1025, 2047, 2048, 10**6, 2**40 + 12345]
    got = [r.b for r in llm.createDataFrame([(v,) for v in values], "v long").select(quality.bucket(quality.F.col("v")).alias("b")).collect()]
    assert got[:4] == values[:4] and all(b <= v and (v - b) * 512 <= v for b, v in zip(got, values))


def test_quality_messy(messy):
    rows, plain, wide = messy
    assert sorted(map(str, quality.keep_good(wide).select("doc_id", "text").collect())) == sorted(
        map(str, quality.keep_good(plain).select("doc_id", "text").collect()))
    assert quality.keep_good(wide).columns == wide.columns
    assert quality.keep_good(plain.limit(0)).count() == 0


def test_masks_miss_nothing():
    """Each mask fits between any two substitutions in a run of 13 words."""
    for mask in decontaminate.MASKS:
        on = [k for k, c in enumerate(mask) if c == "1"]
        for bad in itertools.combinations(range(13), 2):
            assert any(all(a + k not in bad for k in on) for a in range(13 - len(mask) + 1))
    for n in range(decontaminate.MIN_WORDS, 13):  # short items, with as many substitutions as they may have
        for bad in itertools.combinations(range(n), n * 20 // 100):
            assert any(all(a + k not in bad for k, c in enumerate(m) if c == "1")
                       for m in decontaminate.SHORT_MASKS for a in range(n - len(m) + 1))


def test_leaks(llm):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(300)] + ["the", "of", "and"] * 30
    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(words([4, 5, 8, 9, 12, 14, 40, 2, 3, 1][k % 10]))) for k in range(30)] + [(30, None), (31, ""), (None, " ".join(words(20)))]
    items.append((99, items[3][1]))
    docs = []
    for k in range(80):
        body = words(60)
        passage = (items[k % 30][1] or "").split()
        for at in rng.sample(range(len(passage)), min(len(passage), k // 7 % 5)):
            passage[at] = "changed"
        if k % 3:
            body[20:20] = [w.upper() + "," for w in passage]
        docs.append((k, " ".join(body)))
    docs += [(500, None), (501, ""), (None, docs[1][1]), (1, docs[1][1]), (502, items[3][1])]
    found = decontaminate.contaminated(llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.matched_words for r in found.collect()}
    want = brute.leaks(docs, items)
    assert got == want and {len(brute.tokens(dict(items)[k])) for _, k in want} >= {1, 2, 3, 4, 5, 8, 9, 12, 14, 40}
    assert found.count() == len(got)


def test_phrases_of_a_very_long_text(llm):
    docs = [(1, "Filler words. " * 60_000 + "the End, my friend " + "and more " * 60_000), (2, "the end my only friend"), (3, "the")]
    items = [(1, "The end, my friend!"), (2, "the"), (3, "of"), (4, "and more and")]
    found = decontaminate.contaminated(llm.createDataFrame(docs, "doc_id long, text string"), llm.createDataFrame(items, "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id, r.matched_words) for r in found.collect()) == [(1, 1, 4), (1, 2, 1), (1, 4, 3), (2, 2, 1), (3, 2, 1)]


def test_lines_of_small_hosts(llm):
    rows = [(k, f"own {k}\nsame line", "a") for k in range(4)] + [(9, "same line\nother", "b")]
    docs = llm.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r.doc_id: r.text for r in lines.drop_boilerplate(docs).collect()} == {**{k: f"own {k}" for k in range(4)}, 9: "same line\nother"}


def test_leaks_by_shuffled_joins(llm, monkeypatch, real_docs):
    benchmark = llm.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    docs = llm.createDataFrame(real_docs, "doc_id long, text string, lang string, source string")
    usual = sorted(map(str, decontaminate.contaminated(docs, benchmark).collect()))
    for limit in ("BROADCAST_SEEDS", "BROADCAST_ITEMS", "BROADCAST_KEYS"):
        monkeypatch.setattr(decontaminate, limit, 0)
    assert usual and sorted(map(str, decontaminate.contaminated(docs, benchmark).collect())) == usual


def test_leaks_messy(messy, llm):
    rows, plain, wide = messy
    items = llm.createDataFrame([(1, rows[2][1]), (None, None)], "item_id long, text string")
    assert [r.doc_id for r in decontaminate.contaminated(wide, items).collect()] == [1]
    left = decontaminate.drop_contaminated(wide, items)
    assert left.columns == wide.columns and left.count() == len(rows) - 1
    assert decontaminate.drop_contaminated(plain, items.limit(0)).count() == len(rows)
    assert decontaminate.contaminated(plain.limit(0), items).count() == 0


def check_shards(df, rows, n):
    found = df.collect()
    assert len(found) == len(rows)
    count = Counter(r.shard for r in found)
    assert all(0 <= s < n for s in count) and max(count.values()) - min(count.get(s, 0) for s in range(n)) <= 1
    slots = defaultdict(list)
    for r in found:
        slots[r.shard].append(r.slot)
        assert r.law == "rows" and r.grown_shard is None
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return found


def test_shards_keep_groups_together(llm):
    rng = random.Random(2)
    texts = [f"text {k}" for k in range(40) for _ in range(rng.randrange(1, 9))] + [f"alone {k}" for k in range(260)] + ["hot"] * 150
    rows = list(enumerate(texts))
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = check_shards(shards.shard_documents(docs, 8), rows, 8)
    of = defaultdict(Counter)
    for r in found:
        of[dict(rows)[r.doc_id]][r.shard] += 1
        assert r.size == len(dict(rows)[r.doc_id]) + 16
    size = len(rows) // 8
    assert len(of["hot"]) <= -(-150 // size) + 2
    split = sum(len(v) > 1 for t, v in of.items() if t != "hot")
    assert split <= 8  # a group at a quota's edge


def test_groups_that_fit_stay_whole(llm):
    """As many shards as large groups: halves could keep only half of the links."""
    rows = [(k, f"text {k % 4}") for k in range(360)] + [(k, f"alone {k}") for k in range(360, 400)]
    found = check_shards(shards.shard_documents(llm.createDataFrame(rows, "doc_id long, text string").repartition(4), 4), rows, 4)
    pairs, kept = 4 * 90 * 89 // 2, 0
    for n in Counter((dict(rows)[r.doc_id], r.shard) for r in found if r.doc_id < 360).values():
        kept += n * (n - 1) // 2
    assert kept * 10 >= pairs * 7


def test_shards_where_all_is_linked(llm):
    rows = [(k, f"pair {k // 2}") for k in range(200)]
    found = check_shards(shards.shard_documents(llm.createDataFrame(rows, "doc_id long, text string"), 4), rows, 4)
    where = {r.doc_id: r.shard for r in found}
    assert sum(where[k] != where[k + 1] for k in range(0, 200, 2)) <= 10


def test_shards_in_more_buckets(llm, monkeypatch):
    monkeypatch.setattr(shards, "BUCKETS", 2)
    monkeypatch.setattr(shards, "BUCKET_ROWS", 10)
    rows = [(k, f"text {k % 90}" if k < 200 else f"alone {k}") for k in range(301)]
    check_shards(shards.shard_documents(llm.createDataFrame(rows, "doc_id long, text string"), 8), rows, 8)
    assert [shards.buckets_for(n) for n in (0, 29, 301)] == [2, 2, 30]


def test_shards_messy(messy):
    rows, plain, wide = messy
    check_shards(shards.shard_documents(wide), rows, 40)
    check_shards(shards.shard_documents(plain, 3), rows, 3)
    assert shards.shard_documents(plain.limit(0)).count() == 0
    assert sorted(r.text_crc32 for r in shards.shard_documents(plain).collect())[:3] == [0, 0, 0]


def test_number(llm):
    df = llm.createDataFrame([(k % 3, k) for k in range(100)], "g long, k long")
    got = defaultdict(list)
    for r in shards.number(df, ["g"], ["k"], "n", buckets=4).collect():
        got[r.g].append(r.n)
    assert all(sorted(v) == list(range(len(v))) for v in got.values()) and len(got) == 3
