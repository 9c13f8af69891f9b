"""Token alignment against the libraries and a plain count of pairs."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import SF
from depscope.llm import alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
LETTERS = {chr(b): b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b}
LETTERS |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in LETTERS.values())}


@pytest.fixture(scope="module")
def files():
    return alignment.load(A), alignment.load(B), P.PATTERN


def plain(rows):
    a_lib, b_lib = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_lib.encode_special_tokens = True
    docs = []
    for doc_id, text in rows:
        text = text or ""
        enc = a_lib.encode(" " + text, add_special_tokens=False)
        a, a_bytes = enc.ids, [bytes(LETTERS[c] for c in t) for t in enc.tokens]
        b = b_lib.encode(text)
        b_bytes = [bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            a, b, a_bytes, b_bytes = [], [], [], []
        ends = [set(np.cumsum([len(x) for x in side]).tolist()) for side in (a_bytes, b_bytes)]
        common = ends[0] & ends[1]
        groups, at = [[[], []]], [0, 0]
        for side, ids, parts in ((0, a, a_bytes), (1, b, b_bytes)):
            g = end = 0
            for i, x in zip(ids, parts):
                while len(groups) <= g:
                    groups.append([[], []])
                groups[g][side].append(i)
                end += len(x)
                g += end in common
        groups = [g for g in groups if g[0]]
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        digest = hashlib.sha256(";".join("|".join(",".join(map(str, s)) for s in g) for g in groups).encode()).hexdigest() if a else ""
        docs.append((doc_id, len(a), len(b), len(groups), links, digest))
    count, total, best = Counter(), Counter(), defaultdict(int)
    for d in docs:
        count.update(d[4].keys())
        total.update(d[4])
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = [(d, na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()), s)
           for d, na, nb, ng, links, s in docs]
    return sorted(out, key=repr), {p: (n, total[p], n == best[p[0]]) for p, n in count.items()}


def both(docs, pairs):
    rows = sorted((tuple(r) for r in docs.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)
    return rows, {(r.a_id, r.b_id): (r.n_docs, r.n_links, r.is_best) for r in pairs.collect()}


def odd_texts():
    texts = ["a▁b", "two  blanks \t\n\n", "<s> </s> <|endoftext|> <0x41>", "中文 naïve café 😀😀 ﬁ", "\u0000 zero", "don't aren't", " leading", "x" * 3000, "ab" * 900,
             "é" * 700, "😀" * 400, "a b " * 500, "­​ word", "tail "]
    return list(enumerate(texts))


def test_real_and_messy_rows(llm, files, real_docs, messy):
    rows = [(d, t) for d, t, *_ in real_docs][:120]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert both(*alignment.align(df, *files)) == plain(rows)
    for df in messy[1:]:
        assert both(*alignment.align(df, *files)) == plain([r[:2] for r in messy[0]])
    assert both(*alignment.align(messy[1].limit(0), *files)) == ([], {})


def test_containers_of_all_kinds(files, monkeypatch):
    """Bitmaps, lists, planes, large groups, many flushes and many slices give the same."""
    rows = odd_texts() + [(100 + k, "the same few words again and the end. " * (1 + k % 9)) for k in range(60)]
    want = plain(rows)
    for dense, entries, block, group in ((3, 40, 5, 2), (4096, 10, 7, 10 ** 9)):
        tk = alignment.tokenizers(*files)
        keys, links = [], []
        monkeypatch.setattr(alignment, "DENSE", dense)
        monkeypatch.setattr(alignment, "BLOCK_LINKS", block)
        monkeypatch.setattr(alignment, "GROUP_LINKS", group)
        found = alignment._Aligned(tk, *tk.ids([t for _, t in rows]))
        for pair, doc, n in found.entries():
            keys.append(pair << 16 | doc)
            links.append(n)
        counted, total, mult = Counter(), Counter(), Counter()
        for pair, plane, fresh, link, held in alignment.containers(*alignment._summed(keys, links)):
            for p, f, n, c in zip(pair.tolist(), fresh.tolist(), link.tolist(), held.to_pylist()):
                counted[p >> 16, p & 0xFFFF] += f
                total[p >> 16, p & 0xFFFF] += n
                if len(c) < 8192:
                    for d in alignment.documents_of(c):
                        mult[p, int(d)] += 1 << plane
        assert {p: (counted[p], total[p]) for p in counted} == {p: v[:2] for p, v in want[1].items()}
        assert sorted(found.n_links.tolist()) == sorted(r[4] for r in want[0])


def test_bitmap_containers_in_the_scores(llm, files):
    """More documents of one chunk than a list holds."""
    rows = [(k, "one two" if k % 3 else "one two one two one two") for k in range(9000)]
    df = llm.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert both(*alignment.align(df, *files)) == plain(rows)


def test_small_flushes(llm, files):
    rows = odd_texts() + [(100 + k, f"the same few words again {k % 7} and the end. " * (1 + k % 9)) for k in range(60)]
    df = llm.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    held, alignment.HELD_ENTRIES = alignment.HELD_ENTRIES, 30
    try:
        assert both(*alignment.align(df, *files)) == plain(rows)
    finally:
        alignment.HELD_ENTRIES = held


def test_long_text_and_library_on_all_characters(files):
    tk = alignment.tokenizers(*files)
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    text = "".join(map(chr, (c for c in range(0x30000) if not 0xD800 <= c < 0xE000)))
    for t in (text, "word " * 60_000, "a" * 150_000, " " * 100_000 + "x"):
        a = tk.ids([t])[0][0].tolist()
        want = lib.encode(" " + t, add_special_tokens=False).ids
        assert a in ([], want)
        assert a or t == text
    pieces = [text[k:k + 40] for k in range(0, len(text), 40)]
    got = alignment._encode_texts(tk.a, pieces, tk.pattern, 1 << 16)
    assert [x.tolist() for x in got] == [e.ids for e in lib.encode_batch(pieces, add_special_tokens=False)]


def test_sample_table(llm, files):
    df = llm.read.parquet(f"{SF}/documents.parquet")
    docs, pairs = alignment.align(df, *files)
    assert docs.count() == df.count() and pairs.count() > 1000
