"""Plain versions of the operators, row by row and pair by pair, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANKS = " \t\x0b\f\r"


def sha(data):
    return hashlib.sha256(data).hexdigest()


def fingerprint(text):
    words = [w.encode() for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    shingles = [b" ".join(words[k:k + 4]) for k in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def near_groups(rows, budget=4):
    """Component number of each row, by all pairs."""
    fps = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= budget:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return fps, [root(k) for k in range(len(rows))]


def boilerplate(rows, ratio, least):
    """(source, line) to drop, of rows (text, source)."""
    total, seen = Counter(s for _, s in rows), Counter()
    for text, source in rows:
        for line in {x.strip(BLANKS) for x in (text or "").split("\n")} - {""}:
            seen[source, line] += 1
    return {k for k, n in seen.items() if n >= least and n * 1000 > total[k[0]] * ratio}


def without(text, source, bad):
    return None if text is None else "\n".join(x for x in text.split("\n") if (source, x.strip(BLANKS)) not in bad)


def repeats(rows, length):
    """(key, n_bytes, n_removed, n_spans, digest of the rest) of rows (doc_id, text)."""
    def key(d):
        return -(1 << 63) if d is None else d
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - length + 1):
            w, p = b[i:i + length], (key(d), i)
            if w not in first or p < first[w]:
                first[w] = p
    found = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if first[b[i:i + length]] < (key(d), i):
                gone[i:i + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        found.append((key(d), len(b), sum(gone), spans, sha(rest)))
    return sorted(found)


def tokens(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def leaks(docs, items, run_words=13):
    """{(doc_id, item_id): matched words} by all alignments with a common word; under 5 words, all have to be equal."""
    found = {}
    for d, text in docs:
        places = defaultdict(list)
        for k, w in enumerate(tokens(text)):
            places[w].append(k)
        for item, passage in items:
            words = tokens(passage)
            run = min(run_words, len(words))
            need = -(-run * 80 // 100)
            if not words:
                continue
            shifts = defaultdict(list)
            for q, w in enumerate(words):
                for k in places.get(w, ()):
                    shifts[k - q].append(q)
            for at in shifts.values():
                if any(sum(a <= q < a + run for q in at) >= need for a in range(len(words) - run + 1)):
                    found[d, item] = max(found.get((d, item), 0), len(at))
    return found


def base_counts(text):
    words = WORD.findall(text or "")
    seen = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if seen[tuple(words[k:k + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))
