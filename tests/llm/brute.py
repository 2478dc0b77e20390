"""Plain Python versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def key(doc_id):
    return math.inf if doc_id is None else doc_id


def token_rows(rows, tokenizer):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: key(r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        crc = zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))
        out.append((doc_id, start, len(ids), crc))
        start += len(ids)
    return out


def repeated(rows, tokens, width):
    """For each row, which tokens a window covers that also starts in a row with a smaller id."""
    seqs = [tokens(t) for _, t in rows]
    least = {}
    for (d, _), s in zip(rows, seqs):
        for i in range(len(s) - width + 1):
            w = tuple(s[i:i + width]) if not isinstance(s, bytes) else s[i:i + width]
            least[w] = min(least.get(w, math.inf), key(d))
    out = []
    for (d, _), s in zip(rows, seqs):
        gone = [False] * len(s)
        for i in range(len(s) - width + 1):
            w = tuple(s[i:i + width]) if not isinstance(s, bytes) else s[i:i + width]
            if least[w] < key(d):
                gone[i:i + width] = [True] * width
        out.append(gone)
    return seqs, out


def byte_rows(rows, width=50):
    seqs, gone = repeated(rows, lambda t: (t or "").encode(), width)
    out = []
    for (d, _), s, g in zip(rows, seqs, gone):
        kept = bytes(b for b, x in zip(s, g) if not x)
        spans = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        out.append((d, len(s), sum(g), spans, hashlib.sha256(kept).hexdigest()))
    return out


def word_rows(rows, width=50):
    seqs, gone = repeated(rows, lambda t: WORD.findall(t or ""), width)
    return [(d, len(s), sum(g), hashlib.sha256(" ".join(w for w, x in zip(s, g) if not x).encode()).hexdigest())
            for (d, _), s, g in zip(rows, seqs, gone)]


def near_rows(rows, percent=85):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_id = {}
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    for i, (d, _) in enumerate(rows):
        r = root(i)
        by_id[r] = min(by_id.get(r, math.inf), key(d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = by_id[root(i)]
        out.append((d, len(sets[i]), None if c == math.inf else c, key(d) == c))
    return out


def base_scores(rows):
    docs = [(d, [*WORD.findall(lower(t)), None]) for d, t in rows]
    out_of = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    c = Counter(x for d, w in docs if not out_of(d) for x in w)
    n, v = sum(c.values()), len(c)
    return [(d, out_of(d), len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) for d, w in docs]


def katz_scores(rows, cut=5):
    """The back-off model by its definition, on dictionaries."""
    end = None
    docs = [(d, [*WORD.findall(lower(t)), end]) for d, t in rows]
    train = [w for d, w in docs if zlib.crc32(b"" if d is None else str(d).encode()) % 7 != 2]
    uni = Counter(x for w in train for x in w)
    bi = Counter((a, b) for w in train for a, b in zip([end, *w], w))

    def discounts(counts):
        n = Counter(min(c, cut + 2) for c in counts.values())
        common = (cut + 1) * n[cut + 1] / n[1] if n[1] else 1.0
        out = {}
        for r in range(1, cut + 1):
            d = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) if n[r] and common != 1 else 0.0
            out[r] = d if 0 < d < 1 else 1 - 0.5 / r
        return out

    du, db = discounts(uni), discounts(bi)
    total = sum(uni.values())
    mass = sum(c * du.get(c, 1) for c in uni.values())
    scale = total if total - mass > 0 else total + 1
    unknown = (scale - mass) / scale
    p1 = lambda w: uni[w] * du.get(uni[w], 1) / scale if uni[w] else unknown
    after = defaultdict(dict)
    for (h, w), c in bi.items():
        after[h][w] = c
    weights = {}
    for h, seen in after.items():
        m = sum(c * db.get(c, 1) for c in seen.values())
        s = uni[h] if uni[h] - m > 1e-9 * uni[h] else uni[h] + 1
        weights[h] = (s, (s - m) / s / (1 - sum(p1(w) for w in seen)))

    def p2(h, w):
        if h not in weights:
            return p1(w)
        s, alpha = weights[h]
        c = after[h].get(w, 0)
        return c * db.get(c, 1) / s if c else alpha * p1(w)

    scores = [(d, sum(math.log10(p2(a, b)) for a, b in zip([end, *w], w))) for d, w in docs]
    return scores, p1, p2, uni, unknown
