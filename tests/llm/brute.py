"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import xxhash


def split(t, lower=False):
    t = (t or "").encode()
    return (t.lower() if lower else t).split()


def removed(rows, length=20):
    """Substring dedup of (doc_id, text): sorted (doc_id, n_words, n_removed, kept_sha256)."""
    first, out = {}, []
    for d, t in sorted(rows, key=lambda r: r[0]):
        w = split(t)
        for s in range(len(w) - length + 1):
            first.setdefault(tuple(w[s:s + length]), (d, s))
    for d, t in rows:
        w = split(t)
        gone = set()
        for s in range(len(w) - length + 1):
            if first[tuple(w[s:s + length])] < (d, s):
                gone.update(range(s, s + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def fingerprint(t, k=3):
    w = split(t, lower=True)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, distance=2):
    """{doc_id: fingerprint} to {doc_id: smallest doc_id reachable}."""
    root = {k: k for k in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= distance:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {k: find(k) for k in fps}


def _shingles(w, k=5):
    return Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def leaks(docs, items, least=0.8):
    """{(doc_id, item_id): (start of the best window, similarity, windows)}."""
    out = {}
    for d, t in docs:
        w = split(t, lower=True)
        for i, x in items:
            y = split(x, lower=True)
            if not w or not y:
                continue
            want, m, found = _shingles(y), min(len(y), len(w)), []
            if len(w) >= 5 and m >= 5 and not set(want) & set(_shingles(w)):
                continue
            for s in range(len(w) - m + 1):
                got = _shingles(w[s:s + m])
                both = sum((got & want).values())
                v = both / (sum(got.values()) + sum(want.values()) - both)
                if v >= least:
                    found.append((-v, s))
            if found:
                v, s = min(found)
                out[d, i] = (s, -v, len(found))
    return out


class KneserNey:
    """Interpolated modified Kneser-Ney bigrams over lists of tokens."""

    def __init__(self, texts):
        self.uni = Counter(x for w in texts for x in w)
        self.bi = Counter(p for w in texts for p in zip([None, *w[:-1]], w))
        self.cont = Counter(w for _, w in self.bi)
        self.d, self.low, self.all = self._discounts(self.bi), self._discounts(self.cont), sum(self.cont.values())
        self.back = sum(self.low[min(c, 3)] for c in self.cont.values()) / self.all
        self.seen, self.weight = Counter(), defaultdict(float)
        for (v, _), c in self.bi.items():
            self.seen[v] += c
            self.weight[v] += self.d[min(c, 3)]

    @staticmethod
    def _discounts(counts):
        n = [sum(1 for x in counts.values() if x == i) for i in range(1, 5)]
        if not all(n):
            return 0.0, 0.5, 1.0, 1.5
        y = n[0] / (n[0] + 2 * n[1])
        return 0.0, *(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), k) for k in (1, 2, 3))

    def p(self, v, w):
        c = self.cont[w]
        low = (c - self.low[min(c, 3)]) / self.all + self.back / (len(self.uni) + 1)
        if v not in self.seen:
            return low
        c = self.bi[v, w]
        return (c - self.d[min(c, 3)]) / self.seen[v] + self.weight[v] / self.seen[v] * low

    def score(self, w):
        return sum(math.log10(self.p(v, x)) for v, x in zip([None, *w[:-1]], w))

    def base(self, w):
        return sum(math.log10((self.uni[x] + 1) / (sum(self.uni.values()) + len(self.uni) + 1)) for x in w)


def statistics(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(tri)
    covered = {i + j for i, x in enumerate(tri) if n[x] > 1 for j in range(3)}
    lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered))


def crc(x):
    return zlib.crc32(("" if x is None else str(x)).encode())
