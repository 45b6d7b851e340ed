"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

GAP = "\x20\x09-\x0d"
ASSIGN = re.compile(
    r"""((?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A,
)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def words(text):
    return re.findall(f"[^{GAP}]+", text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return sorted(found)


def shingles(text, width):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    width = min(width, len(w)) or 1
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def near_groups(docs, width=2, percent=80):
    """doc_id -> smallest doc_id reachable."""
    sets = {i: shingles(t, width) for i, t in docs}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    ids = sorted(sets)
    for i in ids:
        common = {}
        for x in sets[i]:
            for j in holders[x]:
                if j < i:
                    common[j] = common.get(j, 0) + 1
        for j, both in common.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}


def kept_words(docs, length=50):
    """doc_id -> (words, kept words)."""
    first, out = {}, {}
    split = {i: words(t) for i, t in docs}
    for i, w in split.items():
        for k in range(len(w) - length + 1):
            key = tuple(w[k : k + length])
            first[key] = min(i, first.get(key, i))
    for i, w in split.items():
        gone = np.zeros(len(w) + 1, int)
        for k in range(len(w) - length + 1):
            if first[tuple(w[k : k + length])] < i:
                gone[k] += 1
                gone[k + length] -= 1
        stay = np.cumsum(gone)[:-1] == 0
        out[i] = len(w), [x for x, s in zip(w, stay, strict=True) if s]
    return out


def top_k(vectors, k, every, score):
    """[(query, rank, id, score)] with ties to the smaller id."""
    rows = []
    for q, a in vectors:
        if q % every == 0:
            hits = sorted((-score(a, b), i) for i, b in vectors if i != q and len(a) == len(b))
            rows += [(q, n, i, -s) for n, (s, i) in enumerate(hits[:k], 1)]
    return rows


def whole(a, b):
    f = lambda v: np.floor(np.asarray(v, float) * 256).astype(np.int64)
    return int(f(a) @ f(b))


def cosine(a, b):
    dot = na = nb = 0.0
    for x, y in zip(map(float, a), map(float, b), strict=True):
        dot, na, nb = dot + x * y, na + x * x, nb + y * y
    return dot / (np.sqrt(na) * np.sqrt(nb))


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def periodic(w):
    """Runs of a list of words as (start, length, period), by every period and place."""
    n, least = len(w), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j - i >= p and j - i + p >= 12:
                least.setdefault((i, j + p), p)
            i = j + 1
    return sorted(((s, e - s, p) for (s, e), p in least.items()), key=lambda r: (r[0], r[2]))


def collapsed(w):
    gone = {i for s, n, p in periodic(w) for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def tiled(doc_id, w):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 or not n or doc_id is None:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i if i < a else a + (i - a) % p] for i in range(n)]


def whitened(vectors, components=4):
    """(x, sums, directions, eigenvalues, trace) of distinct scaled vectors, all at once."""
    x = np.unique(np.floor(256 * np.asarray(vectors, float)).astype(np.int64), axis=0)
    centred = x - x.mean(axis=0)
    values, directions = np.linalg.eigh(centred.T @ centred / len(x))
    return x, x.sum(axis=0), directions[:, ::-1][:, :components], values[::-1][:components], values.sum()
