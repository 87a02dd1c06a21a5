"""Plain single-process versions of what the operators compute."""

import hashlib
import re

import numpy as np
import xxhash

UPPER = re.compile("[A-Z]")


def lower_az(t):
    return UPPER.sub(lambda m: m[0].lower(), t or "")


def simhash(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_az(text))
    if not w:
        return 0
    grams = [" ".join(w)] if len(w) < n else [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(rows, bits=3, n=3):
    """{row index: (fingerprint, smallest id)} of (doc_id, text) rows."""
    fps = [simhash(t, n) for _, t in rows]
    uniq = sorted(set(fps))
    arr = np.array(uniq, dtype=np.uint64)
    parent = list(range(len(uniq)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(uniq)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= bits):
            parent[find(i)] = find(int(j))
    at = {f: k for k, f in enumerate(uniq)}
    ids = {}
    for (d, _), f in zip(rows, fps):
        r = find(at[f])
        if d is not None:
            ids[r] = min(ids.get(r, d), d)
    return [(d, f"{f:016x}", ids.get(find(at[f]))) for (d, _), f in zip(rows, fps)]


def repeats(texts, size=200):
    """Per text: (n_bytes, n_removed, n_spans, sha256 of the rest)."""
    data = [(t or "").encode() for t in texts]
    places = {}
    for k, b in enumerate(data):
        for p in range(len(b) - size + 1):
            places.setdefault(b[p:p + size], []).append((k, p))
    gone = [np.zeros(len(b) + 1, dtype=bool) for b in data]
    for at in places.values():
        if len(at) > 1:
            for k, p in at:
                gone[k][p:p + size] = True
    out = []
    for b, g in zip(data, gone):
        kept = bytes(c for c, x in zip(b, g) if not x)
        spans = int((np.diff(np.concatenate([[0], g.astype(int)])) == 1).sum())
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def lines(rows, min_docs=10):
    keys = [[lower_az(x.strip(" \t\n\x0b\x0c\r")) for x in (t or "").split("\n")] for _, t in rows]
    docs = {}
    for (d, t), ks in zip(rows, keys):
        for k in set(ks):
            docs.setdefault(k, set()).add((d, t))
    often = {k for k, v in docs.items() if k and len(v) >= min_docs}
    out = []
    for (d, t), ks in zip(rows, keys):
        kept = [x for x, k in zip((t or "").split("\n"), ks) if k not in often]
        out.append((d, len(ks), len(ks) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_az(t))


def contamination(rows, items, n=10):
    wins = {}
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - n + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + n]), set()).add(i)
    sizes = {len(w) for w in wins}
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for s in sizes:
            for k in range(len(w) - s + 1):
                own = wins.get(tuple(w[k:k + s]))
                if own:
                    hit.update(range(k, k + s))
                    found.update(str(i) for i in own if i is not None)
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def targets(sizes, weights=(1, 2, 3), most=3):
    """{source: target}: excess reshared by weight until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in order if s not in full]
        wsum = sum(w[s] for s in open_)
        t = {s: most * sizes[s] if s in full else rest * w[s] / wsum for s in order}
        above = {s for s in open_ if t[s] > most * sizes[s] + 1e-9}
        if not above:
            return t
        full |= above
