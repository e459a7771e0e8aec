"""Plain-Python versions of the operators, for small tables."""

import collections
import hashlib
import re

import numpy as np


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def substring(rows, width=13):
    """(doc_id, n_words, n_removed, sha) of each row of (doc_id, text)."""
    least = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - width + 1):
            key = tuple(w[i : i + width])
            least[key] = min(least.get(key, float("inf")), float("inf") if d is None else d)
    out = []
    for d, t in rows:
        w, gone = words(t), set()
        for i in range(len(w) - width + 1):
            if least[tuple(w[i : i + width])] < (float("inf") if d is None else d):
                gone.update(range(i, i + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), sha(kept.encode())))
    return out


def suffix(rows, width=200):
    n = collections.Counter()
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        n.update(b[i : i + width] for i in range(len(b) - width + 1))
    out = []
    for d, b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if n[b[i : i + width]] > 1:
                gone[i : i + width] = True
        runs = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
        out.append((d, len(b), int(gone.sum()), runs, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
    return out


def jaccard(rows, n=4, num=85, den=100):
    """doc_id -> (n_names, component_id), doc_id unique."""
    sets = {}
    for d, t in rows:
        w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[d] = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and den * common >= num * (len(sets[a]) + len(sets[b]) - common):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), top(d)) for d in ids}
