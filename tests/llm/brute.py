"""Plain Python versions of what the operators compute."""

import collections
import re

import numpy as np
import xxhash


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text, n=4):
    w = words(lowered(text))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(values, bits):
    v = np.array(values, np.uint64)
    return [(int(v[i]), int(v[j])) for i in range(len(v)) for j in (i + 1 + np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= bits))]


def tokens(text):
    return re.findall(r"\w+", (text or "").lower())


def shingles(w, n=5):
    return [tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []


def similarity(x, y):
    x, y = collections.Counter(x), collections.Counter(y)
    return sum((x & y).values()) / sum((x | y).values())


def leaks(docs, items, limit=0.8):
    """Best similarity of an item-sized window by (doc, item)."""
    where, out = collections.defaultdict(set), {}
    for i, t in items:
        for s in shingles(tokens(t)):
            where[s].add(i)
    texts = dict(items)
    for d, t in docs:
        own = shingles(tokens(t))
        for i in {i for s in own for i in where.get(s, ())}:
            item = shingles(tokens(texts[i]))
            m = min(len(item), len(own))
            best = max(similarity(own[a:a + m], item) for a in range(len(own) - m + 1))
            if best >= limit:
                out[d, i] = max(best, out.get((d, i), 0))
    return out
