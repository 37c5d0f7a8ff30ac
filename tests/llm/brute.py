"""Plain counterparts of the operators, for small inputs."""

from __future__ import annotations

import random
from collections import Counter

EDGE_TEXTS = [
    None, "", " \t\n\x0b\x0c\r ", "one", "one two three", "One TWO three", "Été à l'œuvre — déjà vu ✓", "a\xa0b c",
    "same words here again and again " * 12, "same words here again and again " * 12,
]


def words(text):
    return (text or "").encode().split()


def prose(seed, count, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(count)]


def corpus():
    """(doc_id, text): edge cases, near copies, shared passages, a very long text, repeated and NULL ids."""
    rng = random.Random(5)
    rows = list(enumerate(EDGE_TEXTS))
    base = prose(1, 260)
    for k in range(12):
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        rows.append((100 + k, " ".join(copy)))
    passage = prose(2, 70)
    for k in range(8):
        rows.append((200 + k, " ".join(prose(50 + k, 90) + passage + prose(80 + k, 40))))
    rows.append((300, " ".join(prose(3, 20_000, 5_000))))
    rows.append((301, "z" * 50_000 + " " + " ".join(passage[:40])))
    rows += [(100, rows[10][1]), (None, " ".join(passage)), (None, None), (205, "another text under a known id")]
    return rows


def roots(count, pairs):
    parent = list(range(count))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(k) for k in range(count)]


def smallest(ids, root):
    """Smallest id of each component, NULL only if there is none."""
    low = {}
    for i, r in zip(ids, root, strict=True):
        low.setdefault(r, []).append(i)
    return [min((x for x in low[r] if x is not None), default=None) for r in root]


def shingles(text, size=5):
    own = [w.lower() for w in words(text)]
    return frozenset(tuple(own[k:k + size]) for k in range(len(own) - size + 1)) if len(own) >= size else frozenset([tuple(own)] if own else [])


def jaccard_roots(rows):
    sets = [shingles(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    return sets, roots(len(rows), pairs)


def jaccard(rows):
    sets, root = jaccard_roots(rows)
    low = smallest([i for i, _ in rows], root)
    return sorted(((i, len(s), c if s else i) for (i, _), s, c in zip(rows, sets, low, strict=True)), key=repr)


def repeats(rows, window=35):
    seen = Counter(tuple(w[k:k + window]) for w in (words(t) for _, t in rows) for k in range(len(w) - window + 1))
    out = []
    for i, text in rows:
        own = words(text)
        gone = [False] * len(own)
        for k in range(len(own) - window + 1):
            if seen[tuple(own[k:k + window])] > 1:
                gone[k:k + window] = [True] * window
        out.append((i, len(own), sum(gone), b" ".join(w for w, g in zip(own, gone, strict=True) if not g).decode()))
    return sorted(out, key=repr)
