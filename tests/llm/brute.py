"""The operators' rules written out plainly, for comparison."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

GAP = re.compile("[\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [w for w in GAP.split(text or "") if w]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def window_dedup(docs, size):
    """[(id, text)] -> [(id, n_words, n_removed, sha of what is kept)], sorted; a NULL id is the largest."""
    key = lambda d: (d is None, d or 0)
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - size + 1):
            g = tuple(w[i:i + size])
            first[g] = min(first.get(g, key(d)), key(d))
    out = []
    for d, t in docs:
        w = words(t)
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < key(d):
                gone.update(range(i, i + size))
        out.append((d, len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone).encode())))
    return sorted(out, key=str)


def byte_dedup(docs, length):
    """[(id, text)] -> [(id, n_bytes, n_removed, n_spans, sha of what is kept)], sorted."""
    data = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(b[i:i + length] for _, b in data for i in range(len(b) - length + 1))
    out = []
    for d, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and (not k or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone, strict=True) if not g))))
    return sorted(out, key=str)


def shingles(text, k):
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def jaccard(docs, k, percent):
    """{id: (set size, component)} for distinct ids."""
    sets = {d: shingles(t, k) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for d in sorted(sets):
        met = Counter(e for g in sets[d] for e in where[g])
        for e, both in met.items():
            if 100 * both >= percent * (len(sets[d]) + len(sets[e]) - both):
                a, b = sorted((find(d), find(e)))
                root[b] = a
        for g in sets[d]:
            where[g].append(d)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def base_counts(text):
    text = text or ""
    w = words(text)
    grams = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    twice = {i + j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(twice)


def edit_distance_in(pattern, text):
    """Least edits that turn ``pattern`` into some part of ``text``."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for k, p in enumerate(pattern):
            new.append(min(row[k] + (p != c), row[k + 1] + 1, new[k] + 1))
        row = new
        best = min(best, row[-1])
    return best


def mix_targets(sizes, weights=(5, 2, 1), most=3):
    """{source: size} -> {source: target}: share by weight, stop at the limit, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    fixed, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / max(1, sum(weight[x] for x in free)) for s in free}
        above = [s for s in free if share[s] > most * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed.update((s, most * sizes[s]) for s in above)
