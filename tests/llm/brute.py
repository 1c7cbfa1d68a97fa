"""Plain restatements of the operators' results, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def substring(rows):
    """(id, text) -> {id: (n_words, n_removed, sha256)}."""
    words = {i: WORD.findall(t or "") for i, t in rows}
    first = {}
    for i, w in words.items():
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        kept = [x for x, g in zip(w, gone) if not g]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def shingles(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = WORD.findall(low)
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard(rows):
    """(id, text) -> {id: (n_shingles, component)}."""
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        common = Counter(j for x in s for j in holders[x])
        for x in s:
            holders[x].append(i)
        for j, n in common.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def base_statistics(text):
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    count = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = [0] * len(w)
    for k in range(len(w) - 4):
        if count[tuple(w[k : k + 5])] > 1:
            covered[k : k + 5] = [1] * 5
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, sum(covered)
