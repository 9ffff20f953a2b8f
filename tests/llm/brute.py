"""Plain versions of the operators, for small fixtures."""

from __future__ import annotations

import re
from collections import Counter
from itertools import combinations

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def kept_words(texts: list[str | None], width: int) -> list[list[str]]:
    """Words that no repeated window covers, for each text."""
    split = [words(t) for t in texts]
    count = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = {
            i + k for i in range(len(w) - width + 1) if count[tuple(w[i : i + width])] > 1 for k in range(width)
        }
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def shingles(text: str | None, size: int) -> set:
    w = words((text or "").translate(LOWER))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def components(texts: list[str | None], size: int, percent: int) -> list[int]:
    """Least position that links reach, for each text."""
    sets = [shingles(t, size) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(x) for x in range(len(texts))]
