"""Plain versions of what the operators compute, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")


class Groups:
    """Union of sets that are joined pair by pair."""

    def __init__(self, nodes):
        self.root = {x: x for x in nodes}

    def find(self, x):
        while self.root[x] != x:
            x = self.root[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.root[b] = a


def vector_links(rows, threshold):
    """``(id, n_links, component_id, kept)`` of ``(id, vector, label)`` rows with distinct ids."""

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        most = max(map(abs, v))
        v = [x / most for x in v]
        size = math.sqrt(sum(x * x for x in v))
        return [x / size for x in v]

    units = {i: unit(v) for i, v, _ in rows}
    labels = {i: label for i, _, label in rows}
    groups, links = Groups(units), Counter()
    for a in units:
        for b in units:
            if a < b and labels[a] is not None and labels[a] == labels[b] and units[a] and units[b]:
                if len(units[a]) == len(units[b]) and sum(x * y for x, y in zip(units[a], units[b])) >= threshold:
                    groups.join(a, b)
                    links.update((a, b))
    return sorted((i, links[i], groups.find(i), groups.find(i) == i) for i in units)


def word_counts(text):
    words = WORD.findall(text or "")
    grams = list(zip(words, words[1:], words[2:]))
    seen, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if seen[gram] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def shingles(text, width=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return frozenset()
    if len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(zip(*(words[i:] for i in range(width))))


def shingle_components(docs):
    """``(id, size, component)`` of ``{id: text}``."""
    sets = {i: shingles(text) for i, text in docs.items()}
    groups, ids = Groups(sets), sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * min(len(x), len(y)) >= 90 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 90 * (len(x) + len(y) - both):
                    groups.join(a, b)
    return sorted((i, len(sets[i]), groups.find(i)) for i in ids)


def cut_repeats(docs, length=100):
    """``(id, n_bytes, n_removed, n_spans, sha256)`` of ``{id: text}``."""
    seen, out = set(), []
    for i in sorted(docs):
        data = (docs[i] or "").encode()
        gone = bytearray(len(data))
        for start in range(len(data) - length + 1):
            string = data[start : start + length]
            if string in seen:
                gone[start : start + length] = b"\x01" * length
            seen.add(string)
        kept = bytes(x for x, y in zip(data, gone) if not y)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
