"""Trigram queries of regular expressions, and postings of trigrams over a block of texts.

A query is a trigram, ``All`` or ``Any`` of queries. ``All()`` holds for every text, ``Any()``
for none. A text that a regular expression matches satisfies its query; the converse need not
hold, so candidates are verified. Trigrams are three bytes of UTF-8 with A-Z in lower case.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from re import _constants as kinds
from re import _parser as parser
from typing import NamedTuple

import numpy as np

from .words import LOWER

#: Strings that a part of an expression is spelled out to; beyond, it may be anything. It bounds
#: the size of a query and never what the expression finds.
SPELLED_OUT = 24


class All(frozenset):
    """Every one of these queries holds."""


class Any(frozenset):
    """At least one of these queries holds."""


EVERY_TEXT = All()


def all_of(parts: Iterable) -> All | Any | bytes:
    flat = set()
    for part in parts:
        flat |= part if isinstance(part, All) else {part}
    return next(iter(flat)) if len(flat) == 1 else All(flat)


def any_of(parts: Iterable) -> All | Any | bytes:
    flat = set()
    for part in parts:
        if part == EVERY_TEXT and isinstance(part, All):
            return EVERY_TEXT
        flat |= part if isinstance(part, Any) else {part}
    # what implies another alternative adds nothing to it
    flat = {x for x in flat if not (isinstance(x, All) and any(y in x or (isinstance(y, All) and y < x) for y in flat))}
    return next(iter(flat)) if len(flat) == 1 else Any(flat)


def _within(string: bytes) -> All | bytes:
    return all_of(string[i : i + 3] for i in range(len(string) - 2))


def _one_of(strings: Iterable[bytes]):
    return any_of(map(_within, strings))


class _Part(NamedTuple):
    """What every match of a part has: one of the ``heads`` at its start and of the ``tails`` at
    its end, and ``query``. With ``whole``, the heads are all the strings that it can match."""

    heads: frozenset[bytes]
    tails: frozenset[bytes]
    query: object
    whole: bool


_EMPTY = frozenset([b""])
_ANYTHING = _Part(_EMPTY, _EMPTY, EVERY_TEXT, False)


def _spelled(strings: Iterable[bytes]) -> _Part:
    strings = frozenset(strings)
    return _Part(strings, strings, EVERY_TEXT, True) if len(strings) <= SPELLED_OUT else _ANYTHING


def _opened(part: _Part) -> _Part:
    """The same part with its strings moved to the query."""
    if not part.whole:
        return part
    heads, tails = frozenset(s[:2] for s in part.heads), frozenset(s[-2:] for s in part.tails)
    return _Part(heads, tails, _one_of(part.heads), False)


def _joined(a: _Part, b: _Part) -> _Part:
    across = {x + y for x in a.tails for y in b.heads} if len(a.tails) * len(b.heads) <= SPELLED_OUT else None
    if across is None:
        a, b = _opened(a), _opened(b)
        return _Part(a.heads, b.tails, all_of((a.query, b.query)), False)
    if a.whole and b.whole:
        return _spelled(across)
    heads = frozenset(x[:2] for x in across) if a.whole else a.heads
    tails = frozenset(x[-2:] for x in across) if b.whole else b.tails
    return _Part(heads, tails, all_of((a.query, b.query, _one_of(across))), False)


def _either(parts: list[_Part]) -> _Part:
    if all(p.whole for p in parts):
        strings = frozenset().union(*(p.heads for p in parts))
        if len(strings) <= SPELLED_OUT:
            return _spelled(strings)
    parts = [_opened(p) for p in parts]
    heads, tails = (frozenset().union(*(p[i] for p in parts)) for i in (0, 1))
    heads, tails = (x if len(x) <= SPELLED_OUT else _EMPTY for x in (heads, tails))
    return _Part(heads, tails, any_of(p.query for p in parts), False)


def _characters(codes: Iterable[int], flags: int) -> _Part:
    codes = set(codes)
    # beyond ASCII, the other case of a letter is other bytes
    if flags & re.IGNORECASE and (not flags & re.ASCII or any(x > 127 for x in codes)):
        return _ANYTHING
    return _spelled({chr(x).encode("utf-8", "surrogatepass").lower() for x in codes})


def _of_class(items: list, flags: int) -> _Part:
    codes: set[int] = set()
    for kind, value in items:
        if kind is kinds.LITERAL:
            codes.add(value)
        elif kind is kinds.RANGE and value[1] - value[0] <= SPELLED_OUT:
            codes.update(range(value[0], value[1] + 1))
        else:
            return _ANYTHING
    return _characters(codes, flags)


def _of(pattern, flags: int) -> _Part:
    whole = _spelled([b""])
    for kind, value in pattern:
        if kind is kinds.LITERAL:
            part = _characters([value], flags)
        elif kind is kinds.IN:
            part = _of_class(value, flags)
        elif kind is kinds.BRANCH:
            part = _either([_of(x, flags) for x in value[1]])
        elif kind is kinds.SUBPATTERN:
            part = _of(value[3], (flags | value[1]) & ~value[2])
        elif kind is kinds.ATOMIC_GROUP:
            part = _of(value, flags)
        elif kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT, kinds.POSSESSIVE_REPEAT):
            part = _repeated(*value, flags)
        elif kind in (kinds.AT, kinds.ASSERT, kinds.ASSERT_NOT):
            part = _spelled([b""])
        else:
            part = _ANYTHING
        whole = _joined(whole, part)
    return whole


def _repeated(least: int, most: int, pattern, flags: int) -> _Part:
    once = _of(pattern, flags)
    if (least, most) == (0, 1):
        return _either([once, _spelled([b""])])
    whole = _spelled([b""])
    for _ in range(min(least, 3)):
        whole = _joined(whole, once)
    return whole if least == most <= 3 else _joined(_joined(whole, _ANYTHING), once if least else _ANYTHING)


def trigram_query(pattern: str, flags: int = 0):
    """The query that every text with a match of ``pattern`` satisfies."""
    parsed = parser.parse(pattern, flags)
    return _opened(_of(parsed, parsed.state.flags)).query


def trigrams_of(query) -> set[bytes]:
    return {query} if isinstance(query, bytes) else set().union(*map(trigrams_of, query))


class Postings:
    """Which texts of a block hold which of the ``wanted`` trigrams."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, wanted: Iterable[bytes]):
        self.texts = len(offsets) - 1
        names = sorted(wanted)
        codes = np.array([int.from_bytes(x, "big") for x in names], np.int64)
        opening = np.zeros(1 << 16, bool)
        opening[codes >> 8] = True
        low = LOWER[raw]
        pairs = low[:-1].astype(np.uint16) << 8 | low[1:]
        places = np.flatnonzero(opening[pairs[:-1]]) if len(low) > 2 else np.zeros(0, np.int64)
        found = pairs[places].astype(np.int64) << 8 | low[places + 2]
        which = np.searchsorted(codes, found)
        known = which < len(codes)
        known[known] = codes[which[known]] == found[known]
        places, which = places[known], which[known]
        owners = np.searchsorted(offsets, places, side="right") - 1
        inside = places + 3 <= offsets[owners + 1]
        keys = np.unique(which[inside] * self.texts + owners[inside])
        bounds = np.searchsorted(keys, np.arange(len(names) + 1) * self.texts)
        self.lists = {name: keys[a:b] % self.texts for name, a, b in zip(names, bounds[:-1], bounds[1:])}

    def texts_of(self, query) -> np.ndarray:
        """Numbers of the texts that satisfy ``query``, ascending."""
        if isinstance(query, bytes):
            return self.lists[query]
        if isinstance(query, Any):
            return np.unique(np.concatenate([np.zeros(0, np.int64), *map(self.texts_of, query)]))
        found = np.arange(self.texts)
        for part in sorted(map(self.texts_of, query), key=len):
            found = np.intersect1d(found, part, assume_unique=True)
        return found
