"""Suffix arrays and common prefixes of byte strings, in numpy."""

from __future__ import annotations

import numpy as np


def _words(text: np.ndarray, count: int = 8) -> np.ndarray:
    """The ``count`` bytes from each position on as one big-endian number in the highest bytes
    of 64 bits; zeros after the end."""
    padded = np.concatenate([text, np.zeros(count, np.uint8)])
    out = np.zeros(len(text), np.uint64)
    for i in range(count):
        out |= padded[i : i + len(text)].astype(np.uint64) << np.uint64(56 - 8 * i)
    return out


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in lexicographic order (Larsson and Sadakane).

    Suffixes are sorted by their first seven bytes. Then each group of equals is refined by the
    group of the suffix that starts where the compared part ends, which doubles that part;
    groups of one are settled and take no further part. The end of the text is below all bytes.
    """
    size, step = len(text), 7
    # the lowest byte says how many bytes there are, which puts a padded suffix first
    words = _words(text, step) | np.minimum(size - np.arange(size), step).astype(np.uint64)
    order = np.argsort(words, kind="stable")
    if size < 2:
        return order
    changed = np.empty(size, bool)
    changed[0] = True
    np.not_equal(words[order][1:], words[order][:-1], out=changed[1:])
    starts = np.flatnonzero(changed)
    rank = np.empty(size, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, size)))
    sizes = np.diff(np.append(starts, size))
    # places of the array that are not settled, by group
    unsettled = np.flatnonzero(np.repeat(sizes > 1, sizes))
    while len(unsettled):
        at = order[unsettled]
        group = rank[at]
        after = at + step
        key = np.where(after < size, rank[np.minimum(after, size - 1)], -1)
        sort = np.lexsort((key, group))
        at, group, key = at[sort], group[sort], key[sort]
        order[unsettled] = at
        new = np.empty(len(at), bool)
        new[0] = True
        np.logical_or(group[1:] != group[:-1], key[1:] != key[:-1], out=new[1:])
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(at)))
        rank[at] = np.repeat(unsettled[starts], sizes)
        unsettled = unsettled[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``order``; 0 for
    the first.

    As Kasai found, going one position on in the text loses at most one character. Where the
    characters in front of both suffixes are equal it loses exactly one, so only the other
    positions are compared, eight bytes at a time.
    """
    size = len(text)
    out = np.zeros(size, np.int64)
    if size < 2:
        return out
    before = np.empty(size, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    at = np.arange(size)
    compared = np.ones(size, bool)
    chained = before[1:] > 0
    compared[1:] = ~chained | (text[:-1] != text[np.maximum(before[1:] - 1, 0)])
    # a suffix follows from the one in front only if that one has a predecessor
    compared[1:] |= before[:-1] < 0
    words = np.append(_words(text), np.zeros(1, np.uint64))
    found = np.zeros(size, np.int64)
    left = np.flatnonzero(compared & (before >= 0))
    one, two = left.copy(), before[left]
    while len(left):
        room = size - np.maximum(one, two)
        differ = words[np.minimum(one, size)] ^ words[np.minimum(two, size)]
        equal = np.where(differ == 0, 8, 0)
        for i in range(1, 8):
            equal[differ != 0] += (differ >> np.uint64(64 - 8 * i) == 0)[differ != 0]
        equal = np.minimum(equal, np.maximum(room, 0))
        found[left] += equal
        on = (equal == 8) & (room > 8)
        left, one, two = left[on], one[on] + 8, two[on] + 8
    anchor = np.maximum.accumulate(np.where(compared, at, 0))
    plcp = found[anchor] - (at - anchor)
    plcp[before < 0] = 0
    return plcp[order]
