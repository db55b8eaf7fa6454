"""Words and other runs of characters of many texts at once, in numpy.

Texts lie one after the other in one array of UTF-8 bytes. Runs are hashed to 64 bits: a
polynomial of their bytes, mixed. Equal runs have equal hashes; two different ones of the
same table meet with probability 2**-64.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_FACTOR = 0x5851F42D4C957F2D
_INVERSE = pow(_FACTOR, -1, 1 << 64)
_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: 0 between words, 1 in a word: a word is a run of anything but white space.
WORD_CLASSES = (~WHITE).astype(np.uint8)

#: 0 white space, 1 letters (with all bytes beyond ASCII), 2 digits, 3 other characters.
TOKEN_CLASSES = np.where(WHITE, 0, 3).astype(np.uint8)
TOKEN_CLASSES[128:] = 1
for _first, _last, _kind in ((b"A", b"Z", 1), (b"a", b"z", 1), (b"0", b"9", 2)):
    TOKEN_CLASSES[_first[0] : _last[0] + 1] = _kind

#: Letters only, for words without the signs around them.
LETTER_CLASSES = (TOKEN_CLASSES == 1).astype(np.uint8)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = {_FACTOR: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def _powers_of(base: int, count: int) -> np.ndarray:
    known = _powers[base]
    if len(known) < count:
        size = 1 << (count - 1).bit_length()
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        known = powers
        if size <= 1 << 23:
            _powers[base] = known
    return known[:count]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Runs(NamedTuple):
    """``hashes``, ``kinds`` and byte ``starts`` of the runs; those of text ``i`` are
    ``bounds[i]:bounds[i + 1]``."""

    hashes: np.ndarray
    kinds: np.ndarray
    starts: np.ndarray
    bounds: np.ndarray

    def owners(self) -> np.ndarray:
        """Number of the text of each run."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def runs(
    raw: np.ndarray, offsets: np.ndarray, classes: np.ndarray, *, lower: bool = False, digits_alike: bool = False, cuts: np.ndarray | None = None
) -> Runs:
    """Maximal runs of one class, class 0 left out; a run never crosses texts, nor the places ``cuts``."""
    kinds = classes[raw]
    starts_run = np.empty(len(raw), bool)
    if len(raw):
        starts_run[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=starts_run[1:])
        first = offsets[:-1]
        starts_run[first[first < len(raw)]] = True
        if cuts is not None:
            starts_run[cuts[cuts < len(raw)]] = True
    all_starts = np.flatnonzero(starts_run)
    if not len(all_starts):
        empty = np.zeros(0, np.int64)
        return Runs(empty.astype(np.uint64), empty.astype(np.uint8), empty, np.zeros(len(offsets), np.int64))
    values = _VALUES
    if digits_alike:
        values = values.copy()
        values[ord("0") : ord("9") + 1] = values[ord("0")]
    terms = (values[LOWER] if lower else values)[raw]
    terms *= _powers_of(_FACTOR, len(raw))
    sums = np.add.reduceat(terms, all_starts)
    kept = kinds[all_starts] > 0
    starts = all_starts[kept]
    hashes = mixed(sums[kept] * _powers_of(_INVERSE, len(raw))[starts])
    return Runs(hashes, kinds[starts], starts, np.searchsorted(starts, offsets))


def hash_sums(raw: np.ndarray) -> np.ndarray:
    """What ``span_hashes`` of these bytes are taken from."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUES[raw] * _powers_of(_FACTOR, len(raw)), out=sums[1:])
    return sums


def span_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
    """Hash of the bytes of each span, the same as that of an equal run."""
    sums = hash_sums(raw) if sums is None else sums
    return mixed((sums[stops] - sums[starts]) * _powers_of(_INVERSE, len(raw) + 1)[starts])


def totals(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` in each stretch ``offsets[i]:offsets[i + 1]``."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each stretch of ``width`` neighbours, as if all were of one text."""
    count = max(0, len(hashes) - width + 1)
    out = np.zeros(count, np.uint64)
    for i in range(width):
        out = mixed(out * np.uint64(_FACTOR) + hashes[i : i + count])
    return out
