"""Texts cut into pretokens, with memos on the way.

In a text of ASCII and Latin-1 characters, whose classes every library agrees on, a space
between two visible characters always begins a pretoken of a byte-level pattern, and a line end
between two is one. Such a text is cut there, and what stands between is looked up whole; a part
that is not known is cut by the pattern, and its pretokens are looked up. Stretches with other
white space, and other texts, are cut by the pattern alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import regex

#: Pretokens and space-separated parts that a worker keeps before it starts anew.
PIECE_ENTRIES = 100_000
PART_ENTRIES = 800_000

#: Memos keep keys of at most so many characters.
LONGEST_KEY = 48

PLAIN = re.compile("[ -~\n\t¡-ÿ]*")
_LOOSE_SPACES = ("  ", " \n", "\n ", " \t", "\t ")
_SIGNS = (".", ",", ";", ":", "!", "?")
_LINE_END = re.compile(r"(?<=\S)\n(?=\S)")


class Memo(dict):
    """A dict that computes what it lacks. When half of its entries are new since the last time,
    those that were not asked for since then are forgotten."""

    def __init__(self, compute: Callable[[str], bytes], entries: int):
        super().__init__()
        self.compute, self.half, self.old = compute, entries // 2, {}

    def __missing__(self, key: str) -> bytes:
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= LONGEST_KEY:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Pretokens:
    """``encode(text)``: the joined encodings of its pretokens.

    ``drops_space`` says that white space belongs to no pretoken and only separates them.
    """

    def __init__(self, pattern: str, encode_piece: Callable[[str], bytes], *, drops_space: bool = False):
        self.findall = regex.compile(pattern).findall
        self.drops_space = drops_space
        self.pieces = Memo(encode_piece, PIECE_ENTRIES)
        self.encode_piece, self.lead = encode_piece, "" if drops_space else " "
        self.parts = Memo(self._part, PART_ENTRIES)
        # a run of letters is one pretoken, and one sign after it another
        samples = [(f"{self.lead}{x}", sign) for x in ("a", "Ab", "éß") for sign in _SIGNS]
        self.cuts_signs = all(self.findall(x + sign) == [x, sign] and self.findall(x) == [x] for x, sign in samples)
        self.cuts_lines = all(self.findall(f"{x}\n{y}") == [x, "\n", y] for x in "aZ1.'" for y in "aZ1.'")

    def _part(self, part: str) -> bytes:
        if self.cuts_signs:
            if part.isalpha():
                return self.encode_piece(self.lead + part)
            if part[-1:] in _SIGNS and part[:-1].isalpha():
                return self.parts[part[:-1]] + self.pieces[part[-1]]
        return self.by_pattern(self.lead + part)

    def by_pattern(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.findall(text)))

    def encode(self, text: str) -> bytes:
        if not PLAIN.fullmatch(text):
            return self.by_pattern(text)
        if self.drops_space:
            return b"".join(map(self.parts.__getitem__, text.split()))
        if not self.cuts_lines:
            return self._stretch(text)
        return self.pieces["\n"].join(map(self._stretch, _LINE_END.split(text))) if text else b""

    def _stretch(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if not rest or not first or not rest[-1] or any(x in text for x in _LOOSE_SPACES):
            return self.by_pattern(text)
        return self.by_pattern(first) + b"".join(map(self.parts.__getitem__, rest))
