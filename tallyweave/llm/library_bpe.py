"""Whole texts through a vocabulary of the ``tokenizers`` library, pretoken by pretoken.

Made for the two layouts whose pretokens depend on nothing but a pattern: byte-level BPE, and
lower-cased BPE with word ends. Ids of a pretoken come from the library's model and are
memoised. A text with characters beyond ASCII and Latin-1, where library and Python could
disagree on classes or normal forms, goes through the library whole, and so does one that holds an
added token, such as ``<|endoftext|>``: it gets that token's id, as the plain call gives it. With
``markers_as_text`` such a marker is ordinary text, so no document can end another one.
"""

from __future__ import annotations

import json
import os
import re
import struct

import numpy as np

from .pretokens import PLAIN, Pretokens

#: Fixed value: the split of byte-level BPE.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte: fixed values."""
    kept = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return {byte: chr(byte if byte in kept else next(others)) for byte in range(256)}


class _Packed:
    """Ids of a piece as bytes; the layouts of the usual counts are kept."""

    def __init__(self, dtype: str):
        kind = {"<u4": "I", "<u2": "H"}[dtype]
        self.pack = [struct.Struct(f"<{n}{kind}").pack for n in range(64)]
        self.dtype = dtype

    def __call__(self, *ids: int) -> bytes:
        return self.pack[len(ids)](*ids) if len(ids) < len(self.pack) else np.array(ids, self.dtype).tobytes()


class LibraryBpe:
    """``encode(text)`` gives the ids of a text as bytes of little-endian ``dtype``."""

    def __init__(self, path: str, dtype: str = "<u4", *, markers_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.dtype = Tokenizer.from_file(path), dtype
        self.tokenizer.encode_special_tokens = markers_as_text
        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        markers = [] if markers_as_text else [re.escape(x["content"]) for x in layout.get("added_tokens") or []]
        # the library may look for them in the text as it is or as it is normalised
        self.holds_marker = re.compile("|".join(markers), re.IGNORECASE).search if markers else lambda text: None
        steps = layout["pre_tokenizer"]
        self.lower = drops_space = False
        if steps["type"] == "ByteLevel" and layout["normalizer"] is None and not steps["add_prefix_space"]:
            pattern = BYTE_LEVEL_PATTERN
        elif steps["type"] == "Sequence" and [x["type"] for x in steps["pretokenizers"]] == ["Split", "ByteLevel"]:
            pattern = steps["pretokenizers"][0]["pattern"]["Regex"]
            drops_space = True
            self.lower = any(x["type"] == "Lowercase" for x in layout["normalizer"]["normalizers"])
        else:
            pattern = None
        self.packed, self.space = _Packed(self.dtype), _byte_letters()[32]
        # pieces are memoised here, so the model of its own that they go through keeps none
        self.model, self.letters = Tokenizer.from_file(path).model, _byte_letters()
        self.model._resize_cache(0)
        self.pretokens = pattern and Pretokens(pattern, self._piece, drops_space=drops_space)

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece[1:].isalpha():
            word = piece if piece[0] != " " else self.space + piece[1:]
        else:
            word = piece.encode("utf-8").decode("latin-1").translate(self.letters)
        return self.packed(*[token.id for token in self.model.tokenize(word)])

    def encode(self, text: str) -> bytes:
        if self.pretokens is None or not PLAIN.fullmatch(text) or self.holds_marker(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        return self.pretokens.encode(text.lower() if self.lower else text)


_loaded: dict[tuple[str, str], LibraryBpe] = {}


def loaded(path: str, dtype: str = "<u4") -> LibraryBpe:
    """The encoder of a vocabulary file, kept by a worker from task to task."""
    if (path, dtype) not in _loaded:
        _loaded[path, dtype] = LibraryBpe(path, dtype)
    return _loaded[path, dtype]
