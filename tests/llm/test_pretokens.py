"""Texts cut at spaces and line ends against the libraries' plain calls."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from tallyweave.llm.library_bpe import LibraryBpe
from tallyweave.llm.pretokens import Pretokens

PARTS = ["a", "Word", "it's", "don't", "12", "3.14", ".", ",", "(x)", "é", "ü1", "ß", "日本", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n", "'s", "<|endoftext|>", "\xa0", "\x1c"]


def drawn(seed, count=400):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) + draw.choice(["", " ", "\n", " "]) for _ in range(draw.randint(0, 25))) for _ in range(count)] + ["", "\n", " ", "a\nb", "a\n", "\na"]


@pytest.mark.parametrize("pattern", [public_tokenizers.PATTERN, r"[^\r\n\p{L}\p{N}]?\p{L}+|\p{N}{1,3}| ?[^\s\p{L}\p{N}]+[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"])
def test_same_pretokens_as_the_pattern(pattern):
    pretokens = Pretokens(pattern, lambda piece: piece.encode() + b"|")
    assert pretokens.cuts_lines == (pattern == public_tokenizers.PATTERN)
    for text in drawn(1):
        assert pretokens.encode(text) == b"".join(x.encode() + b"|" for x in regex.findall(pattern, text))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_same_ids_as_the_plain_call(name):
    path = public_tokenizers.path(name)
    own, library, data = LibraryBpe(path), Tokenizer.from_file(path), LibraryBpe(path, markers_as_text=True)
    library_data = Tokenizer.from_file(path)
    library_data.encode_special_tokens = True
    for text in [*drawn(2), "x <|ENDOFTEXT|> y"]:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(data.encode(text), "<u4").tolist() == library_data.encode(text, add_special_tokens=False).ids
