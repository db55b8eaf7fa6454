from __future__ import annotations

import numpy as np
import pyarrow as pa

from tallyweave.llm import toxicity, words
from tallyweave.llm.words import mixed, span_hashes

TEXTS = ["Шел мальчик; alpha alphabet x", "", "漢字かな abc", None, "é漢字b"]


def hash_of(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw)]))


def tokens():
    return toxicity._tokens(*toxicity.lower_bytes(pa.array(TEXTS, pa.string())))


def test_bytes_are_hashed_once_for_words_and_once_for_all_their_parts(monkeypatch):
    tokens()
    calls = []
    powers = words._powers_of
    monkeypatch.setattr(words, "_powers_of", lambda base, n: calls.append(base) or powers(base, n))
    tokens()
    assert calls.count(words._FACTOR) == 2


def test_tokens_are_words_beginnings_and_neighbours():
    found, (fours, sixes, whole, twos, threes) = tokens()
    assert found.bounds.tolist() == [0, 5, 5, 10, 10, 14]

    def expected(texts, extra):
        return np.concatenate([mixed(hash_of(text) + np.uint64(extra)) for text in texts]).tolist()

    assert fours[0].tolist() == [1, 2, 3]
    assert fours[1].tolist() == expected(["маль", "alph", "alph"], 4)
    assert sixes[1].tolist() == expected(["мальчи", "alphab"], 6)
    assert whole[1].tolist() == expected(["шел", "мальчик", "alpha", "alphabet", "x", "abc", "é", "b"], 1)
    assert twos[1].tolist() == expected(["漢字", "字か", "かな", "漢字"], 102)
    assert threes[1].tolist() == expected(["漢字か", "字かな"], 103)
