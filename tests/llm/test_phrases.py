"""Collocations against a plain count of every phrase, on small texts of every kind."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import phrases

CLASHING = ("id", "phrase", "words", "n", "key", "shard", "a", "l", "r", "score", "rank", "total")


def plain(rows, support, longest=5, top=2000):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for k in range(1, longest + 1):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        found = {p: a for p, a in own.items() if a >= support and len(p) > 1}
        best = []
        for phrase, a in found.items():
            longer = (q for q, b in found.items() if len(q) > len(phrase) and b >= a)
            if any(q[i : i + len(phrase)] == phrase for q in longer for i in range(len(q))):
                continue
            cuts = []
            for k in range(1, len(phrase)):
                left, right = own[phrase[:k]], own[phrase[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            score, _, left, right = min(cuts)
            best.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(best)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def drawn(seed, rows):
    draw = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "york city", "ab\tab", "é", "日本", "x,y", "z.", "\n", "o\x0bo", "a b", " "]
    langs = ["en", "fr", None, ""]
    return [(" ".join(draw.choices(words, k=draw.randint(0, 30))), draw.choice(langs)) for _ in range(rows)]


ROWS = drawn(1, 120) + [(None, "en"), ("", None), (" \t ", "fr"), ("ha " * 4000, "de")] + [("new york city hall", "en")] * 9


def found(spark, rows, mining, **more):
    docs = spark.createDataFrame(rows, "body string, tongue string").select("*", *(F.lit(7).alias(x) for x in CLASHING))
    return sorted(tuple(x) for x in phrases.collocations(docs, "body", "tongue", mining, **more).collect())


@pytest.mark.parametrize("shards", [1, 3])
def test_equal_to_a_plain_count(spark, shards):
    expected = plain(ROWS, 6)
    assert len({row[0] for row in expected}) == 5
    assert found(spark, ROWS, phrases.Mining(support=6, shards=shards)) == expected


def test_support_below_the_number_of_shards(spark):
    rows = drawn(2, 25)
    assert found(spark, rows, phrases.Mining(support=2, longest=3, shards=5), top=7) == plain(rows, 2, 3, 7)


def test_longest_phrase_of_two_words(spark):
    rows = drawn(3, 30)
    assert found(spark, rows, phrases.Mining(support=3, longest=2)) == plain(rows, 3, 2)


def test_empty_tables(spark):
    assert found(spark, [], phrases.Mining()) == found(spark, [(None, None)], phrases.Mining()) == []


def test_ties_go_to_the_smaller_bytes(spark):
    rows = [("b a. a b. é a. z b", "en")] * 3
    got = found(spark, rows, phrases.Mining(support=3, shards=2))
    assert got == plain(rows, 3) and [x[2] for x in got] == ["z b", "é a", "a b", "b a"]


def test_full_bit_maps_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MOST_BITS", 15)
    monkeypatch.setattr(phrases, "_in_map", lambda bits, keys: np.ones(len(keys), bool))
    rows = drawn(4, 40)
    assert found(spark, rows, phrases.Mining(support=4)) == plain(rows, 4)


def test_scores_pass_64_bits(spark):
    """A phrase of a large corpus: the product of its numbers is beyond 2**63."""
    a, n = 3 * 10**9, 7 * 10**13
    row = spark.createDataFrame([(a, n, a, a)], "a long, n long, l long, r long")
    score = row.select(F.expr("cast(a as decimal(17)) * cast(n as decimal(17)) * 1000bd div (cast(l as decimal(19)) * cast(r as decimal(19)))"))
    assert score.first()[0] == 1000 * a * n // (a * a)


def test_only_phrases_frequent_everywhere_are_counted_as_text(spark):
    """With a support of one in each shard every phrase is a candidate; few texts leave the tasks."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(30)) for _ in range(200)]
    docs = spark.createDataFrame([(x + " one two three", "en") for x in texts], "text string, lang string").repartition(2)
    mining = phrases.Mining(support=40, shards=40)
    rows = docs.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(mining.shards)).cast("int"))
    of, bits, _ = phrases._candidates(rows, mining)
    counted = rows.mapInArrow(phrases._counter(of, bits), "lang string, phrase string, words int, n long")
    assert {"one", "two three", "one two three"} <= {r["phrase"] for r in counted.collect()}
    every = sum(len({tuple(x.split()[i : i + k]) for x in texts for i in range(31 - k)}) for k in range(1, 6))
    assert counted.count() < every / 20
