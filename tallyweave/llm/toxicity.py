"""Toxic passages by maximum-scoring segment search.

1. Tokens are whole words in lower case, of any length, and their beginnings of 4 and 6
   letters, so that inflected forms of a stem count together. In scripts that are written
   without spaces each character is a word, and its tokens are the two and the three
   characters that start with it. The log-odds of tokens between toxic and clean labelled
   documents use a Dirichlet prior whose shape is the token's share of the whole corpus.
2. A word scores the largest of its tokens' significant log-odds, else a small negative
   drift. One linear scan finds all maximal scoring segments of a text.
3. Under the drift, maxima follow an extreme-value law: a segment of score S in a text of n
   words is expected ``K n exp(-lambda S)`` times by chance. Lambda solves
   ``sum p(s) exp(lambda s) = 1`` over the scores of clean words. The significant segments of a
   text add up their surprise, and a logistic curve fitted on the labelled sample turns the
   sum into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .labelled import labelled_sample
from .tables import text_bytes, text_slices, written
from .words import LETTER_CLASSES, Runs, hash_sums, mixed, runs, span_hashes

#: Labelled rows that log-odds and calibration are fitted on, at most.
SAMPLE_ROWS = 12_000
PRIOR_WEIGHT = 500.0
LEAST_Z = 3.0
LEAST_ODDS = 1.5
MOST_ODDS = 6.0
DRIFT = 0.25
#: The constant K of the extreme-value law, and the surprise up to which a segment is chance.
SEGMENT_K = 0.1
LEAST_SURPRISE = 3.0
#: Letters of a word's beginnings, and characters of the tokens of scripts without spaces.
BEGINNINGS = (4, 6)
NEIGHBOURS = (2, 3)
#: Code points of scripts written without spaces (Thai and Lao, Burmese, Khmer, Han and kana).
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x2E80, 0x2FDF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))


def lower_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts in lower case."""
    return text_bytes(pc.utf8_lower(texts))


def _unspaced(raw: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Of the characters that start at ``firsts``, which are of a script without spaces."""
    out = np.zeros(len(firsts), bool)
    for lead, size in ((0xE0, 3), (0xF0, 4)):
        wide = np.flatnonzero((raw[firsts] >= lead) & (raw[firsts] < lead + 16))
        points = (raw[firsts[wide]] & (0xFF >> (size + 1))).astype(np.int64)
        for i in range(1, size):
            points = points << 6 | raw[firsts[wide] + i] & 0x3F
        for low, high in UNSPACED:
            out[wide] |= (points >= low) & (points <= high)
    return out


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[Runs, list[tuple[np.ndarray, np.ndarray]]]:
    """Words, and for each kind of token the words that have it and its hash."""
    starts_char = (raw & 0xC0) != 0x80
    firsts = np.flatnonzero(starts_char)
    ends = np.append(firsts, len(raw))[1:]
    single = _unspaced(raw, firsts)
    words = runs(raw, offsets, LETTER_CLASSES, cuts=np.concatenate([firsts[single], ends[single]]))
    # places of characters: the first of each word, and the first behind it
    breaks = np.flatnonzero(np.diff(np.append(LETTER_CLASSES[raw], 0).astype(np.int8)) < 0) + 1
    marks = np.zeros(len(raw) + 1, bool)
    for places in (words.starts, breaks, offsets[1:], ends[single]):
        marks[places] = True
    stops = np.flatnonzero(marks)
    stops = stops[np.cumsum(marks)[words.starts]]
    # characters that start before each byte
    before = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(starts_char, out=before[1:])
    at, last = before[words.starts], before[stops]
    sums = hash_sums(raw)
    edges = np.append(firsts, len(raw))
    alone = single[at]
    out = []
    for size in BEGINNINGS:
        own = np.flatnonzero((last - at >= size) & ~alone)
        out.append((own, mixed(span_hashes(raw, words.starts[own], edges[at[own] + size], sums) + np.uint64(size))))
    own = np.flatnonzero(~alone)
    out.append((own, mixed(words.hashes[own] + np.uint64(1))))
    owners = words.owners()
    for size in NEIGHBOURS:
        own = np.flatnonzero(alone[: len(at) - size + 1])
        ahead = own + size - 1
        together = (at[ahead] - at[own] == size - 1) & (owners[ahead] == owners[own])
        for i in range(1, size):
            together &= alone[own + i]
        own, ahead = own[together], ahead[together]
        out.append((own, mixed(span_hashes(raw, words.starts[own], stops[ahead], sums) + np.uint64(100 + size))))
    return words, out


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per slice: ``token``, its uses in toxic and clean texts, and the texts it is in."""
    for batch in text_slices(batches):
        words, kinds = _tokens(*lower_bytes(batch.column("text")))
        toxic = batch.column("label").to_numpy()[words.owners()] == 1
        owners = words.owners().astype(np.uint64)
        for own, hashes in kinds:
            tokens, at = np.unique(hashes, return_inverse=True)
            pairs = np.unique(mixed(hashes + owners[own] * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
            uses = np.bincount(at, minlength=len(tokens))
            hits = np.bincount(at, toxic[own], len(tokens)).astype(np.int64)
            texts = np.bincount(at[pairs], minlength=len(tokens))
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens.view(np.int64)), pa.array(hits), pa.array(uses - hits), pa.array(texts)],
                names=["token", "toxic", "clean", "texts"],
            )


class ToxicModel(NamedTuple):
    """Sorted token hashes with their scores, lambda of the law, and the logistic curve."""

    tokens: np.ndarray
    scores: np.ndarray
    decay: float
    curve: tuple[float, float]


def _word_scores(raw: np.ndarray, offsets: np.ndarray, tokens: np.ndarray, scores: np.ndarray) -> tuple[Runs, np.ndarray]:
    words, kinds = _tokens(raw, offsets)
    out = np.full(len(words.hashes), -DRIFT)
    if len(tokens):
        for own, hashes in kinds:
            at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
            hit = tokens[at] == hashes
            np.maximum.at(out, own[hit], scores[at[hit]])
    return words, out


def maximal_segments(positions: list[int], scores: list[float], drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of a sequence that scores ``scores`` at ``positions`` and
    ``-drift`` elsewhere: ``(first, last, score)``, both inside.

    Linear: a candidate keeps the sums before and after it and a link to the nearest earlier
    one that starts lower, so each is passed once.
    """
    kept: list[tuple[float, float, int, int, int]] = []
    total, at = 0.0, -1
    for position, score in zip(positions, scores):
        before = total - drift * (position - at - 1)
        total, at = before + score, position
        low, high, first, last = before, total, position, position
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][0] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][1] >= high:
                kept.append((low, high, first, last, j))
                break
            low, first, up = kept[j][0], kept[j][2], kept[j][4]
            del kept[j:]
            j = up
    return [(first, last, high - low) for low, high, first, last, _ in kept]


def _passages(raw: np.ndarray, offsets: np.ndarray, model: ToxicModel) -> tuple[Runs, list[list[tuple[int, int, float]]]]:
    """Significant segments of each text, as word numbers within it and their surprise."""
    words, scores = _word_scores(raw, offsets, model.tokens, model.scores)
    positive = np.flatnonzero(scores > 0)
    bounds = np.searchsorted(positive, words.bounds)
    out: list[list[tuple[int, int, float]]] = []
    for i, (start, stop) in enumerate(zip(bounds[:-1], bounds[1:])):
        found = []
        if stop > start:
            own = positive[start:stop]
            size = float(words.bounds[i + 1] - words.bounds[i])
            for first, last, score in maximal_segments((own - words.bounds[i]).tolist(), scores[own].tolist()):
                # minus the logarithm of the expected number of such segments
                surprise = model.decay * score - float(np.log(SEGMENT_K * size))
                if surprise > LEAST_SURPRISE:
                    found.append((first, last, surprise))
        out.append(found)
    return words, out


def _surprise(found: list[tuple[int, int, float]]) -> float:
    return float(np.log1p(sum(x[2] for x in found)))


def _decay(counts: np.ndarray, values: np.ndarray) -> float:
    """The positive root of ``sum p(s) exp(lambda s) = 1``."""
    shares = counts / counts.sum()
    low, high = 1e-3, 30.0
    for _ in range(80):
        middle = (low + high) / 2
        if np.sum(shares * np.exp(np.minimum(middle * values, 500))) > 1:
            high = middle
        else:
            low = middle
    return low


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope by Newton's method, held by a weak prior."""
    rows = np.stack([np.ones(len(x)), x], axis=1)
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -35, 35)))
        slope = rows.T @ (p - y) + 1e-2 * weights
        bend = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(2)
        weights = weights - np.linalg.solve(bend, slope)
    return float(weights[0]), float(weights[1])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learn: Column, *, rows: int = SAMPLE_ROWS
) -> ToxicModel:
    """Log-odds and calibration from at most ``rows`` labelled documents for which ``learn``
    holds; the prior from all of ``docs``. Without labels every text scores one half at most.

    The vocabulary is that of the sample: every token that leans to the toxic side and is in
    three of its texts, none left out. Its size is bounded by the sample, not by the corpus."""
    sample = written(labelled_sample(docs, labels, id_col, text_col, label_col, learn, rows), "toxic-sample")
    counts = sample.mapInArrow(_sample_counts, "token long, toxic long, clean long, texts long")
    counts = counts.groupBy("token").agg(*(F.sum(x).alias(x) for x in ("toxic", "clean", "texts")))
    counts = written(counts, "toxic-counts")
    totals = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    n_toxic, n_clean = (float(x or 0) for x in totals)
    # only tokens that lean to the toxic side can score
    leaning = counts.where((F.col("texts") >= 3) & (F.col("toxic") * n_clean > F.col("clean") * n_toxic))
    chosen = leaning.select("token", "toxic", "clean").toArrow()
    tokens = chosen["token"].to_numpy().view(np.uint64)
    sort = np.argsort(tokens)
    tokens = tokens[sort]
    toxic, clean = (chosen[x].to_numpy().astype(np.float64)[sort] for x in ("toxic", "clean"))

    def corpus_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses, seen = np.zeros(len(tokens), np.int64), 0
        for batch in text_slices(batches):
            for own, hashes in _tokens(*lower_bytes(batch.column("text")))[1]:
                seen += len(own)
                at = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
                uses += np.bincount(at[tokens[at] == hashes], minlength=len(tokens))
        some = np.flatnonzero(uses)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(some, -1)), pa.array(np.append(uses[some], seen))], names=["nth", "uses"]
        )

    shape = np.zeros(len(tokens))
    if len(tokens):
        texts = docs.select(F.col(text_col).alias("text"))
        sums = texts.mapInArrow(corpus_counts, "nth long, uses long").groupBy("nth").agg(F.sum("uses").alias("uses")).toArrow()
        nth, uses = sums["nth"].to_numpy(), sums["uses"].to_numpy().astype(np.float64)
        shape[nth[nth >= 0]] = uses[nth >= 0] / max(1.0, uses[nth < 0].sum())
    prior = PRIOR_WEIGHT * shape + 1e-3
    mass = PRIOR_WEIGHT + 1e-3 * len(tokens)
    odds = np.log((toxic + prior) / (n_toxic + mass - toxic - prior)) - np.log((clean + prior) / (n_clean + mass - clean - prior))
    z = odds / np.sqrt(1 / (toxic + prior) + 1 / (clean + prior)) if len(tokens) else odds
    # a token never seen in clean texts has a variance that says little: its uses decide
    sure = (odds >= LEAST_ODDS) & ((z >= LEAST_Z) | ((clean == 0) & (toxic >= 8)))
    best = np.flatnonzero(sure)
    model = ToxicModel(tokens[best], np.minimum(odds[best], MOST_ODDS), 1.0, (0.0, 0.0))

    bins = np.arange(-1, int(4 * MOST_ODDS) + 1) / 4

    def score_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(len(bins), np.int64)
        for batch in text_slices(batches):
            words, scores = _word_scores(*lower_bytes(batch.column("text")), model.tokens, model.scores)
            clean_words = scores[batch.column("label").to_numpy()[words.owners()] == 0]
            found += np.bincount(np.clip(np.round(clean_words * 4).astype(np.int64) + 1, 0, len(bins) - 1), minlength=len(bins))
        yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(found)], names=["score", "words"])

    law = sample.mapInArrow(score_counts, "score double, words long").groupBy("score").agg(F.sum("words").alias("words"))
    seen = {row["score"]: row["words"] for row in law.collect()}
    # a millionth of a use for every score keeps the root finite where clean texts have none
    numbers = np.array([seen.get(float(x), 0) for x in bins]) + 1e-6 * max(1, sum(seen.values())) + 1e-9
    numbers[bins == 0] = 0
    model = model._replace(decay=_decay(numbers, bins))

    def surprises(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            values = [_surprise(x) for x in _passages(*lower_bytes(batch.column("text")), model)[1]]
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.float64()), batch.column("label")], names=["value", "label"])

    # at most ``rows`` rows of two numbers; sorted, so that the order of tasks has no effect
    pairs = np.array(sorted(tuple(r) for r in sample.mapInArrow(surprises, "value double, label int").collect()))
    if len(pairs):
        model = model._replace(curve=_logistic(pairs[:, 0], pairs[:, 1]))
    return model


def score(docs: DataFrame, model: ToxicModel, id_col: str, text_col: str) -> DataFrame:
    """``id, score, passages`` for every row; ``score`` is the probability of label 1, and
    ``passages`` holds each significant toxic passage as its first and last word (runs of
    letters, or single characters of a script without spaces, counted from 0) and its surprise.

    Null and empty texts have no passage and the score that goes with none. Null ids and
    repeated rows are scored like any other; other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    passage = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("surprise", pa.float64())])
    schema = pa.schema(
        [pa.field("id", to_arrow_type(rows.schema["id"].dataType)), pa.field("score", pa.float64()), pa.field("passages", pa.list_(passage))]
    )
    bias, slope = model.curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            found = _passages(*lower_bytes(batch.column("text")), model)[1]
            values = np.array([_surprise(x) for x in found])
            scores = 1 / (1 + np.exp(-np.clip(bias + slope * values, -35, 35)))
            listed = [[{"first": a, "last": b, "surprise": c} for a, b, c in x] for x in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores), pa.array(listed, pa.list_(passage))], schema=schema)

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, score double, passages array<struct<first: long, last: long, surprise: double>>")
