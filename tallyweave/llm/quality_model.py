"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

1. Random indexing over all documents: each token has a sparse random index vector, drawn by
   its hash; the vector of a token is the sum of the index vectors of its neighbours. Tokens
   share a table of fixed size by hash, so a task adds up one small table and tables are summed
   part by part.
2. A document is the mean and the maximum of its tokens' vectors, scaled to length one, and
   the logarithm of its length.
3. A network with one hidden layer, fitted in numpy on a bounded sample of labelled rows. Its
   probabilities are calibrated by a temperature chosen on a part of the sample that the
   weights were not fitted on.

Tokens are runs of letters, digits or signs, case kept, digits alike. A token that repeats
the one before it counts as a token of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .labelled import SAMPLE_ROWS, labelled_sample
from .tables import filtered, text_bytes, text_slices
from .words import TOKEN_CLASSES, mixed, runs

ROW_BITS = 13
DIMENSIONS = 32
NONZEROS = 2
REACH = 2
PARTS = 64
HIDDEN = 32


def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table row of each token and the bounds of each text; row 0 is a repeated token."""
    found = runs(raw, offsets, TOKEN_CLASSES, digits_alike=True)
    rows = (found.hashes >> np.uint64(64 - ROW_BITS)).astype(np.int64)
    rows[rows == 0] = 1
    same = np.zeros(len(rows), bool)
    same[1:] = found.hashes[1:] == found.hashes[:-1]
    same[found.bounds[:-1][found.bounds[:-1] < len(rows)]] = False
    rows[same] = 0
    return rows, found.bounds


def _index_vectors() -> list[tuple[np.ndarray, np.ndarray]]:
    """For each nonzero of the index vectors: its dimension and sign, by table row."""
    rows = np.arange(1 << ROW_BITS, dtype=np.uint64)
    drawn = [mixed(rows * np.uint64(NONZEROS) + np.uint64(i + 1)) for i in range(NONZEROS)]
    return [((x % np.uint64(DIMENSIONS)).astype(np.int64), np.where(x >> np.uint64(63), 1.0, -1.0)) for x in drawn]


def _co_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = (1 << ROW_BITS) * DIMENSIONS
    table, index = np.zeros(size), _index_vectors()
    for batch in text_slices(batches):
        rows, bounds = _tokens(*text_bytes(batch.column("text")))
        owners = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        for reach in range(1, REACH + 1):
            inside = owners[reach:] == owners[:-reach]
            left, right = rows[:-reach][inside], rows[reach:][inside]
            for word, neighbour in ((left, right), (right, left)):
                for dimension, sign in index:
                    table += np.bincount(word * DIMENSIONS + dimension[neighbour], sign[neighbour], size)
    parts = np.split(table.astype(np.float32), PARTS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(range(PARTS), pa.int32()), pa.array([x.tobytes() for x in parts], pa.binary())], names=["part", "sums"]
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, raw in zip(batch.column("part").to_pylist(), batch.column("sums").to_pylist()):
            values = np.frombuffer(raw, np.float32).astype(np.float64)
            sums[part] = sums[part] + values if part in sums else values
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["part", "sums"]
    )


def word_vectors(docs: DataFrame, text_col: str) -> np.ndarray:
    """Unit vectors by table row, from the neighbours of every token of every text."""
    texts = docs.select(F.col(text_col).alias("text"))
    parts = texts.mapInArrow(_co_occurrences, "part int, sums binary").repartition(PARTS, "part")
    # PARTS rows, of one table of fixed size in all
    summed = sorted((r["part"], r["sums"]) for r in parts.mapInArrow(_summed, "part int, sums binary").collect())
    size = (1 << ROW_BITS) * DIMENSIONS
    flat = np.concatenate([np.frombuffer(x, np.float64) for _, x in summed]) if summed else np.zeros(size)
    table = flat.reshape(-1, DIMENSIONS)
    table = np.sign(table) * np.log1p(np.abs(table))
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(raw: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of each text: mean and maximum of its tokens' vectors, share of repeated
    tokens, logarithm of the number of tokens. A text without tokens is all zeros."""
    rows, bounds = _tokens(raw, offsets)
    counts = np.diff(bounds)
    out = np.zeros((len(counts), 2 * DIMENSIONS + 2), np.float64)
    full = np.flatnonzero(counts)
    if len(full):
        drawn = vectors[rows]
        out[full, :DIMENSIONS] = np.add.reduceat(drawn, bounds[full], axis=0) / counts[full, None]
        out[full, DIMENSIONS : 2 * DIMENSIONS] = np.maximum.reduceat(drawn, bounds[full], axis=0)
        out[full, -2] = np.add.reduceat((rows == 0).astype(np.float64), bounds[full]) / counts[full]
        out[full, -1] = np.log1p(counts[full]) / 10
    return out


class Network(NamedTuple):
    """Standardised input, one hidden layer of rectified units, one output, a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    inner: np.ndarray
    inner_bias: np.ndarray
    outer: np.ndarray
    outer_bias: float
    temperature: float

    def logits(self, features: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((features - self.mean) / self.scale) @ self.inner + self.inner_bias, 0)
        return hidden @ self.outer + self.outer_bias

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(features) / self.temperature, -35, 35)))


def fit_network(features: np.ndarray, labels: np.ndarray, *, steps: int = 1500, seed: int = 7) -> Network:
    """Adam on the log loss of four fifths of the rows; the rest sets the temperature."""
    draw = np.random.default_rng(seed)
    width = features.shape[1]
    if not len(labels) or labels.min() == labels.max():
        sure = 0.0 if not len(labels) else 4.0 if labels[0] else -4.0
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), sure, 1.0)
    order = draw.permutation(len(labels))
    fit, rest = order[len(order) // 5 :], order[: len(order) // 5]
    mean, scale = features[fit].mean(0), features[fit].std(0) + 1e-6
    x, y = (features - mean) / scale, labels.astype(np.float64)
    weights = [draw.normal(0, np.sqrt(2 / width), (width, HIDDEN)), np.zeros(HIDDEN), draw.normal(0, np.sqrt(1 / HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        at = fit[draw.integers(0, len(fit), min(512, len(fit)))]
        hidden = np.maximum(x[at] @ weights[0] + weights[1], 0)
        error = (1 / (1 + np.exp(-np.clip(hidden @ weights[2] + weights[3], -35, 35))) - y[at]) / len(at)
        back = np.outer(error, weights[2]) * (hidden > 0)
        slopes = [x[at].T @ back + 1e-4 * weights[0], back.sum(0), hidden.T @ error + 1e-4 * weights[2], error.sum(keepdims=True)]
        rate = 5e-3 * (1 - step / (steps + 1))
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.999 * second[i] + 0.001 * slope**2
            weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    network = Network(mean, scale, *weights[:3], float(weights[3][0]), 1.0)
    if len(rest):
        logits, truth = network.logits(features[rest]), y[rest]
        tried = np.geomspace(0.25, 8, 61)
        losses = [np.mean(np.logaddexp(0, logits / t) - truth * logits / t) for t in tried]
        network = network._replace(temperature=float(tried[int(np.argmin(losses))]))
    return network


class QualityModel(NamedTuple):
    vectors: np.ndarray
    network: Network


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learn: Column, *, rows: int = SAMPLE_ROWS
) -> QualityModel:
    """Word vectors from all of ``docs``; a network from at most ``rows`` labelled ones for
    which ``learn`` holds. Without labels, or with one kind only, scores are constant."""
    vectors = word_vectors(docs, text_col)
    sample = labelled_sample(docs, labels, id_col, text_col, label_col, learn, rows)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            features = pooled(*text_bytes(batch.column("text")), vectors)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.tobytes() for x in features.astype(np.float32)], pa.binary()), batch.column("label")],
                names=["features", "label"],
            )

    # at most ``rows`` rows of a fixed width; sorted, so that the order of tasks has no effect
    found = sorted((r["features"], r["label"]) for r in sample.mapInArrow(featured, "features binary, label int").collect())
    width = 2 * DIMENSIONS + 2
    features = np.frombuffer(b"".join(bytes(x) for x, _ in found), np.float32).reshape(-1, width).astype(np.float64)
    return QualityModel(vectors, fit_network(features, np.array([y for _, y in found])))


def score(docs: DataFrame, model: QualityModel, id_col: str, text_col: str) -> DataFrame:
    """``id, score`` for every row; ``score`` is the probability of label 1.

    Null and empty texts have the score of a text without tokens. Null ids and repeated rows
    are scored like any other; other columns are not read, whatever their names.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = pa.schema([pa.field("id", to_arrow_type(rows.schema["id"].dataType)), pa.field("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            scores = model.network.scores(pooled(*text_bytes(batch.column("text")), model.vectors))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], schema=schema)

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, score double")


def accepted(docs: DataFrame, model: QualityModel, text_col: str, least: float) -> DataFrame:
    """Rows of ``docs``, with all columns, whose score is at least ``least``."""
    return filtered(docs, text_col, lambda texts: model.network.scores(pooled(*text_bytes(texts), model.vectors)) >= least)
