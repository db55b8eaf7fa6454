"""Quality rules by compression bands.

A text is compressed as a whole and in fixed chunks with zstandard. Its ratio, compressed to
raw bytes, must lie in a band that depends on its length: below it the text repeats itself,
above it there is nothing to compress. A text that is sound as a whole is still rejected if
too much of it lies in chunks outside the band for chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .tables import filtered, text_bytes, text_slices
from .words import WHITE, WORD_CLASSES, mixed, runs, totals, windows

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_WHITE_SIGNS = " \t\n\x0b\x0c\r"


class Bands(NamedTuple):
    """``limits``: rows (bytes from, least ratio, most ratio), ascending; the first starts at 0.
    A text is cut into chunks of ``chunk_bytes``; a rest of less than ``least_chunk`` bytes joins
    the chunk before it. Of a text's bytes at most the share ``most_bad`` may lie in chunks
    outside ``chunk_limits``. A text below ``least_chunk`` is judged as a whole only."""

    limits: tuple[tuple[int, float, float], ...] = (
        (0, 0.30, 2.00),
        (256, 0.48, 0.92),
        (512, 0.46, 0.80),
        (1024, 0.43, 0.70),
        (2048, 0.415, 0.65),
        (4096, 0.395, 0.61),
        (8192, 0.385, 0.57),
        (16384, 0.36, 0.55),
        (65536, 0.33, 0.55),
    )
    level: int = 3
    chunk_bytes: int = 2048
    least_chunk: int = 512
    chunk_limits: tuple[float, float] = (0.30, 0.85)
    most_bad: float = 0.3


def _compression(text: bytes, compress, bands: Bands) -> tuple[float | None, float, bool]:
    """Ratio of the whole, share of bytes in chunks outside their band, verdict."""
    if not text:
        return None, 0.0, False
    whole = len(compress(text)) / len(text)
    low, high = next((low, high) for start, low, high in reversed(bands.limits) if len(text) >= start)
    cuts = list(range(0, len(text), bands.chunk_bytes))
    if len(text) - cuts[-1] < bands.least_chunk:
        cuts.pop()
    bad = 0
    for start, stop in zip(cuts, [*cuts[1:], len(text)]):
        ratio = whole if stop - start == len(text) else len(compress(text[start:stop])) / (stop - start)
        bad += (stop - start) * (not bands.chunk_limits[0] <= ratio <= bands.chunk_limits[1])
    share = bad / len(text)
    return whole, share, low <= whole <= high and share <= bands.most_bad


def _repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(_WHITE_SIGNS)]
    return len(lines) - len(set(lines))


def _repeated_words(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text its words that lie in a window of three found twice or more in it."""
    owners = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found = windows(hashes, 3)
    covered = np.zeros(len(hashes), bool)
    if len(found):
        inside = np.flatnonzero(owners[2:] == owners[:-2])
        keys = mixed(found[inside] + owners[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order][1:] == keys[order][:-1]
        again = np.zeros(len(keys), bool)
        again[order[1:]] |= same
        again[order[:-1]] |= same
        for step in range(3):
            covered[inside[again] + step] = True
    return totals(covered, bounds)


def _judged(texts: pa.Array, compress, bands: Bands) -> list:
    """The columns that ``quality_rules`` adds, verdict last."""
    raw, offsets = text_bytes(texts)
    words = runs(raw, offsets, WORD_CLASSES)
    n_words = np.diff(words.bounds)
    repeated = _repeated_words(words.hashes, words.bounds)
    failed = (n_words < 50) | (100 * repeated > 50 * n_words)
    data = raw.tobytes()
    verdicts = [_compression(data[a:b], compress, bands) for a, b in zip(offsets[:-1], offsets[1:])]
    return [
        n_words,
        totals(~WHITE[raw] & ((raw & 0xC0) != 0x80), offsets),
        totals(_SYMBOLS[raw], offsets),
        [_repeated_lines(text or "") for text in texts.to_pylist()],
        repeated,
        failed,
        [x[0] for x in verdicts],
        [x[1] for x in verdicts],
        [bool(x[2] and not bad) for x, bad in zip(verdicts, failed)],
    ]


def quality_rules(docs: DataFrame, id_col: str, text_col: str, bands: Bands = Bands()) -> DataFrame:
    """One row per input row: ``id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, whole_ratio, bad_share, kept``.

    A word is a run of anything but space and U+0009 to U+000D. A null text has no words and
    fails like an empty one, with a null ratio. Null ids and repeated rows pass through; other
    columns are not read, whatever their names. ``kept`` is false where the counts fail, else
    the verdict of the bands.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    kinds = [(x, pa.int64()) for x in counts]
    kinds += [("base_failed", pa.bool_()), ("whole_ratio", pa.float64()), ("bad_share", pa.float64()), ("kept", pa.bool_())]
    schema = pa.schema([pa.field("id", to_arrow_type(rows.schema["id"].dataType)), *kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=bands.level).compress
        for batch in text_slices(batches):
            columns = _judged(batch.column("text"), compress, bands)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(x, kind) for x, (_, kind) in zip(columns, kinds))], schema=schema
            )

    kind = rows.schema["id"].dataType.simpleString()
    ddl = ", ".join(f"{x} long" for x in counts)
    return rows.mapInArrow(run, f"id {kind}, {ddl}, base_failed boolean, whole_ratio double, bad_share double, kept boolean")


def accepted(docs: DataFrame, text_col: str, bands: Bands = Bands()) -> DataFrame:
    """Rows of ``docs``, with all columns, that the rules keep."""

    def decide(texts: pa.Array) -> list[bool]:
        return _judged(texts, zstandard.ZstdCompressor(level=bands.level).compress, bands)[-1]

    return filtered(docs, text_col, decide)
