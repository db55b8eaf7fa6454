"""Written tables and bounded slices shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..staging import stage, staging_path

#: Bytes of text that vectorised code takes at a time; intermediates are some 30 times as large.
SLICE_BYTES = 1 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder once and return the table, free of its shuffles."""
    return stage(df, name)


def fresh_path(spark: SparkSession, name: str) -> str:
    return staging_path(spark, name)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the strings of ``column`` take about ``limit`` bytes each;
    a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its texts; null counts as empty."""
    filled = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[filled.offset : filled.offset + len(filled) + 1]
    data = filled.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def filtered(df: DataFrame, text_col: str, decide) -> DataFrame:
    """Rows of ``df``, with all columns, for which ``decide(texts)`` is true; ``texts`` is an Arrow
    array of strings. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_col):
            yield batch.filter(pa.array(decide(batch.column(text_col)), pa.bool_()))

    return df.mapInArrow(run, df.schema)
