"""Bounded samples of labelled rows for models that are fitted on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on, at most.
SAMPLE_ROWS = 20_000


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Rows of the fold that no label is learnt from: crc32 of the id, written as text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, learn: Column, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled documents for which ``learn`` (over the
    columns of ``labels``) holds.

    The rows are those with the smallest hashes of their ids, so the sample depends on nothing
    but the ids. Rows without an id or label are passed over; ids repeated in ``labels`` count
    once with their largest label. The sample of ids is broadcast: ``rows`` bounds it.
    """
    known = labels.where(learn & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("sample_id")).agg(F.max(label_col).cast("int").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.lit("sample"), "sample_id"), "sample_id").limit(rows)
    texts = docs.select(F.col(id_col).alias("doc_key"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("doc_key") == F.col("sample_id")).select("text", "label")
