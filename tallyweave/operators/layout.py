"""Rows per partition, as read or after hash partitioning."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _rows_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sum(batch.num_rows for batch in batches)
    columns = [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([rows], pa.int64())]
    yield pa.RecordBatch.from_arrays(columns, names=["partition", "rows"])


def _with_empty(counts: DataFrame, n_partitions: int) -> DataFrame:
    every = counts.sparkSession.range(n_partitions).select(F.col("id").cast("int").alias("partition"))
    return every.join(counts, "partition", "left").select(
        "partition", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows")
    )


def partition_layout(df: DataFrame) -> DataFrame:
    """Rows in each partition of ``df`` as it is; empty partitions show as 0.

    Every partition reports itself, in the one execution that counts it. All columns are kept
    alive up to there by a hash, as Spark sizes partitions after a shuffle by their bytes.
    """
    values = [F.map_entries(c) if df.schema[c].dataType.typeName() == "map" else F.col(f"`{c}`") for c in df.columns]
    return df.select(F.xxhash64(*values).alias("row")).mapInArrow(_rows_of_partition, "partition int, rows long")


def hash_layout(df: DataFrame, n_partitions: int, *columns: str) -> DataFrame:
    """Rows each partition would hold after ``df.repartition(n_partitions, *columns)``.

    The target partition is computed from the hash, so no row moves to be counted.
    """
    target = F.pmod(F.hash(*columns), F.lit(n_partitions))
    counts = df.groupBy(target.alias("partition")).agg(F.count("*").alias("rows"))
    return _with_empty(counts, n_partitions)
