"""Written intermediate tables.

Iterative operators cut their lineage by writing a table to the shared folder the
cluster names in ``spark.checkpoint.dir`` and reading it back. A lost executor then
costs one stage, not the whole loop, and the optimizer sees true file sizes, so a join
against a staged table is broadcast only when that table is known to be small.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staging_root(spark: SparkSession) -> str:
    """Folder that holds this application's staged tables."""
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not shared:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if sc.applicationId not in _local_roots:
            _local_roots[sc.applicationId] = tempfile.mkdtemp(prefix="tallyweave-", dir="/tmp")
        shared = _local_roots[sc.applicationId]
    return f"{shared.rstrip('/')}/tallyweave-{sc.applicationId}"


def staging_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the staging root; never reused."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that starts and ends here are dropped when it has ended."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def first_row(df: DataFrame) -> Row | None:
    """``df.first()``, free of its shuffles."""
    with shuffles_dropped(df.sparkSession):
        return df.first()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table, free of its shuffles."""
    path = staging_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``stage`` that nothing reads any more: all that came of them is staged, too."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Even parts for every core, for rows that are small now and expand when read."""
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *columns)


def stage_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Like ``stage``, with the number of rows, counted while they are written."""
    seen = Observation(name)
    table = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return table, seen.get["rows"]
