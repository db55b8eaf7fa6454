"""JSON writers. Every value is escaped by Spark; rows are written where they are.

Results whose size the caller fixes (top-k reports) become one JSON object. Results that grow with the data are written as rows, never as one array.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as one JSON object with named answers."""
    report.write.json(path)


def write_category_report(report: DataFrame, path: str) -> None:
    """The rows of a category report, best first, as one object ``{"result": [..]}``; the
    report's own ``n`` bounds it."""
    entry = F.struct((-F.col("average")).alias("order"), "category", "average")
    entries = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["category"].alias("category"), e["average"].alias("average")))
    report.agg(entries.alias("result")).write.json(path)


def write_busy_report(layout: DataFrame, counts: DataFrame, path: str) -> None:
    """``{path}/layout``: one ``{partition, rows}`` object a row, as there may be as many
    partitions as the input has splits. ``{path}/result``: one ``{key, count}`` object a row."""
    layout.write.json(f"{path}/layout")
    counts.write.json(f"{path}/result")


def write_itemsets(candidates: DataFrame, itemsets: DataFrame, path: str) -> None:
    """``{path}/candidates`` and ``{path}/frequent``, one folder per itemset size.

    Rows are sorted by items inside each size.
    """
    for name, rows in (("candidates", candidates), ("frequent", itemsets)):
        rows.orderBy("size", "items").write.partitionBy("size").json(f"{path}/{name}")


def write_similar_pairs(pairs: DataFrame, path: str) -> None:
    """One ``{"b1", "b2", "sim"}`` object a line."""
    pairs.select("b1", "b2", "sim").write.json(path)
