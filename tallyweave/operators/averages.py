"""Averages over a multi-valued attribute across a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import categories


def category_averages(
    facts: DataFrame,
    dimension: DataFrame,
    key: str,
    value: str,
    category: str,
    separator: str = ",",
) -> DataFrame:
    """Average of the facts' ``value`` per category of the dimension row they belong to.

    Facts are summed per key before the join, so the join moves one row per key, however
    many facts one key has; lists are split after it, when only matched keys are left. A category named twice by a dimension row counts twice; the
    empty category counts; rows with null value, key or category list are skipped.
    """
    per_key = facts.groupBy(key).agg(
        F.sum(value).alias("_sum"), F.count(value).alias("_count")
    )
    named = per_key.filter(F.col("_count") > 0).join(dimension.select(key, category), key)
    return (
        named.select(
            F.explode(categories(F.col(category), separator)).alias("category"), "_sum", "_count"
        )
        .groupBy("category")
        .agg((F.sum("_sum") / F.sum("_count")).alias("average"))
    )


def top_categories(averages: DataFrame, n: int, digits: int | None = None) -> DataFrame:
    """The ``n`` best averages; ties go to the smaller name. With ``digits``, averages are
    rounded first: the last bits of a sum depend on the order of its parts."""
    if digits is not None:
        averages = averages.withColumn("average", F.round("average", digits))
    return averages.orderBy(F.desc("average"), F.asc("category")).limit(n)
