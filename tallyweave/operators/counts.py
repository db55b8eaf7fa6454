"""Counts, distinct counts, word counts and top-k reports.

All of these aggregate before the shuffle, so a key that holds a third of the rows
leaves each map task as one row.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import in_year, tokens


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def year_count(df: DataFrame, date: str, year: int) -> DataFrame:
    """Rows whose date falls in ``year``. Null dates are not counted."""
    return df.filter(in_year(F.col(date), df.schema[date].dataType, year)).agg(
        F.count("*").alias("rows")
    )


def distinct_count(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``key``; null counts as one value."""
    return df.select(key).distinct().agg(F.count("*").alias("distinct"))


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key; null keys form a group."""
    return df.groupBy(key).agg(F.count("*").alias("count"))


def busy_keys(df: DataFrame, key: str, more_than: int) -> DataFrame:
    """Keys with more than ``more_than`` rows."""
    return key_counts(df, key).filter(F.col("count") > more_than)


def top_keys(df: DataFrame, key: str, m: int) -> DataFrame:
    """The ``m`` keys with most rows; ties go to the smaller key."""
    return key_counts(df, key).orderBy(F.desc("count"), F.asc(key)).limit(m)


def word_counts(
    df: DataFrame, text: str, stopwords: DataFrame | Iterable[str] = ()
) -> DataFrame:
    """Occurrences of each word, without empty words and stopwords.

    ``stopwords`` is a word list or a one-column DataFrame, compared as given. It is
    taken out after the aggregation, where there is one row per word, not per occurrence.
    """
    words = df.select(F.explode(tokens(F.col(text))).alias("word")).filter(F.col("word") != "")
    counts = words.groupBy("word").agg(F.count("*").alias("count"))
    if isinstance(stopwords, DataFrame):
        return counts.join(stopwords.toDF("word"), "word", "left_anti")
    listed = list(stopwords)
    return counts.filter(~F.col("word").isin(listed)) if listed else counts


def top_words(
    df: DataFrame, text: str, n: int, stopwords: DataFrame | Iterable[str] = ()
) -> DataFrame:
    """The ``n`` most frequent words; ties go to the smaller word."""
    return word_counts(df, text, stopwords).orderBy(F.desc("count"), F.asc("word")).limit(n)
