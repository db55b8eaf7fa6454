"""Whole reports put together from the operators."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import in_year
from ..operators.averages import category_averages, top_categories
from ..operators.counts import busy_keys, top_words
from ..operators.itemsets import frequent_itemsets, son_candidates
from ..operators.layout import hash_layout, partition_layout
from ..staging import stage


class BusyReport(NamedTuple):
    layout: DataFrame
    result: DataFrame


class ItemsetReport(NamedTuple):
    candidates: DataFrame
    frequent: DataFrame


def exploration_report(
    reviews: DataFrame,
    year: int,
    m: int = 10,
    n: int = 10,
    stopwords: DataFrame | Iterable[str] = (),
    *,
    texts: DataFrame | None = None,
    user: str = "user_id",
    date: str = "date",
    text: str = "text",
) -> DataFrame:
    """One row with the answers A to E.

    A: reviews; B: reviews of ``year``; C: distinct users; D: the ``m`` users with most
    reviews and their counts; E: the ``n`` most frequent words, of ``texts`` if they are a
    table of their own. A to D come from one pass
    that leaves a row per user, E from a pass over the text.
    """
    dated = in_year(F.col(date), reviews.schema[date].dataType, year)
    per_user = stage(
        reviews.groupBy(user).agg(F.count("*").alias("count"), F.count_if(dated).alias("in_year")),
        "users",
    )
    totals = per_user.selectExpr(
        "coalesce(sum(count), 0) AS A", "coalesce(sum(in_year), 0) AS B", "count(*) AS C"
    )
    users = per_user.orderBy(F.desc("count"), F.asc(user)).limit(m).agg(
        F.transform(
            _by_rank(user), lambda e: F.struct(e["name"].alias(user), (-e["order"]).alias("count"))
        ).alias("users")
    )
    words = top_words(reviews if texts is None else texts, text, n, stopwords).agg(_by_rank("word")["name"].alias("words"))
    return totals.select("A", "B", "C", users.scalar().alias("D"), words.scalar().alias("E"))


def _by_rank(name: str) -> Column:
    """Top-k rows as one array in rank order; its length is the k of the report."""
    entry = F.struct((-F.col("count")).alias("order"), F.col(name).alias("name"))
    return F.array_sort(F.collect_list(entry))


def category_report(
    reviews: DataFrame,
    businesses: DataFrame,
    n: int = 10,
    *,
    key: str = "business_id",
    stars: str = "stars",
    category: str = "categories",
    separator: str = ",",
    digits: int | None = None,
) -> DataFrame:
    """The ``n`` categories with the best average of review stars."""
    averages = category_averages(reviews, businesses, key, stars, category, separator)
    return top_categories(averages, n, digits)


def busy_report(
    reviews: DataFrame,
    more_than: int = 200,
    *,
    key: str = "business_id",
    n_partitions: int | None = None,
    partition_by: str = "review_id",
) -> BusyReport:
    """Partition layout, and the keys with more than ``more_than`` rows.

    Without ``n_partitions`` the layout is that of the data as read; with it, that of a
    hash partitioning by ``partition_by``.
    """
    layout = (
        partition_layout(reviews)
        if n_partitions is None
        else hash_layout(reviews, n_partitions, partition_by)
    )
    return BusyReport(layout, busy_keys(reviews, key, more_than))


def itemset_report(
    baskets: DataFrame,
    min_support: int,
    min_basket_size: int = 0,
    n_chunks: int = 2,
    *,
    basket: str = "basket",
    item: str = "item",
) -> ItemsetReport:
    """Candidates of the chunks, and the frequent itemsets with their support."""
    return ItemsetReport(
        son_candidates(baskets, basket, item, min_support, n_chunks, min_basket_size),
        frequent_itemsets(baskets, basket, item, min_support, min_basket_size),
    )
