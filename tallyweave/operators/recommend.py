"""Item-based collaborative filtering: a model of item pairs, and predictions from it.

The model holds the correlation of two items over the users who rated both. It is one aggregate
of running moments; no list of ratings is built. A rater with very many items has a quadratic
number of item pairs, but fewer such raters than ``min_co_raters`` cannot carry a pair alone: up to
one less than that many of the heaviest raters are not expanded, and add to the pairs that
lighter raters have. What remains of heavy raters is cut into pair cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .pairs import pairs_within

#: Items of a rater above which it may be left out of the expansion. It changes no result.
HEAVY_RATER = 2_000

#: Decimals of a weight, so that equal weights are equal whatever order their sums were taken in.
WEIGHT_DECIMALS = 9

_MOMENTS = {"n": "1L", "sx": "x", "sy": "y", "sxx": "x * x", "syy": "y * y", "sxy": "x * y"}


def mean_ratings(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """``(user, item, rating)``: one mean rating of each user and item. Rows with a null user,
    item or rating, and ratings that are not numbers, are skipped."""
    rows = df.select(F.col(user).alias("user"), F.col(item).alias("item"), F.col(rating).cast("double").alias("rating"))
    rows = rows.dropna().where("NOT isnan(rating)")
    return rows.groupBy("user", "item").agg(F.avg("rating").alias("rating"))


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("item_1", "item_2").agg(*(F.expr(f"sum({x}) AS {name}") for name, x in _MOMENTS.items()))


def _weight() -> Column:
    spread = F.expr("(n * sxx - sx * sx) * (n * syy - sy * sy)")
    return F.when(spread > 0, F.round(F.expr("n * sxy - sx * sy") / F.sqrt(spread), WEIGHT_DECIMALS))


def item_model(
    df: DataFrame, user: str, item: str, rating: str, min_co_raters: int = 3, *, heavy: int = HEAVY_RATER
) -> DataFrame:
    """``(item_1, item_2, co_raters, weight)`` of the pairs ``item_1 < item_2`` that
    ``min_co_raters`` users or more have rated: Pearson's correlation over these users.

    A user's repeated ratings of an item count as their mean. Pairs of which one item has the same
    rating from all co-raters have no correlation and are left out. Empty input gives no pairs.
    """
    if min_co_raters < 2:
        raise ValueError("a correlation needs two co-raters or more")
    ratings = stage(mean_ratings(df, user, item, rating), "ratings")
    popular = ratings.groupBy("item").agg(F.count("*").alias("_raters")).filter(F.col("_raters") >= min_co_raters)
    ratings = stage(ratings.join(popular.select("item"), "item", "left_semi"), "popular-ratings")
    sizes = ratings.groupBy("user").agg(F.count("*").alias("_items"))
    # one less than a pair needs: at most so many rows
    apart = sizes.filter(F.col("_items") > heavy).orderBy(F.desc("_items"), "user").limit(min_co_raters - 1)
    apart = stage(apart.select("user"), "heavy-raters")
    n_apart = apart.count()
    light = ratings.join(apart, "user", "left_anti") if n_apart else ratings
    pairs = pairs_within(light, ["user"], "item", ["rating"], by_first=True)
    found = _sums(pairs.selectExpr("item_1", "item_2", "rating_1 AS x", "rating_2 AS y"))
    found = found.filter(F.col("n") >= min_co_raters - n_apart)
    if n_apart:
        found = stage(found, "light-pairs")
        known = stage(ratings.join(apart, "user", "left_semi"), "heavy-ratings")
        left, right = (known.selectExpr("user", f"item AS item_{i}", f"rating AS {x}") for i, x in ((1, "x"), (2, "y")))
        more = found.select("item_1", "item_2").join(left, "item_1").join(right, ["user", "item_2"])
        found = found.unionByName(_sums(more)).groupBy("item_1", "item_2").agg(*(F.sum(x).alias(x) for x in _MOMENTS))
        found = found.filter(F.col("n") >= min_co_raters)
    return (
        found.withColumn("weight", _weight())
        .filter("weight IS NOT NULL")
        .select("item_1", "item_2", F.col("n").alias("co_raters"), "weight")
    )


def predict_ratings(
    wanted: DataFrame,
    ratings: DataFrame,
    model: DataFrame,
    n_neighbours: int = 3,
) -> DataFrame:
    """``(user, item, neighbours, prediction)`` for each distinct ``(user, item)`` of ``wanted``.

    ``ratings`` is that of ``mean_ratings``, ``model`` that of ``item_model``. The neighbours are the
    items that the user has rated and that correlate positively with the item; the
    ``n_neighbours`` strongest count, of equal ones the smaller items, and the prediction is
    the average of their ratings by weight. Without neighbours it is the mean rating of the
    item, of an item that nobody has rated the mean of all ratings (null if there is none).
    Rows of ``wanted`` with a null user or item are skipped.
    """
    wanted = wanted.select("user", "item").dropna().distinct()
    ratings = stage(ratings, "ratings")
    positive = model.filter("weight > 0")
    both = positive.selectExpr("item_1 AS item", "item_2 AS other", "weight").unionByName(
        positive.selectExpr("item_2 AS item", "item_1 AS other", "weight")
    )
    others = ratings.selectExpr("user", "item AS other", "rating")
    near = wanted.join(both, "item").join(others, ["user", "other"])
    # Spark keeps the first rows of each group before it shuffles them
    order = Window.partitionBy("user", "item").orderBy(F.desc("weight"), "other")
    best = near.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= n_neighbours)
    best = best.groupBy("user", "item").agg(
        F.count("*").alias("neighbours"), (F.sum(F.col("weight") * F.col("rating")) / F.sum("weight")).alias("_near")
    )
    means = ratings.groupBy("item").agg(F.avg("rating").alias("_mean"))
    overall = ratings.agg(F.avg("rating").alias("_overall")).first()[0]
    return (
        wanted.join(best, ["user", "item"], "left")
        .join(means, "item", "left")
        .select(
            "user",
            "item",
            F.coalesce("neighbours", F.lit(0)).alias("neighbours"),
            F.coalesce("_near", "_mean", F.lit(overall).cast("double")).alias("prediction"),
        )
    )
