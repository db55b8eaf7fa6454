"""Readers with explicit schemas; no pass over the data is spent on inference."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("business_id", T.StringType()),
        T.StructField("stars", T.DoubleType()),
        T.StructField("date", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
BUSINESS_SCHEMA = T.StructType(
    [
        T.StructField("business_id", T.StringType()),
        T.StructField("categories", T.StringType()),
        T.StructField("stars", T.DoubleType()),
    ]
)


def read_baskets(
    spark: SparkSession,
    path: str,
    swap: bool = False,
    *,
    header: bool | str = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """``(basket, item)`` from two-column comma-separated text.

    Values are taken as they stand: no quoting, no trimming, an empty field is an empty
    string. ``swap`` takes the second column as the basket. ``header`` is the text of a header
    line, or true for the first line of the input; every row equal to it is dropped, in
    whichever files it stands. A line without exactly two fields fails the read in
    ``FAILFAST`` mode and is skipped in ``DROPMALFORMED`` mode.
    """
    schema = T.StructType(
        [T.StructField("first", T.StringType()), T.StructField("second", T.StringType())]
    )
    rows = (
        spark.read.schema(schema)
        .option("enforceSchema", True)
        .option("quote", "")
        .option("escape", "")
        .option("mode", mode)
        .csv(path)
        .select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("first", "second")))
    )
    if header is True:
        first = spark.read.text(path).first()
        header = first[0] if first else False
    if header is not False:
        names = header.split(",")
        rows = rows.filter(~((F.col("first") == names[0]) & (F.col("second") == F.lit(",".join(names[1:])))))
    basket, item = ("second", "first") if swap else ("first", "second")
    return rows.select(F.col(basket).alias("basket"), F.col(item).alias("item"))


def read_reviews(
    spark: SparkSession,
    path: str,
    schema: T.StructType = REVIEW_SCHEMA,
    *,
    strict: bool = False,
) -> DataFrame:
    """Review records, one JSON object a line; ``strict`` fails on a line that is not one."""
    reader = spark.read.schema(schema).option("mode", "FAILFAST" if strict else "PERMISSIVE")
    return reader.json(path)


def read_businesses(
    spark: SparkSession, path: str, schema: T.StructType = BUSINESS_SCHEMA
) -> DataFrame:
    """Business records without their own ``stars``, which reviews overrule."""
    return spark.read.schema(schema).json(path).drop("stars")


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Word list, one word a line, as one column ``word``."""
    return spark.read.text(path).select(F.col("value").alias("word"))
