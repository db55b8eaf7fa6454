from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.operators import (
    busy_keys,
    category_averages,
    distinct_count,
    hash_layout,
    key_counts,
    partition_layout,
    row_count,
    top_categories,
    top_keys,
    top_words,
    word_counts,
    year_count,
)
from tallyweave.plans import busy_report, category_report, exploration_report

REVIEWS = "user_id string, business_id string, stars double, date string, text string, review_id string"


def reviews(spark):
    return spark.createDataFrame(
        [
            ("u1", "b1", 5.0, "2018-01-01", "Good good food.", "r1"),
            ("u2", "b1", 1.0, "2018-02-01", "bad, bad (food)", "r2"),
            ("u2", "b2", 3.0, "2017-02-01", "THE the", "r3"),
            ("u1", "b2", None, None, None, "r4"),
            (None, "b3", 4.0, "2018", "", "r5"),
            (None, "b4", 4.0, "2018", "ok", "r6"),
        ],
        REVIEWS,
    )


def test_counts(spark):
    df = reviews(spark)
    assert row_count(df).first()[0] == 6
    assert year_count(df, "date", 2018).first()[0] == 4
    assert distinct_count(df, "user_id").first()[0] == 3  # null is one of them


def test_empty_input(spark):
    df = reviews(spark).limit(0)
    report = exploration_report(df, 2018).first()
    assert (report.A, report.B, report.C, report.D, report.E) == (0, 0, 0, [], [])
    assert category_averages(df, df.withColumn("categories", F.lit("a")), "business_id", "stars", "categories").count() == 0


def test_null_keys_form_a_group(spark, rows_of):
    counts = {r[0]: r[1] for r in key_counts(reviews(spark), "user_id").collect()}
    assert counts == {"u1": 2, "u2": 2, None: 2}


def test_top_keys_break_ties_by_key(spark):
    df = reviews(spark).filter("user_id is not null")
    assert [tuple(r) for r in top_keys(df, "user_id", 1).collect()] == [("u1", 2)]


def test_busy_keys_are_strictly_above(spark, rows_of):
    assert rows_of(busy_keys(reviews(spark), "business_id", 1)) == [("b1", 2), ("b2", 2)]
    assert rows_of(busy_keys(reviews(spark), "business_id", 2)) == []


def test_words(spark, rows_of):
    assert rows_of(word_counts(reviews(spark), "text", ["the"])) == [
        ("bad", 2), ("food", 2), ("good", 2), ("ok", 1)]
    assert [r[0] for r in top_words(reviews(spark), "text", 2, ["the"]).collect()] == ["bad", "food"]


def test_stopwords_are_compared_as_given(spark, rows_of):
    listed = spark.createDataFrame([("The",), (" bad",), ("food",)], "w string")
    words = dict(rows_of(word_counts(reviews(spark), "text", listed)))
    assert words == {"bad": 2, "good": 2, "ok": 1, "the": 2}


def test_exploration_report(spark):
    report = exploration_report(reviews(spark), 2018, m=2, n=3, stopwords=["the"]).first()
    assert (report.A, report.B, report.C) == (6, 4, 3)
    assert [tuple(e) for e in report.D] == [(None, 2), ("u1", 2)]
    assert report.E == ["bad", "food", "good"]


def businesses(spark):
    return spark.createDataFrame(
        [("b1", "A, B,,A "), ("b2", "B"), ("b3", None), ("b4", "C"), ("b9", "Z")],
        "business_id string, categories string",
    )


def test_category_averages(spark, rows_of):
    averages = category_averages(reviews(spark), businesses(spark), "business_id", "stars", "categories")
    # A counts each b1 review twice; the null stars of b2 are skipped.
    assert rows_of(averages) == [("", 3.0), ("A", 3.0), ("B", 3.0), ("C", 4.0)]
    assert [r[0] for r in top_categories(averages, 3).collect()] == ["C", "", "A"]
    report = category_report(reviews(spark), businesses(spark), 1)
    assert [tuple(r) for r in report.collect()] == [("C", 4.0)]


def test_category_averages_repeat_for_repeated_dimension_rows(spark, rows_of):
    facts = spark.createDataFrame([("k", 1.0), ("k", 2.0), ("j", 9.0)], "id string, v double")
    names = spark.createDataFrame([("k", "x"), ("k", "x"), ("j", "x")], "id string, c string")
    assert rows_of(category_averages(facts, names, "id", "v", "c")) == [("x", 3.0)]


def test_hash_layout_is_that_of_repartition(spark, rows_of):
    df = spark.range(1000).select(F.col("id"), F.concat(F.lit("k"), "id").alias("name"))
    for column in ("id", "name"):
        assert rows_of(hash_layout(df, 16, column)) == rows_of(partition_layout(df.repartition(16, column)))


def test_layout_shows_empty_partitions(spark):
    layout = hash_layout(spark.range(3), 16, "id")
    counts = [r["rows"] for r in layout.collect()]
    assert len(counts) == 16 and sum(counts) == 3 and 0 in counts
    assert partition_layout(spark.range(3, numPartitions=5)).agg(F.sum("rows")).first()[0] == 3


def test_hash_layout_moves_no_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = hash_layout(df, 16, "l_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" not in plan and "ReadSchema: struct<l_orderkey:bigint>" in plan


def test_busy_report(spark, rows_of):
    as_read = busy_report(reviews(spark), 1)
    assert as_read.layout.agg(F.sum("rows")).first()[0] == 6
    hashed = busy_report(reviews(spark), 1, n_partitions=3)
    assert hashed.layout.count() == 3
    assert rows_of(hashed.result) == rows_of(as_read.result) == [("b1", 2), ("b2", 2)]


def lengths(df):
    return [(i, n) for i, n in enumerate(map(len, df.rdd.glom().collect()))]


def test_layout_as_read_is_that_of_the_data(spark, rows_of):
    """After a shuffle that Spark coalesces by bytes, after a join, and from a file."""
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        wide = spark.range(20000).withColumn("text", F.repeat(F.sha2(F.col("id").cast("string"), 256), 3))
        shuffled = wide.repartition("id")
        joined = wide.join(spark.range(0, 20000, 3).withColumnRenamed("id", "other"), F.col("id") == F.col("other"))
        mapped = spark.range(10).select(F.create_map("id", "id").alias("m")).repartition(3)
        scan = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
        for df in (shuffled, joined, mapped, scan):
            assert rows_of(partition_layout(df)) == lengths(df)
        assert len(lengths(shuffled)) > 2
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
