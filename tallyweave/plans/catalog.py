"""Named queries over the given tables. ``oracle.py`` holds the SQL each is checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import compact_categories, tokens
from ..operators import (
    busy_keys,
    category_averages,
    distinct_count,
    frequent_itemsets,
    hash_layout,
    item_model,
    key_counts,
    lsh_buckets,
    mean_ratings,
    minhash_signatures,
    partition_layout,
    predict_ratings,
    row_count,
    similar_pairs,
    similar_pairs_lsh,
    son_candidates,
    son_itemsets,
    top_categories,
    top_keys,
    top_words,
    word_counts,
    year_count,
)
from ..sources import (
    read_baskets,
    read_businesses,
    read_reviews,
    read_words,
    write_busy_report,
    write_category_report,
    write_itemsets,
    write_report,
    write_similar_pairs,
)
from ..staging import stage, staging_path
from . import parameters as P
from .reports import busy_report, category_report, exploration_report, itemset_report

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(l_orderkey, p_brand)``: the brands in each order."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    return lines.join(parts, "l_partkey").select("l_orderkey", "p_brand")


def _supplier_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(l_suppkey, o_custkey)``: the customers each supplier has served."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(orders, "l_orderkey").select("l_suppkey", "o_custkey")


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review-shaped rows without their texts: an order is a review by its customer."""
    return _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("review_id"),
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderdate").cast("string").alias("date"),
    )


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review-shaped rows that are texts only: the documents."""
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("review_id"), "text")


def _line_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review-shaped rows: a part is the business, the quantity its stars."""
    return _table(spark, sf_dir, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        "l_orderkey",
        F.col("l_partkey").cast("string").alias("business_id"),
        F.col("l_quantity").alias("stars"),
    )


def _joined(itemsets: DataFrame) -> DataFrame:
    return itemsets.withColumn("items", F.array_join("items", P.ITEM_SEPARATOR))


def review_count(spark, sf_dir):
    return row_count(_table(spark, sf_dir, "events"))


def orders_in_year(spark, sf_dir):
    return year_count(_table(spark, sf_dir, "orders"), "o_orderdate", P.YEAR)


def distinct_users(spark, sf_dir):
    return distinct_count(_table(spark, sf_dir, "events"), "user_id")


def user_counts(spark, sf_dir):
    return key_counts(_table(spark, sf_dir, "events"), "user_id")


def top_users(spark, sf_dir):
    return top_keys(_table(spark, sf_dir, "events"), "user_id", P.TOP)


def document_words(spark, sf_dir):
    return word_counts(_table(spark, sf_dir, "documents"), "text", P.STOPWORDS)


def top_document_words(spark, sf_dir):
    return top_words(_table(spark, sf_dir, "documents"), "text", P.TOP, P.STOPWORDS)


def exploration(spark, sf_dir):
    report = exploration_report(
        _reviews(spark, sf_dir), P.YEAR, P.TOP, P.TOP, P.STOPWORDS, texts=_texts(spark, sf_dir)
    )
    users = F.transform("D", lambda e: F.concat_ws(":", e["user_id"], e["count"].cast("string")))
    return report.select("A", "B", "C", F.array_join(users, ",").alias("D"), F.array_join("E", ",").alias("E"))


def category_avg(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    averages = category_averages(
        _table(spark, sf_dir, "lineitem"), parts, "l_partkey", "l_quantity", "p_name", " "
    )
    return averages.withColumn("average", F.round("average", 6))


def best_categories(spark, sf_dir):
    parts = _table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    averages = category_averages(
        _table(spark, sf_dir, "lineitem"), parts, "l_partkey", "l_quantity", "p_name", " "
    )
    return top_categories(averages, P.TOP, digits=6)


def compact_name_counts(spark, sf_dir):
    names = _table(spark, sf_dir, "part").select(
        F.explode(compact_categories(F.concat_ws(",", "p_name", "p_type"))).alias("category")
    )
    return key_counts(names, "category")


def busy_parts(spark, sf_dir):
    return busy_keys(_table(spark, sf_dir, "lineitem"), "l_partkey", P.BUSY)


def order_layout(spark, sf_dir):
    return hash_layout(_table(spark, sf_dir, "orders"), P.PARTITIONS, "o_orderkey")


def order_layout_as_read(spark, sf_dir):
    """What holds however Spark cut the file: all rows are counted, ids run from 0 on."""
    layout = partition_layout(_table(spark, sf_dir, "orders"))
    return layout.agg(
        F.sum("rows").alias("rows"),
        (
            (F.min("partition") == 0)
            & (F.max("partition") == F.count("*") - 1)
            & (F.countDistinct("partition") == F.count("*"))
        ).alias("ids_run_on"),
    )


def brand_itemsets(spark, sf_dir):
    return _joined(frequent_itemsets(_order_brands(spark, sf_dir), "l_orderkey", "p_brand", P.SUPPORT))


def brand_itemsets_large_orders(spark, sf_dir):
    return _joined(
        frequent_itemsets(
            _order_brands(spark, sf_dir), "l_orderkey", "p_brand", P.SUPPORT, P.BASKET_SIZE
        )
    )


def supplier_itemsets(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    found = frequent_itemsets(lines, "l_partkey", "l_suppkey", P.SUPPLIER_SUPPORT)
    return found.withColumn(
        "items", F.array_join(F.col("items").cast("array<string>"), P.ITEM_SEPARATOR)
    )


def supplier_part_itemsets(spark, sf_dir):
    """Baskets of suppliers: each holds very many parts, and more of them than the support."""
    lines = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    support = P.SUPPLIER_PART_SUPPORT
    found = frequent_itemsets(lines, "l_suppkey", "l_partkey", support)
    return found.withColumn("items", F.array_join(F.col("items").cast("array<string>"), P.ITEM_SEPARATOR))


def supplier_part_itemsets_two_pass(spark, sf_dir):
    lines = _table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    found = son_itemsets(lines, "l_suppkey", "l_partkey", P.SUPPLIER_PART_SUPPORT, 2)
    return found.withColumn("items", F.array_join(F.col("items").cast("array<string>"), P.ITEM_SEPARATOR))


def brand_candidates(spark, sf_dir):
    return _joined(
        son_candidates(
            _order_brands(spark, sf_dir),
            "l_orderkey",
            "p_brand",
            P.SUPPORT,
            P.CHUNKS,
            chunk=F.pmod("basket", F.lit(P.CHUNKS)),
        )
    )


def brand_itemsets_two_pass(spark, sf_dir):
    return _joined(
        son_itemsets(_order_brands(spark, sf_dir), "l_orderkey", "p_brand", P.SUPPORT, P.CHUNKS)
    )


def supplier_signatures(spark, sf_dir):
    signed = minhash_signatures(
        _supplier_customers(spark, sf_dir), "l_suppkey", "o_custkey", P.BANDS * P.BAND_ROWS, P.SEED
    )
    return signed.select("key", F.posexplode("signature").alias("slot", "minimum"))


def supplier_buckets(spark, sf_dir):
    buckets = lsh_buckets(
        _supplier_customers(spark, sf_dir), "l_suppkey", "o_custkey", P.BANDS, P.BAND_ROWS, P.SEED
    )
    return buckets.withColumn("minima", F.array_join(F.col("minima").cast("array<string>"), ","))


def similar_suppliers(spark, sf_dir):
    return similar_pairs(
        _supplier_customers(spark, sf_dir), "l_suppkey", "o_custkey", P.SIMILARITY
    )


def similar_suppliers_lsh(spark, sf_dir):
    return similar_pairs_lsh(
        _supplier_customers(spark, sf_dir),
        "l_suppkey",
        "o_custkey",
        P.SIMILARITY,
        P.BANDS,
        P.BAND_ROWS,
        P.SEED,
    )


def _document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _table(spark, sf_dir, "documents").select("doc_id", F.explode(tokens(F.col("text"))).alias("word"))
    return words.filter(F.col("word") != "")


def similar_documents(spark, sf_dir):
    """Documents as sets of words: words in most sets, equal sets, sets of very many words."""
    return similar_pairs(_document_words(spark, sf_dir), "doc_id", "word", P.DOCUMENT_SIMILARITY)


def equal_documents_lsh(spark, sf_dir):
    """Documents with the same words; equal sets agree on every band."""
    return similar_pairs_lsh(_document_words(spark, sf_dir), "doc_id", "word", 1.0, 4, 2, P.SEED)


def basket_text_itemsets(spark, sf_dir):
    """Itemsets of text baskets in both orientations, through files on either side."""
    brands = _order_brands(spark, sf_dir)
    found = []
    for columns, swap in ((("l_orderkey", "p_brand"), False), (("p_brand", "l_orderkey"), True)):
        source, path = (staging_path(spark, name) for name in ("basket-text", "itemset-json"))
        brands.select(*columns).write.option("header", True).csv(source)
        report = itemset_report(read_baskets(spark, source, swap=swap), P.SUPPORT, 0, P.CHUNKS)
        write_itemsets(report.candidates, report.frequent, path)
        named, frequent = (
            spark.read.schema(f"items array<string>, {measure} bigint, size int").json(f"{path}/{name}")
            for name, measure in (("candidates", "chunks"), ("frequent", "support"))
        )
        checked = frequent.join(named.select("items", F.lit(True).alias("named")), "items", "left")
        found.append(_joined(checked).select("items", "size", "support", "named", F.lit(swap).alias("swapped")))
    return found[0].unionByName(found[1])


def review_json_pairs(spark, sf_dir):
    """Suppliers and customers under text ids through JSON reviews, pairs, and JSON lines.

    With as many bands of one row as here, a pair at the threshold is missed once in 10**10.
    """
    reviews, path = (staging_path(spark, name) for name in ("review-json", "pair-json"))
    _supplier_customers(spark, sf_dir).select(
        F.concat(F.lit("s"), "l_suppkey").alias("business_id"), F.concat(F.lit('c"'), "o_custkey").alias("user_id")
    ).write.json(reviews)
    pairs = similar_pairs_lsh(
        read_reviews(spark, reviews), "business_id", "user_id", P.SIMILARITY, 100, 1, P.SEED
    )
    write_similar_pairs(pairs, path)
    return spark.read.schema(pairs.schema).json(path)


def basket_text_items(spark, sf_dir):
    """Order lines through comma-separated text, second column as the basket."""
    path = staging_path(spark, "basket-text")
    _order_brands(spark, sf_dir).select(
        F.col("p_brand").alias("item"), F.col("l_orderkey").alias("basket")
    ).write.option("header", True).csv(path)
    return key_counts(read_baskets(spark, path, swap=True).distinct(), "item")


def review_json_report(spark, sf_dir):
    """Orders, documents and a word list through files, and the report through JSON."""
    reviews, texts, words, report = (
        staging_path(spark, name) for name in ("review-json", "text-json", "word-text", "report-json")
    )
    _reviews(spark, sf_dir).write.json(reviews)
    _texts(spark, sf_dir).write.json(texts)
    spark.createDataFrame([(w,) for w in P.STOPWORDS], "word string").write.text(words)
    answers = exploration_report(
        read_reviews(spark, reviews, strict=True),
        P.YEAR,
        P.TOP,
        P.TOP,
        read_words(spark, words),
        texts=read_reviews(spark, texts, strict=True),
    )
    write_report(answers, report)
    users = F.transform("D", lambda e: F.concat_ws(":", e["user_id"], e["count"].cast("string")))
    return spark.read.schema(answers.schema).json(report).select(
        "A", "B", "C", F.array_join(users, ",").alias("D"), F.array_join("E", ",").alias("E")
    )


def review_json_categories(spark, sf_dir):
    """Order lines and parts through JSON lines; the average is that of the order lines."""
    reviews, businesses = (staging_path(spark, name) for name in ("review-json", "business-json"))
    _line_reviews(spark, sf_dir).write.json(reviews)
    _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("business_id"),
        F.concat_ws(" , ", "p_name", "p_type", "p_type").alias("categories"),
        F.lit(5.0).alias("stars"),
    ).write.json(businesses)
    best = category_report(read_reviews(spark, reviews), read_businesses(spark, businesses), P.TOP, digits=6)
    path = staging_path(spark, "category-json")
    write_category_report(best, path)
    written = spark.read.schema("result array<struct<category: string, average: double>>").json(path)
    return written.select(F.posexplode("result").alias("place", "entry")).select("place", "entry.*")


def busy_report_json(spark, sf_dir):
    """Busy parts and the layout of the order lines, written and read back."""
    path = staging_path(spark, "busy-json")
    found = busy_report(
        _line_reviews(spark, sf_dir), P.BUSY, n_partitions=P.PARTITIONS, partition_by="l_orderkey"
    )
    write_busy_report(found.layout, found.result, path)
    result = spark.read.schema(found.result.schema).json(f"{path}/result")
    layout = spark.read.schema(found.layout.schema).json(f"{path}/layout")
    return result.unionByName(
        layout.select(F.concat(F.lit("partition "), "partition").alias("business_id"), F.col("rows").alias("count"))
    )


def itemset_files(spark, sf_dir):
    """Candidates and frequent itemsets written as JSON and read back."""
    path = staging_path(spark, "itemset-json")
    brands = _order_brands(spark, sf_dir)
    candidates = son_candidates(
        brands, "l_orderkey", "p_brand", P.SUPPORT, P.CHUNKS, chunk=F.pmod("basket", F.lit(P.CHUNKS))
    )
    frequent = frequent_itemsets(brands, "l_orderkey", "p_brand", P.SUPPORT)
    write_itemsets(candidates, frequent, path)
    parts = [
        _joined(spark.read.schema(f"items array<string>, {count} bigint, size int").json(f"{path}/{name}"))
        .select("items", "size", F.col(count).alias("count"), F.lit(name).alias("kind"))
        for name, count in (("candidates", "chunks"), ("frequent", "support"))
    ]
    return parts[0].unionByName(parts[1])


def similar_pair_files(spark, sf_dir):
    """Similar suppliers written as JSON lines and read back."""
    path = staging_path(spark, "pair-json")
    pairs = similar_suppliers(spark, sf_dir)
    write_similar_pairs(pairs, path)
    return spark.read.schema(pairs.schema).json(path)


def _part_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(o_custkey, l_partkey, l_quantity)``: the quantity is the customer's rating of the part."""
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(orders, "l_orderkey").select("o_custkey", "l_partkey", "l_quantity")


def part_correlations(spark, sf_dir):
    """The model of item pairs: parts by the customers who bought both."""
    return item_model(_part_ratings(spark, sf_dir), "o_custkey", "l_partkey", "l_quantity", P.CO_RATERS)


def part_predictions(spark, sf_dir):
    """Every rating predicted from the customer's ratings of other parts."""
    model = stage(part_correlations(spark, sf_dir), "model")
    ratings = mean_ratings(_part_ratings(spark, sf_dir), "o_custkey", "l_partkey", "l_quantity")
    found = predict_ratings(ratings, ratings, model, P.NEIGHBOURS)
    return found.withColumn("prediction", F.round("prediction", 6))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        review_count,
        orders_in_year,
        distinct_users,
        user_counts,
        top_users,
        document_words,
        top_document_words,
        exploration,
        category_avg,
        best_categories,
        compact_name_counts,
        busy_parts,
        order_layout,
        order_layout_as_read,
        brand_itemsets,
        brand_itemsets_large_orders,
        supplier_itemsets,
        supplier_part_itemsets,
        supplier_part_itemsets_two_pass,
        brand_candidates,
        brand_itemsets_two_pass,
        supplier_signatures,
        supplier_buckets,
        similar_suppliers,
        similar_suppliers_lsh,
        similar_documents,
        equal_documents_lsh,
        basket_text_items,
        basket_text_itemsets,
        review_json_pairs,
        review_json_report,
        review_json_categories,
        busy_report_json,
        itemset_files,
        similar_pair_files,
        part_correlations,
        part_predictions,
    )
}
