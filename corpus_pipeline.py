"""Documents to packed training sequences, in five stages.

Each stage takes what the one before it kept, as written Parquet, and decides on all of it.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import ngram_join, packing, quality_model, quality_rules, repeats
from tallyweave.llm.labelled import held_out
from tallyweave.llm.tables import written

#: A document is rejected if it is good with a probability below this.
LEAST_QUALITY = 0.7
#: Near copies are those of the n-gram join's own contract: three words, similarity 0.9.
NEAR_COPIES = ngram_join.Join(width=3, share=(90, 100))


def _by_row(docs: DataFrame) -> DataFrame:
    """The id of a stage's rows is their place in its input, so that rows with equal or null
    ids are decided on one by one. It is written with them: another scan may number them anew."""
    return written(docs.withColumn("stage_row", F.monotonically_increasing_id()), "stage-rows")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality classifier does not reject. Labels are learnt from the
    same fold as in the query of the operator."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_model.fit(docs, labels, "doc_id", "text", "quality", ~held_out("doc_id", 4, 2))
    return quality_model.accepted(docs, model, "text", LEAST_QUALITY)


def check_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass the counts and the compression bands."""
    return quality_rules.accepted(docs, "text")


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, whose sets of three-word shingles have a
    Jaccard similarity of 0.9 or more: the first by id; of rows with one id, the first by text.
    Documents without words are in no group and stay."""
    rows = _by_row(docs)
    order = rows.select("doc_id", F.md5("text").alias("digest"), "stage_row")
    groups = ngram_join.ngram_components(rows, "stage_row", "text", NEAR_COPIES)
    grouped = groups.join(order, F.col("id") == F.col("stage_row"))
    first = F.min_by("id", F.struct("doc_id", "digest", "id")).alias("id")
    kept = grouped.groupBy("component_id").agg(first).select(F.col("id").alias("stage_row"))
    return rows.join(kept, "stage_row", "left_semi").drop("stage_row")


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut repeated passages. What is left of a character that was cut in two is replaced, and a
    document of which nothing is left is dropped."""
    cut = repeats.remove_repeats(docs, "doc_id", "text", *docs.columns)
    rest = cut.where(F.octet_length("kept") > 0).withColumn("rest", F.make_valid_utf8(F.col("kept").cast("string")))
    new = {"text": F.col("rest"), "n_chars": F.char_length("rest").cast("long")}
    return rest.select(*(new.get(x, F.col(f"carried.`{x}`")).alias(x) for x in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    pieces = packing.pack(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality classifier", classify),
    ("quality rules", check_rules),
    ("n-gram join", join_near_copies),
    ("repeated passages", remove_repeats),
    ("packing", pack),
]

#: Stages that train a model, compress and tokenise are beyond SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
