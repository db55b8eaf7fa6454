"""One query per operator of this folder, over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    id_files,
    main_text,
    near_vectors,
    ngram_join,
    packing,
    phrases,
    prefix_trie,
    quality_model,
    quality_rules,
    repeats,
    secret_scan,
    toxicity,
)
from .labelled import held_out
from .oracle import SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return near_vectors.near_vectors(vectors, "vec_id", "embedding", "label", 0.93).withColumnRenamed("id", "vec_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_rules.quality_rules(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    vocab = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(docs, "doc_id", "text", vocab, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        F.col("id").alias("doc_id"),
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = main_text.extract(pages, "page_id", "html", "url").withColumnRenamed("id", "page_id")
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return ngram_join.ngram_components(docs, "doc_id", "text").withColumnRenamed("id", "doc_id")


def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    files = id_files.write(docs, "doc_id", "text", public_tokenizers.path("word_bpe_49k.json"))
    back = id_files.read(spark, files, files.manifest.select("id", "copy"), with_ids=False)
    return back.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    apart = held_out("doc_id", 5, 0)
    model = toxicity.fit(docs, labels, "doc_id", "text", "toxic", ~apart)
    scored = toxicity.score(docs, model, "doc_id", "text").withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    apart = held_out("doc_id", 4, 2)
    model = quality_model.fit(docs, labels, "doc_id", "text", "quality", ~apart)
    scored = quality_model.score(docs, model, "doc_id", "text").withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    cut = repeats.remove_repeats(docs, "doc_id", "text")
    return cut.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    pieces = packing.pack(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumnRenamed("id", "doc_id")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"), "text", "lang")


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"), "doc_id", "text")
    base = [rule.kind for rule in secret_scan.BASE_RULES]

    def line(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda x: x["kind"].isin(*kinds))

    return found.select(
        F.col("id").alias("doc_id"),
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(line(of(*base)), 256).alias("base_sha256"),
        line(F.col("spans")).alias("spans"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.turns(_table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    source, shared = F.col("conv") - F.col("conv") % 100, F.crc32(F.col("conv").cast("string")) % 6
    return prefix_trie.prefix_trie(*prefix_trie.share_openings(own, source, shared, most=5))


QUERIES = {
    "op1_near_vectors": op1_near_vectors,
    "op2_quality_rules": op2_quality_rules,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_main_text": op4_main_text,
    "op5_ngram_join": op5_ngram_join,
    "op6_id_files": op6_id_files,
    "op7_toxicity": op7_toxicity,
    "op8_quality_model": op8_quality_model,
    "op9_repeats": op9_repeats,
    "op10_packing": op10_packing,
    "op11_phrases": op11_phrases,
    "op12_secrets": op12_secrets,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = dict(SQL)
