"""Queries over the training-data operators: thin adapters from an operator's
general output to the columns a query promises. Each runs over its whole
table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, collocations, kdtree, language, mixing, near_dedup, pieces, quality_model, quality_rules, repeats, secret_scan, sharding
from .common import held_out, table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and all spans of every document."""
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    strong = F.filter("spans", lambda s: s["kind"] < secret_scan.N_STRONG)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == secret_scan.RANK[kind])).cast("long")

    return found.select(
        F.col("id").alias("doc_id"),
        *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secret_scan.span_list(strong), 256).alias("base_sha256"),
        secret_scan.span_list(F.col("spans")).alias("spans"),
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from rows not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language.label(docs, language.train(docs))
    return found.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "lang_pred", "score", "spans")


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated passages take from every document."""
    found = repeats.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every fiftieth."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(rows, rows.where("vec_id % 50 = 0")).withColumnRenamed("id", "vec_id")


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of the mixed corpus, in its global order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.replicate(docs).select("row.doc_id", "row.source", "copies", "copy", "order_key")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; learned from labels not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality_model.predict(docs, quality_model.train(docs, table(spark, sf_dir, "labels")))
    return found.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document."""
    found = near_dedup.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best and N-best segmentations of every document, decoded again."""
    coded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])
    return coded.select(
        F.col("row.doc_id").alias("doc_id"),
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
        F.sha2("ids", 256).alias("ids_sha256"),
        "score",
        F.array_join(F.transform("nbest", lambda b: b["score"].cast("decimal(38,0)").cast("string")), ",").alias("nbest_scores"),
        "round_trip",
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document under the law of rows."""
    put = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return put.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of every language."""
    return collocations.mine(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document."""
    found = alignment.measure(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


def op13_kdtree_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best vectors of every hundredth."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return kdtree.nearest(rows, rows.where("vec_id % 100 = 0")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality_rules": op2_quality_rules,
    "op3_language_id": op3_language_id,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_hnsw_search": op5_hnsw_search,
    "op6_source_mixing": op6_source_mixing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_sharding": op10_sharding,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_token_alignment": op12_token_alignment,
    "op13_kdtree_search": op13_kdtree_search,
}
