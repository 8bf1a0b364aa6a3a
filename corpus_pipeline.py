"""Corpus pipeline: quality rules, near-duplicates, secrets, mixing, pieces.

``STAGES`` names the stages in order. Each takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and reread as the next one's
``docs``; all but the last return the columns they were given. Null and empty
texts fall at the first stage; a table without rows passes through all of them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedspark.llm import mixing, near_dedup, pieces, quality_rules, secret_scan
from feedspark.llm.common import cut, table

# words of a shingle when whole documents are compared
SHINGLE = 5


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return near_dedup.keep(docs, size=SHINGLE)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked and lengths counted again."""
    return secret_scan.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, in global random order."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every copy (``ids``: 32-bit little-endian), its N best
    segmentations, and whether the pieces decode to the text."""
    coded = pieces.encode(docs, carry=["doc_id", "lang", "source"])
    n_pieces = F.floor(F.octet_length("ids") / 4).cast("long").alias("n_pieces")
    return coded.select("row.doc_id", "row.lang", "row.source", n_pieces, "score", "ids", "nbest", "round_trip")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mix),
    ("pieces", encode),
]

# near-duplicate links over signatures and piece lattices are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage over all that went before, on ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
