"""A corpus from raw documents to token ids, in stages that each call one text operator.

Every stage works on all rows the one before kept, and is written before the
next one reads it. Rows with nulls, empty or very long texts, repeated rows and
further columns go through by the rules in the operators' docstrings; an empty
table stays empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_engine.llm import bpe, mixing, recompress, simhash, toxicity
from catalog_engine.llm.common import table
from catalog_engine.session import cut

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network, fitted on the labels, does not reject."""
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one with the smallest doc_id.

    Rows are told apart by a number of their own, so of rows that repeat this
    doc_id one stays too, and a group without any doc_id keeps one row.
    """
    rows = cut(docs.withColumn("_row", F.monotonically_increasing_id()))
    groups = simhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("_row"), "component_id").join(rows.select("_row", "doc_id"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))).alias("first")
    stays = groups.groupBy("component_id").agg(first).select(F.col("first._row").alias("_row"))
    return rows.join(stays, "_row", "left_semi").select(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand elsewhere; n_chars is counted anew where text went."""
    found = recompress.remove_repeats(docs)
    n_chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return found.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    found = mixing.mixed_sources(docs)
    return found.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select(*docs.columns)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of every row, and the digest of what they decode to."""
    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", without_toxic),
    ("simhash_near_dedup", without_near_copies),
    ("substring_dedup", without_repeats),
    ("mix_sources", mixed_to_weights),
    ("bpe_encode_decode", to_tokens),
]
# A trained network decides in the first stage, which SQL cannot express; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
