"""Labels and words: from entries to labels and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from catalog_engine.functions.lists import score_order
from catalog_engine.functions.text import is_word, split_words
from catalog_engine.operators.groups import LIST_ROWS, sorted_lists


def label_rows(df: DataFrame, labels: Column, key: str = "id") -> DataFrame:
    """List of ``struct<label, score>`` -> one row per (label, id) with its score."""
    return df.select(key, F.inline(labels))


def label_universe(rows: DataFrame, label: str = "label") -> DataFrame:
    return rows.select(label).distinct()


def inverted_lists(
    rows: DataFrame, label: str = "label", key: str = "id", score: str = "score", list_rows: int = LIST_ROWS
) -> DataFrame:
    """Per label the ids and scores, highest score first, ties by id.

    A label found on more than ``list_rows`` entries goes on in further rows,
    numbered by ``part``.
    """
    order = score_order(F.col(score), F.col(key))
    return sorted_lists(rows.select(label, key, score), [label], order, [key, score], list_rows)


def tag_rows(df: DataFrame, tags: Column) -> DataFrame:
    """One row per tag; repetitions in one list count."""
    return df.select(F.explode_outer(tags).alias("tag")).filter(F.col("tag").isNotNull())


def tag_counts(rows: DataFrame) -> DataFrame:
    """Number of occurrences per tag."""
    return rows.groupBy("tag").agg(F.count("*").alias("n"))


def word_rows(df: DataFrame, source: Column, word: str, *kept: str) -> DataFrame:
    """One row per word of a text; repetitions count."""
    # The outer form: for the inner one Spark adds a size test that splits the text a second time.
    words = df.select(*kept, split_words(source).alias("_words"))
    return words.select(*kept, F.explode_outer("_words").alias(word)).filter(is_word(F.col(word)))


def tag_totals(counts: DataFrame) -> DataFrame:
    """Total and distinct number of tags, from the counts."""
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("distinct_tags"))
