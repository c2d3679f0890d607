"""Joins by entry id, id sets and cascades over related tables.

No side is forced to be broadcast: an id set can hold a large part of the
catalogue, so Spark decides by measured size.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from catalog_engine.operators.groups import spread_join


def restrict(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is in the id table."""
    return df.join(ids.select(key), key, "left_semi")


def without(df: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key is not in the id table."""
    return df.join(ids.select(key), key, "left_anti")


def union_ids(*sets: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids of several sets."""
    first, *rest = [s.select(key) for s in sets]
    for other in rest:
        first = first.union(other)
    return first.distinct()


def subtract_ids(first: DataFrame, second: DataFrame, key: str = "id") -> DataFrame:
    """Distinct ids of the first set that are not in the second."""
    return without(first.select(key), second, key).distinct()


def cascade(tables: Mapping[str, DataFrame], dropped: DataFrame, key: str = "id") -> dict[str, DataFrame]:
    """Delete an id set from every table."""
    return {name: without(table, dropped, key) for name, table in tables.items()}


def drop_links(edges: DataFrame, dropped: DataFrame, source: str = "src", target: str = "dst") -> DataFrame:
    """Delete edges that start or end at a dropped id. One source or target may hold much of the table."""
    starts = dropped.select(F.col("id").alias(source))
    ends = dropped.select(F.col("id").alias(target))
    kept = spread_join(edges, starts, source, "left_anti")
    return spread_join(kept, ends, target, "left_anti").select(*edges.columns)


def add_columns(df: DataFrame, other: DataFrame, *columns: str, key: str = "id") -> DataFrame:
    """Add columns of another table by id; ids it lacks get NULL."""
    return df.join(other.select(key, *columns), key, "left")


def align(*tables: DataFrame, key: str = "id") -> DataFrame:
    """All columns of several tables by id, keeping ids found in any of them."""
    first, *rest = tables
    for other in rest:
        first = first.join(other, key, "full")
    return first


def add_flag(df: DataFrame, side: DataFrame, flag: str, key: str = "id") -> DataFrame:
    """Whether the id has a row in a side table with one row or more per id."""
    present = side.select(key).distinct().withColumn(flag, F.lit(True))
    return df.join(present, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
