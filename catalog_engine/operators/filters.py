"""Row and column selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from catalog_engine import fixed_values as fixed
from catalog_engine.functions.text import any_of, contains_any, short_id
from catalog_engine.operators.groups import lowest


def keep_category(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) == value)


def deny_titles(df: DataFrame, column: str, words: Sequence[str] = fixed.TITLE_DENY_LIST) -> DataFrame:
    """Drop rows whose text contains a listed word; a missing text is kept."""
    return df.filter(~F.coalesce(contains_any(F.col(column), words), F.lit(False)))


def exclude_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop rows with a listed value; NULL is kept."""
    return df.filter(~F.coalesce(F.col(column).isin(*values), F.lit(False))) if values else df


def exclude_lowest_ids(
    df: DataFrame, url: str, most: int = fixed.LOWEST_IDS_DROPPED, among: DataFrame | None = None
) -> DataFrame:
    """Drop the rows with the ``most`` lowest short ids, ties broken by the link.

    ``among`` are the rows the lowest ids are taken from, when those are not the rows of the table.
    """
    ids = (df if among is None else among).select(short_id(F.col(url)).alias("_short"), F.col(url))
    # At most `most` rows, whatever the table holds.
    return df.join(F.broadcast(lowest(ids, ["_short", url], most).select(url).distinct()), url, "left_anti")


def drop_errors(df: DataFrame, error: str = "error") -> DataFrame:
    return df.filter(F.col(error).isNull()).drop(error)


def is_blocked(
    columns: Sequence[Column], blocked: Sequence[str] = fixed.BLOCKED_LIKELIHOODS
) -> Column:
    """Any of the categories has a blocked value; a missing value does not block."""
    return any_of([F.coalesce(c.isin(*blocked), F.lit(False)) for c in columns])


def keep_language(df: DataFrame, column: str, language: str = fixed.KEPT_LANGUAGE) -> DataFrame:
    """Keep rows in the language, and rows without one."""
    return df.filter(F.col(column).isNull() | (F.col(column) == language))


def drop_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which all listed columns are missing."""
    return df.na.drop("all", subset=list(columns))


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which any of the columns is missing."""
    return df.na.drop("any", subset=list(columns) if columns else None)


def fill_missing(df: DataFrame, columns: Sequence[str], value: str = fixed.UNKNOWN) -> DataFrame:
    """Fill missing texts; a missing list becomes a list holding the value."""
    types = dict(df.dtypes)
    filled = {
        c: F.coalesce(c, F.array(F.lit(value)) if types[c].startswith("array") else F.lit(value))
        for c in columns
    }
    return df.withColumns(filled)


def missing_count(*columns: str) -> Column:
    """Number of missing values among the columns of one row."""
    return sum((F.col(c).isNull().cast("int") for c in columns), F.lit(0))


def has_any(*columns: str) -> Column:
    """At least one of the columns is present."""
    return any_of([F.col(c).isNotNull() for c in columns])


def blank_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Replace listed values with NULL."""
    return df.withColumn(column, F.when(~F.col(column).isin(*values), F.col(column)))


def single_value_columns(df: DataFrame) -> list[str]:
    """Names of the columns that hold one value or none, in one pass without distinct counts.

    Equal minimum and maximum is the same statement, and both combine before any shuffle.
    """
    kept = [n for n, t in df.dtypes if not t.startswith("map")]
    same = df.agg(*[F.min(n).eqNullSafe(F.max(n)).alias(n) for n in kept]).first()
    return [n for n in kept if same[n]]


def exclude_positions(df: DataFrame, positions: Sequence[int], ordinal: str = "ordinal") -> DataFrame:
    """Without the rows at these positions of the source."""
    return df.filter(~F.col(ordinal).isin(list(positions)))
