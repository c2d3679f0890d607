"""People: names that are none, dates from two sources, and totals per person."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog_engine import fixed_values as fixed
from catalog_engine.functions import dates
from catalog_engine.functions.lists import score_order
from catalog_engine.operators.groups import LIST_ROWS, lowest, sorted_lists


def blank_lowest_names(
    df: DataFrame,
    lists: dict[str, str],
    key: str = "id",
    most: int = fixed.LOWEST_NAMES_DROPPED,
    literals: list[str] = fixed.DROPPED_NAMES,
) -> DataFrame:
    """NULL out names that are among the lowest ones of a column, or literals.

    ``lists`` maps each column to the column its lowest names are taken from.
    Names are counted per row, so one name may fill several of the places.
    """
    for column, taken_from in lists.items():
        # At most `most` rows, whatever the table holds.
        names = lowest(df.filter(F.col(taken_from).isNotNull()).select(taken_from, key), [taken_from, key], most)
        listed = names.select(F.col(taken_from).alias("_name")).distinct().withColumn("_listed", F.lit(True))
        df = (
            df.join(F.broadcast(listed), F.col(column) == F.col("_name"), "left")
            .withColumn(f"_new_{column}", F.when(F.col("_listed").isNull() & ~F.col(column).isin(*literals), F.col(column)))
            .drop("_name", "_listed")
        )
    return df.withColumns({c: F.col(f"_new_{c}") for c in lists}).drop(*[f"_new_{c}" for c in lists])


def reconcile_dates(
    df: DataFrame, added: tuple[str, str], updated: tuple[str, str], year: str
) -> DataFrame:
    """Earliest added and latest updated day of two sources, then what can be inferred from them."""
    last = dates.latest(F.col(updated[0]), F.col(updated[1]))
    first = dates.inferred_added(dates.earliest(F.col(added[0]), F.col(added[1])), last)
    return df.withColumns(
        {added[0]: first, updated[0]: last, year: dates.inferred_year(F.col(year), first)}
    )


def person_totals(df: DataFrame, person: str, views: str) -> DataFrame:
    """Count and total per person; combined before the shuffle, so a busy person is one row per partition."""
    return (
        df.filter(F.col(person).isNotNull())
        .groupBy(person)
        .agg(F.count("*").alias("meme_counts"), F.coalesce(F.sum(views), F.lit(0)).alias("tot_views"))
    )


def person_rollup(
    df: DataFrame, person: str, views: str, key: str = "id", list_rows: int = LIST_ROWS
) -> DataFrame:
    """Per person the ids by views, their count and their total views.

    A person with more than ``list_rows`` ids has their list in several rows,
    numbered by ``part``.
    """
    rows = df.filter(F.col(person).isNotNull()).select(person, views, key)
    lists = sorted_lists(rows, [person], score_order(F.col(views), F.col(key)), [key], list_rows)
    totals = person_totals(df, person, views)
    return (
        lists.join(totals, person)
        .withColumnRenamed(key, "meme_ids")
        .select(person, "part", "meme_ids", "meme_counts", "tot_views")
    )
