"""Table overviews and constraint checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from catalog_engine.operators.groups import spread_join
from catalog_engine.session import cut


def profile(df: DataFrame) -> DataFrame:
    """Per column: type, missing values, and whether it holds a single value. One pass."""
    # A map has no order, so its minimum does not exist.
    orderable = {n: not t.startswith("map") for n, t in df.dtypes}
    single = {
        n: F.min(n).eqNullSafe(F.max(n)) if orderable[n] else F.lit(None).cast("boolean") for n in df.columns
    }
    facts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.lit(kind).alias("type"),
                    F.count_if(F.col(name).isNull()).alias("missing"),
                    single[name].alias("single_value"),
                )
                for name, kind in df.dtypes
            ]
        ).alias("facts"),
        F.count("*").alias("table_rows"),
    )
    return facts.select(F.inline("facts"), "table_rows")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def missing_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in which a key column is missing."""
    missing = F.col(keys[0]).isNull()
    for key in keys[1:]:
        missing = missing | F.col(key).isNull()
    return df.filter(missing)


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent row and how many child rows carry them.

    The child side is counted per key before the join, so a key shared by many
    rows takes part in it once.
    """
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias(key)).distinct()
    return used.join(known, key, "left_anti")


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Per column the number of values over its length limit."""
    facts = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.lit(limit).alias("length_limit"),
                    F.count_if(F.length(name) > limit).alias("n"),
                )
                for name, limit in limits.items()
            ]
        ).alias("facts")
    )
    return facts.select(F.inline("facts"))


def too_long_rows(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """The rows with a value over its length limit."""
    over = F.lit(False)
    for name, limit in limits.items():
        over = over | F.coalesce(F.length(name) > limit, F.lit(False))
    return df.filter(over)


def gate(
    df: DataFrame,
    key: str,
    references: Sequence[tuple[str, DataFrame, str]] = (),
    limits: Mapping[str, int] | None = None,
    order: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every constraint, and the others with their ``reasons``.

    A key must be there and be the only one: of repeated keys the first row by
    ``order`` (all columns by default) passes. A value of a reference (column,
    parent table, its key) must be missing or be a parent's. A value must not be
    longer than its limit. Reasons are ``key missing``, ``key repeated``,
    ``<column> unknown`` and ``<column> too long``, all that hold, sorted.
    """
    names = df.columns
    # Only keys that occur twice are put in order; all other rows pass by the count.
    placed = df.withColumn("_n", F.lit(1))
    again = spread_join(placed, duplicate_keys(df.filter(F.col(key).isNotNull()), key).select(key), key, "left_semi")
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*[F.col(c) for c in (order or names)]))
    again = again.withColumn("_nth", nth)
    once = spread_join(placed, duplicate_keys(df.filter(F.col(key).isNotNull()), key).select(key), key, "left_anti")
    rows = again.unionByName(once.withColumn("_nth", F.lit(1)))
    reasons = [
        F.when(F.col(key).isNull(), F.lit("key missing")),
        F.when(F.col("_nth") > 1, F.lit("key repeated")),
    ]
    for i, (column, parent, parent_key) in enumerate(references):
        known = parent.filter(F.col(parent_key).isNotNull()).select(F.col(parent_key).alias(column)).distinct().withColumn(f"_k{i}", F.lit(True))
        rows = spread_join(rows, known, column, "left")
        reasons.append(F.when(F.col(column).isNotNull() & F.col(f"_k{i}").isNull(), F.lit(f"{column} unknown")))
    for column, limit in (limits or {}).items():
        reasons.append(F.when(F.length(column) > limit, F.lit(f"{column} too long")))
    judged = cut(rows.withColumn("reasons", F.sort_array(F.array_compact(F.array(*reasons)))).select(*names, "reasons"))
    return judged.filter(F.size("reasons") == 0).drop("reasons"), judged.filter(F.size("reasons") > 0)


def constraint_report(checks: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Number of violations per check: distinct offending keys, and rows that carry them."""
    reports = [
        found.agg(
            F.lit(name).alias("check_name"),
            F.count("*").alias("n_keys"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        )
        for name, found in checks
    ]
    combined = reports[0]
    for report in reports[1:]:
        combined = combined.unionByName(report)
    return combined
