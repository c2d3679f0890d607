"""Grouping, ranking and joining that stay even when one key holds much of the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from catalog_engine.session import cut

# A list in one row never holds more than this many items; a longer list goes on in the next row.
LIST_ROWS = 10_000
# Rows of one key that one task takes; a key with more is spread over as many tasks as it needs.
KEY_ROWS = 1_000_000


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row of every group of equal keys.

    A rank limit of one is applied before the shuffle as well, so a key with
    many copies sends one row per input partition.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(window)).filter("_nth = 1").drop("_nth")


def keep_first_placed(df: DataFrame, key: Column, place: Sequence[str]) -> DataFrame:
    """First row by ``place`` of every group of equal keys; ``place`` is different for all rows, and never null.

    The rows that go are left out by their place, and Spark decides by their
    number whether the others are sent for it.
    """
    return df.join(later_copies(df, key, place), list(place), "left_anti").select(*df.columns)


def later_copies(df: DataFrame, key: Column, place: Sequence[str]) -> DataFrame:
    """Places of all rows but the first of every group of equal keys, stored. Only keys and places are sent."""
    # A struct is never null itself, so rows whose key is null are joined as equal too.
    placed = df.select(F.struct(key.alias("key")).alias("_key"), F.struct(*place).alias("_place"))
    firsts = placed.groupBy("_key").agg(F.min("_place").alias("_first"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    copies = spread_join(placed, firsts, "_key").filter(F.col("_place") != F.col("_first"))
    return cut(copies.select("_place.*"))


def text_key(*columns: str) -> Column:
    """SHA-256 of long grouping texts, so a shuffle moves 32 bytes instead of the text."""
    whole = F.col(columns[0]) if len(columns) == 1 else F.to_json(F.struct(*columns))
    return F.unhex(F.sha2(F.encode(whole, "utf-8"), 256))


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int) -> DataFrame:
    """First ``most`` rows of every group, with their position; limited before the shuffle too."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("position", F.row_number().over(window)).filter(F.col("position") <= most)


def lowest(df: DataFrame, order: Sequence[str], most: int) -> DataFrame:
    """The ``most`` lowest rows of the whole table."""
    return df.orderBy(*order).limit(most)


# --- hot keys --------------------------------------------------------------


def key_shares(df: DataFrame, key: str, key_rows: int = KEY_ROWS) -> DataFrame:
    """Keys with more than ``key_rows`` rows, and over how many tasks each is spread.

    Counts combine before the shuffle. There are at most rows / ``key_rows`` such
    keys, so a join broadcasts them and sends no row to learn that its key is not among them.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    return counts.filter(F.col("_n") > key_rows).select(key, F.ceil(F.col("_n") / key_rows).cast("int").alias("_shares"))


def spread_join(
    many: DataFrame, few: DataFrame, key: str, how: str = "inner", key_rows: int = KEY_ROWS, keys: DataFrame | None = None
) -> DataFrame:
    """Equi-join in which a key with more than ``key_rows`` rows of ``many`` is spread over several tasks.

    Only rows of ``few`` with such a key are repeated, once per share. Both
    sides see the same keys, so whichever they are the result is that of the
    plain join. ``keys`` are the shares if the caller knows them. ``how`` is
    inner, left, left_semi or left_anti.
    """
    shares = F.broadcast(key_shares(many, key, key_rows) if keys is None else keys)
    count = F.coalesce("_shares", F.lit(1))
    shared = many.join(shares, key, "left").withColumn("_share", F.pmod(F.xxhash64(*many.columns), count).cast("int")).drop("_shares")
    repeated = few.join(shares, key, "left").withColumn("_share", F.explode(F.sequence(F.lit(0), count - 1))).drop("_shares")
    return shared.join(repeated, [key, "_share"], how).drop("_share")


# --- order inside a group --------------------------------------------------


def rank_in_groups(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Exact position of every row in its group, without bringing a group into one task.

    The rows are cut into sorted ranges over (keys, order), and stored so that
    counting and numbering see the same ranges. A range is numbered by itself; a
    group that runs over several ranges starts where the range before it
    stopped. ``order`` must leave no ties.
    """
    ranges = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    stored = cut(ranges.withColumn("_range", F.spark_partition_id()))
    pieces = stored.groupBy("_range", *keys).agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first group of a range can have begun in an earlier one: at most
    # one row per range, so this table is bounded by the number of partitions.
    carried = (
        pieces.withColumn("_before", F.sum("_rows").over(earlier))
        .filter("_before > 0")
        .select("_range", *[F.col(k).alias(f"_{k}") for k in keys], "_before")
    )
    same = F.col("_range") == F.col("_of_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    inside = Window.partitionBy("_range", *keys).orderBy(*order)
    return (
        stored.withColumn("_nth", F.row_number().over(inside))
        .join(F.broadcast(carried.withColumnRenamed("_range", "_of_range")), same, "left")
        .withColumn("position", (F.col("_nth") + F.coalesce("_before", F.lit(0))).cast("bigint"))
        .select(*df.columns, "position")
    )


def sorted_lists(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: Sequence[str],
    list_rows: int = LIST_ROWS,
    key_rows: int = KEY_ROWS,
) -> DataFrame:
    """One row per group with its values as parallel sorted lists.

    Every list is whole and in order. A group with more than ``list_rows`` rows
    continues in further rows, numbered by ``part`` from 0. Rows are sent once,
    by their group; a group with more than ``key_rows`` rows takes its positions
    from sorted ranges, so it is never ordered in one task.
    """
    stored = cut(df)
    counts = stored.groupBy(*keys).agg(F.count("*").alias("_n"))
    # At most rows / key_rows keys.
    large = cut(counts.filter(F.col("_n") > key_rows).select(*[F.col(k).alias(f"_{k}") for k in keys]))
    n_large = large.count()
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    few = stored.join(F.broadcast(large), same, "left_anti") if n_large else stored
    placed = few.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint"))

    def listed(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("part", F.floor((F.col("position") - 1) / list_rows).cast("bigint"))
        items = F.sort_array(F.collect_list(F.struct("position", *[F.col(v).alias(f"_v{i}") for i, v in enumerate(values)])))
        lists = rows.groupBy(*keys, "part").agg(items.alias("_items"))
        return lists.select(*keys, "part", *[F.col("_items")[f"_v{i}"].alias(v) for i, v in enumerate(values)])

    lists = listed(placed)
    if n_large:
        lists = lists.unionByName(listed(rank_in_groups(stored.join(F.broadcast(large), same, "left_semi"), keys, order)))
    return lists
