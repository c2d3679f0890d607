"""Resharding by minimum-cost flow: which bytes move so that new capacities hold and as few as possible are moved.

Old shard sizes are supplies, new capacities are demands, and a byte costs
something only if it changes its shard. The flow is solved on the driver, where
it has one number for each pair of shards. To carry it out, an old shard is cut
into blocks of rows (largest first, so that what moves is small and fills the
flow closely), and the blocks are laid along the flow's amounts. Only shards
that give or receive are written anew.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from catalog_engine.llm.common import table
from catalog_engine.session import cut, new_folder

SHARDS = 40
OLD_SHARDS = 32
ROW_BYTES = 16
# Blocks of a size class in an old shard, by the text's hash; copies of a text share a block unless it is too large.
BLOCKS_A_CLASS = 32
BLOCKS_A_SHARD = 200


def minimum_cost_flow(
    supply: Sequence[int], demand: Sequence[int], cost: Callable[[int, int], int]
) -> list[tuple[int, int, int]]:
    """(from, to, amount) that sends every supply within the demands at the least cost.

    Successive shortest paths: every turn sends what fits along the cheapest path
    from a supply that is left to a demand that is left, taking back earlier flow
    where that is cheaper. The demands must hold all supplies; costs are integers.
    """
    n, m = len(supply), len(demand)
    if sum(supply) > sum(demand):
        raise ValueError("the new capacities do not hold all bytes")
    price = np.array([[cost(i, j) for j in range(m)] for i in range(n)], np.int64).reshape(n, m)
    flow = np.zeros((n, m), np.int64)
    left, room = np.array(supply, np.int64), np.array(demand, np.int64)
    far = np.iinfo(np.int64).max // 4
    while left.any():
        # Distances from all supplies that are left; each round lengthens the paths by a step there and a step back.
        at, goals = np.where(left > 0, 0, far), np.full(m, far)
        came, back = np.full(m, -1), np.full(n, -1)
        while True:
            there = np.minimum(at[:, None] + price, far)
            nearer = there.min(axis=0, initial=far) < goals
            came[nearer] = there.argmin(axis=0)[nearer]
            goals[nearer] = there.min(axis=0)[nearer]
            again = np.where(flow > 0, np.minimum(goals[None, :] - price, far), far)
            closer = again.min(axis=1) < at
            if not closer.any():
                break
            back[closer] = again.argmin(axis=1)[closer]
            at[closer] = again.min(axis=1)[closer]
        goal = int(np.argmin(np.where(room > 0, goals, far)))
        steps, j = [], goal
        while True:
            i = int(came[j])
            steps.append((i, j, 1))
            if back[i] < 0:
                break
            j = int(back[i])
            steps.append((i, j, -1))
        amount = min([int(left[i]), int(room[goal]), *(int(flow[x, y]) for x, y, sign in steps if sign < 0)])
        for x, y, sign in steps:
            flow[x, y] += sign * amount
        left[i] -= amount
        room[goal] -= amount
    return [(int(i), int(j), int(flow[i, j])) for i, j in zip(*np.nonzero(flow))]


def moving(old: int, new: int) -> int:
    return int(old != new)


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (i < total % shards) for i in range(shards)]


def block_columns(key: Column) -> list[Column]:
    """Size class and hash bucket of a row in its old shard."""
    return [F.length(F.bin("_size")).alias("_class"), F.pmod(F.floor(key / OLD_SHARDS), F.lit(BLOCKS_A_CLASS)).cast("int").alias("_bucket")]


def divided(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` with _class, _bucket and _part: the block they are in; ``parts`` has the blocks that are cut."""
    keyed = rows.select("*", *block_columns(F.col("_key"))).join(F.broadcast(parts), ["_old", "_class", "_bucket"], "left")
    part = F.pmod(F.xxhash64("_row"), F.coalesce("_parts", F.lit(1)))
    return keyed.withColumn("_part", part.cast("int")).drop("_parts")


def homes(
    narrow: DataFrame, shards: int, cost: Callable[[int, int], int] = moving, capacities: Sequence[int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Parts of blocks that are too large, and the new ``shard`` of every block, for rows (_old, _size, _key, _row).

    ``_key`` groups rows that should stay together, ``_row`` divides a block
    that is too large. Sizes of old shards and flows are a number for each pair
    of shards; the tables of blocks are bounded by shards, size classes and the
    two block parameters, so they are sent to all tasks.
    """
    spark = narrow.sparkSession
    keys = ["_old", "_class", "_bucket"]
    blocks = cut(narrow.select("_old", "_size", *block_columns(F.col("_key"))).groupBy(*keys).agg(F.sum("_size").alias("_bytes")))
    old = {r["_old"]: r["n"] for r in blocks.groupBy("_old").agg(F.sum("_bytes").alias("n")).collect()}
    numbers, total = sorted(old), sum(old.values())
    capacities = even_capacities(total, shards) if capacities is None else capacities
    flows = minimum_cost_flow([old[i] for i in numbers], capacities, lambda i, j: cost(numbers[i], j))
    most = max(1, total // (shards * BLOCKS_A_SHARD))
    parts = blocks.select(*keys, F.ceil(F.col("_bytes") / most).alias("_parts")).filter("_parts > 1")
    sizes = divided(narrow, parts).groupBy(*keys, "_part").agg(F.sum("_size").alias("_bytes"))
    order = Window.partitionBy("_old").orderBy(F.desc("_class"), "_bucket", "_part")
    before = F.coalesce(F.sum("_bytes").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    along = sizes.withColumn("_middle", before + F.col("_bytes") / 2)
    # The flow out of each old shard as stretches: what stays first, then what goes to each other shard.
    stretches, reached = [], {}
    for i, j, amount in sorted(flows, key=lambda f: (f[0], cost(numbers[f[0]], f[1]), f[1])):
        start = reached.get(i, 0)
        reached[i] = start + amount
        stretches.append((numbers[i], start, start + amount, j))
    lengths = spark.createDataFrame(stretches, "_old int, _from bigint, _to bigint, shard int")
    found = along.join(F.broadcast(lengths), "_old").filter("_middle >= _from and _middle < _to")
    return parts, cut(found.select(*keys, "_part", "shard"))


def rewrite(rows: DataFrame, changed: Sequence[int], still: Sequence[int], folder: str) -> DataFrame:
    """Write the changed shards of ``rows`` (shard, ...) as ``shard=N`` folders; all rows, as they lie now.

    Rows of the ``still`` shards stay where they are. Large shards are written by
    several tasks, small ones share a task.
    """
    if not changed:
        return rows
    affected = rows.filter(F.col("shard").isin(*changed)) if still else rows
    affected.hint("rebalance", "shard").write.partitionBy("shard").parquet(folder)
    written = rows.sparkSession.read.schema(rows.schema).parquet(folder).select(*rows.columns)
    return written.unionByName(rows.filter(F.col("shard").isin(*still))) if still else written


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a gapless ``slot`` from 0 in each shard; a shard is numbered by its blocks, none of them large."""
    block = ["_old", "_class", "_bucket", "_part"]
    counts = rows.groupBy("shard", *block).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", *block, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", *block).orderBy("_size", "doc_id", "_key")
    slots = rows.withColumn("_place", F.row_number().over(inside)).join(F.broadcast(starts), ["shard", *block])
    return slots.withColumn("slot", (F.col("_start") + F.col("_place") - 1).cast("bigint"))


def reshard(docs: DataFrame, folder: str, old_shard: Column | None = None, shards: int = SHARDS) -> DataFrame:
    """Place ``docs`` (doc_id, text, ...) in ``shards`` shards of nearly equal bytes, and write them into ``folder``.

    ``old_shard`` is where a row lies now (from the text's CRC-32 by default);
    shards keep their numbers. Returned: the given columns with size (UTF-8
    bytes of the text and 16 more), text_crc32, shard and slot; columns of these
    names are replaced. A null text has no bytes and the CRC-32 of an empty one;
    copies of a text lie together unless there are more of them than a block
    takes; repeated rows are rows of their own. An empty table gives an empty
    result.
    """
    names = [c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot")]
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    own = [F.col(f"`{c}`").alias("doc_id" if c == "doc_id" else f"c{i}") for i, c in enumerate(names)]
    rows = docs.select(
        *own, (F.length(text) + ROW_BYTES).cast("bigint").alias("_size"), F.crc32(text).alias("_key"),
        (F.pmod(F.crc32(text), F.lit(OLD_SHARDS)) if old_shard is None else old_shard).cast("int").alias("_old"),
    )
    rows = rows.withColumn("_row", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    parts, home = homes(cut(rows.select("_old", "_size", "_key", "_row")), shards)
    pairs = [(r["_old"], r["shard"]) for r in home.select("_old", "shard").distinct().collect()]
    changed = sorted({s for pair in pairs if pair[0] != pair[1] for s in pair})
    block = ["_old", "_class", "_bucket", "_part"]
    at_home = divided(rows, parts).join(F.broadcast(home), block).drop("_row")
    still = sorted({new for _, new in pairs} - set(changed))
    at_home = rewrite(at_home, changed, still, folder)
    slots = numbered(at_home)
    back = [F.col("doc_id" if c == "doc_id" else f"c{i}").alias(c) for i, c in enumerate(names)]
    return slots.select(*back, F.col("_size").alias("size"), F.col("_key").alias("text_crc32"), "shard", "slot")


def op9_reshard(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes, from 32 by the text's hash; the shards are written as files."""
    docs = table(spark, folder, "documents").withColumn("doc_id", F.col("doc_id").cast("bigint"))
    found = reshard(docs, new_folder(spark, "shards"))
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
