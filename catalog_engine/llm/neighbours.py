"""Approximate nearest neighbours by multi-index hashing of learned, rotated binary codes.

Vectors are centred, turned by many rotations that are learned so that signs
lose as little as possible (iterative quantisation), and kept as bits. A code is
split into substrings of 16 bits, about as many as number the rows of a block,
each with an index of its own. Every bucket within ``reach`` bits of the query's
substring is probed. By the pigeonhole principle this retrieves every code
within ``substrings * (reach + 1) - 1`` bits. Beyond that sure radius a code is
retrieved if any one of its substrings comes within the reach; as many
substrings are taken as find ``PROBE_RECALL`` of the true neighbours of some
sample rows, with the smallest reach that can. Retrieved codes are compared as a
whole; those within the outer radius are ranked by the inner product of the
original vectors.

Rotations, reach and radius are fitted on a bounded sample; every row is
indexed. Rows lie in blocks and queries in groups. A task gets a block once,
builds its index once, and streams the groups past it. A query that finds fewer
neighbours than asked for is searched again without a radius, so nobody comes
out short.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from catalog_engine.llm.common import ranges, table
from catalog_engine.session import cut

SAMPLE_ROWS = 8_192
SAMPLE_QUERIES = 256
TURNS = 10
SUBSTRING_BITS = 16
MOST_SUBSTRINGS = 192
# Share of the sample's true neighbours that probes retrieve, and share of all of them in the outer radius.
PROBE_RECALL = 0.94
RADIUS_RECALL = 0.99
NEIGHBOURS = 20
BLOCK_ROWS = 32_768
GROUP_ROWS = 1_024
# Groups of queries that share one copy of a block, and tasks that the work is dealt over at most.
GROUPS_A_LANE = 64
TASKS = 10_000
# Rows coded at a time, which bounds the turned vectors a task holds.
CODED_ROWS = 1_024


@dataclass
class Coder:
    """Centre of the vectors, directions whose signs are the bits, bits a probe may differ by, and the outer radius."""

    centre: np.ndarray
    directions: np.ndarray
    reach: int = 0
    radius: int = 0

    @property
    def substrings(self) -> int:
        return self.directions.shape[1] // SUBSTRING_BITS

    @property
    def sure_radius(self) -> int:
        """A code within it has, by the pigeonhole principle, some substring within the reach."""
        return self.substrings * (self.reach + 1) - 1

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """Substrings of the codes, one row of 16-bit numbers a vector."""
        out = np.empty((len(vectors), self.substrings), "<u2")
        for at in range(0, len(vectors), CODED_ROWS):
            some = slice(at, at + CODED_ROWS)
            bits = (vectors[some] - self.centre) @ self.directions > 0
            out[some] = np.packbits(bits, axis=1, bitorder="little").view("<u2")
        return out


def learned_rotation(around: np.ndarray, axes: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Principal axes, turned so that the signs of the turned vectors are close to them."""
    projected = around @ axes
    turn = np.linalg.qr(random.normal(size=(len(axes), len(axes))))[0]
    for _ in range(TURNS):
        left, _, right = np.linalg.svd(np.sign(projected @ turn).T @ projected)
        turn = (left @ right).T
    return axes @ turn


def distances(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


def learn(sample: np.ndarray, neighbours: int, seed: int = 11) -> Coder:
    """Directions, reach and radius by the sample; a sample that is hardly larger than a result is searched whole."""
    random = np.random.default_rng(seed)
    centre = sample.mean(axis=0)
    around = sample - centre
    width = sample.shape[1]
    if len(sample) <= 2 * neighbours:
        return Coder(centre, random.normal(size=(width, SUBSTRING_BITS)), SUBSTRING_BITS, SUBSTRING_BITS)
    axes = np.linalg.eigh(around.T @ around)[1][:, ::-1]
    turns = -(-MOST_SUBSTRINGS * SUBSTRING_BITS // width)
    directions = np.concatenate([learned_rotation(around, axes, random) for _ in range(turns)], axis=1)
    coder = Coder(centre, directions[:, : MOST_SUBSTRINGS * SUBSTRING_BITS])
    codes = coder.codes(sample)
    asked = np.arange(len(sample))[:: max(1, len(sample) // SAMPLE_QUERIES)]
    differ = []
    for at in asked:
        products = sample @ sample[at]
        products[at] = -np.inf
        best = np.argsort(-products)[:neighbours]
        differ.append(np.bitwise_count(codes[best] ^ codes[at]))
    differ = np.concatenate(differ)
    for reach in range(SUBSTRING_BITS + 1):
        found = np.logical_or.accumulate(differ <= reach, axis=1).mean(axis=0)
        if found[-1] >= PROBE_RECALL:
            break
    n = int(np.searchsorted(found, PROBE_RECALL)) + 1
    coder = Coder(centre, directions[:, : n * SUBSTRING_BITS], reach)
    radius = int(np.quantile(differ[:, :n].sum(axis=1, dtype=np.int64), RADIUS_RECALL, method="higher"))
    coder.radius = max(radius, coder.sure_radius)
    return coder


def masks(reach: int) -> np.ndarray:
    """All 16-bit numbers with at most ``reach`` bits."""
    every = np.arange(1 << SUBSTRING_BITS, dtype=np.uint16)
    return every[np.bitwise_count(every) <= reach]


class Index:
    """Rows of one block with an index for each substring of their codes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, coder: Coder):
        self.ids, self.vectors, self.coder = ids, vectors, coder
        self.codes = coder.codes(vectors)
        self.masks = masks(coder.reach)
        orders = [np.argsort(own, kind="stable") for own in self.codes.T]
        # Rows by bucket, one substring after the other, and where each bucket begins there.
        self.rows = np.concatenate(orders).astype(np.int32)
        every = np.arange((1 << SUBSTRING_BITS) + 1)
        starts = [np.searchsorted(own[o], every) + j * len(ids) for j, (own, o) in enumerate(zip(self.codes.T, orders))]
        self.starts = np.concatenate(starts).astype(np.int32)
        self.offsets = np.arange(coder.substrings)[:, None] * len(every)

    def probed(self, code: np.ndarray) -> np.ndarray:
        """Rows with any substring within the reach of the query's."""
        if self.coder.reach >= SUBSTRING_BITS:
            return np.arange(len(self.ids))
        found = np.zeros(len(self.ids), bool)
        buckets = ((self.masks ^ code[:, None]) + self.offsets).ravel()
        first, last = self.starts[buckets], self.starts[buckets + 1]
        some = last > first
        found[self.rows[ranges(first[some], (last - first)[some])]] = True
        return np.flatnonzero(found)

    def within(self, code: np.ndarray) -> np.ndarray:
        """Probed rows whose whole code is within the outer radius."""
        at = self.probed(code)
        return at[distances(self.codes[at], code) <= self.coder.radius]

    def best(self, query_id: int, vector: np.ndarray, code: np.ndarray | None, neighbours: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and inner products of the nearest rows in the radius (without a code: of all), without the query itself."""
        at = np.arange(len(self.ids)) if code is None else self.within(code)
        at = at[self.ids[at] != query_id]
        # Products one row at a time, in a fixed order of addition, so a score does not depend on the block.
        scores = np.einsum("ij,j->i", self.vectors[at], vector)
        order = np.lexsort((self.ids[at], -scores))[:neighbours]
        return self.ids[at][order], scores[order]


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the rows that take part, as arrays of doubles; all have the commonest length.

    Left out: a null id or vector, null or non-finite components, a vector of
    zeros or without components, and other lengths than the commonest.
    """
    inner = rows.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = inner.filter(F.col("id").isNotNull() & (F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0))
    lengths = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return good.filter(F.size("vector") == (lengths["n"] if lengths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def packed(rows: DataFrame, n: int, most: int, name: str) -> DataFrame:
    """Rows (id, vector) as blocks of at most ``most``: ``name``, ids and vectors as bytes.

    Rows draw one of ``n`` numbers and are dealt by it, so there are about ``n``
    blocks however many partitions the shuffle has. The number comes from the
    row's place in its stored table: rows that repeat an id part ways. Blocks
    are numbered from 0; numbers of blocks that got no row are left out.
    """
    parts = min(n, TASKS)

    def blocks(batches):
        ids, vectors, made = [], [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            ids.append(batch.column("id").to_numpy())
            vectors.append(matrix(batch.column("vector")))
            while sum(map(len, ids)) >= most:
                i, v = np.concatenate(ids), np.concatenate(vectors)
                yield full(part + parts * made, i[:most], v[:most])
                ids, vectors, made = [i[most:]], [v[most:]], made + 1
        if sum(map(len, ids)):
            yield full(part + parts * made, np.concatenate(ids), np.concatenate(vectors))

    def full(number, ids, vectors):
        return pa.record_batch(
            [pa.array([number]), pa.array([ids.tobytes()], pa.binary()), pa.array([vectors.tobytes()], pa.binary())],
            [name, f"{name}_ids", f"{name}_vectors"],
        )

    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    dealt = rows.withColumn("part", part).repartitionById(parts, "part")
    return dealt.mapInArrow(blocks, f"{name} bigint, {name}_ids binary, {name}_vectors binary")


def search(blocks: DataFrame, groups: DataFrame, n_groups: int, coder: Coder, neighbours: int, whole: bool) -> DataFrame:
    """(query_id, vec_id, score, rank) of every query in the groups, best of all blocks.

    The stated queries meet all rows, in blocks: a group of queries goes to every
    block once. A block goes to its lanes, each for up to ``GROUPS_A_LANE``
    groups, or more lanes where there would be fewer tasks than cores.
    """
    slots = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    cores = blocks.sparkSession.sparkContext.defaultParallelism
    lanes = max(1, -(-n_groups // GROUPS_A_LANE), min(n_groups, -(-cores // slots)))
    lane = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(lanes - 1).cast("bigint")))
    sent_blocks = blocks.withColumn("lane", lane).select(
        (F.col("block") * lanes + F.col("lane")).alias("unit"), F.lit(0).alias("kind"),
        F.col("block_ids").alias("ids"), F.col("block_vectors").alias("vectors"),
    )
    slot = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slots - 1).cast("bigint")))
    sent_groups = groups.withColumn("slot", slot).select(
        (F.col("slot") * lanes + F.col("group") % lanes).alias("unit"), F.lit(1).alias("kind"),
        F.col("group_ids").alias("ids"), F.col("group_vectors").alias("vectors"),
    )
    tasks = min(slots * lanes, TASKS)
    work = sent_blocks.unionByName(sent_groups).repartitionById(tasks, (F.col("unit") % tasks).cast("int"))

    def ranked(batches):
        built, index = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                unit = batch.column("unit")[row].as_py()
                ids = np.frombuffer(batch.column("ids")[row].as_buffer(), np.int64)
                vectors = np.frombuffer(batch.column("vectors")[row].as_buffer(), np.float64).reshape(len(ids), -1)
                if batch.column("kind")[row].as_py() == 0:
                    built, index = unit, Index(ids, vectors, coder)
                elif unit == built:
                    codes = [None] * len(ids) if whole else coder.codes(vectors)
                    found = [index.best(q, v, c, neighbours) for q, v, c in zip(ids.tolist(), vectors, codes)]
                    yield pa.record_batch(
                        [
                            pa.array(np.repeat(ids, [len(i) for i, _ in found])), pa.array(np.concatenate([i for i, _ in found])),
                            pa.array(np.concatenate([s for _, s in found])),
                        ],
                        ["query_id", "vec_id", "score"],
                    )

    # The block of a unit comes before its groups, so a task holds one index and one batch of groups.
    near = work.sortWithinPartitions("unit", "kind").mapInArrow(ranked, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours)


def sampled(good: DataFrame, total: int) -> np.ndarray:
    """Vectors of about ``SAMPLE_ROWS`` rows with the lowest hashes of their ids, never more."""
    place = F.xxhash64("id")
    # A quarter more than needed pass by their hash alone, so that few rows are sorted.
    highest = min(2**63 - 1, int(-(2**63) + 2**64 * min(1.0, 1.25 * SAMPLE_ROWS / max(1, total))))
    chosen = good.filter(place <= F.lit(highest)).orderBy(place, "id", "vector").limit(SAMPLE_ROWS)
    return np.array([r["vector"] for r in chosen.select("vector").collect()])


def nearest(
    rows: DataFrame,
    queries: DataFrame,
    neighbours: int = NEIGHBOURS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``neighbours`` rows with the largest inner product found for each query.

    A row with the query's own id is no candidate; ties go to the smaller id.
    Rows that repeat an id are candidates each; of queries that do, the one with
    the least vector is asked. A query gets all candidates if there are fewer
    than asked for. Rows and queries that ``usable`` leaves out take no part;
    an empty table gives an empty result.
    """
    good = cut(usable(rows, id_column, vector_column))
    total = good.count()
    sample = sampled(good, total)
    none = "query_id bigint, rank int, vec_id bigint, score double"
    if len(sample) < 2:
        return rows.sparkSession.createDataFrame([], none)
    coder = learn(sample, neighbours)
    asked = usable(queries, id_column, vector_column).filter(F.size("vector") == sample.shape[1])
    asked = cut(asked.groupBy("id").agg(F.min("vector").alias("vector")))
    # Blocks are filled to seven eighths on average, so that their number hardly ever grows by chance.
    blocks = cut(packed(good, -(-8 * total // (7 * block_rows)), block_rows, "block"))

    def searched(some: DataFrame, count: int, whole: bool) -> DataFrame:
        n = -(-count // GROUP_ROWS)
        return search(blocks, packed(some, n, GROUP_ROWS, "group"), n, coder, neighbours, whole)

    n_asked = asked.count()
    if not n_asked:
        return rows.sparkSession.createDataFrame([], none)
    first = cut(searched(asked, n_asked, False))
    most = min(neighbours, total - 1)
    enough = first.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= most)
    short = cut(asked.join(enough, asked.id == enough.query_id, "left_anti"))
    # The blocks are sent again only if some query came out short.
    n_short = short.count()
    done = first
    if n_short:
        done = first.join(enough.select("query_id"), "query_id", "left_semi").unionByName(searched(short, n_short, True))
    return done.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 nearest of all embeddings for every one whose id is divisible by 20."""
    rows = table(spark, folder, "embeddings")
    return nearest(rows, rows.filter("vec_id % 20 = 0"))
