"""SimHash near-duplicates: tiled exact comparison of fingerprints with exclusive-or and bit counts.

A fingerprint has a bit set if the bit is set in more than half of the 64-bit
hashes of the text's word shingles. All different fingerprints are sorted by
population counts (of the whole, of halves, of quarters) and dealt into blocks.
Which blocks can come within the radius is found from the bounds of their counts
alone, without their fingerprints. A block is then sent once for up to
``PARTNERS`` others, which stream past it; inside, tiles of the blocks are compared with numpy exclusive-or and bit
counts, and tile pairs whose population counts differ by more than the radius
are skipped, which loses nothing: the distance of two fingerprints is at least
the difference of their counts, summed over any parts of the word.

A task returns a spanning forest of the links it finds, never the links
themselves, so a group of thousands of near copies costs a row per member.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_engine.llm.common import components, offsets_of, pieces, raw_texts, table
from catalog_engine.session import cut

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Fingerprints of a block (512 KB), and of a tile: a tile pair's matrix stays in a core's cache.
BLOCK_ROWS = 65_536
TILE_ROWS = 256
# Blocks that stream past one copy of a block, and tasks that the meetings are dealt over at most.
PARTNERS = 64
TASKS = 10_000
HASHES_AT_ONCE = 16_384
HALF = 0x00000000FFFFFFFF
QUARTERS = [0xFFFF << s for s in (0, 16, 32, 48)]


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """SimHash of a text's word shingles as an unsigned 64-bit number; 0 without words."""
    words = text.lower().split()  # of bytes: lowers A-Z only, cuts at ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = memoryview(b" ".join(words))
    starts = offsets_of(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    ends = (starts[shingle_words:] - 1).tolist()
    starts = starts[: len(ends)].tolist()
    set_in = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(ends), HASHES_AT_ONCE):
        some = slice(at, at + HASHES_AT_ONCE)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[some], ends[some])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_in > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint's 64 bits as a signed long."""

    def hashed(batches):
        for piece in pieces(batches):
            found = np.array([fingerprint(t, shingle_words) for t in raw_texts(piece)], np.uint64)
            yield pa.record_batch([piece.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        hashed, "doc_id bigint, fp bigint"
    )


def part_counts(fps: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters of each fingerprint, one row each."""
    return np.bitwise_count(fps[:, None] & np.array(QUARTERS, np.uint64)).astype(np.int16)


def tile_bounds(fps: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest population counts of each tile: of the whole, two halves and four quarters."""
    quarters = part_counts(fps)
    halves = quarters[:, ::2] + quarters[:, 1::2]
    counts = np.concatenate([quarters.sum(axis=1, keepdims=True, dtype=np.int16), halves, quarters], axis=1)
    at = np.arange(0, len(fps), tile)
    return np.minimum.reduceat(counts, at), np.maximum.reduceat(counts, at)


def apart(low_a: np.ndarray, high_a: np.ndarray, low_b: np.ndarray, high_b: np.ndarray) -> np.ndarray:
    """Least possible distance between a tile and each of many, by their population counts."""
    gap = np.maximum(0, np.maximum(low_b - high_a, low_a - high_b))
    return np.maximum(np.maximum(gap[:, 0], gap[:, 1:3].sum(axis=1)), gap[:, 3:].sum(axis=1))


class Forest:
    """Disjoint sets over 0..n-1; the root of a set is its least member."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at) -> np.ndarray:
        found = self.parent[at]
        while True:
            above = self.parent[found]
            if (above == found).all():
                return found
            found = above

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite the sets of a[i] and b[i] for all i."""
        while True:
            a, b = self.roots(a), self.roots(b)
            differ = a != b
            if not differ.any():
                return
            a, b = a[differ], b[differ]
            # Each larger root goes below the least root it is linked to; what is left is linked in the next turn.
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def forest(a: np.ndarray, b: np.ndarray | None, bits: int, tile: int = TILE_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest, as (member, root), of the links between fingerprints of ``a`` and ``b`` (None: inside ``a``)."""
    inside = b is None
    b = a if inside else b
    whole = a if inside else np.concatenate([a, b])
    shift = 0 if inside else len(a)
    sets = Forest(len(whole))
    low_a, high_a = tile_bounds(a, tile)
    low_b, high_b = (low_a, high_a) if inside else tile_bounds(b, tile)
    for i in range(len(low_a)):
        near = np.flatnonzero(apart(low_a[i], high_a[i], low_b, high_b) <= bits)
        rows = np.arange(i * tile, min(len(a), (i + 1) * tile))
        for j in near[near >= i] if inside else near:
            columns = np.arange(j * tile, min(len(b), (j + 1) * tile))
            hit = np.bitwise_count(a[rows, None] ^ b[None, columns]) <= bits
            if not hit.any():
                continue
            hit &= sets.roots(rows)[:, None] != sets.roots(columns + shift)[None, :]
            x, y = np.nonzero(hit)
            if len(x):
                sets.link(rows[x], columns[y] + shift)
    everyone = np.arange(len(whole))
    roots = sets.roots(everyone)
    below = roots != everyone
    return whole[below], whole[roots[below]]


def blocks(nodes: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The fingerprints ``fp``, sorted by population counts and packed: (block, lows, highs, fps).

    ``lows`` and ``highs`` bound the population counts of the block as ``tile_bounds`` does.
    """
    n = max(1, -(-nodes.count() // block_rows))
    counts = [F.bit_count("fp"), F.bit_count(F.col("fp").bitwiseAND(F.lit(HALF))), F.bit_count(F.col("fp").bitwiseAND(F.lit(QUARTERS[0])))]
    ordered = nodes.select("fp").repartitionByRange(n, *counts, F.col("fp"))

    def packed(batches):
        rows = [b.column("fp").to_numpy() for b in batches if b.num_rows]
        if rows:
            fps = np.concatenate(rows).view(np.uint64)
            quarters = part_counts(fps)
            total = quarters.sum(axis=1)
            fps = fps[np.lexsort((fps, quarters[:, 2], quarters[:, 0], quarters[:, 0] + quarters[:, 1], total))]
            for at in range(0, len(fps), block_rows):
                some = fps[at : at + block_rows]
                low, high = tile_bounds(some, len(some))
                yield pa.record_batch(
                    [pa.array(low.tolist(), pa.list_(pa.int32())), pa.array(high.tolist(), pa.list_(pa.int32())), pa.array([some.tobytes()], pa.binary())],
                    ["lows", "highs", "fps"],
                )

    made = ordered.mapInArrow(packed, "lows array<int>, highs array<int>, fps binary")
    return made.withColumn("block", F.monotonically_increasing_id())


def meetings(bounds: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(a, b): every pair of blocks, by (block, lows, highs), that may hold fingerprints within ``bits``; each pair once."""
    # A block meets those that begin within its counts or up to the radius above: an equi-join on that count.
    left = bounds.select(
        F.col("block").alias("a"), F.col("lows").alias("lows_a"), F.col("highs").alias("highs_a"),
        F.explode(F.sequence(F.col("lows")[0], F.col("highs")[0] + F.lit(bits))).alias("count"),
    )
    met = left.join(bounds.withColumn("count", F.col("lows")[0]), "count")
    once = (F.col("count") > F.col("lows_a")[0]) | (F.col("block") >= F.col("a"))
    gap = [
        F.greatest(F.lit(0), F.col("lows")[i] - F.col("highs_a")[i], F.col("lows_a")[i] - F.col("highs")[i]) for i in range(7)
    ]
    halves, quarters = gap[1] + gap[2], gap[3] + gap[4] + gap[5] + gap[6]
    near = F.greatest(gap[0], halves, quarters) <= bits
    return met.filter(once & near).select("a", F.col("block").alias("b"))


def links(nodes: DataFrame, bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS, tile: int = TILE_ROWS) -> DataFrame:
    """Links (u, v) that connect all fingerprints ``fp`` with at most ``bits`` differing bits, as forests."""
    packed = cut(blocks(nodes, block_rows))
    n = max(1, packed.count())
    cores = nodes.sparkSession.sparkContext.defaultParallelism
    lanes = max(-(-n // PARTNERS), min(n, -(-cores // n)))
    lane = F.pmod(F.xxhash64("b"), F.lit(lanes)).alias("lane")
    pairs = cut(meetings(packed.select("block", "lows", "highs"), bits).select("a", "b", lane))
    own = pairs.select("a", "lane").distinct().join(packed.select(F.col("block").alias("a"), "fps"), "a")
    others = pairs.join(packed.select(F.col("block").alias("b"), "fps"), "b")
    # A block that meets itself is there already.
    others = others.select("a", "lane", F.lit(1).alias("kind"), F.when(F.col("a") != F.col("b"), F.col("fps")).alias("fps"))
    ready = own.select("a", "lane", F.lit(0).alias("kind"), "fps").unionByName(others)
    ready = ready.repartition(min(2 * n * lanes, TASKS), "a", "lane").sortWithinPartitions("a", "lane", "kind")

    def compared(batches):
        a = None
        for batch in batches:
            for kind, fps in zip(batch.column("kind").to_pylist(), batch.column("fps")):
                other = np.frombuffer(fps.as_buffer(), np.uint64) if fps.is_valid else None
                if kind == 0:
                    a = other
                    continue
                u, v = forest(a, other, bits, tile)
                yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

    return ready.mapInArrow(compared, "u bigint, v bigint")


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, bits: int = MAX_BITS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs`` (doc_id, text; other columns are ignored).

    component_id is the smallest doc_id reachable over links of at most ``bits``
    bits. A null, empty or blank text has fingerprint zero, linked like any
    other. A row with null doc_id takes part; component_id is null only if the
    whole group has no doc_id. Repeated rows come out as often as they came in.
    An empty table gives an empty result.
    """
    hashed = cut(fingerprints(docs, shingle_words))
    nodes = cut(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")))
    found = components(links(nodes, bits, block_rows)).withColumnRenamed("node", "fp")
    members = nodes.join(found, "fp")
    least = members.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = members.join(least, "root").select("fp", "component_id")
    # Fingerprints without a link are their own component.
    own = nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return hashed.join(own, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return near_duplicates(table(spark, folder, "documents"))
