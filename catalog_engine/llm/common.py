"""What the operators of this folder share: tables, pieces of Arrow batches, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from catalog_engine.session import cut

# A word is a run of characters other than ASCII white space. bytes.split() cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
# Python works on so many bytes of text at a time, or on one text if that is longer.
PIECE_BYTES = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def word_count(text: str | Column) -> Column:
    """Number of words of a text (0 for null)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def pieces(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a piece has at most ``most`` bytes of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        before = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            base = before[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(before, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of every text; a null text is empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    """Where each of the runs of these lengths begins, and where the last ends."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the ranges [start, start + length), one range after the other."""
    ends = offsets_of(lengths)
    return np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths)


def window_starts(starts: np.ndarray, window: int) -> np.ndarray:
    """Every word with which a whole window of its text begins."""
    sizes = np.maximum(0, np.diff(starts) - window + 1)
    ends = offsets_of(sizes)
    return np.arange(ends[-1]) + np.repeat(starts[:-1] - ends[:-1], sizes)


def covered(hit: np.ndarray, n: int, window: int) -> np.ndarray:
    """Which of n words lie in a window that begins at one of ``hit``."""
    edge = np.zeros(n + 1, np.int64)
    edge[hit] += 1
    edge[hit + window] -= 1
    return np.cumsum(edge[:-1]) > 0


def mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A 64-bit name for each ordered pair of 64-bit numbers (multiply and xor-shift, as in public mixers)."""
    with np.errstate(over="ignore"):
        x = a * np.uint64(0x9E3779B97F4A7C15) + (np.uint64(0x632BE59BD9B4E019) ^ np.asarray(b, np.uint64))
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def lowest_hashes(rows: DataFrame, label: str, counts: dict[int, int], most: int) -> DataFrame:
    """Rows of each class whose hash of the doc_id, as ``place``, is so low that about ``most`` of ``counts`` rows pass.

    A bounded sample without any shuffle: the share of rows that pass falls as
    the class grows. Where a class has no more than ``most`` rows, all pass.
    """
    passes = F.lit(False)
    for value, n in counts.items():
        highest = min(2**63 - 1, int(-(2**63) + 2**64 * min(1.0, most / max(n, 1))))
        passes = passes | ((F.col(label) == value) & (F.col("place") <= F.lit(highest)))
    return rows.withColumn("place", F.xxhash64("doc_id")).filter(passes)


def same_edges(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected links (u, v); root is the smallest node reachable.

    Alternates two star steps until the links no longer change: every larger
    neighbour is linked to the smallest one, then every smaller. Both are a
    minimum, which combines before the shuffle, and a join on the node; links
    stay as many as nodes and links at the start, and every round is stored in
    the shared folder. A node with very many links is split by the skew join.
    """
    current = cut(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    before = same_edges(current)
    while True:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(least, "u")
        small = pairs.select("u", F.col("m").alias("v")).unionByName(
            pairs.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        current = cut(small.distinct())
        after = same_edges(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
