"""Substring deduplication by recompression.

Every word has a 128-bit name, whose first half is its first symbol. A round gives a new name to each maximal run of
equal symbols, or to each adjacent pair whose left symbol falls on one side of
a split of all names and whose right symbol falls on the other. Names are made
from content alone, so all executors name alike without a dictionary, and equal
substrings get equal symbols except near their ends. How far the ends reach in
is followed exactly, for every window of words.

1. The symbols of the last round go to the task that owns their range of names,
   each block of documents sending a symbol once. It answers one bit a symbol:
   seen twice or not.
2. A window with an inner symbol seen once cannot be repeated. All others (few)
   are verified: 128-bit hashes of whole windows, made from both halves of the
   words' names, go the same way and come back as one bit each. Equal symbols
   by chance only cost a verification; a wrong result takes equal 128-bit hashes.
3. Words covered by a repeated window are removed.

The texts are stored once as blocks, bucketed by block number, so the bits
return to them without moving any text. No group of copies meets in a task: a
symbol or window costs one entry a block, however often the block has it. Rows
sent are one a block and part that has any of its keys, so never more than keys.
"""

from __future__ import annotations

import uuid
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_engine.llm.common import covered, mixed, offsets_of, pieces, table, window_starts
from catalog_engine.session import cut, new_folder

WINDOW_WORDS = 35
PAIR_ROUNDS = 5
# Text of a block, and text whose names are compared in one group.
BLOCK_BYTES = 4_000_000
BYTES_A_PART = 32_000_000
KEPT_WORDS = 500_000
# Text of a bucket of blocks, which is read by one task, and buckets at most.
BUCKET_BYTES = 16_000_000
MOST_BUCKETS = 50_000
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class WordNames(dict):
    """Number of each word among those seen lately; ``names`` holds their 128-bit names in that order, as bytes."""

    def __init__(self):
        super().__init__()
        self.names = bytearray()

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.names += xxhash.xxh3_128_digest(word)
        return number

    def forget(self) -> None:
        self.clear()
        self.names = bytearray()


def word_names(texts: list[list[bytes]], known: WordNames) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words (two 64-bit halves a row), and where each text's words begin (and the last end)."""
    if len(known) > KEPT_WORDS:
        known.forget()
    starts = offsets_of(np.fromiter(map(len, texts), np.int64, len(texts)))
    numbers = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), np.int64, starts[-1])
    return np.frombuffer(bytes(known.names), "<u8").reshape(-1, 2)[numbers], starts


class Parse:
    """The last round's symbols, and for every boundary between words the nearest inner symbol boundary.

    ``left[i]`` is the first symbol that is the same wherever the words from i
    on occur; ``right[e]`` is one past the last that is the same wherever the
    words before e occur.
    """

    def __init__(self, names: np.ndarray, starts: np.ndarray, pair_rounds: int = PAIR_ROUNDS):
        n = len(names)
        self.left, self.right = np.arange(n + 1), np.arange(n + 1)
        first = np.zeros(n + 1, bool)  # symbols that begin a text
        first[starts] = True
        self.names, self.first = names, first[:n]
        self.name_runs()
        for number in range(pair_rounds):
            self.name_pairs(number)

    def name_runs(self) -> None:
        """Every maximal run of equal symbols becomes one symbol, named by symbol and length."""
        names, n = self.names, len(self.names)
        begins = self.first.copy()
        begins[1:] |= names[1:] != names[:-1]
        at = np.flatnonzero(begins)
        sizes = np.diff(np.append(at, n))
        run = np.append(np.cumsum(begins), len(at) + 1)  # number of the run, from 1
        # A run at an end may go on outside: the first and the last one are not inner.
        self.left = np.minimum(run, len(at))[self.left]
        self.right = np.append(0, run[:-1] - 1)[self.right]
        self.names = np.where(sizes > 1, mixed(names[at], sizes.astype(np.uint64)), names[at])
        self.first = self.first[at]

    def name_pairs(self, number: int) -> None:
        """Adjacent symbols, left side then right side, become one. Only a right-side symbol can join what is before."""
        names, n = self.names, len(self.names)
        is_right = (mixed(names, np.uint64(number + 1)) & np.uint64(1)).astype(bool)
        joins = np.zeros(n, bool)  # the second of a pair
        joins[1:] = ~is_right[:-1] & is_right[1:] & ~self.first[1:]
        at = np.flatnonzero(~joins)
        before = offsets_of(~joins)  # new symbols that begin before each boundary
        step = np.append(is_right, False).astype(np.int64)
        self.left = before[np.minimum(np.arange(n + 1) + step, n)][self.left]
        step = np.append(False, ~is_right).astype(np.int64)
        self.right = before[np.arange(n + 1) - step][self.right]
        paired = np.append(joins[1:], False)[at]
        second = names[np.minimum(at + 1, n - 1)] if n else names
        self.names = np.where(paired, mixed(mixed(names[at], np.uint64(99)), second), names[at])
        self.first = self.first[at]


def candidates(parse: Parse, starts: np.ndarray, repeated: np.ndarray, window: int) -> np.ndarray:
    """Starts of the windows without an inner symbol that occurs only once."""
    at = window_starts(starts, window)
    once = offsets_of(~repeated)
    left, right = parse.left[at], parse.right[at + window]
    return at[(left >= right) | (once[np.maximum(left, right)] == once[left])]


def window_hashes(names: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Two polynomial hashes of the windows that begin at ``at``, one row each: one of each half of the words' names."""
    out = np.empty((len(at), 2), np.uint64)
    with np.errstate(over="ignore"):
        for k, base in enumerate(BASES):
            values = mixed(names[:, k], np.uint64(k + 7))
            powers = np.cumprod(np.append(np.uint64(1), np.full(len(names), base, np.uint64)))
            back = np.cumprod(np.append(np.uint64(1), np.full(len(names), pow(base, -1, 2**64), np.uint64)))
            sums = np.append(np.uint64(0), np.cumsum(values * powers[:-1]))
            out[:, k] = mixed((sums[at + window] - sums[at]) * back[at], np.uint64(k))
    return out


# --- which keys occur twice, over all blocks -------------------------------


def different(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different rows of ``keys`` (sorted), the row of each key, and how often each occurs."""
    order = np.lexsort(keys.T[::-1])
    ordered = keys[order]
    begins = np.append(True, (ordered[1:] != ordered[:-1]).any(axis=1)) if len(keys) else np.zeros(0, bool)
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(begins) - 1
    return ordered[begins], which, np.diff(np.append(np.flatnonzero(begins), len(keys)))


def dealt(keys: np.ndarray, parts: int) -> list[tuple[int, int, int]]:
    """(part, from, to) of sorted keys, by ranges of the first number; parts without keys are left out."""
    of = ((keys[:, 0] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    at = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    return list(zip(of[at].tolist(), at.tolist(), np.append(at[1:], len(of)).tolist()))


def seen_twice(sent: DataFrame, width: int) -> DataFrame:
    """One row a block with the answers (part, bits) to the keys it sent as (part, block, keys)."""

    def compared(group: pa.Table) -> pa.Table:
        raw = [np.frombuffer(k.as_buffer(), np.uint64).reshape(-1, width) for k in group.column("keys")]
        _, which, times = different(np.concatenate(raw))
        bits = np.split(times[which] > 1, np.cumsum([len(r) for r in raw])[:-1])
        return pa.table(
            [group.column("block"), group.column("part"), pa.array([np.packbits(b).tobytes() for b in bits], pa.binary())],
            ["block", "part", "bits"],
        )

    answers = sent.groupBy("part").applyInArrow(compared, "block bigint, part bigint, bits binary")
    return answers.groupBy("block").agg(F.collect_list(F.struct("part", "bits")).alias("answers"))


def with_answers(keys: np.ndarray, answers, parts: int) -> np.ndarray:
    """For each key, whether it occurs twice: in its own block, or by the answers."""
    unique, which, times = different(keys)
    twice = times > 1
    bits = {a["part"]: a["bits"] for a in answers or ()}
    for part, start, stop in dealt(unique, parts):
        twice[start:stop] |= np.unpackbits(np.frombuffer(bits[part], np.uint8), count=stop - start).astype(bool)
    return twice[which]


def sent_keys(block: int, keys: np.ndarray, parts: int) -> pa.RecordBatch:
    unique = different(keys)[0]
    rows = dealt(unique, parts)
    return pa.record_batch(
        [
            pa.array([p for p, _, _ in rows], pa.int64()), pa.array([block] * len(rows), pa.int64()),
            pa.array([unique[s:e].tobytes() for _, s, e in rows], pa.binary()),
        ],
        ["part", "block", "keys"],
    )


# --- the operator ----------------------------------------------------------


def bucket_count(n_bytes: int) -> int:
    """Buckets for texts of so many bytes; Spark allows 100,000, and a bucket's blocks pass one after the other."""
    return max(1, min(MOST_BUCKETS, -(-n_bytes // BUCKET_BYTES)))


def stored_blocks(docs: DataFrame, block_bytes: int, buckets: int) -> DataFrame:
    """The rows as blocks, one list a column, stored bucketed by block number."""
    spark = docs.sparkSession
    shape = ", ".join(f"`{c}` array<{t}>" for c, t in docs.dtypes)

    def packed(batches):
        for piece in pieces(batches, "text", block_bytes):
            lists = []
            for i in range(piece.num_columns):
                column = piece.column(i)
                lists.append(pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column))
            yield pa.record_batch(lists, piece.schema.names)

    made = docs.mapInArrow(packed, shape).withColumn("block", F.monotonically_increasing_id())
    name = f"blocks_{uuid.uuid4().hex}"
    made.write.bucketBy(buckets, "block").option("path", new_folder(spark, "blocks")).saveAsTable(name)
    stored = spark.table(name)
    # The name is only needed to tell Spark of the buckets; the files stay in the shared folder.
    spark.sql(f"drop table {name}")
    return stored


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW_WORDS,
    pair_rounds: int = PAIR_ROUNDS,
    rejoin: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the words that lie in a window of words which also begins anywhere else.

    All columns stay; ``n_words`` and ``n_removed`` are added (columns of these
    names are replaced). A text that loses words becomes its kept words, joined
    by one space; another stays as it is, or with ``rejoin`` is joined likewise.
    A null text has no words: it stays null, or with ``rejoin`` becomes empty.
    Texts shorter than the window lose nothing, copies and repeated rows lose
    all windows they share, and an empty table gives an empty result.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_removed")
    names = docs.columns
    text_at = names.index("text")
    inner = docs.select(*[F.col(f"`{c}`").cast("string" if c == "text" else t).alias("text" if c == "text" else f"c{i}") for i, (c, t) in enumerate(docs.dtypes)])
    inner_names = inner.columns
    n_bytes = inner.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = stored_blocks(inner, block_bytes, bucket_count(n_bytes))
    parts = max(1, -(-n_bytes // BYTES_A_PART))

    def parsed(texts: list, known: WordNames):
        words = [(t or b"").split() for t in texts]
        ids, starts = word_names(words, known)
        return words, ids, starts, Parse(ids[:, 0], starts, pair_rounds)

    def texts_of(batch: pa.RecordBatch, row: int) -> list:
        return batch.column("text")[row].values.cast(pa.binary()).to_pylist()

    def symbols(batches):
        known = WordNames()
        for batch in batches:
            for row in range(batch.num_rows):
                parse = parsed(texts_of(batch, row), known)[3]
                yield sent_keys(batch.column("block")[row].as_py(), parse.names[:, None], parts)

    sent = "part bigint, block bigint, keys binary"
    first = cut(seen_twice(blocks.select("block", "text").mapInArrow(symbols, sent), 1))

    def windows(batches):
        known = WordNames()
        for batch in batches:
            for row in range(batch.num_rows):
                _, ids, starts, parse = parsed(texts_of(batch, row), known)
                repeated = with_answers(parse.names[:, None], batch.column("answers")[row].as_py(), parts)
                at = candidates(parse, starts, repeated, window)
                yield sent_keys(batch.column("block")[row].as_py(), window_hashes(ids, at, window), parts)

    asked = blocks.select("block", "text").join(first, "block", "left").mapInArrow(windows, sent)
    second = cut(seen_twice(asked, 2))

    def removed(batches):
        known = WordNames()
        for batch in batches:
            for row in range(batch.num_rows):
                texts = texts_of(batch, row)
                words, ids, starts, parse = parsed(texts, known)
                repeated = with_answers(parse.names[:, None], batch.column("answers")[row].as_py(), parts)
                at = candidates(parse, starts, repeated, window)
                hit = at[with_answers(window_hashes(ids, at, window), batch.column("verified")[row].as_py(), parts)]
                gone = covered(hit, len(ids), window)
                lost = np.diff(offsets_of(gone)[starts])
                out = []
                for i, (text, own) in enumerate(zip(texts, words)):
                    if lost[i]:
                        stays = ~gone[starts[i] : starts[i + 1]]
                        out.append(b" ".join([w for w, s in zip(own, stays.tolist()) if s]))
                    else:
                        out.append(b" ".join(own) if rejoin else text)
                columns = [batch.column(f"c{i}")[row].values for i in range(len(names)) if i != text_at]
                columns.insert(text_at, pa.array(out, pa.binary()).cast(pa.string()))
                yield pa.record_batch(
                    [*columns, pa.array(np.diff(starts)), pa.array(lost)], [*inner_names, "n_words", "n_removed"]
                )

    shape = ", ".join(f"`{c}` {t}" for c, t in inner.dtypes)
    verified = blocks.join(first, "block", "left").join(second.withColumnRenamed("answers", "verified"), "block", "left")
    out = verified.mapInArrow(removed, f"{shape}, n_words bigint, n_removed bigint")
    return out.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(inner_names, names)], "n_words", "n_removed")


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents without repeated passages, as digests."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    kept = remove_repeats(docs, rejoin=True)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
