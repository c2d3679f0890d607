"""Phrase collocation mining by dynamic itemset counting.

The texts are numbered once, in pieces that hold one language's words, and the
pieces are dealt to shards, which are scanned in a cycle. Words are counted from
the first scan on. A longer phrase becomes active in the scan after both its
subphrases (without its last word, without its first) have reached the
threshold, so lengths are counted side by side, and a phrase is complete when
its scans have seen every shard once. The scans end when no phrase can still be
open, after five cycles at most.

What a scan must know of the reached phrases is a table of fixed size: a phrase
has a slot by its name, and a slot holds the first scan in which longer phrases
may start. Slots are set once, so every phrase has one starting scan, that of
the latest slot among its subphrases, and is counted for exactly one cycle. Two
phrases in one slot only make a few phrases start that need not; a phrase that
is reported has counts of its own words, and its subphrases have theirs, as they
are at least as frequent. So the table bounds what is broadcast, not what is
found.

While they are counted, phrases go by names of 95 bits made from their words'
128-bit hashes; those reported get their words back from the texts. With 1e12
different phrases, the chance that any two have one name is below 2e-5.

Each scan's counts are stored once. A phrase that reaches the threshold in one
cycle has its share of it, threshold / shards, in some scan, so only phrases that
are so frequent in one of the last scans are summed over them. After two cycles
all words and pairs are complete, and the pieces are cut down to the words in
frequent pairs: no other word can be in a frequent phrase that is still open.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from catalog_engine.llm.common import mixed, pieces, raw_texts, table
from catalog_engine.session import cut, new_folder

THRESHOLD = 100
LONGEST = 5
MOST_PHRASES = 2_000
SHARDS = 4
# Entries of the table of reached phrases, one byte each; compressed, it goes to every task of a scan.
SLOTS = 1 << 24
# Texts are numbered together up to so many bytes, and split into words by fewer.
PIECE_BYTES = 4_000_000
SPLIT_BYTES = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What ends a piece becomes a full stop, which then is in no word; a tab becomes a space.
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
CLEAN = bytes(ord(".") if c in ENDS else 32 if c == 9 else ord(chr(c).lower()) if chr(c) in UPPER else c for c in range(256))
# Phrases, of three numbers each, that are sent to all tasks to join them with the counts.
BROADCAST_ROWS = 500_000
BITMAP_BITS = 32_768  # of one row of Spark's bitmap functions
PIECE = "lang string, shard int, piece bigint, words binary, ids binary, n_words bigint"
PIECE_COLUMNS = ["lang", "shard", "piece", "words", "ids"]
# Pieces are numbered by task, with so many numbers for each.
TASK_PIECES = 1 << 12
# Name of a phrase in two numbers; mark is 256 times its size and its first scan; at is its first place found: one bit
# for pieces that are cut down, then the piece, and 31 bits for the word.
DELTA = "a bigint, b int, mark int, n bigint, at bigint"
CUT_DOWN = 1 << 62


class Numbering:
    """Words of texts of one language as numbers; number 0 is the end of a phrase's piece of text."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {b".": 0}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        tokens = (text + b".").translate(CLEAN).replace(b".", b" . ").split()
        numbers = self.numbers
        self.parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in tokens), np.int32, len(tokens)))
        self.size += len(text)


def piece_row(lang: str, shard: int, piece: int, words: list[bytes], ids: np.ndarray) -> tuple:
    return lang, shard, piece, b" ".join(words), ids.astype(np.int32).tobytes(), int(np.count_nonzero(ids))


def piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*PIECE_COLUMNS, "n_words"])


def numbered(docs: DataFrame, shards: int) -> DataFrame:
    """Pieces of the texts of one language each, dealt to the shards in turn."""

    def made(batches) -> Iterator[pa.RecordBatch]:
        open_pieces: dict[str, Numbering] = {}
        task, n_made = TaskContext.get().partitionId(), 0

        def closed(lang: str) -> pa.RecordBatch:
            nonlocal n_made
            x = open_pieces.pop(lang)
            if n_made == TASK_PIECES:
                raise ValueError(f"more than {TASK_PIECES} pieces in a task: read the table in smaller splits")
            n_made += 1
            turn = task + n_made
            return piece_batch([piece_row(lang, turn % shards, task * TASK_PIECES + n_made - 1, list(x.numbers), np.concatenate(x.parts))])

        for piece in pieces(batches, most=SPLIT_BYTES):
            groups: dict[str, list[bytes]] = {}
            for text, lang in zip(raw_texts(piece), piece.column("lang").to_pylist()):
                groups.setdefault(lang, []).append(text)
            for lang, texts in groups.items():
                open_pieces.setdefault(lang, Numbering()).add(b".".join(texts))
            whole = sum(x.size for x in open_pieces.values())
            for lang in list(open_pieces):
                if open_pieces[lang].size >= PIECE_BYTES or whole >= 2 * PIECE_BYTES:
                    yield closed(lang)
        for lang in list(open_pieces):
            yield closed(lang)

    return docs.select("lang", "text").mapInArrow(made, PIECE)


def rows_of(batches) -> Iterator[tuple]:
    """lang, shard, piece, words and their numbers of every piece, and what other columns there are."""
    for batch in batches:
        for k in range(batch.num_rows):
            lang, shard, piece, words, ids, *more = (c[k].as_py() for c in batch.columns)
            yield lang, shard, piece, words.split(b" "), np.frombuffer(ids, np.int32), *more


def word_names(lang: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    seed = xxhash.xxh3_64_intdigest(lang.encode())
    both = np.frombuffer(b"".join([xxhash.xxh3_128_digest(w, seed) for w in words]), np.uint64).reshape(-1, 2)
    return np.ascontiguousarray(both[:, 0]), np.ascontiguousarray(both[:, 1])


def stored_name(a: np.ndarray, b: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """A name as it is counted: 63 bits of the first part and 32 of the second."""
    return pa.array((a >> np.uint64(1)).view(np.int64)), pa.array((b >> np.uint64(32)).astype(np.uint32).view(np.int32))


def places(a: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Slots of names; the number that is stored is half of the first part, which then has a sign."""
    return ((a >> np.uint64(1)) % np.uint64(len(slots))).astype(np.int64)


class Level:
    """Where the phrases of one size begin that start with the reached ones: names, numbers in the piece, first scans."""

    def __init__(self, at, a, b, key, since):
        self.at, self.a, self.b, self.key, self.since = at, a, b, key, since

    def some(self, which: np.ndarray) -> Level:
        return Level(self.at[which], self.a[which], self.b[which], self.key[which], self.since[which])

    def reached(self, slots: np.ndarray) -> Level:
        """Those whose slot is set. It may be older than the phrase if another set it; then the phrase's own start counts."""
        opened = slots[places(self.a, slots)]
        out = self.some(np.flatnonzero(opened))
        out.since = np.maximum(opened[opened > 0], out.since)
        return out

    def unique(self, which: np.ndarray) -> tuple[Level, np.ndarray]:
        """One of each phrase among ``which``, and how many there are."""
        code, unique = pd.factorize(self.key[which])
        example = np.zeros(len(unique), np.int64)
        example[code[::-1]] = which[::-1]
        return self.some(example), np.bincount(code, minlength=len(unique))


def levels(lang: str, words: list[bytes], ids: np.ndarray, slots: np.ndarray, longest: int) -> Iterator[Level]:
    """Phrases of one word, of two and so on, each with both parts reached before it."""
    a, b = word_names(lang, words)
    opened = slots[places(a, slots)]
    opened[0] = 0
    at = np.flatnonzero(opened[ids])
    own = ids[at]
    level = Level(at, a[own], b[own], own.astype(np.int64), opened[own])
    yield level
    for size in range(2, longest + 1):
        both = np.flatnonzero(level.at[1:] == level.at[:-1] + 1)
        since = np.maximum(level.since[both], level.since[both + 1])
        level = level.some(both)
        last = ids[level.at + size - 1]
        key = pd.factorize(level.key * len(words) + last)[0]
        longer = Level(level.at, mixed(level.a, a[last]), mixed(b[last], level.b), key, since)
        yield longer
        level = longer.reached(slots)


def piece_counts(lang: str, words: list[bytes], ids: np.ndarray, slots: np.ndarray, scan: int, shards: int, longest: int):
    """(names in two parts, mark, n, first place) of the phrases of a piece that are active in this scan."""
    if scan < shards:
        a, b = word_names(lang, words)
        n = np.bincount(ids, minlength=len(words))
        yield *stored_name(a[1:], b[1:]), np.full(len(words) - 1, 256), n[1:], np.zeros(len(words) - 1, np.int64)
    for size, level in enumerate(levels(lang, words, ids, slots, longest), 1):
        if size > 1:
            found, n = level.unique(np.flatnonzero(level.since.astype(np.int32) + shards > scan))
            yield *stored_name(found.a, found.b), size * 256 + found.since.astype(np.int32), n, found.at


def scan_counts(stored: DataFrame, shared, scan: int, shards: int, longest: int) -> DataFrame:
    """Counts of the active phrases in one shard, combined by piece; ``shared`` is the broadcast table of slots, compressed."""

    def scanned(batches):
        slots = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for lang, _, piece, words, ids in rows_of(batches):
            place = (piece << 31) + (CUT_DOWN if scan >= 2 * shards else 0)
            for a, b, mark, n, at in piece_counts(lang, words, ids, slots, scan, shards, longest):
                columns = [a, b, pa.array(mark, pa.int32()), pa.array(n, pa.int64()), pa.array(at + place)]
                yield pa.record_batch(columns, ["a", "b", "mark", "n", "at"])

    found = stored.filter(F.col("shard") == scan % shards).select(*PIECE_COLUMNS).mapInArrow(scanned, DELTA)
    return found.groupBy("a", "b", "mark").agg(F.sum("n").alias("n"), F.min("at").alias("at"))


def in_frequent_pairs(stored: DataFrame, shared) -> DataFrame:
    """The pieces cut down to the words in reached pairs, with what is between replaced by an end."""

    def cut_down(batches):
        slots = np.frombuffer(zlib.decompress(shared.value), np.uint8)
        for lang, shard, piece, words, ids in rows_of(batches):
            _, pairs = levels(lang, words, ids, slots, 2)
            first = pairs.reached(slots).at
            kept = np.union1d(first, first + 1)
            gap = np.flatnonzero(np.diff(kept) > 1) + 1
            chosen, place = np.unique(np.append(np.insert(ids[kept], gap, 0), 0), return_inverse=True)
            yield piece_batch([piece_row(lang, shard, piece, [words[i] for i in chosen], place)])

    return stored.select(*PIECE_COLUMNS).mapInArrow(cut_down, PIECE)


def name_of(names: tuple[np.ndarray, np.ndarray], ids: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of ``size`` words that begin at ``at``."""
    a, b = (x[ids[at]] for x in names)
    for k in range(1, size):
        word = ids[at + k]
        a, b = mixed(a, names[0][word]), mixed(names[1][word], b)
    return a, b


def cuts_of(often: DataFrame, stored: DataFrame) -> DataFrame:
    """The words of the frequent phrases that were first found in these pieces, and for each cut the names of first part and rest.

    Every phrase is looked up once, where it was found first, so a piece has as
    many as it has places at most.
    """
    places = F.struct(*[F.col(c) for c in ("a", "b")], (F.col("at") % (1 << 31)).alias("word"), F.floor(F.col("mark") / 256).alias("size"))
    wanted = often.filter("mark >= 512").withColumn("piece", F.shiftright("at", 31) % (1 << 31))
    wanted = wanted.groupBy("piece").agg(F.collect_list(places).alias("places"))
    if often.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def named(batches):
        for lang, _, _, words, ids, places in rows_of(batches):
            names, texts = word_names(lang, words), pa.array(words, pa.binary()).cast(pa.string())
            table = np.array([(p["word"], p["size"], p["a"], p["b"]) for p in places], np.int64)
            for size in np.unique(table[:, 1]).tolist():
                at, _, a, b = table[table[:, 1] == size].T
                phrase = pc.binary_join_element_wise(*[texts.take(pa.array(ids[at + k])) for k in range(size)], " ")
                for k in range(1, size):
                    first, rest = name_of(names, ids, at, k), name_of(names, ids, at + k, size - k)
                    own = pa.array(a), pa.array(b.astype(np.int32))
                    yield pa.record_batch(
                        [
                            pa.repeat(pa.scalar(lang, pa.string()), len(phrase)),
                            phrase.cast(pa.string()),
                            pa.repeat(pa.scalar(size, pa.int32()), len(phrase)),
                            pa.repeat(pa.scalar(k, pa.int32()), len(phrase)),
                            *own, *stored_name(*first), *stored_name(*rest),
                        ],
                        ["lang", "phrase", "size", "k", "a", "b", "a_first", "b_first", "a_rest", "b_rest"],
                    )

    shape = "lang string, phrase string, size int, k int, a bigint, b int, a_first bigint, b_first int, a_rest bigint, b_rest int"
    return stored.join(wanted, "piece").select(*PIECE_COLUMNS, "places").mapInArrow(named, shape)


def union_of(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def in_shards(rows: DataFrame) -> DataFrame:
    """The rows, stored in a folder for each shard."""
    path = new_folder(rows.sparkSession, "shards")
    rows.write.partitionBy("shard").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def open_counts(deltas: list[DataFrame], threshold: int, scan: int, shards: int) -> DataFrame:
    """Counts so far, and in the last scan, of the phrases still open in it that can have reached the threshold.

    ``deltas`` are the counts of the last scans, a cycle at most. A phrase with
    fewer than threshold / shards in each of them is below the threshold.
    """
    least = -(-threshold // shards)
    likely = union_of([d.filter((F.col("n") >= least) & (F.col("mark") % 256 + shards > scan)).select("a", "b", "mark") for d in deltas])
    last = len(deltas) - 1
    counts = union_of([d.select("a", "b", "n", (F.col("n") * int(k == last)).alias("n_now"), "at") for k, d in enumerate(deltas)])
    # Stored and counted first: few phrases go to the counts, and only very many are joined by a shuffle of all counts.
    likely = cut(likely.distinct())
    if likely.count() <= BROADCAST_ROWS:
        likely = F.broadcast(likely)
    found = counts.join(likely, ["a", "b"]).groupBy("a", "b", "mark")
    return cut(found.agg(F.sum("n").alias("n"), F.sum("n_now").alias("n_now"), F.min("at").alias("at")))


def newly_reached(counted: DataFrame, threshold: int, longest: int, slots: int) -> np.ndarray:
    """Slots of the phrases that reached the threshold in this scan, brought here as bitmaps: a bit for a slot at most."""
    found = counted.filter((F.col("n") >= threshold) & (F.col("n") - F.col("n_now") < threshold) & (F.col("mark") < longest * 256))
    place = F.col("a") % slots + 1
    bits = found.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    out = np.zeros(-(-slots // BITMAP_BITS) * BITMAP_BITS, bool)
    for row in bits.collect():
        begin = (row["bucket"] - 1) * BITMAP_BITS
        out[begin : begin + BITMAP_BITS] |= np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little").astype(bool)
    return out[:slots]


def phrase_counts(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, shards: int = SHARDS, slots: int = SLOTS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(a, b, n) of all phrases with ``threshold`` occurrences, the cuts of such phrases, and (lang, n) of all word occurrences.

    ``docs`` has lang and text. ``shards`` times ``longest`` is below 256, so a scan's number fits a byte.
    """
    spark = docs.sparkSession
    if not 0 < shards * longest < 256:
        raise ValueError("shards times longest must be below 256")
    rows = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    stored = whole = in_shards(numbered(rows, shards))
    totals = cut(stored.groupBy("lang").agg(F.sum("n_words").alias("n")))
    opening = np.zeros(slots, np.uint8)
    deltas: list[DataFrame] = []
    complete, scan, until = [], 0, shards - 1
    while scan <= until:
        shared = spark.sparkContext.broadcast(zlib.compress(opening.tobytes(), 1))
        if scan == 2 * shards:
            stored = in_shards(in_frequent_pairs(stored, shared))
        deltas = [*deltas, cut(scan_counts(stored, shared, scan, shards, longest))][-shards:]
        shared.destroy()  # nothing reads the scan again: its counts are stored
        counted = open_counts(deltas, threshold, scan, shards)
        found = newly_reached(counted, threshold, longest, slots)
        if found.any():
            until = max(until, scan + shards)
            opening = np.where((opening == 0) & found, np.uint8(scan + 1), opening)
        # A phrase is complete after one cycle; only those of the threshold are kept then.
        complete.append(counted.filter((F.col("mark") % 256 + shards - 1 == scan) & (F.col("n") >= threshold)))
        scan += 1
    often = cut(union_of(complete).select("a", "b", "mark", "n", "at"))
    cuts = cuts_of(often.filter(F.col("at") < CUT_DOWN), whole)
    if stored is not whole:
        cuts = cuts.unionByName(cuts_of(often.filter(F.col("at") >= CUT_DOWN), stored))
    return often, cuts, totals


def collocations(
    docs: DataFrame,
    threshold: int = THRESHOLD,
    longest: int = LONGEST,
    most: int = MOST_PHRASES,
    shards: int = SHARDS,
    slots: int = SLOTS,
) -> DataFrame:
    """Each language's phrases of two words or more that are the most often together, against their weakest cut.

    Further columns of ``docs`` are not read. A null language is ``und``, a null
    or empty text has no words, rows that repeat count each time, ties are in
    byte order of the phrase. A language without frequent phrases has no row,
    and an empty table gives an empty result.
    """
    often, cuts, totals = phrase_counts(docs, threshold, longest, shards, slots)

    def count_of(name: str, suffix: str) -> DataFrame:
        return often.select(*[F.col(c).alias(c + suffix) for c in ("a", "b")], F.col("n").alias(name))

    cuts = cut(cuts)
    cuts = cuts.join(count_of("f", ""), ["a", "b"])
    # A phrase inside a longer one is inside one that is longer by one word and at least as frequent as that.
    head = cuts.filter("size > 2 and k = size - 1").select(F.col("a_first").alias("a"), F.col("b_first").alias("b"), F.col("f").alias("f_longer"))
    tail = cuts.filter("size > 2 and k = 1").select(F.col("a_rest").alias("a"), F.col("b_rest").alias("b"), F.col("f").alias("f_longer"))
    longer = head.unionByName(tail).groupBy("a", "b").agg(F.max("f_longer").alias("f_longer"))
    own = cuts.join(longer, ["a", "b"], "left").filter("f_longer is null or f_longer < f")
    own = own.join(count_of("l", "_first"), ["a_first", "b_first"]).join(count_of("r", "_rest"), ["a_rest", "b_rest"]).join(totals, "lang")
    # Products of three counts pass 64 bits; decimals hold 38 digits and divide exactly.
    score = F.expr("(1000BD * cast(f as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    best = own.withColumn("score", score).groupBy("lang", "phrase", F.col("f").alias("a"), "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("best.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "best.l", "best.r", "n", "best.score")


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """Phrases of all documents."""
    return collocations(table(spark, folder, "documents"))


COLLOCATIONS_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), grams AS (
  SELECT lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) AS phrase
  FROM words, (SELECT unnest(range(1, {LONGEST + 1})) AS k) WHERE len(w) >= k
), counted AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(n)::HUGEINT AS n FROM counted WHERE k = 1 GROUP BY lang
), often AS (
  SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE n >= {THRESHOLD}
), longer AS (
  SELECT lang, part, max(n) AS n FROM (
    SELECT lang, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:k], ' ')]) AS part, n FROM often WHERE k > 2
  ) GROUP BY lang, part
), own AS (
  SELECT o.* FROM often o LEFT JOIN longer x ON x.lang = o.lang AND x.part = o.phrase WHERE o.k > 1 AND coalesce(x.n, 0) < o.n
), cuts AS (
  SELECT o.lang, o.phrase, o.n AS a, c, x.n AS l, y.n AS r, t.n, (1000 * o.n * t.n) // (x.n * y.n) AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM own) o
  JOIN often x ON x.lang = o.lang AND x.phrase = array_to_string(o.w[1:o.c], ' ')
  JOIN often y ON y.lang = o.lang AND y.phrase = array_to_string(o.w[o.c + 1:o.k], ' ')
  JOIN totals t ON t.lang = o.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best
)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {MOST_PHRASES}
"""
