"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

A text's features are its words, hashed to buckets and weighted by the logarithm
of their count; statistics of its structure, each in bins; and its recorded
length against its real one. The score is the logistic function of a linear part
and of all pairwise interactions <v_i, v_j> x_i x_j, which the identity

    sum over pairs = 1/2 * sum over factors of ((sum v x)^2 - sum (v x)^2)

gives in time linear in the features. The machine is fitted in numpy, in one
task, on a bounded sample of labelled rows that arrive as feature vectors, not
as texts. Scoring runs in all tasks, over whole texts.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_engine.llm.common import lowest_hashes, offsets_of, pieces, raw_texts, table

# Labelled rows of each class that the machine is fitted on. A row has at most N_FEATURES values of 6 bytes, so the
# sample is 300 MB where every text uses every bucket, and some 10 MB for texts of common length.
SAMPLE_PER_CLASS = 1_500
WORD_BUCKETS = 16_384
BINS = 16
FACTORS = 8
EPOCHS = 12
BATCH = 64
RATE = 0.02
SHRINK = 0.002
KEEP_SCORE = 0.3
# Classes of bytes whose share of the text is a statistic.
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
BYTE_CLASSES = (UPPER, b"0123456789", b"#*$%&|<>~^@_=+\\/{}[]`", b".,;:!?'\"()-", bytes(range(128, 256)), b" \t\n\r\x0b\x0c")
STATISTICS = len(BYTE_CLASSES) + 8
METADATA = 2
N_FEATURES = WORD_BUCKETS + (STATISTICS + METADATA) * BINS
CLASS_OF = np.zeros((256, len(BYTE_CLASSES)), np.int64)
for _k, _bytes in enumerate(BYTE_CLASSES):
    CLASS_OF[list(_bytes), _k] = 1


def share_bins(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Bin of a share, finer near zero."""
    return np.minimum(BINS - 1, (BINS * np.sqrt(part / np.maximum(whole, 1))).astype(np.int64))


def size_bins(size: np.ndarray) -> np.ndarray:
    """Bin of a size: the bits of its number."""
    return np.minimum(BINS - 1, np.log2(1 + np.maximum(size, 0)).astype(np.int64))


@dataclass
class Rows:
    """Sparse rows: the features and values of each, row after row, and where each begins."""

    index: np.ndarray
    value: np.ndarray
    starts: np.ndarray


def features(texts: list[bytes], lengths: list[int | None]) -> Rows:
    """Feature vectors of UTF-8 texts and their recorded lengths."""
    n = len(texts)
    lists = [t.split() for t in texts]
    sizes = np.fromiter(map(len, lists), np.int64, n)
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for words in lists for w in words), np.int64, sizes.sum())
    n_words = max(1, len(numbers))
    used, times = np.unique(np.repeat(np.arange(n), sizes) * n_words + ids, return_counts=True)
    doc, word = used // n_words, used % n_words
    lower = [w.lower() for w in numbers]
    bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % WORD_BUCKETS for w in lower), np.int64, len(lower))
    at, place = np.unique(doc * WORD_BUCKETS + bucket[word], return_inverse=True)
    count = np.bincount(place, weights=times, minlength=len(at))
    row, index = at // WORD_BUCKETS, at % WORD_BUCKETS
    value = np.log1p(count)
    value /= np.sqrt(np.bincount(row, weights=value**2, minlength=n))[row]

    raw = np.array([np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in texts]).reshape(n, 256)
    n_bytes = raw.sum(axis=1)
    shares = raw @ CLASS_OF
    lines = [[line for line in t.split(b"\n") if line.strip()] for t in texts]
    n_lines = np.fromiter(map(len, lines), np.int64, n)
    n_unlike = np.fromiter((len(set(x)) for x in lines), np.int64, n)
    longest = np.fromiter((max(map(len, words), default=0) for words in lists), np.int64, n)
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc, times)
    distinct = np.bincount(doc, minlength=n)
    n_chars = n_bytes - raw[:, 128:192].sum(axis=1)  # bytes that continue a character are not counted
    told = np.array([-1 if x is None else x for x in lengths], np.float64)
    bins = [share_bins(shares[:, k], n_bytes) for k in range(len(BYTE_CLASSES))]
    bins += [
        size_bins(sizes),
        size_bins(8 * n_bytes / np.maximum(sizes, 1)),
        size_bins(longest),
        size_bins(4 * sizes / np.maximum(n_lines, 1)),
        share_bins(n_lines - n_unlike, n_lines),
        share_bins(distinct, sizes),
        share_bins(most, sizes),
        share_bins(raw[:, 33], n_bytes),
        # Metadata: the recorded length, and how far it is from the real one; the last bin says that there is none.
        np.where(told < 0, BINS - 1, np.minimum(BINS - 2, size_bins(told))),
        np.where(told < 0, BINS - 1, np.minimum(BINS - 2, size_bins(np.abs(told - n_chars)))),
    ]
    others = WORD_BUCKETS + np.arange(len(bins)) * BINS + np.stack(bins, axis=1)
    row = np.concatenate([row, np.repeat(np.arange(n), len(bins))])
    index = np.concatenate([index, others.ravel()])
    # The statistics together weigh as much as the words.
    value = np.concatenate([value, np.full(others.size, 1 / np.sqrt(len(bins)))])
    order = np.argsort(row, kind="stable")
    return Rows(index[order], value[order].astype(np.float32), offsets_of(np.bincount(row, minlength=n)))


@dataclass
class Machine:
    """Intercept, weight of every feature, and its factors."""

    bias: np.ndarray
    linear: np.ndarray
    factors: np.ndarray

    @classmethod
    def fresh(cls, prior: float, seed: int) -> Machine:
        random = np.random.default_rng(seed)
        odds = np.log(prior / (1 - prior))
        return cls(
            np.full(1, odds, np.float32), np.zeros(N_FEATURES, np.float32), (random.normal(size=(N_FEATURES, FACTORS)) * 0.05).astype(np.float32)
        )

    def sums(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Logits, each row's sum of v x, and v x of every value. No row is empty: every text has its statistics."""
        terms = self.factors[rows.index] * rows.value[:, None]
        begins = rows.starts[:-1]
        total = np.add.reduceat(terms, begins, axis=0)
        squares = np.add.reduceat((terms**2).sum(axis=1), begins)
        linear = np.add.reduceat(self.linear[rows.index] * rows.value, begins)
        return self.bias[0] + linear + ((total**2).sum(axis=1) - squares) / 2, total, terms

    def scores(self, rows: Rows) -> np.ndarray:
        if len(rows.starts) < 2:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.sums(rows)[0].astype(np.float64), -30, 30)))

    def gradients(self, rows: Rows, labels: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        """Of the weighted log loss."""
        logit, total, terms = self.sums(rows)
        d_logit = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels) * importance
        each = np.repeat(d_logit, np.diff(rows.starts)) * rows.value
        linear, factors = np.zeros_like(self.linear), np.zeros_like(self.factors)
        np.add.at(linear, rows.index, each.astype(linear.dtype))
        inner = each[:, None] * (np.repeat(total, np.diff(rows.starts), axis=0) - terms)
        np.add.at(factors, rows.index, inner.astype(factors.dtype))
        return {"bias": d_logit.sum(keepdims=True), "linear": linear, "factors": factors}


def chosen_rows(rows: Rows, which: np.ndarray) -> Rows:
    sizes = np.diff(rows.starts)[which]
    at = np.concatenate([np.arange(rows.starts[i], rows.starts[i + 1]) for i in which])
    return Rows(rows.index[at], rows.value[at], offsets_of(sizes))


def train(rows: Rows, labels: np.ndarray, share: float, seed: int = 11) -> Machine | float:
    """A fitted machine for a population with this share of label 1, or the share if there is only one class."""
    if not len(labels) or labels.min() == labels.max():
        return share
    machine = Machine.fresh(share, seed)
    random = np.random.default_rng(seed)
    # The sample holds as many of each class as it can get; weights bring back their shares.
    importance = np.where(labels == 1, share / labels.mean(), (1 - share) / (1 - labels.mean()))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in vars(machine).items()}
    turn = 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(labels))
        for begin in range(0, len(order), BATCH):
            some = order[begin : begin + BATCH]
            turn += 1
            for name, gradient in machine.gradients(chosen_rows(rows, some), labels[some], importance[some] / len(some)).items():
                weight, (first, second) = getattr(machine, name), moments[name]
                if name == "factors":
                    gradient = gradient + SHRINK * weight / len(weight)
                first += 0.1 * (gradient - first)
                second += 0.001 * (gradient**2 - second)
                step = (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
                weight -= (RATE * 0.5 ** (epoch / 4) * step).astype(weight.dtype)
    return machine


def is_held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def readable(docs: DataFrame) -> DataFrame:
    """doc_id, text and recorded length; without a column n_chars no length is known."""
    length = F.col("n_chars").cast("bigint") if "n_chars" in docs.columns else F.lit(None).cast("bigint")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), length.alias("n_chars"))


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Machine | float:
    """Train on the labelled documents that are not held out.

    At most ``per_class`` documents of each class are read, those with the
    lowest hash of the doc_id. Labels other than 0 and 1 are left out, a null
    text is empty, and of rows that repeat a doc_id the least text counts.
    """
    known = labels.filter("quality in (0, 1)").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.filter(~is_held_out()).distinct()
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}  # two rows
    if not counts:
        return 0.0
    share = counts.get(1, 0) / sum(counts.values())
    # Twice the rows wanted pass the bound on the hash, whatever the number of labels; then they are ranked.
    candidates = lowest_hashes(known, "quality", counts, 2 * per_class)
    rows = readable(docs).join(F.broadcast(candidates), "doc_id").groupBy("doc_id", "quality", "place").agg(
        F.min(F.struct("text", "n_chars")).alias("row")
    )
    rows = rows.select("doc_id", "quality", "place", F.col("row.text").alias("text"), F.col("row.n_chars").alias("n_chars"))

    def vectors(batches):
        for piece in pieces(batches):
            made = features(raw_texts(piece), piece.column("n_chars").to_pylist())
            index = made.index.astype(np.uint16)
            cut_at = list(zip(made.starts[:-1], made.starts[1:]))
            yield pa.record_batch(
                [
                    piece.column("place"),
                    piece.column("doc_id"),
                    piece.column("quality"),
                    pa.array([index[a:b].tobytes() for a, b in cut_at], pa.binary()),
                    pa.array([made.value[a:b].tobytes() for a, b in cut_at], pa.binary()),
                ],
                ["place", "doc_id", "quality", "features", "weights"],
            )

    def trained(batches):
        rows = sorted(
            (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[:3]
        )
        kept = [r for label in (0, 1) for r in [x for x in rows if x[2] == label][:per_class]]
        index = [np.frombuffer(r[3], np.uint16) for r in kept]
        made = Rows(
            np.concatenate([np.zeros(0, np.uint16), *index]).astype(np.int32),
            np.frombuffer(b"".join(r[4] for r in kept), np.float32),
            offsets_of(np.array([len(i) for i in index], np.int64)),
        )
        model = train(made, np.array([r[2] for r in kept], np.int64), share)
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    sample = rows.mapInArrow(vectors, "place bigint, doc_id bigint, quality int, features binary, weights binary")
    # The sample is bounded by its parameter, so one task may hold it, and the driver the fitted weights.
    found = sample.coalesce(1).mapInArrow(trained, "model binary").first()
    return pickle.loads(found[0]) if found else share


def score(docs: DataFrame, model: Machine | float, keep_score: float = KEEP_SCORE) -> DataFrame:
    """doc_id, ``score`` (0 to 1) and ``predicted`` (1 if score >= ``keep_score``) of every row of ``docs``.

    A null text is an empty one, and is scored by its statistics. Where the
    labels know only one class every text has their share of label 1. Equal
    texts of one recorded length score alike; an empty table stays empty.
    """

    def scored(batches):
        for piece in pieces(batches):
            texts = raw_texts(piece)
            if isinstance(model, Machine):
                found = model.scores(features(texts, piece.column("n_chars").to_pylist()))
            else:
                found = np.full(len(texts), model)
            yield pa.record_batch([piece.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])

    out = readable(docs).mapInArrow(scored, "doc_id bigint, score double")
    return out.withColumn("predicted", (F.col("score") >= keep_score).cast("int"))


def op11_factorization_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of all documents."""
    docs = table(spark, folder, "documents")
    scored = score(docs, fitted(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
