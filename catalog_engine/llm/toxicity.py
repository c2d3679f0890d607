"""Toxicity: a bidirectional gated recurrent network with attention pooling over character and word inputs.

A word's input is a learned vector of the word beside the mean of learned
vectors of its character n-grams, so a known stem with a new ending is still
seen. Windows of words overlap by half and are all scored; a document's score is
that of its highest window. The network is written and trained in numpy: in one
task, on a bounded sample of labelled rows. Labels say nothing of single
windows, so each epoch trains on the windows that score highest in their
document. Scoring runs in all tasks, over whole texts.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from catalog_engine.llm.common import lowest_hashes, mixed, offsets_of, pieces, ranges, raw_texts, table

# Labelled rows of each class that the network is fitted on, and bytes of their texts. A fit holds the texts, four bytes a
# word, and for each different word a few hundred bytes: some 200 MB for texts of 16 MB without a repeated word.
SAMPLE_PER_CLASS = 1_000
SAMPLE_BYTES = 8_000_000
WINDOW_WORDS = 32
STRIDE_WORDS = 16
HIDDEN = 8
WORD_SIZE = 8
CHAR_SIZE = 8
KNOWN_WORDS = 4_000
CHAR_BUCKETS = 16_384
CHAR_GRAMS = (3, 4, 5)
EPOCHS = 5
UPDATES = 24  # of an epoch, at least
BATCH = 256
RATE = 0.01
# The vectors of words and n-grams start from their log odds and move slower than the rest.
TABLE_RATE = 0.002
PRIOR_ROWS = 5
# Words whose inputs a worker keeps, and windows scored together.
KEPT_WORDS = 200_000
WINDOWS_AT_ONCE = 4_096
# Words whose n-grams are made at once, and windows of one run of words numbered at once.
WORDS_AT_ONCE = 8_192
WINDOWS_OF_A_RUN = 8_192
LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def char_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all character n-grams of the words, with marked ends, and how many each word has."""
    raw = [b"<" + w.encode() + b">" for w in words]
    lengths = np.fromiter(map(len, raw), np.int64, len(raw))
    joined = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    ends = np.repeat(np.cumsum(lengths), lengths)
    word = np.repeat(np.arange(len(raw)), lengths)
    found, owner = [], []
    for n in CHAR_GRAMS:
        at = np.flatnonzero(np.arange(len(joined)) + n <= ends)
        gram = np.full(len(at), n, np.uint64)
        for k in range(n):
            gram = gram << np.uint64(8) | joined[at + k]
        found.append((mixed(gram, 1) % np.uint64(CHAR_BUCKETS)).astype(np.int64))
        owner.append(word[at])
    owner = np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], np.bincount(owner, minlength=len(raw))


def window_table(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start (in all words), length and document of every window of documents of these numbers of words."""
    per_doc = np.where(sizes > 0, np.maximum(1, -(-(sizes - STRIDE_WORDS) // STRIDE_WORDS)), 0)
    doc = np.repeat(np.arange(len(sizes)), per_doc)
    inside = ranges(np.zeros(len(sizes), np.int64), per_doc) * STRIDE_WORDS
    return offsets_of(sizes)[doc] + inside, np.minimum(WINDOW_WORDS, sizes[doc] - inside), doc


@dataclass
class Network:
    """Parameters by name, the known words, and the share of toxic rows among the labelled."""

    known: dict[str, int]
    prior: float
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, known: dict[str, int], prior: float, seed: int) -> Network:
        random = np.random.default_rng(seed)
        size = WORD_SIZE + CHAR_SIZE
        some = lambda *shape: (random.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
        weights = {"words": some(len(known) + 1, WORD_SIZE), "chars": some(CHAR_BUCKETS, CHAR_SIZE)}
        weights["words"] *= 0
        weights["chars"] *= 0
        for way in ("f", "b"):
            weights |= {f"{way}x": some(size, 3 * HIDDEN), f"{way}h": some(HIDDEN, 3 * HIDDEN), f"{way}c": np.zeros(3 * HIDDEN, np.float32)}
        weights |= {"att": some(2 * HIDDEN, HIDDEN), "att_v": some(HIDDEN), "out": some(2 * HIDDEN), "out_c": np.zeros(1, np.float32)}
        return cls(known, prior, weights)

    def inputs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Inputs of different words: vectors, number of the known word, buckets and how many each word has."""
        number = np.fromiter((self.known.get(w, 0) for w in words), np.int64, len(words))
        return self.vectors(number, *char_buckets(words))

    def vectors(self, number: np.ndarray, buckets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same from what is known of the words."""
        sums = np.zeros((len(number), CHAR_SIZE), np.float32)
        begins = offsets_of(counts)[:-1]
        some = counts > 0
        if some.any():
            sums[some] = np.add.reduceat(self.weights["chars"][buckets], begins[some], axis=0)
        means = sums / np.maximum(counts, 1)[:, None]
        return np.concatenate([self.weights["words"][number], means], axis=1).astype(np.float32), number, buckets, counts

    def recur(self, way: str, projected: np.ndarray, index: np.ndarray, mask: np.ndarray | None, keep: list | None) -> np.ndarray:
        """Hidden states (steps, windows, HIDDEN) over ``index`` (steps, windows), in this or the opposite order."""
        steps, n = index.shape
        across = self.weights[f"{way}h"]
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((steps, n, HIDDEN), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            x = projected[index[t]]
            g = h @ across
            gates = x[:, : 2 * HIDDEN] + g[:, : 2 * HIDDEN]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(x[:, 2 * HIDDEN :] + r * g[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, new, g[:, 2 * HIDDEN :]))
            after = new + z * (h - new)
            h = after if mask is None else np.where(mask[t][:, None], after, h)
            out[t] = h
        return out

    def logits(self, projected: dict[str, np.ndarray], index: np.ndarray, mask: np.ndarray | None, keep: dict | None = None) -> np.ndarray:
        states = np.concatenate(
            [self.recur(w, projected[w], index, mask, None if keep is None else keep.setdefault(w, [])) for w in ("f", "b")], axis=2
        )
        inner = np.tanh(states @ self.weights["att"])
        score = inner @ self.weights["att_v"]
        if mask is not None:
            score = np.where(mask, score, -1e9)
        share = np.exp(score - score.max(axis=0))
        share /= share.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", share, states)
        if keep is not None:
            keep |= {"states": states, "inner": inner, "share": share, "pooled": pooled}
        return pooled @ self.weights["out"] + self.weights["out_c"][0]

    def project(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        return {w: inputs @ self.weights[f"{w}x"] + self.weights[f"{w}c"] for w in ("f", "b")}

    def gradients(self, inputs, number, buckets, counts, index, mask, labels, importance) -> dict[str, np.ndarray]:
        """Of the weighted log loss of these windows."""
        keep: dict = {}
        logit = self.logits(self.project(inputs), index, mask, keep)
        w = self.weights
        d_logit = ((sigmoid(logit) - labels) * importance).astype(np.float32)
        states, inner, share = keep["states"], keep["inner"], keep["share"]
        out = {"out": keep["pooled"].T @ d_logit, "out_c": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * w["out"]
        d_share = np.einsum("nh,tnh->tn", d_pooled, states)
        d_states = share[:, :, None] * d_pooled
        d_score = share * (d_share - (share * d_share).sum(axis=0))
        out["att_v"] = np.einsum("tn,tnh->h", d_score, inner)
        d_inner = d_score[:, :, None] * w["att_v"] * (1 - inner**2)
        out["att"] = np.einsum("tnh,tnk->hk", states, d_inner)
        d_states = d_states + d_inner @ w["att"].T
        d_inputs = np.zeros_like(inputs)
        for way, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            across = w[f"{way}h"]
            d_across, d_projected = np.zeros_like(across), np.zeros((len(inputs), 3 * HIDDEN), np.float32)
            d_h = np.zeros((index.shape[1], HIDDEN), np.float32)
            for t, h, z, r, new, g_new in reversed(keep[way]):
                d_h = d_h + d_states[t, :, part]
                d_after = d_h if mask is None else np.where(mask[t][:, None], d_h, 0)
                passed = d_h - d_after
                d_new = d_after * (1 - z) * (1 - new**2)
                d_z = d_after * (h - new) * z * (1 - z)
                d_r = d_new * g_new * r * (1 - r)
                d_x = np.concatenate([d_z, d_r, d_new], axis=1)
                d_g = np.concatenate([d_z, d_r, d_new * r], axis=1)
                d_across += h.T @ d_g
                np.add.at(d_projected, index[t], d_x)
                d_h = passed + d_after * z + d_g @ across.T
            out |= {f"{way}h": d_across, f"{way}x": inputs.T @ d_projected, f"{way}c": d_projected.sum(axis=0)}
            d_inputs += d_projected @ w[f"{way}x"].T
        out["words"], out["chars"] = np.zeros_like(w["words"]), np.zeros_like(w["chars"])
        np.add.at(out["words"], number, d_inputs[:, :WORD_SIZE])
        out["words"][0] = 0
        np.add.at(out["chars"], buckets, np.repeat(d_inputs[:, WORD_SIZE:] / np.maximum(counts, 1)[:, None], counts, axis=0))
        return out


class Scorer:
    """Scores texts with a network; keeps the projected inputs of the words it has seen."""

    def __init__(self, network: Network):
        self.network = network
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.projected = {w: np.zeros((WORDS_AT_ONCE, 3 * HIDDEN), np.float32) for w in ("f", "b")}

    def keep(self, begin: int, projected: dict[str, np.ndarray]) -> None:
        """Store projected inputs of new words; the room for them doubles when it is full."""
        for way, rows in projected.items():
            room, end = self.projected[way], begin + len(rows)
            if end > len(room):
                larger = np.zeros((max(2 * len(room), end), 3 * HIDDEN), np.float32)
                larger[:begin] = room[:begin]
                self.projected[way] = room = larger
            room[begin:end] = rows

    def numbers(self, words: list[str]) -> np.ndarray:
        if len(self.index) > KEPT_WORDS:
            self.forget()
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        for at in range(0, len(new), WORDS_AT_ONCE):
            some = new[at : at + WORDS_AT_ONCE]
            begin = len(self.index)
            self.keep(begin, self.network.project(self.network.inputs(some)[0]))
            self.index.update(zip(some, range(begin, begin + len(some))))
        return np.fromiter((self.index[w] for w in words), np.int64, len(words))

    def window_logits(self, numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.float32)
        whole = lengths == WINDOW_WORDS
        for group, masked in ((np.flatnonzero(whole), False), (np.flatnonzero(~whole), True)):
            for at in range(0, len(group), WINDOWS_AT_ONCE):
                some = group[at : at + WINDOWS_AT_ONCE]
                index, mask = window_index(numbers, starts[some], lengths[some], masked)
                out[some] = self.network.logits(self.projected, index, mask)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        lists = [words_of(t) for t in texts]
        words = [w for own in lists for w in own]
        starts, lengths, doc = window_table(np.fromiter(map(len, lists), np.int64, len(lists)))
        out = np.full(len(texts), self.network.prior)
        logits = np.empty(len(starts), np.float32)
        # Runs of windows, so that the words kept stay few in one very long text too.
        for at in range(0, len(starts), WINDOWS_OF_A_RUN):
            some = slice(at, at + WINDOWS_OF_A_RUN)
            first, last = starts[some][0], (starts[some] + lengths[some]).max()
            logits[some] = self.window_logits(self.numbers(words[first:last]), starts[some] - first, lengths[some])
        if len(starts):
            begins = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
            out[doc[begins]] = sigmoid(np.maximum.reduceat(logits, begins).astype(np.float64))
        return out


def window_index(numbers: np.ndarray, starts: np.ndarray, lengths: np.ndarray, masked: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Word numbers (steps, windows), and which of them are in the window if some are shorter."""
    step = np.arange(WINDOW_WORDS)[:, None]
    if not masked:
        return numbers[starts + step], None
    mask = step < lengths
    return numbers[np.where(mask, starts + step, starts)], mask


def log_odds(toxic_rows: np.ndarray, clean_rows: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Of features being in a toxic row against a clean one, from the number of rows of each class that have them."""
    # PRIOR_ROWS unseen rows, shared out like the classes, keep rare features near zero.
    n, m = positive.sum(), (~positive).sum()
    more_n, more_m = PRIOR_ROWS * n / (n + m), PRIOR_ROWS * m / (n + m)
    return np.log((toxic_rows + more_n) / (n + more_n)) - np.log((clean_rows + more_m) / (m + more_m))


@dataclass
class Sample:
    """Words of the texts as numbers, the different words, and the n-gram buckets of each."""

    numbers: np.ndarray
    sizes: np.ndarray
    unique: list[str]
    buckets: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Sample:
        number_of: dict[str, int] = {}
        rows = [np.fromiter((number_of.setdefault(w, len(number_of)) for w in words_of(t)), np.int32) for t in texts]
        unique = list(number_of)
        made = [char_buckets(unique[at : at + WORDS_AT_ONCE]) for at in range(0, len(unique), WORDS_AT_ONCE)]
        buckets = np.concatenate([np.zeros(0, np.uint16), *(b.astype(np.uint16) for b, _ in made)])
        counts = np.concatenate([np.zeros(0, np.int64), *(c for _, c in made)])
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return cls(np.concatenate([np.zeros(0, np.int32), *rows]), sizes, unique, buckets, counts)

    def buckets_of(self, words: np.ndarray) -> np.ndarray:
        return self.buckets[ranges(offsets_of(self.counts)[words], self.counts[words])]

    def rows_with(self, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many toxic and clean texts have each word, and each bucket; one text at a time."""
        words, grams = np.zeros((2, len(self.unique)), np.int64), np.zeros((2, CHAR_BUCKETS), np.int64)
        begins = offsets_of(self.counts)
        ends = offsets_of(self.sizes)
        for k, side in enumerate(np.where(positive, 0, 1)):
            own = np.unique(self.numbers[ends[k] : ends[k + 1]])
            words[side, own] += 1
            grams[side, np.unique(self.buckets[ranges(begins[own], self.counts[own])])] += 1
        return words, grams

    def project(self, network: Network, number: np.ndarray) -> dict[str, np.ndarray]:
        """Projected inputs of all different words; ``number`` tells the known ones."""
        begins = offsets_of(self.counts)
        out = {w: np.empty((len(self.unique), 3 * HIDDEN), np.float32) for w in ("f", "b")}
        for at in range(0, len(self.unique), WORDS_AT_ONCE):
            some = slice(at, at + WORDS_AT_ONCE)
            counts = self.counts[some]
            inputs = network.vectors(number[some], self.buckets[begins[at] : begins[at + len(counts)]], counts)[0]
            for way, rows in network.project(inputs).items():
                out[way][some] = rows
        return out


def train(texts: list[str], labels: list[int], prior: float, seed: int = 7) -> Network | float:
    """A fitted network, or the share of toxic rows if there is only one class."""
    positive = np.array(labels, bool)
    if positive.all() or not positive.any():
        return prior
    sample = Sample.of(texts)
    numbers, sizes, unique = sample.numbers, sample.sizes, sample.unique
    words, grams = sample.rows_with(positive)
    odds = log_odds(*words, positive)
    often = words.sum(axis=0)
    # Known words: those in two rows at least that tell the classes apart best.
    best = np.lexsort((np.arange(len(unique)), -np.abs(odds) * np.sqrt(often)))
    best = best[often[best] > 1][:KNOWN_WORDS]
    network = Network.fresh({unique[i]: k + 1 for k, i in enumerate(best)}, prior, seed)
    known = np.zeros(len(unique), np.int64)
    known[best] = np.arange(len(best)) + 1
    # The first number of every vector starts as the log odds of its word or n-gram.
    network.weights["words"][1:, 0] = odds[best] / 4
    network.weights["chars"][:, 0] = log_odds(*grams, positive) / 4

    starts, lengths, doc = window_table(sizes)
    random = np.random.default_rng(seed)
    begins = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.weights.items()}
    turn = 0
    for epoch in range(EPOCHS):
        scorer = Scorer(network)
        scorer.projected = sample.project(network, known)
        logits = scorer.window_logits(numbers, starts, lengths)
        # Highest windows first in every document; toxic ones train on the first, clean ones on three.
        order = np.lexsort((-logits, doc))
        place = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(doc))))
        chosen = order[place < np.where(positive[doc[order]], 1, 3)]
        toxic = positive[doc[chosen]]
        weight = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum())) * len(chosen)
        for _ in range(max(1, -(-UPDATES * BATCH // len(chosen)))):
            order = random.permutation(len(chosen))
            for at in range(0, len(chosen), BATCH):
                some = chosen[order[at : at + BATCH]]
                index, mask = window_index(numbers, starts[some], lengths[some], True)
                used, inverse = np.unique(index, return_inverse=True)
                inputs = network.vectors(known[used], sample.buckets_of(used), sample.counts[used])
                importance = weight[order[at : at + BATCH]] / len(some)
                found = network.gradients(*inputs, inverse.reshape(index.shape), mask, positive[doc[some]], importance)
                turn += 1
                for name, gradient in found.items():
                    first, second = moments[name]
                    first += 0.1 * (gradient - first)
                    second += 0.001 * (gradient**2 - second)
                    step = (first / (1 - 0.9**turn)) / (np.sqrt(second / (1 - 0.999**turn)) + 1e-8)
                    rate = TABLE_RATE if name in ("words", "chars") else RATE
                    network.weights[name] -= (rate * 0.5 ** (epoch / 2) * step).astype(np.float32)
    return network


def fit(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS, most_bytes: int = SAMPLE_BYTES) -> Network | float:
    """Train on the texts of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) mark.

    At most ``per_class`` documents of each class are read, those with the
    lowest hash of the doc_id, as long as their texts have at most ``most_bytes``
    together. Rows without a label are left out, a null text is empty, and of
    rows that repeat a doc_id the least text counts.
    """
    known = labels.filter("toxic in (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}  # two rows
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    # Documents are chosen without their texts; the chosen ones are bounded, so they go to the texts and not the other way.
    # A bound on the hash leaves twice the rows wanted of each class, whatever the number of labels, for the ranking.
    candidates = lowest_hashes(known.distinct(), "toxic", counts, 2 * per_class)
    found = docs.join(F.broadcast(candidates), "doc_id").groupBy("doc_id", "toxic", "place").agg(F.min("text").alias("text"))
    order = Window.partitionBy("toxic").orderBy("place", "doc_id")
    found = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= per_class)
    bytes_so_far = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    sample = found.withColumn("bytes", bytes_so_far).filter(F.col("bytes") <= most_bytes)

    def trained(batches):
        rows = [r for b in batches for r in b.to_pylist()]
        rows.sort(key=lambda r: (r["nth"], r["toxic"]))
        model = train([r["text"] or "" for r in rows], [r["toxic"] for r in rows], share)
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    # The sample is bounded by its parameter, so one task may hold it, and the driver the fitted weights.
    found = sample.select("nth", "text", "toxic").coalesce(1).mapInArrow(trained, "model binary").first()
    return pickle.loads(found[0]) if found else share


def score(docs: DataFrame, model: Network | float) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5); columns of these names are replaced.

    A text without letters (null, empty, only signs) has the share of toxic rows
    among the labelled as its score, and so has every text if the labels know
    only one class. Equal texts score alike, and an empty table stays empty.
    """
    kept = docs.drop("score", "predicted")
    names = kept.columns
    at = names.index("text")
    inner = kept.select(*[(F.col(f"`{c}`").cast("string") if i == at else F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(names)])

    def scored(batches):
        scorer = Scorer(model) if isinstance(model, Network) else None
        for piece in pieces(batches, f"c{at}"):
            texts = [t.decode() for t in raw_texts(piece, f"c{at}")]
            found = scorer.scores(texts) if scorer else np.full(len(texts), model)
            yield pa.record_batch([*piece.columns, pa.array(found, pa.float64())], [*piece.schema.names, "score"])

    shape = ", ".join(f"c{i} {t}" for i, (_, t) in enumerate(inner.dtypes))
    out = inner.mapInArrow(scored, f"{shape}, score double")
    return out.select(
        *[F.col(f"c{i}").cast(kept.schema[c].dataType).alias(c) for i, c in enumerate(names)],
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def is_held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Network | float:
    """Train on the labelled documents that are not held out."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learned = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), "toxic").filter(~is_held_out())
    return fit(texts, learned, per_class)


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    scored = score(docs, fitted(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", is_held_out().alias("held_out"), "score", "predicted")
