"""Language identification by word-first backoff.

A word that was seen in training scores each language by the log of its relative
frequency there. A word that was not is scored by its character n-grams, from
the longest down: the first length with any known n-gram counts, as the mean of
the known ones' log frequencies. A text gets the language with the largest sum
over its words.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from catalog_engine.llm.common import offsets_of, pieces, raw_texts, table

# Texts of each language that the tables are fitted on, and the entries kept of each table and language.
SAMPLE_PER_LANGUAGE = 2_000
KEPT_ENTRIES = 5_000
LONGEST_GRAM = 5
SMOOTHING = 0.5
UNKNOWN = "und"
# Words whose scores a worker keeps.
KEPT_WORDS = 300_000
LETTERS = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of the word, its ends marked by a space."""
    marked = f" {word} "
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Log frequencies per language (in code point order): table 0 for words, table n for n-grams."""

    languages: list[str]
    tables: list[dict[str, np.ndarray]]

    def word_score(self, word: str) -> np.ndarray:
        found = self.tables[0].get(word)
        if found is not None:
            return found
        for n in range(LONGEST_GRAM, 0, -1):
            known = [self.tables[n][g] for g in grams_of(word, n) if g in self.tables[n]]
            if known:
                return np.mean(known, axis=0)
        return np.zeros(len(self.languages))


class Reader:
    """Predicts texts with a model; keeps the scores of the words it has seen."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.languages)))

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if len(self.index) > KEPT_WORDS:
            self.forget()
        lists = [words_of(t) for t in texts]
        new = [w for w in dict.fromkeys(w for words in lists for w in words) if w not in self.index]
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            self.scores = np.concatenate([self.scores, [self.model.word_score(w) for w in new]])
        starts = offsets_of(np.fromiter(map(len, lists), np.int64, len(lists)))
        ids = np.fromiter((self.index[w] for words in lists for w in words), np.int64, starts[-1])
        names, sure = [UNKNOWN] * len(texts), np.zeros(len(texts))
        some = np.flatnonzero(np.diff(starts))
        if len(some) and self.model.languages:
            sums = np.add.reduceat(self.scores[ids], starts[some], axis=0)
            best = sums.argmax(axis=1)
            share = np.exp(sums - sums.max(axis=1, keepdims=True))
            sure[some] = 1 / share.sum(axis=1)
            for i, b in zip(some, best):
                names[i] = self.model.languages[b]
        return names, sure


def fit(rows: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, kept: int = KEPT_ENTRIES) -> Model:
    """Tables from (key, lang, text): at most ``per_language`` texts of a language, chosen by a hash of the key.

    Rows with a null language or text are left out; of rows with the same key and language the least text counts. The model has at most
    ``kept`` entries a table and language, so it may be sent to all tasks.
    """
    # Keys are chosen without their texts; the chosen ones are bounded, so they go to the texts and not the other way.
    order = Window.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    known = rows.filter("lang is not null and text is not null")
    chosen = known.select("key", "lang").distinct().withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= per_language)
    sample = known.join(F.broadcast(chosen.drop("_place")), ["key", "lang"]).groupBy("key", "lang").agg(F.min("text").alias("text"))

    def counted(batches):
        for piece in pieces(batches):
            counts: Counter = Counter()
            for lang, text in zip(piece.column("lang").to_pylist(), raw_texts(piece)):
                for word, n in Counter(words_of(text.decode())).items():
                    counts[lang, 0, word] += n
                    for size in range(1, LONGEST_GRAM + 1):
                        for gram in grams_of(word, size):
                            counts[lang, size, gram] += n
            keys = list(counts)
            yield pa.record_batch(
                [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                 pa.array([k[2] for k in keys], pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["lang", "size", "gram", "n"],
            )

    sums = sample.mapInArrow(counted, "lang string, size int, gram string, n bigint").groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    totals = F.sum("n").over(Window.partitionBy("lang", "size"))
    place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram"))
    top = sums.withColumn("total", totals).withColumn("place", place).filter(F.col("place") <= kept).collect()
    languages = sorted({r["lang"] for r in top})
    at = {lang: i for i, lang in enumerate(languages)}
    counts: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST_GRAM + 1)]
    total = np.ones((LONGEST_GRAM + 1, len(languages)))
    for r in top:
        counts[r["size"]].setdefault(r["gram"], np.zeros(len(languages)))[at[r["lang"]]] = r["n"]
        total[r["size"], at[r["lang"]]] = r["total"]
    tables = [
        {gram: np.log((n + SMOOTHING) / (total[size] + SMOOTHING * len(found))) for gram, n in found.items()}
        for size, found in enumerate(counts)
    ]
    return Model(languages, tables)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1: the language's share among all); such columns are replaced.

    A null text and one without a letter are ``und`` with score 0, and so is
    every text if the model knows no language. Ties go to the language that is
    first in code point order. Equal texts get equal results, and an empty table
    stays empty.
    """
    kept = docs.drop("lang_pred", "score")
    names = kept.columns
    inner = kept.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col("text").cast("string").alias("text"))

    def read(batches):
        reader = Reader(model)
        for piece in pieces(batches):
            found, sure = reader.predict([t.decode() for t in raw_texts(piece)])
            own = [piece.column(i) for i in range(len(names))]
            yield pa.record_batch([*own, pa.array(found, pa.string()), pa.array(sure)], [*piece.schema.names[: len(names)], "lang_pred", "score"])

    shape = ", ".join(f"c{i} {t}" for i, (_, t) in enumerate(kept.dtypes))
    out = inner.mapInArrow(read, f"{shape}, lang_pred string, score double")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "lang_pred", "score")


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose language is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of all documents."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "lang")
    model = fit(docs.filter(~is_held_out()).select(F.col("doc_id").cast("string").alias("key"), "lang", "text"))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", is_held_out().alias("held_out"), "lang_pred", "score")
