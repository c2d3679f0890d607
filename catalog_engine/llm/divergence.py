"""Quality rules by distribution divergence.

Each language has two references, counted over all its documents: a histogram
of character classes, and one of its common words (those that make up a given
share of its words) and all others. A document is compared with its language's
references by Jensen-Shannon distance; a comparison is made only where the text
is long enough for its histogram to mean something.

Common words are found exactly in two passes. A word with a share of a language
has that share in some piece of the table too, so a piece reports only the words
above a quarter of the share, and no more than 4 / 3 of 1 / share words can pass
the bound that their reports give. The second pass counts these.

References of the large languages, of which there are few, go to all tasks. Any
number of small ones can stand in a dirty column: their words are counted by a
shuffle, their references stay in a table, and their documents are joined to it.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_engine.llm.common import covered, offsets_of, pieces, raw_texts, table, window_starts
from catalog_engine.session import cut

COMMON_SHARE = 1 / 500
# A language with at least this share of all words has its reference sent to all tasks; there are 1 / share at most.
LANGUAGE_SHARE = 1 / 1_000
MIN_CHARS = 200
MIN_WORDS = 60
MOST_CLASS_DISTANCE = 0.28
MOST_WORD_DISTANCE = 0.42
# The base rules.
MIN_BASE_WORDS = 10
REPEAT_WINDOW = 5
SYMBOLS = b"#*$%&|<>"
EDGES = ".,;:!?\"'()"
CLASSES = 10


def class_table() -> np.ndarray:
    """Class of every code point below 65,536: ASCII letters by case, other letters by case or without, digits,
    ASCII white space, the punctuation of prose, other signs, and the rest."""
    out = np.full(65_536, 9, np.uint8)
    for c in range(65_536):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            out[c] = (0 if c < 128 else 2) if kind == "Ll" else (1 if c < 128 else 3) if kind == "Lu" else 4
        elif kind[0] == "N":
            out[c] = 5
        elif kind[0] in "PS":
            out[c] = 7 if chr(c) in ".,;:!?\"'()-" else 8
    out[[9, 10, 11, 12, 13, 32]] = 6
    return out


CLASS_OF = class_table()


def class_counts(text: bytes) -> np.ndarray:
    points = np.frombuffer(text.decode().encode("utf-32-le"), np.uint32)
    return np.bincount(CLASS_OF[np.minimum(points, 65_535)], minlength=CLASSES)


def bare(word: bytes) -> str:
    """A word as it is counted: lower case, without punctuation at its ends."""
    return word.decode().lower().strip(EDGES)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors: root of the divergence in bits, 0 to 1."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2

    def against(x):
        some = x > 0
        return float((x[some] * np.log2(x[some] / middle[some])).sum())

    return float(np.sqrt(max(0.0, (against(p) + against(q)) / 2)))


class Piece:
    """Words of a piece of the table, numbered: ``ids`` of all words, where each text's begin, the words by number."""

    def __init__(self, texts: list[bytes]):
        lists = [t.split() for t in texts]
        self.starts = offsets_of(np.fromiter(map(len, lists), np.int64, len(lists)))
        numbers: dict[bytes, int] = {}
        self.ids = np.fromiter((numbers.setdefault(w, len(numbers)) for words in lists for w in words), np.int64, self.starts[-1])
        self.words = list(numbers)

    def repeated(self, window: int = REPEAT_WINDOW) -> np.ndarray:
        """Per text, the words in windows of words that the text has twice or more."""
        at = window_starts(self.starts, window)
        doc = np.searchsorted(self.starts, at, side="right") - 1
        # Equal windows of a text get equal numbers, built up word by word without any hash of their content.
        key = pd.factorize(doc * (len(self.words) + 1) + self.ids[at])[0]
        for k in range(1, window):
            key = pd.factorize(key * (len(self.words) + 1) + self.ids[at + k])[0]
        hit = at[np.bincount(key, minlength=1)[key] > 1] if len(at) else at
        return np.diff(offsets_of(covered(hit, len(self.ids), window))[self.starts])


@dataclass
class Reference:
    classes: np.ndarray
    words: dict[str, int]  # place in the histogram; the last place is for all others
    counts: np.ndarray


@dataclass
class References:
    """Of the large languages by name, and of all others with a word as a table (lang, reference), if there are any."""

    large: dict[str, Reference]
    small: DataFrame | None


def languages_of(batch: pa.RecordBatch) -> list:
    return batch.column("lang").to_pylist()


def columns_of(rows: list[tuple], types: tuple) -> list[pa.Array]:
    return [pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(types), types)]


def counts_by_language(texts: list[bytes], langs: list, wanted) -> list[tuple]:
    """(lang, counts of its characters' classes, its bare words, their counts, number of its words) for each language ``wanted``."""
    made = Piece(texts)
    bares = pd.Series([bare(w) for w in made.words], dtype=object)
    out = []
    for lang in {x for x in langs if x is not None and wanted(x)}:
        rows = [i for i, x in enumerate(langs) if x == lang]
        ids = np.concatenate([made.ids[made.starts[i] : made.starts[i + 1]] for i in rows])
        counts = np.bincount(ids, minlength=len(made.words))
        used = np.flatnonzero(counts)
        words = pd.Series(counts[used], dtype=np.int64).groupby(bares[used].to_numpy(), sort=False).sum()
        out.append((lang, sum(class_counts(texts[i]) for i in rows), words, len(ids)))
    return out


WORD_ROWS, WORD_TYPES = "lang string, what string, n bigint, of bigint", (pa.string(), pa.string(), pa.int64(), pa.int64())


def references(docs: DataFrame, share: float = COMMON_SHARE, language_share: float = LANGUAGE_SHARE) -> References:
    """Reference of every language (non-null ``lang``) that has a word, over all rows of ``docs``."""

    def reported(batches):
        for piece in pieces(batches):
            out = []
            for lang, classes, words, n_words in counts_by_language(raw_texts(piece), languages_of(piece), lambda _: True):
                out += [(lang, f"class {k}", int(n), 0) for k, n in enumerate(classes) if n]
                out.append((lang, "words", n_words, 0))
                often = words[words >= share / 4 * n_words]
                out += [(lang, f"= {w}", int(n), n_words) for w, n in often.items() if w]
            yield pa.record_batch(columns_of(out, WORD_TYPES), ["lang", "what", "n", "of"])

    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    sums = rows.mapInArrow(reported, WORD_ROWS).groupBy("lang", "what").agg(F.sum("n").alias("n"), F.sum("of").alias("of"))
    # Stored, as all that follows reads it: the texts are read once for it.
    sums = cut(sums)
    totals = sums.filter("what = 'words' and n > 0").select("lang", F.col("n").alias("total"))
    whole = totals.agg(F.sum("total").alias("all"), F.count("*").alias("n_langs")).first()
    least = (whole["all"] or 0) * language_share
    # Bounded: large languages by their share, words by the bound that their reports give.
    known = {r["lang"]: np.zeros(CLASSES, np.int64) for r in totals.filter(F.col("total") >= least).collect()}
    large = F.col("lang").isin(list(known))
    for r in sums.filter(large & F.col("what").startswith("class ")).collect():
        known[r["lang"]][int(r["what"][6:])] = r["n"]
    likely = sums.filter(large & F.col("what").startswith("= ")).join(F.broadcast(totals.filter(large)), "lang")
    likely = likely.filter(F.col("n") + (F.col("total") - F.col("of")) * (share / 4) >= F.col("total") * share)
    words: dict[str, list[str]] = {lang: [] for lang in known}
    for r in likely.select("lang", "what").collect():
        words[r["lang"]].append(r["what"][2:])
    words = {lang: sorted(found) for lang, found in words.items()}

    def exact(batches):
        for piece in pieces(batches):
            out = []
            for lang, _, counted, n_words in counts_by_language(raw_texts(piece), languages_of(piece), words.__contains__):
                counts = [int(counted.get(w, 0)) for w in words[lang]]
                out += [(lang, k, n) for k, n in enumerate([*counts, n_words - sum(counts)])]
            yield pa.record_batch(columns_of(out, (pa.string(), pa.int32(), pa.int64())), ["lang", "place", "n"])

    counts = {lang: np.zeros(len(found) + 1, np.int64) for lang, found in words.items()}
    for r in rows.mapInArrow(exact, "lang string, place int, n bigint").groupBy("lang", "place").agg(F.sum("n").alias("n")).collect():
        counts[r["lang"]][r["place"]] = r["n"]
    out = {}
    for lang, classes in known.items():
        common = np.flatnonzero(counts[lang][:-1] >= share * counts[lang].sum())
        others = counts[lang].sum() - counts[lang][common].sum()
        out[lang] = Reference(classes, {words[lang][i]: k for k, i in enumerate(common)}, np.append(counts[lang][common], others))
    if whole["n_langs"] == len(known):
        return References(out, None)

    def every_word(batches):
        for piece in pieces(batches):
            found = counts_by_language(raw_texts(piece), languages_of(piece), lambda _: True)
            out = [(lang, w, int(n)) for lang, _, counted, _ in found for w, n in counted.items() if w]
            yield pa.record_batch(columns_of(out, (pa.string(), pa.string(), pa.int64())), ["lang", "word", "n"])

    # A language has 1 / share common words at most, so its reference is one row.
    few = rows.filter(~large & F.col("lang").isNotNull()).mapInArrow(every_word, "lang string, word string, n bigint")
    common = few.groupBy("lang", "word").agg(F.sum("n").alias("n")).join(totals, "lang").filter(F.col("n") >= F.col("total") * share)
    common = common.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("words"))
    classes = sums.filter(~large & F.col("what").startswith("class ")).groupBy("lang").agg(F.collect_list(F.struct("what", "n")).alias("classes"))
    small = totals.filter(~large).join(common, "lang", "left").join(classes, "lang", "left")
    return References(out, cut(small.select("lang", F.struct("total", "words", "classes").alias("reference"))))


def reference_of(row: dict) -> Reference:
    """A row of the table of small references."""
    classes = np.zeros(CLASSES, np.int64)
    for item in row["classes"] or []:
        classes[int(item["what"][6:])] = item["n"]
    counts = [item["n"] for item in row["words"] or []]
    return Reference(
        classes, {item["word"]: k for k, item in enumerate(row["words"] or [])}, np.array([*counts, row["total"] - sum(counts)], np.int64)
    )


def judged(
    docs: DataFrame,
    found: References,
    min_chars: int = MIN_CHARS,
    min_words: int = MIN_WORDS,
    most_class: float = MOST_CLASS_DISTANCE,
    most_word: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, lang, text): counts, base_failed, distances and kept.

    ``class_distance`` is null for fewer than ``min_chars`` characters in words,
    ``word_distance`` for fewer than ``min_words`` words: the text is too short
    to be judged by them, and not rejected by them. A row whose language is null
    or has no word is compared with the nearest of the large languages; without
    any only the base rules hold. A null text has no words and fails the base
    rules. Repeated rows come out alike; an empty table gives an empty result.
    """

    large = found.large

    def scored(batches):
        names = sorted(large)
        for piece in pieces(batches):
            texts, langs = raw_texts(piece), languages_of(piece)
            known = dict(large)
            if "reference" in piece.schema.names:
                own = piece.column("reference")
                for i, lang in enumerate(langs):
                    if lang not in known and own[i].is_valid:
                        known[lang] = reference_of(own[i].as_py())
            made = Piece(texts)
            bares = [bare(w) for w in made.words]
            # Words are placed for the languages that this piece compares with.
            compared = set(langs) & set(known) if all(x in known for x in langs) else {*names, *(set(langs) & set(known))}
            place = {lang: np.array([known[lang].words.get(w, len(known[lang].words)) for w in bares], np.int64) for lang in compared}
            repeated = made.repeated()
            rows = []
            for i, text in enumerate(texts):
                classes = class_counts(text)
                ids = made.ids[made.starts[i] : made.starts[i + 1]]
                n_words, word_chars = len(ids), int(classes.sum() - classes[6])
                lines = [line for line in text.split(b"\n") if line.strip()]
                best = None
                for lang in [langs[i]] if langs[i] in known else names:
                    ref = known[lang]
                    by_class = js_distance(classes, ref.classes) if word_chars >= min_chars else None
                    by_word = None
                    if n_words >= min_words:
                        by_word = js_distance(np.bincount(place[lang][ids], minlength=len(ref.counts)), ref.counts)
                    worst = max((by_class or 0.0) / most_class, (by_word or 0.0) / most_word)
                    if best is None or worst < best[0]:
                        best = (worst, by_class, by_word)
                worst, by_class, by_word = best or (0.0, None, None)
                failed = n_words < MIN_BASE_WORDS or 100 * int(repeated[i]) > 20 * n_words
                rows.append((
                    n_words, word_chars, len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
                    int(repeated[i]), failed, not failed and worst <= 1.0, by_class, by_word,
                ))
            columns = list(zip(*rows))
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            yield pa.record_batch(
                [piece.column("doc_id"), *[pa.array(c, t) for c, t in zip(columns, types)]],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"],
            )

    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")
    )
    shape = (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
        "base_failed boolean, kept boolean, class_distance double, word_distance double"
    )
    if found.small is None:
        return rows.mapInArrow(scored, shape)
    few = F.coalesce(~F.col("lang").isin(list(large)), F.lit(False))
    joined = rows.filter(few).join(found.small, "lang", "left")
    return rows.filter(~few).mapInArrow(scored, shape).unionByName(joined.mapInArrow(scored, shape))


def op1_quality_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """All documents judged against the languages' references."""
    docs = table(spark, folder, "documents")
    return judged(docs, references(docs))
