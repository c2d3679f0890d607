"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

Texts are cut into words by the pattern that byte-level vocabularies are made
with. The symbols of many different words lie in one flat array; a round finds
every adjacent pair's rank by binary search over the sorted pair keys, takes
each word's lowest rank, and merges all places of that pair in all words at
once. A word that has no pair left drops out. Encoded words are kept between
batches, so a frequent word is merged once per Python worker.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog_engine.llm.common import offsets_of, pieces, ranges, raw_texts, table

# Words whose ids a worker keeps, and the bytes of new words that are merged together.
KEPT_WORDS = 150_000
MERGE_BYTES = 1_000_000
# White space as the pattern of byte-level vocabularies means it; the regex module's \s has four control characters more.
SPACE = r"\p{White_Space}"
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
NO_RANK = np.iinfo(np.int32).max


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Vocabulary:
    """Byte-level BPE vocabulary as arrays; ``added`` are the strings that are one token wherever they stand."""

    first: np.ndarray  # id of each single byte
    keys: np.ndarray  # left id << 32 | right id of every merge, sorted
    ranks: np.ndarray  # rank of the merge
    merged: np.ndarray  # id that the merge gives
    token_bytes: list[bytes]
    added: dict[str, int]

    @classmethod
    def from_json(cls, text: str) -> Vocabulary:
        spec = json.loads(text)
        ids, letters = spec["model"]["vocab"], byte_letters()
        added = {a["content"]: a["id"] for a in spec["added_tokens"]}
        token_bytes = [b""] * (1 + max([*ids.values(), *added.values()]))
        for token, i in ids.items():
            token_bytes[i] = bytes(letters[c] for c in token)
        for token, i in added.items():
            token_bytes[i] = token.encode()
        first = np.zeros(256, np.int64)
        for letter, b in letters.items():
            first[b] = ids[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        return cls(first, keys[order], order.astype(np.int32), merged[order], token_bytes, added)


def merge_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, one after the other, and how many each word has."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    symbols = vocabulary.first[np.frombuffer(b"".join(words), np.uint8)]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    word_of = np.repeat(np.arange(len(words)), lengths)
    done_symbols, done_words = [], []
    while len(symbols):
        # Rank of the pair that begins at each symbol; the last symbol of a word begins none.
        key = symbols[:-1] << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(vocabulary.keys, key), len(vocabulary.keys) - 1)
        known = (vocabulary.keys[at] == key) & (word_of[:-1] == word_of[1:])
        rank = np.append(np.where(known, vocabulary.ranks[at], NO_RANK), NO_RANK)
        begins = np.flatnonzero(np.append(True, word_of[1:] != word_of[:-1]))
        sizes = np.diff(np.append(begins, len(symbols)))
        lowest = np.repeat(np.minimum.reduceat(rank, begins), sizes)
        live = lowest != NO_RANK
        if not live.all():
            done_symbols.append(symbols[~live])
            done_words.append(word_of[~live])
        chosen = np.flatnonzero((rank == lowest) & live)
        if not len(chosen):
            break
        # In a run of overlapping places (aaa) only every second one, from the left, is merged.
        run_start = np.append(True, np.diff(chosen) != 1)
        run_of = np.cumsum(run_start) - 1
        chosen = chosen[(np.arange(len(chosen)) - np.flatnonzero(run_start)[run_of]) % 2 == 0]
        symbols[chosen] = vocabulary.merged[at[chosen]]
        live[chosen + 1] = False
        symbols, word_of = symbols[live], word_of[live]
    symbols, word_of = np.concatenate(done_symbols), np.concatenate(done_words)
    order = np.argsort(word_of, kind="stable")
    return symbols[order], np.bincount(word_of, minlength=len(words))


class Coder:
    """Encodes and decodes texts; keeps the ids of the words it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.split = regex.compile(SPLIT).findall
        names = sorted(vocabulary.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.forget()

    def forget(self) -> None:
        self.index = {name: i for i, name in enumerate(self.vocabulary.added)}
        self.flat = np.array(list(self.vocabulary.added.values()), np.int64)
        self.sizes = np.ones(len(self.flat), np.int64)

    def words(self, text: str) -> list[str]:
        if self.added is None or not any(name in text for name in self.vocabulary.added):
            return self.split(text)
        out = []
        for i, part in enumerate(self.added.split(text)):
            # Odd parts are the added strings: looked up under their own name, as no word of the pattern is.
            out.extend([part] if i % 2 else self.split(part))
        return out

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        if len(self.index) > KEPT_WORDS:
            self.forget()
        lists = [self.words(t) for t in texts]
        new = [w for w in dict.fromkeys(w for words in lists for w in words) if w not in self.index]
        at = 0
        flats, sizes = [self.flat], [self.sizes]
        while at < len(new):
            stop, size = at, 0
            while stop < len(new) and (stop == at or size < MERGE_BYTES):
                size += len(new[stop])
                stop += 1
            ids, counts = merge_words([w.encode() for w in new[at:stop]], self.vocabulary)
            flats.append(ids)
            sizes.append(counts)
            at = stop
        for word in new:
            self.index[word] = len(self.index)
        if new:
            self.flat, self.sizes = np.concatenate(flats), np.concatenate(sizes)
        starts = offsets_of(self.sizes)
        out = []
        for words in lists:
            which = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
            out.append(self.flat[ranges(starts[which], self.sizes[which])])
        return out

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.vocabulary.token_bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")


def with_tokens(docs: DataFrame, vocabulary_path: str, column: str = "text", packed: bool = False) -> DataFrame:
    """``docs`` with ``token_ids`` (list of int) and ``decoded`` (string); columns of these names are replaced.

    With ``packed`` the ids are bytes, four to an id, the lowest first.

    A null text is encoded as an empty one: no ids, an empty decoded text. Every
    row is coded by itself, so repeated rows come out alike, and an empty table
    gives an empty result. The vocabulary file is read once, on the driver, and
    sent with the task (a vocabulary's size does not grow with the data).
    """
    with open(vocabulary_path, encoding="utf-8") as file:
        spec = file.read()
    kept = docs.drop("token_ids", "decoded")
    names = kept.columns
    numbered = kept.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.col(f"`{column}`").cast("string").alias("whole"))
    shape = ", ".join(f"c{i} {t}" for i, (_, t) in enumerate(kept.dtypes))

    def coded(batches):
        coder = Coder(Vocabulary.from_json(spec))
        for piece in pieces(batches, "whole"):
            ids = coder.encode([t.decode() for t in raw_texts(piece, "whole")])
            if packed:
                lists = pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
            else:
                flat = pa.array(np.concatenate(ids).astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array(offsets_of([len(i) for i in ids]).astype(np.int32)), flat)
            decoded = pa.array([coder.decode(i) for i in ids], pa.string())
            own = [piece.column(i) for i in range(len(names))]
            yield pa.record_batch([*own, lists, decoded], [*piece.schema.names[: len(names)], "token_ids", "decoded"])

    kind = "binary" if packed else "array<int>"
    out = numbered.mapInArrow(coded, f"{shape}, token_ids {kind}, decoded string")
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], "token_ids", "decoded")


def digests(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: what ``with_tokens`` gives, as digests."""

    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    tokens = with_tokens(docs, vocabulary_path, packed=True)
    return tokens.select(
        "doc_id", (F.length("token_ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op5_bpe_encode_decode(spark: SparkSession, folder: str) -> DataFrame:
    """Ids and decoded text of all documents, as digests."""
    return digests(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
