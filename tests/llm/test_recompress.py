import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from catalog_engine.llm import recompress
from catalog_engine.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def slow(rows, window=35):
    texts = [(t or "").encode().split() for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), words in zip(rows, texts):
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def digests(df):
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in df.collect()), key=repr
    )


def made_rows():
    random.seed(5)
    passage = " ".join(f"p{i % 17}{i}" for i in range(60))
    few = lambda n: " ".join(random.choices("ab", k=n))
    rows = [(1, None), (2, ""), (3, " \n "), (4, "same " * 34), (5, "same " * 35), (6, "same " * 36), (7, "runs " * 500)]
    rows += [(10 + i, f"{few(i * 3)} x{i} {passage} y{i} {few(i)}") for i in range(12)]
    rows += [(40, few(3_000)), (41, "a b " * 400), (42, "ab ba a b É " * 40), (43, passage[:-9]), (43, passage[:-9]), (None, "x" * 90_000)]
    return rows


@pytest.mark.parametrize("block_bytes", [300, 4_000_000])
def test_rows(spark, block_bytes):
    rows = made_rows()
    docs = spark.createDataFrame([(d, t, 1, "k") for d, t in rows], "doc_id long, text string, n_words int, block string")
    found = recompress.remove_repeats(docs, rejoin=True, block_bytes=block_bytes)
    assert found.columns == ["doc_id", "text", "block", "n_words", "n_removed"]
    assert digests(found) == slow(rows)


def test_other_rounds_and_windows(spark):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window, rounds in ((3, 5), (35, 0), (50, 9)):
        assert digests(recompress.remove_repeats(docs, window, rounds, True, 2_000)) == slow(rows, window)


def test_text_stays_where_nothing_goes(spark):
    docs = spark.createDataFrame([(1, "a  b\n"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, recompress.remove_repeats(docs).collect())) == [(1, "a  b\n", 2, 0), (2, None, 0, 0)]
    assert recompress.remove_repeats(docs.limit(0)).collect() == []


def test_equal_passages_have_equal_inner_symbols():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 2**63, 40).astype(np.uint64)
    for alphabet in (words, words[:2]):
        passage = rng.choice(alphabet, 120)
        inner = []
        for before, after in ((3, 9), (50, 0), (0, 17)):
            names = np.concatenate([rng.choice(alphabet, before), passage, rng.choice(alphabet, after)])
            parse = recompress.Parse(names, np.array([0, len(names)]))
            inner.append(parse.names[parse.left[before] : parse.right[before + 120]].tolist())
        assert inner[0] and inner[0] == inner[1] == inner[2]


def test_names_have_two_halves_and_can_be_forgotten(monkeypatch):
    monkeypatch.setattr(recompress, "KEPT_WORDS", 3)
    known = recompress.WordNames()
    first, starts = recompress.word_names([[b"a", b"b"], [], [b"a", b"c", b"d"]], known)
    assert starts.tolist() == [0, 2, 2, 5] and first.shape == (5, 2)
    assert len(np.unique(first)) == 8 and first[0].tolist() == first[2].tolist()
    again, _ = recompress.word_names([[b"d", b"x", b"a"]], known)
    assert again[0].tolist() == first[4].tolist() and again[2].tolist() == first[0].tolist() and len(known) == 3


def test_words_with_one_half_in_common_are_not_equal():
    names = np.random.default_rng(1).integers(0, 2**63, (80, 2)).astype(np.uint64)
    names[40:] = names[:40]
    same = recompress.window_hashes(names, np.array([0, 40]), 35)
    assert same[0].tolist() == same[1].tolist()
    for half in (0, 1):
        other = names.copy()
        other[50, half] += np.uint64(1)
        hashes = recompress.window_hashes(other, np.array([0, 40]), 35)
        assert hashes[0].tolist() != hashes[1].tolist()


def test_stored_blocks(spark):
    """Buckets follow the bytes, no table stays behind, rows sent are one a block and part with keys."""
    mb = 10**6
    assert [recompress.bucket_count(n) for n in (0, 1, 16 * mb, 17 * mb, 100 * mb * mb)] == [1, 1, 1, 2, recompress.MOST_BUCKETS]
    before = {r.name for r in spark.catalog.listTables()}
    docs = spark.createDataFrame(made_rows(), "doc_id long, text string")
    blocks = recompress.stored_blocks(docs, 2_000, 4)
    assert blocks.selectExpr("sum(size(text))").first()[0] == docs.count()
    assert {r.name for r in spark.catalog.listTables()} == before
    keys = np.unique(np.random.default_rng(2).integers(0, 2**63, 50).astype(np.uint64))[:, None]
    assert recompress.sent_keys(1, np.concatenate([keys, keys]), 10**9).num_rows == len(keys)
    assert recompress.sent_keys(1, keys, 3).num_rows <= 3


def test_query(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    found = recompress.op10_substring_dedup(spark, FOLDER)
    assert sorted(map(tuple, found.collect()), key=repr) == slow(rows)
