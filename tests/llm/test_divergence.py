from collections import Counter

import numpy as np
import pytest

from catalog_engine.llm import divergence
from catalog_engine.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def slow_base(text):
    text = text or ""
    blank = " \t\n\x0b\x0c\r"
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(blank)]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {k for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    return (
        len(words), sum(c not in blank for c in text), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit),
        len(words) < 10 or 100 * len(hit) > 20 * len(words),
    )


def test_base_and_verdict(spark):
    docs = {r.doc_id: r for r in table(spark, FOLDER, "documents").collect()}
    quality = {r.doc_id: r.quality for r in table(spark, FOLDER, "labels").collect()}
    found = divergence.op1_quality_divergence(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    right = Counter()
    for r in found:
        base = slow_base(docs[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base
        assert not (r.base_failed and r.kept)
        if not r.base_failed and r.doc_id in quality:
            right[quality[r.doc_id], r.kept] += 1
    assert right[1, False] <= 0.01 * right[1, True] and right[0, True] <= 0.2 * right[0, False]


def test_references_count_all_rows(spark):
    docs = table(spark, FOLDER, "documents")
    found = divergence.references(docs)
    for lang in {r.lang for r in docs.select("lang").distinct().collect()}:
        words, classes = Counter(), np.zeros(10, int)
        for r in docs.filter(docs.lang == lang).collect():
            words.update(divergence.bare(w) for w in r.text.encode().split())
            classes += divergence.class_counts(r.text.encode())
        total = sum(words.values())
        common = {w for w, n in words.items() if w and n >= total / 500}
        assert set(found.large[lang].words) == common
        assert all(found.large[lang].counts[k] == words[w] for w, k in found.large[lang].words.items())
        assert found.large[lang].counts.sum() == total and (found.large[lang].classes == classes).all()


def test_distance():
    p, q = np.array([1.0, 0, 3]), np.array([0, 2.0, 0])
    assert divergence.js_distance(p, p * 7) == 0 and divergence.js_distance(p, q) == pytest.approx(1)
    assert divergence.js_distance(p, np.array([1.0, 1, 2])) == pytest.approx(divergence.js_distance(np.array([1.0, 1, 2]), p))


def test_rows(spark):
    rows = [(1, None, "en"), (2, "", None), (3, " \n", "en"), (4, "a b c d e f g h i j k", "en"), (5, "x y " * 50, "xx"), (6, "w" * 70_000, "en"),
            (7, "same line\n\nsame line\n" * 2, "en"), (None, "é ü ñ", None), (8, "the of and " + " ".join(f"n{i}" for i in range(90)), None)]
    docs = spark.createDataFrame([(*r, True, 3) for r in rows], "doc_id long, text string, lang string, kept boolean, n_words int")
    for some in (docs, docs.filter("doc_id < 4"), docs.limit(0)):
        found = divergence.judged(some, divergence.references(some)).collect()
        texts = {r.doc_id: r.text for r in some.collect()}
        assert sorted(r.doc_id or 0 for r in found) == sorted(d or 0 for d in texts)
        for r in found:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == slow_base(texts[r.doc_id])
            assert (r.word_distance is None) == (r.n_words < 60 or not divergence.references(some).large)


def test_small_languages_are_judged_by_their_own_words(spark):
    """Languages below the share stay out of the broadcast, and come out as they would with it."""
    words = [f"w{i % 7}x{i % 3} ." for i in range(60)]
    rows = [(i, " ".join(words) + f" own{i % 9} " * 12, f"l{i % 9}" if i % 11 else None) for i in range(90)]
    rows += [(100, " ".join(f"q{i}" for i in range(80)), "l3"), (101, None, "l3"), (102, "  ", "empty"), (103, "x", "one"), (103, "x", "one")]
    docs = spark.createDataFrame([(*r, "r") for r in rows], "doc_id long, text string, lang string, reference string")
    every, none = divergence.references(docs, language_share=0.0), divergence.references(docs, language_share=2.0)
    assert every.small is None and none.large == {} and {r.lang for r in none.small.collect()} == set(every.large)
    some = divergence.references(docs, language_share=0.115)
    assert 0 < len(some.large) < 9 and some.small.count() + len(some.large) == len(every.large)
    judge = lambda refs: sorted(map(tuple, divergence.judged(docs.filter("lang <> 'empty'"), refs).collect()))
    right = judge(every)
    assert right == judge(some) == judge(none) and len(right) == sum(r[2] not in (None, "empty") for r in rows)
    assert len(divergence.judged(docs, some).collect()) == len(rows)
    for row in none.small.collect():
        made, own = divergence.reference_of(row.reference.asDict(True)), every.large[row.lang]
        assert (made.classes == own.classes).all() and made.words == own.words and (made.counts == own.counts).all()


def test_texts_are_read_twice_for_the_references(spark, tmp_path):
    """Once for the reports, once for the exact counts, whatever is collected from them."""
    made = []
    kept = divergence.pieces

    def noted(batches, *args, **kwargs):
        (tmp_path / f"pass{len(list(tmp_path.iterdir()))}").touch()
        return kept(batches, *args, **kwargs)

    docs = spark.createDataFrame([(1, "a b c " * 30, "en")], "doc_id long, text string, lang string").coalesce(1)
    divergence.pieces = noted
    try:
        divergence.references(docs)
    finally:
        divergence.pieces = kept
    made = list(tmp_path.iterdir())
    assert len(made) == 2
