import functools
import math
import zlib
from collections import Counter, defaultdict

import pytest
import regex

from catalog_engine.llm import language
from catalog_engine.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in table(spark, FOLDER, "documents").collect()}
    found = language.op3_language_id(spark, FOLDER).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    right = []
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out:
            right.append(r.lang_pred == docs[r.doc_id].lang)
    assert sum(right) >= 0.98 * len(right)


def test_word_first_then_shorter_grams():
    known = {f" {w} ": 0 for w in ()}
    tables = [{"the": language.np.array([-1.0, -5.0])}] + [dict(known) for _ in range(5)]
    tables[3] = {"abc": language.np.array([-4.0, -2.0]), "bcd": language.np.array([-6.0, -2.0])}
    tables[1] = {"x": language.np.array([-1.0, -3.0])}
    model = language.Model(["aa", "bb"], tables)
    assert model.word_score("the").tolist() == [-1.0, -5.0]
    assert model.word_score("abcd").tolist() == [-5.0, -2.0]
    assert model.word_score("xyz").tolist() == [-1.0, -3.0]
    assert model.word_score("qq").tolist() == [0.0, 0.0]
    names, sure = language.Reader(model).predict(["THE the", "abcd", "qq", "12", ""])
    assert names == ["aa", "bb", "aa", "und", "und"] and sure[2] == 0.5 and sure[3] == 0


def test_rows(spark):
    rows = [(1, "la casa la", "es"), (2, "the house the", "en"), (3, None, "en"), (4, "", None), (5, "1 2", "en"), (6, "x" * 60_000 + " the", None)]
    docs = spark.createDataFrame([(*r, "s", 7) for r in rows], "doc_id long, text string, lang string, score string, c1 int")
    model = language.fit(docs.select(docs.doc_id.cast("string").alias("key"), "lang", "text"))
    found = sorted(language.identify(docs, model).collect())
    assert [r.lang_pred for r in found] == ["es", "en", "und", "und", "und", "en"] and {r.c1 for r in found} == {7}
    none = language.fit(docs.limit(0).select(docs.doc_id.cast("string").alias("key"), "lang", "text"))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).collect() == []


def test_query_equals_a_plain_pass(spark):
    """Fit and prediction written out, over the whole table."""
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents").collect()
    counts = defaultdict(Counter)
    for d in docs:
        if d.lang is not None and d.text is not None and zlib.crc32(str(d.doc_id).encode()) % 4 != 2:
            for word in regex.findall(r"\p{L}+", d.text.lower()):
                counts[d.lang, 0][word] += 1
                for n in range(1, 6):
                    counts[d.lang, n].update(f" {word} "[i : i + n] for i in range(len(word) + 3 - n))
    langs = sorted({lang for lang, _ in counts})
    kept = {
        key: dict(sorted(found.items(), key=lambda x: (-x[1], x[0].encode()))[: language.KEPT_ENTRIES]) for key, found in counts.items()
    }
    known = [set().union(*(kept[lang, n] for lang in langs)) for n in range(6)]

    def log_share(lang, n, gram):
        return math.log((kept[lang, n].get(gram, 0) + 0.5) / (sum(counts[lang, n].values()) + 0.5 * len(known[n])))

    @functools.cache
    def word_scores(word):
        if word in known[0]:
            return [log_share(lang, 0, word) for lang in langs]
        for n in range(5, 0, -1):
            grams = [g for g in (f" {word} "[i : i + n] for i in range(len(word) + 3 - n)) if g in known[n]]
            if grams:
                return [sum(log_share(lang, n, g) for g in grams) / len(grams) for lang in langs]
        return [0.0] * len(langs)

    found = {r.doc_id: r for r in language.op3_language_id(spark, folder).collect()}
    assert len(found) == len(docs)
    for d in docs:
        words = regex.findall(r"\p{L}+", (d.text or "").lower())
        if not words:
            assert (found[d.doc_id].lang_pred, found[d.doc_id].score) == ("und", 0)
            continue
        sums = [sum(x) for x in zip(*map(word_scores, words))]
        assert found[d.doc_id].lang_pred == langs[sums.index(max(sums))]
        assert found[d.doc_id].score == pytest.approx(1 / sum(math.exp(x - max(sums)) for x in sums), abs=1e-6)
