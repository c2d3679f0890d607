import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from catalog_engine.llm import source_audit

FOLDER = "/root/testdata/sf0.01"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute_force(rows, least, top):
    """The contract, word by word, in Python's integers."""
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]
        groups[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {k for k, _ in groups}:
        kept = [t for t, d in docs[lang].items() if d >= least]

        def shares(count):
            total = sum(count[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 2) // total for t in kept}

        own = {s: shares(c) for (k, s), c in groups.items() if k == lang}
        whole = shares(sum((c for (k, _), c in groups.items() if k == lang), Counter()))
        for s, p in own.items():
            def f(t, q):
                return (p[t] - q[t]) ** 2 // (p[t] + q[t])

            found = sorted((-sum(f(t, q) for t in kept), o.encode()) for o, q in own.items() if o != s)
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(found)]
            found = sorted((-f(t, whole), t.encode()) for t in kept if groups[lang, s][t] and p[t] > whole[t])
            out += [(lang, s, "term", o.decode(), -v, i + 1) for i, (v, o) in enumerate(found[:top])]
    return sorted(out)


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    right = sorted(duck.execute(source_audit.AUDIT_SQL).fetchall())
    found = sorted(map(tuple, source_audit.op12_source_audit(spark, FOLDER).collect()))
    assert found == right and len(found) > 2_000


def rows_of(seed=3):
    random = np.random.default_rng(seed)
    words = ["Ab", "cd", "é", "ÉÀ", "e3f", "g_h", "IJ", "日本", "k", "ß", "lm", "no"]
    out = [(None, None, None), ("x", None, ""), ("x", "s0", "1 2 3"), ("lonely", "s0", "ab cd"), ("none", "a", ""), ("none", "b", "ab"), ("none", "c", None)]
    for i in range(240):
        out.append((["x", "y", None][i % 3], f"s{i % 17}" if i % 5 else None, " ".join(random.choice(words, random.integers(0, 12), p=None))))
    # Half of the rows are one group, and some rows repeat.
    return out + [("x", "hot", "ab ab cd no")] * 200


@pytest.mark.parametrize("group_block, term_block", [(64, 4_096), (3, 2), (1, 1), (5, 3)])
def test_cells_of_any_size(spark, group_block, term_block):
    rows = rows_of()
    docs = spark.createDataFrame([(*r, 7, "q") for r in rows], "lang string, source string, text string, docs int, term string")
    found = source_audit.audit(docs, least := 10, 4, group_block, term_block)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, least, 4)


def test_empty_table_and_one_document(spark):
    docs = spark.createDataFrame([(None, "s", "one text")], "lang string, source string, text string")
    assert source_audit.audit(docs).collect() == []
    assert source_audit.audit(docs.limit(0)).collect() == []


def test_long_text_and_large_counts(spark):
    rows = [("x", "a", "word " * 400_000), ("x", "b", "word other"), ("x", "c", "Other " * 70_001)]
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, source_audit.audit(docs, 1, 10).collect())) == brute_force(rows, 1, 10)
    counts = np.array([[9 * 10**14, 5, 0], [1, 10**15, 3]])
    totals = counts.sum(axis=1) + 6
    expected = [[1 + 10**9 * (int(c) + 2) // int(t) for c in row] for row, t in zip(counts, totals)]
    assert source_audit.shares_of(counts, totals).tolist() == expected
    df = spark.createDataFrame([(int(c), int(t)) for row, t in zip(counts, totals) for c in row], "c long, t long")
    assert [r.p for r in source_audit.with_share(df, "p", "c", "t").collect()] == [x for row in expected for x in row]


def test_slices_go_only_to_their_cells():
    left, right = np.array([[3, 9], [5, 5]]), np.array([[1, 1]])
    assert source_audit.cell_sums(left, right).tolist() == [[4 // 4 + 64 // 10], [16 // 6 + 16 // 6]]
