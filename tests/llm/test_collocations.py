import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from catalog_engine.llm import collocations

FOLDER = "/root/testdata/sf0.01"


def brute_force(rows, threshold, longest, most):
    """The contract, word by word, in Python's integers: (lang, rank, phrase, a, l, r, n, score)."""
    counts = defaultdict(Counter)
    for lang, text in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            for k in range(1, longest + 1):
                counts["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        found = []
        for p, a in often.items():
            inside = lambda q: any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            if any(len(q) > len(p) and 100 * b >= 100 * a and inside(q) for q, b in often.items()):
                continue
            score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        found.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(found[:most])]
    return sorted(out)


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    right = sorted(duck.execute(collocations.COLLOCATIONS_SQL).fetchall())
    assert sorted(map(tuple, collocations.op13_collocations(spark, FOLDER).collect())) == right and right


def rows_of(seed=5):
    random = np.random.default_rng(seed)
    words = ["Ab", "cd", "é", "x-y", "IJ", "日本", "k\x1cz", "lm", " ", "no"]
    share = np.array([30, 20, 10, 8, 6, 5, 4, 3, 2, 1]) / 89
    out = [(None, None), ("x", ""), ("x", " \t "), ("x", ".,;:!?\n\x0b\x0c\r"), ("z", "one two three"), ("", "a b")]
    for i in range(150):
        text = " ".join(random.choice(words, random.integers(0, 30), p=share))
        out.append((["x", "y", None][i % 3], text.replace("IJ", "IJ." if i % 2 else "\tIJ\n")))
    # One text is a large part of the table; rows repeat, and phrases overlap themselves.
    return out + [("x", "to be or not to be, that is"), ("y", "no no no no no no no")] * 60 + [("x", "long " * 5_000)]


@pytest.mark.parametrize("shards, slots, threshold", [(1, 1 << 16, 20), (3, 1 << 16, 20), (4, 7, 20), (5, 1 << 16, 60), (2, 1, 3)])
def test_any_cycle_and_any_table(spark, shards, slots, threshold):
    """One slot for all phrases only costs counts; the result is the same."""
    rows = rows_of()
    docs = spark.createDataFrame([(*r, 1, "q") for r in rows], "lang string, text string, n int, phrase string").repartition(5)
    found = collocations.collocations(docs, threshold, 5, 30, shards, slots)
    assert sorted(map(tuple, found.collect())) == brute_force(rows, threshold, 5, 30)


def test_phrases_start_when_both_parts_are_reached(spark):
    """A phrase is counted in one cycle from the scan after its later part's, and in no other scan."""
    slots = np.zeros(1 << 16, np.uint8)
    words = [b".", b"a", b"b", b"c"]
    ids = np.array([1, 2, 3, 0, 1, 2, 0] * 4, np.int32)
    a, b = collocations.word_names("x", words)
    pair = lambda i, j: int(collocations.mixed(a[i : i + 1], a[j : j + 1])[0] >> np.uint64(1))
    of = {pair(1, 2): "a b", pair(2, 3): "b c"}

    def counted(scan):
        found = collocations.piece_counts("x", words, ids, slots, scan, 3, 5)
        return {of.get(int(x), int(x)): int(c) for first, _, mark, n, _ in found for x, m, c in zip(first.to_pylist(), mark, n) if m >= 512}

    place = collocations.places(a, slots)
    slots[place[1]] = 1
    assert counted(1) == {}
    slots[place[2]] = 2
    assert counted(2) == counted(3) == counted(4) == {"a b": 8}
    assert counted(5) == {}
    slots[place[3]] = 4
    assert counted(4) == {"a b": 8, "b c": 4} and counted(5) == counted(6) == {"b c": 4}


def test_products_beyond_64_bits(spark):
    """Score of counts whose products need 38 digits."""
    a, l, r, n = 10**12, 3 * 10**12, 7 * 10**12, 8 * 10**13
    score = "(1000BD * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))"
    df = spark.createDataFrame([(a, l, r, n)], "a long, l long, r long, n long")
    assert df.selectExpr(f"{score} as s").first().s == 1000 * a * n // (l * r)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs, slots=64).collect() == []
