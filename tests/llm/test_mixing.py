import duckdb
import pytest

from catalog_engine.llm import mixing

FOLDER = "/root/testdata/sf0.01"


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{FOLDER}/documents.parquet'")
    right = sorted(duck.execute(mixing.MIX_SQL).fetchall())
    found = sorted(map(tuple, mixing.op7_mix_sources(spark, FOLDER).collect()))
    assert [(r[0], r[1], r[2], r[4]) for r in found] == [(r[0], r[1], r[2], r[4]) for r in right]
    assert [r[3] for r in found] == pytest.approx([r[3] for r in right], rel=1e-12)


def slow_targets(sizes, weights=(3, 1, 2)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def test_targets_and_near_misses(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_A_RANGE", 16)
    rows = [(i, "abc d"[i % 5] if i % 7 else None, "w " * (i * 37 % 91)) for i in range(900)]
    rows += [(2_000 + i, "hot", "w " * (i % 23)) for i in range(3_000)] + [(1, None, None), (1, "a", ""), (None, "b", "x y"), (7, "c", "q " * 3), (7, "c", "q " * 3)]
    docs = spark.createDataFrame([(d, s, t, 1, 2) for d, s, t in rows], "doc_id long, source string, text string, size int, _own int")
    mix = mixing.mixed_sources(docs).collect()
    assert len(mix) == len(rows)
    sizes, taken = {}, {}
    for r in mix:
        assert r.size == len((r.text or "").split()) and r.taken in (0, r.size, 2 * r.size) and r._own == 2
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    target = slow_targets(sizes)
    for r in mix:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 91
    other = sorted((r.doc_id or -1, r.size, r.taken) for r in mixing.mixed_sources(docs.repartition(5), narrow_only=True).collect())
    assert other == sorted((r.doc_id or -1, r.size, r.taken) for r in mix)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.mixed_sources(docs).collect()) == [
        (1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    assert mixing.mixed_sources(docs.limit(0)).collect() == []
