import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catalog_engine.llm import neighbours
from catalog_engine.llm.common import table


def brute(ids, vectors, queries, k=20):
    out = {}
    for q in queries:
        scores = np.einsum("ij,j->i", vectors, vectors[ids == q][0])
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1", "/root/testdata/sf0.01"])
def test_recall(spark, folder):
    rows = table(spark, folder, "embeddings").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows])
    right = brute(ids, vectors, [i for i in ids.tolist() if i % 20 == 0])
    found = neighbours.op8_nearest_neighbours(spark, folder).collect()
    own = {q: [] for q in right}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        own[r.query_id].append((r.vec_id, r.score))
    hits = 0
    for q, near in own.items():
        assert len(near) == 20 and near == sorted(near, key=lambda x: (-x[1], x[0]))
        for i, score in near:
            assert i != q and score == pytest.approx(float(vectors[ids == i][0] @ vectors[ids == q][0]), abs=1e-12)
        hits += len({i for i, _ in near} & {i for i, _ in right[q]})
    assert hits >= 0.9 * 20 * len(right)


def test_probes_find_every_code_in_the_sure_radius():
    random = np.random.default_rng(3)
    centres = random.normal(size=(300, 24))
    vectors = np.concatenate([centres + random.normal(size=centres.shape) * w for w in (0.02, 0.1, 0.3, 0.6, 0.6)])
    coder = neighbours.learn(vectors, 10)
    index = neighbours.Index(np.arange(len(vectors)), vectors, coder)
    assert 0 < coder.sure_radius <= coder.radius < index.codes.shape[1] * 16
    met = 0
    for at in range(0, len(vectors), 50):
        code = index.codes[at]
        near = np.flatnonzero((np.bitwise_count(index.codes ^ code) <= coder.reach).any(axis=1))
        assert index.probed(code).tolist() == near.tolist()
        apart = neighbours.distances(index.codes, code)
        sure = np.flatnonzero(apart <= coder.sure_radius)
        met += len(sure) - 1
        assert set(sure) <= set(index.within(code)) and (apart[index.within(code)] <= coder.radius).all()
    assert met > 0


def test_probes_reach_few_rows():
    rows = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    ids, vectors = rows["vec_id"].to_numpy(), np.array(rows["embedding"].to_pylist(), float)
    coder = neighbours.learn(vectors, 20)
    index = neighbours.Index(ids, vectors, coder)
    right = brute(ids, vectors, [i for i in ids.tolist() if i % 20 == 0])
    probed = within = hits = short = 0
    for q, near in right.items():
        code = coder.codes(vectors[ids == q])[0]
        probed += len(index.probed(code))
        within += len(index.within(code))
        own = index.best(q, vectors[ids == q][0], code, 20)[0]
        short += len(own) < 20
        hits += len(set(own.tolist()) & {i for i, _ in near})
    assert probed < 0.3 * len(ids) * len(right)
    assert within < 0.05 * len(ids) * len(right)
    assert hits >= 0.9 * 20 * len(right)
    assert short <= 0.1 * len(right)


def test_blocks_do_not_follow_partitions(spark):
    rows = spark.range(1_000).select("id", F.array(F.col("id").cast("double")).alias("vector"))
    stored = neighbours.cut(rows.unionByName(rows.filter("id = 7").select(F.explode(F.array_repeat("id", 500)).alias("id"), "vector")).repartition(40))
    for most in (2_000, 100):
        made = neighbours.packed(stored, -(-1_500 // most), most, "block").collect()
        ids = np.concatenate([np.frombuffer(r.block_ids, np.int64) for r in made])
        assert sorted(ids.tolist()) == sorted([*range(1_000), *[7] * 500])
        assert max(len(r.block_ids) // 8 for r in made) <= most and len(made) <= 2 * -(-1_500 // most)
        assert len({r.block for r in made}) == len(made)


def test_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, -0.5]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [1.0, 1.0, 1.0]), (9, []), (None, [1.0, 1.0]), (10, [-1.0, 2.0]), (20, [4.0, 3.0]), (40, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    found = neighbours.nearest(docs, docs.filter("vec_id % 20 = 0"), 3).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)
    assert got == [(0, 1, 20, 4.0), (0, 2, 1, 0.5), (0, 3, 2, 0.5), (20, 1, 0, 4.0), (20, 2, 1, 3.5), (20, 3, 10, 2.0)]
    everyone = neighbours.nearest(docs, docs.filter("vec_id = 0"), 50, block_rows=2).collect()
    assert sorted(r.vec_id for r in everyone) == [1, 2, 10, 20]
    assert neighbours.nearest(docs.limit(0), docs, 3).collect() == []
    assert neighbours.nearest(docs, docs.limit(0), 3).collect() == []
    again = docs.filter("vec_id = 0").unionByName(spark.createDataFrame([(0, [0.0, 1.0], 1)], docs.schema))
    found = neighbours.nearest(docs.unionByName(again), again, 5).collect()
    # Of the two vectors asked under one id the least one, (0, 1), counts; its own id is no candidate.
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == [
        (0, 1, 20, 3.0), (0, 2, 10, 2.0), (0, 3, 1, 0.5), (0, 4, 2, -0.5)
    ]


def test_many_copies(spark):
    """A third of all rows are one vector; ties among them go to the smallest ids, over blocks and lanes."""
    random = np.random.default_rng(8)
    vectors = random.normal(size=(900, 16))
    vectors[::3] = 3 * vectors[0]
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(docs, docs.filter("vec_id % 30 = 0"), 5, block_rows=100).collect()
    own = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        own.setdefault(r.query_id, []).append(r.vec_id)
    assert own == {q: [i for i in range(0, 18, 3) if i != q][:5] for q in range(0, 900, 30)}
