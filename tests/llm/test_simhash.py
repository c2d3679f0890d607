import numpy as np
import pytest
import xxhash

from catalog_engine.llm import simhash
from catalog_engine.llm.common import components, table

FOLDER = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(rows, bits=4):
    fps = [slow_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted(
        (d if d is not None else -1, f"{fp:016x}", least.get(root(i), -1)) for i, ((d, _), fp) in enumerate(zip(rows, fps))
    )


def found_groups(df):
    return sorted(
        (-1 if r.doc_id is None else r.doc_id, r.fingerprint, -1 if r.component_id is None else r.component_id)
        for r in df.collect()
    )


def test_edge_rows(spark):
    near = " ".join(f"w{i}" for i in range(300))
    rows = [
        (5, None), (7, ""), (3, " \t\n"), (9, "One two"), (8, "one TWO"), (8, "one TWO"), (None, "lonely words of nobody here"),
        (12, near), (11, near + " tail"), (13, near.replace("w7 ", "x7 ")), (14, "    É é"), (15, "x" * 100_000 + " y" * 30_000),
    ]
    docs = spark.createDataFrame([(d, t, "a", 1) for d, t in rows], "doc_id long, text string, fp string, root int")
    assert found_groups(simhash.near_duplicates(docs)) == slow_groups(rows)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_small_blocks_find_the_same_groups(spark):
    docs = table(spark, FOLDER, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found_groups(simhash.near_duplicates(docs, block_rows=20)) == slow_groups(rows)
    assert found_groups(simhash.op4_simhash_near_dedup(spark, FOLDER)) == slow_groups(rows)


@pytest.mark.parametrize("other", [False, True])
def test_tiles_lose_no_link(other):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 60, np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (20, 60, 3)).astype(np.uint64), axis=2)
    a = np.unique(np.concatenate([base, (base ^ flips).ravel()]))
    rng.shuffle(a)
    a, b = (a[:600], a[600:]) if other else (a, None)
    u, v = simhash.forest(a, b, 4, tile=16)
    group = {int(x): int(x) for x in a} | ({} if b is None else {int(x): int(x) for x in b})

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for x, y in zip(u.tolist(), v.tolist()):
        group[root(x)] = root(y)
    for x in a.tolist():
        for y in (a if b is None else b).tolist():
            if (x ^ y).bit_count() <= 4:
                assert root(x) == root(y)
    assert len(u) < len(group)


def test_bounds_lose_no_meeting(spark):
    """Blocks of a kind of their own are told apart by halves and quarters; those with a link always meet."""
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 2**64, 3_000, np.uint64)
    fps = np.unique(np.concatenate([fps, fps[:500] ^ np.uint64(0b1011)]))
    nodes = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    packed = simhash.cut(simhash.blocks(nodes, 40))
    own = {r.block: np.frombuffer(r.fps, np.uint64) for r in packed.collect()}
    assert sorted(np.concatenate(list(own.values())).tolist()) == fps.tolist()
    met = [(r.a, r.b) for r in simhash.meetings(packed.select("block", "lows", "highs")).collect()]
    pairs = {tuple(sorted(p)) for p in met}
    assert len(pairs) == len(met) < 0.9 * len(own) * (len(own) + 1) / 2
    for a, x in own.items():
        for b, y in own.items():
            if (np.bitwise_count(x[:, None] ^ y) <= 4).any():
                assert tuple(sorted((a, b))) in pairs


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(x), int(y)) for x, y in rng.integers(0, 300, (200, 2))] + [(1000, i) for i in range(1001, 1400)]
    edges += [(2000 + i, 2001 + i) for i in range(60)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found[1399] == 1000 and found[2060] == 2000
    for u, v in edges:
        assert u == v or found[u] == found[v] <= min(u, v)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
