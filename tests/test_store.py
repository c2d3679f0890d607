"""Batches that can run again, stores of which changed buckets are rewritten, gates, exact sets, bounded bodies."""

import json

import pytest
from pyspark.sql import functions as F

from catalog_engine.operators import filters, quality, relations
from catalog_engine.sources import split, store, write


# --- batches -------------------------------------------------------------------------


def test_batches_can_run_again(spark, tmp_path):
    path = str(tmp_path / "s")
    schema = "k string, n int"
    make = lambda rows: spark.createDataFrame(rows, schema)
    assert store.read_batches(spark, path, schema).collect() == []
    one = make([("a", 2), ("a", 1), (None, 5), (None, 4), ("b", 1)])
    assert store.append_batch(one, path, ["k"], "one", ["n"])
    assert not store.append_batch(make([("z", 0)]), path, ["k"], "one")
    two = make([(None, 0), ("c", 3), ("c", 3), ("a", 0)])
    assert store.append_batch(two, path, ["k"], "two", ["n"])
    rows = sorted(map(tuple, store.read_batches(spark, path, schema).collect()), key=str)
    assert rows == sorted([("a", 1), (None, 4), ("b", 1), ("c", 3)], key=str)
    assert store.append_batch(make([]), path, ["k"], "three") and store.read_batches(spark, path, schema).count() == 4


def test_a_killed_batch_leaves_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([("a", 1)], "k string, n int")

    def killed(*_):
        raise KeyboardInterrupt

    kept = store._files
    calls = []

    def files(*args):
        calls.append(args)
        found = kept(*args)
        if len(calls) == 2:  # the step that moves the batch into the store
            raise KeyboardInterrupt
        return found

    monkeypatch.setattr(store, "_files", files)
    with pytest.raises(KeyboardInterrupt):
        store.append_batch(rows, path, ["k"], "one")
    monkeypatch.setattr(store, "_files", kept)
    assert any(p.name.startswith("_staged") for p in (tmp_path / "s").iterdir())
    assert store.read_batches(spark, path, rows.schema).collect() == []
    assert store.append_batch(rows, path, ["k"], "one")
    assert [tuple(r) for r in store.read_batches(spark, path, rows.schema).collect()] == [("a", 1)]


# --- buckets --------------------------------------------------------------------------


def rows_of(found):
    return sorted(map(tuple, found.read().collect()), key=str)


def test_only_changed_buckets_are_written(spark, tmp_path):
    found = store.BucketStore(spark, str(tmp_path / "s"), "key string, value int", ["key"])
    make = lambda rows: spark.createDataFrame(rows, "key string, value int")
    assert rows_of(found) == []
    first = [(f"k{i}", i) for i in range(400)] + [(None, 1)]
    assert found.merge(make(first + first[:5]), bucket_rows=10) == 41
    assert rows_of(found) == sorted(first, key=str)
    assert found.merge(make(first)) == 0

    changed = [(k, -1 if k == "k7" else v) for k, v in first if k != "k9"]
    written = {p.name for p in (tmp_path / "s" / "rows").iterdir()}
    assert 1 <= found.merge(make(changed)) <= 2
    assert rows_of(found) == sorted(changed, key=str)
    new = [p for p in (tmp_path / "s" / "rows").iterdir() if p.name not in written]
    assert sum(1 for p in new for _ in p.glob("bucket=*")) <= 2

    # Added and replaced rows; the others stay.
    assert 1 <= found.merge(make([("k3", 33), ("new", 1), (None, 2)]), whole=False) <= 3
    expected = [(k, {"k3": 33, None: 2}.get(k, v)) for k, v in changed] + [("new", 1)]
    assert rows_of(found) == sorted(expected, key=str)
    assert found.merge(make([]), whole=False) == 0 and found.merge(make([])) > 30 and rows_of(found) == []


def test_rows_of_an_unfinished_merge_are_not_read(spark, tmp_path):
    found = store.BucketStore(spark, str(tmp_path / "s"), "key string", ["key"])
    found.merge(spark.createDataFrame([("a",), ("b",)], "key string"))
    stray = spark.createDataFrame([("c", "torn", 0)], "key string, version string, bucket int")
    stray.write.mode("append").partitionBy("version", "bucket").parquet(str(tmp_path / "s" / "rows"))
    assert rows_of(found) == [("a",), ("b",)]


# --- gates ------------------------------------------------------------------------------


def test_gate(spark):
    rows = [(1, "a", "x"), (1, "a", "w"), (None, "a", "x"), (None, "b", "x"), (2, None, "toolong"), (3, "q", "toolong"), (4, "b", None), (5, "a", "é" * 6)]
    df = spark.createDataFrame(rows, "id int, who string, name string")
    people = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "person string")
    good, bad = quality.gate(df, "id", [("who", people, "person")], {"name": 6}, ["name"])
    assert good.columns == df.columns
    assert sorted(map(tuple, good.collect())) == [(1, "a", "w"), (4, "b", None), (5, "a", "éééééé")]
    reasons = sorted(((r.id, r.who, r.name, r.reasons) for r in bad.collect()), key=str)
    assert reasons == sorted(
        [
            (1, "a", "x", ["key repeated"]),
            (None, "a", "x", ["key missing"]),
            (None, "b", "x", ["key missing"]),
            (2, None, "toolong", ["name too long"]),
            (3, "q", "toolong", ["name too long", "who unknown"]),
        ],
        key=str,
    )
    assert good.join(people, good.who == people.person, "left_anti").filter("who is not null").count() == 0
    assert quality.duplicate_keys(good, "id").count() == quality.too_long_rows(good, {"name": 6}).count() == 0
    for part in quality.gate(df.limit(0), "id"):
        assert part.collect() == []


# --- siblings -----------------------------------------------------------------------------


def one_signature(groups):
    """All groups of one size have one signature."""
    return groups.groupBy("group_id").agg(F.count("*").alias("n_members"), F.lit(0).alias("_sum"), F.lit(0).alias("_xor"))


def test_equal_signatures_of_different_sets_stay_apart(spark):
    sets = {"a": "123", "b": "123", "c": "124", "d": "124", "e": "34", "f": "125", "g": "123", "h": "34", "i": "6"}
    groups = spark.createDataFrame([(g, m) for g, ms in sets.items() for m in ms], "group_id string, member string")
    for signatures in (relations.set_signatures, one_signature):
        found = {r.group_id: (r.n_members, r.n_groups) for r in relations.distinct_sets(groups, signatures).collect()}
        assert found == {"a": (3, 3), "c": (3, 2), "e": (2, 2), "f": (3, 1), "i": (1, 1)}
    assert relations.distinct_sets(groups.limit(0)).collect() == []


def test_sibling_lists_are_whole(spark):
    groups = [("g", f"{i:03}") for i in range(25)] + [("h", "001"), ("h", "x"), ("i", "001"), ("i", "002"), ("j", "alone")]
    groups = spark.createDataFrame(groups, "group_id string, member string")
    ids = spark.createDataFrame([("001",), ("alone",), ("unknown",), ("x",), ("001",)], "id string")
    found = sorted(map(tuple, relations.sibling_lists(groups, ids, list_rows=10).collect()))
    everyone = [f"{i:03}" for i in range(25) if i != 1] + ["x"]
    assert found == [("001", 0, everyone[:10]), ("001", 1, everyone[10:20]), ("001", 2, everyone[20:]), ("x", 0, ["001"])]
    assert {r.id for r in relations.sibling_lists(groups).collect()} == {f"{i:03}" for i in range(25)} | {"x"}


def test_relations_have_siblings(spark):
    edges = spark.createDataFrame([("a", "p", "parent"), ("b", "p", "parent")], "src string, dst string, kind string")
    groups = spark.createDataFrame([("a", "a"), ("a", "b"), ("a", "c")], "group_id string, member string")
    found = {r.id: tuple(r)[1:] for r in relations.relations_table(edges, 10, groups).collect()}
    assert found == {
        "a": (0, "p", None, ["b", "c"]), "b": (0, "p", None, ["a", "c"]), "c": (0, None, None, ["a", "b"]), "p": (0, None, ["a", "b"], None),
    }
    assert "siblings" not in relations.relations_table(edges, 10).columns


# --- bodies and positions --------------------------------------------------------------------


def test_bodies_are_closed_by_their_size(spark, tmp_path):
    """Long records make more files, each with one record beyond the bound at most."""
    long = 300_000
    df = spark.range(40).coalesce(1).select("id", F.repeat(F.lit("x"), F.when(F.col("id") % 2 == 0, long).otherwise(10)).alias("t"))
    write.write_array(df, str(tmp_path / "a"), chars=1_000_000)
    files = [p.read_text() for p in (tmp_path / "a").glob("part-*")]
    bodies = [json.loads(f) for f in files if f]
    assert len(bodies) == 7 and max(map(len, files)) < 1_000_000 + long + 1_000
    assert sorted(r["id"] for b in bodies for r in b) == list(range(40))
    assert all([r["id"] for r in b] == sorted(r["id"] for r in b) for b in bodies)
    write.write_object(df.limit(4), str(tmp_path / "o"), records=2)
    assert sorted(len(json.loads(p.read_text())) for p in (tmp_path / "o").glob("part-*") if p.stat().st_size) == [2, 2]


def test_positions_have_no_gaps(spark, tmp_path):
    for name, n in (("b", 3), ("a", 4)):
        (tmp_path / name).write_text("".join(f'{{"id": "{name}{i}"}}\n' if i != 1 else "bad\n" for i in range(n)))
    rows, bad = split.read_lines(spark, str(tmp_path), "id string")
    placed = split.with_ordinal(rows)
    assert [(r.id, r.ordinal) for r in placed.orderBy("ordinal").collect()] == [("a0", 0), ("a2", 1), ("a3", 2), ("b0", 3), ("b2", 4)]
    assert bad.count() == 2
    kept = filters.exclude_positions(placed, [1, 3])
    assert sorted(r.id for r in kept.collect()) == ["a0", "a3", "b2"]


def test_added_rows_are_not_made_distinct_again(spark, tmp_path, monkeypatch):
    found = store.BucketStore(spark, str(tmp_path / "s"), "k string, n int", ["k"])
    found.merge(spark.createDataFrame([("a", 1), ("b", 1), (None, 1)], "k string, n int"), bucket_rows=1)
    plans, changed = [], found._changed

    def seen(stored, wanted):
        plans.append(wanted._jdf.queryExecution().optimizedPlan().toString())
        return changed(stored, wanted)

    monkeypatch.setattr(found, "_changed", seen)
    found.merge(spark.createDataFrame([("a", 2), ("a", 3), (None, 2), (None, 2)], "k string, n int"), whole=False)
    assert {tuple(r) for r in found.read().collect()} == {("a", 2), ("a", 3), ("b", 1), (None, 2)}
    # Only the newest versions are found by a group.
    assert plans[0].count("Aggregate") == 1
