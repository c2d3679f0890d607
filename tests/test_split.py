"""Files of one array or object read by many tasks, rejects with their place, and true source order."""

import contextlib
import io
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog_engine import session
from catalog_engine.plans import stored_queries
from catalog_engine.sources import split, write

SCHEMA = "id int, name string, parts array<struct<a:string>>, more map<string,string>"


def records(n, seed=1):
    pick = random.Random(seed)
    signs = ['}', '{', '"', "\\", ",", "[", "]", "é", " ", "}, {", '\\"', "\n", "x", '": {"']
    texts = ["".join(pick.choice(signs) for _ in range(pick.randint(0, 12))) for _ in range(n)]
    return [{"id": i, "name": t, "parts": [{"a": t}] * (i % 3), "more": {t: t} if i % 4 == 0 else {}} for i, t in enumerate(texts)]


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of a few hundred bytes."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "300")
    spark.conf.set(names[1], "0")
    spark.conf.set(names[2], "64")
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


@pytest.mark.parametrize("indent", [None, 1])
def test_array_is_whole_whatever_the_cuts(spark, tmp_path, small_blocks, indent):
    rows = records(200)
    (tmp_path / "one.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    (tmp_path / "two.json").write_text(json.dumps(rows[:7]))
    (tmp_path / "none.json").write_text("[ ]\n")
    (tmp_path / "empty.json").write_text("")
    path = str(tmp_path)
    blocks = split.file_blocks(spark, path, "}").select("file", "block").distinct().count()
    assert blocks > 20
    good, bad = split.read_array(spark, path, SCHEMA)
    found = {(r.file.split("/")[-1], r.nth): r for r in good.collect()}
    assert bad.collect() == [] and len(found) == 207
    for name, some in (("one.json", rows), ("two.json", rows[:7])):
        for i, row in enumerate(some):
            r = found[name, i]
            assert (r.id, r.name, [p.a for p in r.parts], r.more) == (i, row["name"], [p["a"] for p in row["parts"]], row["more"])


def test_object_is_whole_whatever_the_cuts(spark, tmp_path, small_blocks):
    rows = records(150, 2)
    (tmp_path / "one.json").write_text(json.dumps({f'k"}}{{{r["id"]}': r for r in rows}))
    (tmp_path / "none.json").write_text("{}")
    good, bad = split.read_object(spark, str(tmp_path), SCHEMA, "key")
    found = {r.nth: r for r in good.collect()}
    assert bad.collect() == [] and sorted(found) == list(range(150))
    assert all((r.key, r.name) == (f'k"}}{{{n}', rows[n]["name"]) for n, r in found.items())


@pytest.mark.parametrize("depth", [1, 2])
def test_files_read_whole_are_assembled_as_in_blocks(spark, tmp_path, small_blocks, depth):
    rows = records(24, 4)
    array, keyed = json.dumps(rows, ensure_ascii=False), json.dumps({f'k"}}{{{r["id"]}': r for r in rows})
    torn = ['[{"id": 1}, {"id": 2, "name": "b', '[{"id": 1, "name": "}"}', array[:-40], array + ' x}', "}}{{"]
    for i, text in enumerate([array, "[ ]\n", "", *torn] if depth == 1 else [keyed, "{}", "{", keyed[:-9], keyed[:-1], keyed + "}"]):
        (tmp_path / f"{i}.json").write_text(text)

    def found():
        return sorted(map(tuple, split.split_members(spark, str(tmp_path), depth).collect()), key=repr)

    in_blocks = found()
    assert len(in_blocks) > 70
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000000")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    # One task reads all the files, one after another.
    pieces = split.file_blocks(spark, str(tmp_path), "}")
    assert pieces.filter("not is_whole").count() == 0 and pieces.select(F.spark_partition_id()).distinct().count() == 1
    assert found() == in_blocks


def test_text_of_files_read_whole_is_neither_stored_nor_sent(spark, tmp_path):
    df = spark.range(400).select("id", F.repeat(F.md5(F.col("id").cast("string")), 30).alias("name")).repartition(2)
    write.write_array(df, str(tmp_path / "a"), records=90, compression="gzip")
    shared = Path(session.shared_folder(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    members = split.split_members(spark, str(tmp_path / "a"))
    stored = [spark.read.parquet(str(p)) for p in set(shared.iterdir()) - before]
    assert sum(t.count() for t in stored if "value" in t.columns) == 0
    assert "MapInArrow" in members._jdf.queryExecution().executedPlan().toString() and members.count() == 400


def test_rejects_have_place_and_reason(spark, tmp_path, small_blocks):
    rows = [json.dumps(r) for r in records(60, 3)]
    rows[4] = '{"id": "four", "name": "x"}'
    rows[9] = '{"id": 9, "name": "x",, }'
    (tmp_path / "one.json").write_text("[" + ", ".join(rows) + "]")
    (tmp_path / "torn.json").write_text('[{"id": 1, "name": "a"}, {"id": 2, "name": "b')
    (tmp_path / "open.json").write_text('[{"id": 1, "name": "}"}')
    good, bad = split.read_array(spark, str(tmp_path), SCHEMA)
    rejected = {(r.file.split("/")[-1], r.nth): (r.reason, r.value) for r in bad.collect()}
    assert rejected[("one.json", 4)] == (split.MALFORMED, rows[4]) and rejected[("one.json", 9)] == (split.MALFORMED, rows[9])
    assert rejected[("torn.json", 1)] == (split.CUT_OFF, ', {"id": 2, "name": "b') and len(rejected) == 3
    assert good.count() == 58 + 1 + 1


def test_lines_are_numbered_without_gaps(spark, tmp_path, small_blocks):
    for name, n in (("b", 300), ("a", 40), ("c", 0)):
        (tmp_path / name).write_text("".join(f"{name} {i} {'x' * (i % 90)}\n" for i in range(n)))
    found = split.numbered_lines(spark, str(tmp_path)).collect()
    assert sorted((r.value.split(" ")[0], int(r.value.split(" ")[1]), r.line) for r in found) == sorted(
        [("b", i, i) for i in range(300)] + [("a", i, i) for i in range(40)]
    )


def test_bad_lines_are_rejected_whole(spark, tmp_path):
    lines = ['{"id": 1}', "", "no record", '{"id": "x"}', "[1]", '{"id": 2, "name": null, "other": 3}']
    (tmp_path / "one").write_text("\n".join(lines) + "\n")
    good, bad = split.read_lines(spark, str(tmp_path), "id int, name string")
    assert [(r.nth, r.id, r.name) for r in good.orderBy("nth").collect()] == [(0, 1, None), (5, 2, None)]
    assert [(r.nth, r.value) for r in bad.orderBy("nth").collect()] == [(2, "no record"), (3, '{"id": "x"}'), (4, "[1]")]


def test_plan_carries_one_row_a_block(spark, tmp_path):
    (tmp_path / "one").write_text("a\nb\n")
    df = split.file_blocks(spark, str(tmp_path)).withColumn("one", F.lit(1))
    plan = split.carried(df, "one", "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.index("HashAggregate")


def test_text_is_sent_once_and_only_torn_records_again(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(records(50)))
    text = split.split_members(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    # One window chain by block in each of the two branches, which share their shuffle; before, the text was stored thrice more.
    assert "quotes_before" in text and text.count("Aggregate") == 3


def test_good_records_are_stored_without_their_text(spark, tmp_path):
    (tmp_path / "one.json").write_text('[{"id": 1, "name": "a"}, {"id": "x"}]')
    good, bad = split.read_array(spark, str(tmp_path), SCHEMA)
    stored = spark.read.parquet(*{f.rsplit("/", 1)[0] for f in good.inputFiles()})
    assert sorted((r.value is None, r.reason) for r in stored.collect()) == [(False, split.MALFORMED), (True, None)] or \
        {(r.nth, r.value) for r in stored.collect()} == {(0, None), (1, '{"id": "x"}')}
    assert [r.id for r in good.collect()] == [1] and [r.value for r in bad.collect()] == ['{"id": "x"}']


def test_compressed_bodies_are_read_back(spark, tmp_path):
    df = spark.range(500).select("id", F.lit('}"{').alias("name")).repartition(3)
    write.write_array(df, str(tmp_path / "a"), records=70, compression="gzip")
    assert len(list((tmp_path / "a").glob("*.json.gz")) + list((tmp_path / "a").glob("*.txt.gz"))) >= 8
    good, bad = split.read_array(spark, str(tmp_path / "a"), "id int, name string")
    assert bad.collect() == [] and sorted((r.id, r.name) for r in good.collect()) == [(i, '}"{') for i in range(500)]


def test_lines_of_a_place_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    spark.range(3000).select(F.col("id").alias("doc_id"), F.repeat(F.md5(F.col("id").cast("string")), 40).alias("text")).write.parquet(
        str(tmp_path / "documents.parquet")
    )
    monkeypatch.setattr(stored_queries, "new_folder", lambda _, name: str(tmp_path / name))
    before = {n: spark.conf.get(n, None) for n in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = {r.ordinal: r.doc_id for r in stored_queries.first_in_source(spark, str(tmp_path)).collect()}
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    order = sorted(range(3000), key=lambda d: (2 - d % 3, d))
    assert found == {i: d for i, d in enumerate(order) if i not in stored_queries.DROPPED_POSITIONS}
    assert all(len(list(place.glob("*.json"))) > 1 for place in (tmp_path / "lines").glob("place=*"))


def test_files_read_whole_need_no_patterns(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps(records(9)))
    text = plan(split.assembled_files(split.file_blocks(spark, str(tmp_path), "}").drop("is_whole"), 1))
    assert "MapInArrow" in text and "regexp_replace" not in text and "replace(" not in text


@pytest.mark.parametrize("whole", [True, False])
def test_escaped_signs_are_no_quotes_or_braces(spark, tmp_path, small_blocks, whole):
    if whole:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
    texts = ["\\", '\\"', '"', "\\\\", '{\\"', '\\"{', "\n{\n", "a\\nb", "\\{", '\\\\"{', " {", "}\\", '"}"', "", " , ["]
    rows = [{"id": i, "name": a + b, "parts": [{"a": b}], "more": {a: b}} for i, (a, b) in enumerate((a, b) for a in texts for b in texts)]
    (tmp_path / "one.json").write_text(" ,[ , " + json.dumps(rows)[1:])
    assert (split.file_blocks(spark, str(tmp_path), "}").select("block").distinct().count() == 1) == whole
    good, bad = split.read_array(spark, str(tmp_path), SCHEMA)
    assert bad.count() == 0
    assert [(r.nth, r.id, r.name, r.parts[0].a, r.more) for r in good.orderBy("nth").collect()] == [
        (r["id"], r["id"], r["name"], r["parts"][0]["a"], r["more"]) for r in rows
    ]
