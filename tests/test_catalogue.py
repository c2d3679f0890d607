"""The whole build on a small made-up catalogue, read from files in the raw layouts."""

import datetime
import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog_engine import schemas, session
from catalog_engine.operators import graph, joins, quality
from catalog_engine.plans import job, stages
from catalog_engine.sources import buckets, read, split, write

BASE = "https://site.example/entries/"
DAY = 86_400


def entry(slug, **changes):
    base = {
        "title": slug.title(), "url": BASE + slug, "category": "Meme", "last_update_source": 15_340 * DAY + 5,
        "added": 15_000.0 * DAY, "meta": {"description": "short", "og:image": f"http://img/{slug}"},
        "details": {"year": "2011", "type": ["h/types/pop-culture"], "status": "confirmed"},
        "additional_references": {}, "search_keywords": None, "tags": [], "content": {}, "parent": None,
        "siblings": None, "children": None, "template_image_url": f"http://tpl/{slug}", "ld": {"x": 1},
    }
    return {**base, **changes}


ENTRIES = [
    # Seventeen symbol-like ids; the lowest sixteen go.
    *[entry(f"%{i:02}") for i in range(17)],
    entry(
        "alpha",
        content={
            "about": {"text": ["A much longer about text[1]"]},
            "origin": {"subsections": {"s": {"text": ["Born[2]", "Work in Progress"]}}},
            "examples": {"images": ["i1", "i2"]},
        },
        additional_references={"Wikipedia": "http://en.wikipedia.org/alpha", "x": "no link"},
        tags=["meme", "cats"], search_keywords=["#Grumpy", "u4dcub"],
        siblings=[BASE + "beta", BASE + "alpha", BASE + "gone"], parent=BASE + "root",
    ),
    entry("alpha", tags=["second copy"]),
    entry("beta", parent=BASE + "root", added=None, details={"year": None, "type": [], "status": "submission"}),
    entry("gamma", siblings=[BASE + "alpha", BASE + "delta"]),
    entry("delta", added=None, details={"year": None}),
    entry("root", children=[BASE + "alpha"]),
    entry("french"),
    entry("unsafe", children=[BASE + "delta"]),
    entry("faulty"),
    entry("unseen"),
    entry("rude", title="Pussy cat"),
    entry("person", category="Person"),
    entry("temmie", url="https://knowyourmeme.com/memes/temmie"),
]


def vision(language="en", **changes):
    base = {
        "labelAnnotations": [
            {"mid": "m", "description": "Cat", "score": 0.9, "topicality": 0.9},
            {"mid": "n", "description": "Font", "score": 0.5, "topicality": 0.5},
        ],
        "safeSearchAnnotation": {
            "adult": "UNLIKELY", "medical": "POSSIBLE", "racy": "LIKELY", "spoof": "VERY_LIKELY", "violence": "UNLIKELY",
        },
        "webDetection": {
            "bestGuessLabels": [{"label": "guess it", "languageCode": language}],
            "fullMatchingImages": [{"url": "http://kym-cdn/1"}, {"url": "http://a/1"}],
            "partialMatchingImages": [{"url": f"http://b/{i}"} for i in range(8)],
            "visuallySimilarImages": [{"url": f"http://c/{i}"} for i in range(12)],
            "webEntities": [{"description": "Web Thing", "score": 1.0}, {"score": 0.2}],
        },
    }
    return {**base, **changes}


BAD = {"adult": "VERY_LIKELY", "medical": "UNLIKELY", "racy": "UNLIKELY", "spoof": "UNLIKELY", "violence": "UNLIKELY"}
VISION = {
    BASE + "%16": vision(labelAnnotations=None),
    BASE + "alpha": vision(),
    BASE + "beta": vision(labelAnnotations=[{"description": "Cat", "score": 0.95}]),
    BASE + "gamma": vision(webDetection={"bestGuessLabels": [{}]}),
    BASE + "delta": vision(language=None),
    BASE + "root": vision(),
    BASE + "french": vision("fr"),
    BASE + "unsafe": vision(safeSearchAnnotation=BAD),
    BASE + "faulty": vision(error={"code": 3}),
    BASE + "person": vision(),
}
ENTITIES = {
    BASE + "alpha": {
        "@text": "Linked text", "@confidence": "0.3",
        "Resources": [
            {"@surfaceForm": "Grumpy Cat", "@similarityScore": "0.7", "@URI": "u1"},
            {"@surfaceForm": "meme", "@similarityScore": "1", "@URI": "u2"},
            {"@surfaceForm": "Internet fame", "@similarityScore": "0.9", "@URI": "u3"},
        ],
    },
    BASE + "beta": {"@text": "", "@confidence": "0.3", "Resources": []},
    BASE + "person": {"@text": "nobody", "Resources": []},
}
LOG = (
    ["0,{}alpha,200,100,ann,bob,2010-01-01,2013-01-01", "1,{}beta,200,300,ann,,,2012-03-04",
     "2,{}gamma,200,200,cid,ann,2012-05-05,2012-05-06", "3,{}person,200,9,ann,ann,2012-05-05,2012-05-06"]
    + ["4,{}delta,404,0,,,,", "5,{}%16,200,5,aaa,zed,2012-01-01,2012-01-01", "6,{}root,200,,200,ann,2012-01-01,"]
)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("catalogue")
    (path / "entries.json").write_text(json.dumps(ENTRIES))
    (path / "vision.json").write_text(json.dumps(VISION))
    (path / "entities.json").write_text(json.dumps(ENTITIES))
    (path / "log.txt").write_text("\n".join(LOG).replace("{}", BASE) + "\n")
    return path


@pytest.fixture(scope="module")
def built(spark, folder):
    entries = read.read_records(spark, str(folder / "entries.json"), schemas.ENTRIES)
    vision_rows = read.read_keyed(spark, str(folder / "vision.json"), schemas.VISION_RECORD, separator='}, "https')
    entity_rows = read.read_keyed(spark, str(folder / "entities.json"), schemas.ENTITY_RECORD)
    log = read.read_scrape_log(spark, str(folder / "log.txt"))
    first = stages.clean_entries(entries)
    second = stages.join_vision(first, vision_rows)
    third = stages.join_entities(second, entity_rows)
    return {"first": first, "last": stages.add_people(third, log)}


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def test_first_stage_rows(built):
    main = by_id(built["first"]["main"])
    assert set(main) == {"%16", "alpha", "beta", "gamma", "delta", "root", "french", "unsafe", "faulty", "unseen"}
    alpha = main["alpha"]
    assert alpha["description"] == "A much longer about text\n"
    assert alpha["search_keywords"] == ["Grumpy", "cats"]
    assert alpha["type"] == ["pop culture"]
    assert alpha["similar_images"] == ["i1", "i2"]
    assert (alpha["added"], alpha["updated"], alpha["year"]) == (datetime.date(2011, 1, 26), datetime.date(2012, 1, 1), 2011)
    assert (alpha["has_refs"], alpha["has_other_texts"], alpha["has_relations"]) == (True, True, True)
    assert (main["beta"]["has_refs"], main["beta"]["has_other_texts"]) == (False, False)
    assert [k for k, r in sorted(main.items()) if r["has_relations"]] == ["alpha", "beta", "delta", "gamma", "root", "unsafe"]
    refs = by_id(built["first"]["refs"])
    assert list(refs) == ["alpha"] and refs["alpha"]["ref_wikipedia"] == "http://en.wikipedia.org/alpha"
    assert [tuple(r) for r in built["first"]["textual"].collect()] == [("alpha", "Born\n", None, None)]


def test_long_texts_are_made_and_looked_through_once(spark, folder, monkeypatch):
    plans, real = [], stages.cut_by

    def noted(df, *more):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, *more)

    monkeypatch.setattr(stages, "cut_by", noted)
    entries, _ = split.read_array(spark, str(folder / "entries.json"), schemas.ENTRIES)
    main = by_id(stages.clean_entries(entries)["main"])
    assert set(main) == {"%16", "alpha", "beta", "gamma", "delta", "root", "french", "unsafe", "faulty", "unseen"}
    assert (main["alpha"]["description"], main["alpha"]["search_keywords"]) == ("A much longer about text\n", ["Grumpy", "cats"])
    # One pattern for each kind of text; titles are looked through for these rows only, the lowest ids and copies are known by then.
    assert plans[0].count("regexp_replace") == 4 and plans[0].count("Raped") == 1


def test_recognition_and_cascade(built):
    tables = built["last"]
    main = by_id(tables["main"])
    assert set(main) == {"%16", "alpha", "beta", "gamma", "delta", "root"}
    assert main["alpha"]["alt_img_urls"] == ["http://a/1", *[f"http://b/{i}" for i in range(5)]]
    assert main["alpha"]["similar_images2"] == [f"http://c/{i}" for i in range(10)]
    assert main["alpha"]["image_recogn_scores"] == [0.9, 0.5]
    assert main["%16"]["image_recogn_labels"] == []
    assert main["gamma"]["alt_img_urls"] is None
    assert main["alpha"]["spoof"] == "VERY_LIKELY"
    labels = sorted((r["label"], r["memes"], r["scores"]) for r in tables["labels"].collect())
    assert labels == [
        ("Cat", ["beta", "alpha", "delta", "gamma", "root"], [0.95, 0.9, 0.9, 0.9, 0.9]),
        ("Font", ["alpha", "delta", "gamma", "root"], [0.5] * 4),
    ]
    assert [k for k, r in sorted(main.items()) if r["has_relations"]] == ["alpha", "beta", "delta", "gamma", "root"]


def test_relations(built):
    found = {r["id"]: (r["parent"], r["children"]) for r in built["last"]["relations"].collect()}
    assert found == {"alpha": ("root", None), "beta": ("root", None), "root": (None, ["alpha", "beta"])}
    siblings = {}
    for r in built["last"]["first_siblings"].orderBy("id", "position").collect():
        siblings.setdefault(r["id"], []).append(r["sibling"])
    assert siblings == {
        "alpha": ["beta", "delta", "gamma"], "beta": ["alpha"], "gamma": ["alpha", "delta"], "delta": ["alpha", "gamma"],
    }


def test_entities_and_keywords(built):
    tables = built["last"]
    linked = by_id(tables["DBpedia"])
    assert {k: (r["keywords"], r["scores"], r["links"]) for k, r in linked.items()} == {
        "alpha": (["Internet fame", "Grumpy Cat"], [0.9, 0.7], ["u3", "u1"])
    }
    main = by_id(tables["main"])
    assert main["alpha"]["description"] == "Linked text" and main["beta"]["description"] == "short"
    assert (main["alpha"]["has_DBpedia"], main["beta"]["has_DBpedia"]) == (True, False)
    assert main["alpha"]["search_keywords"] == ["cat", "cats", "culture", "fame", "grumpy", "guess", "pop", "thing", "web"]


def test_people(built):
    tables = built["last"]
    main = by_id(tables["main"])
    # All seven logged authors are among the 23 lowest, so none is left as an author or updater.
    assert {r["author"] for r in main.values()} == {None}
    assert {k: r["updater"] for k, r in main.items() if r["updater"]} == {"alpha": "bob", "%16": "zed"}
    assert str(main["alpha"]["added"]) == "2010-01-01" and str(main["alpha"]["updated"]) == "2013-01-01"
    assert str(main["beta"]["added"]) == "2012-03-04" and main["beta"]["year"] == 2012
    assert str(main["delta"]["added"]) == "2012-01-01" and main["delta"]["year"] == 2012
    assert (main["beta"]["views"], main["delta"]["views"], main["root"]["views"]) == (300, 0, None)
    assert tables["authors"].count() == 0
    updaters = sorted(tuple(r) for r in tables["updaters"].collect())
    assert updaters == [("bob", 0, ["alpha"], 1, 100), ("zed", 0, ["%16"], 1, 5)]


def test_people_with_names(built):
    from catalog_engine.operators import people

    log = built["last"]["main"].select(
        "id", "views", F.when(F.col("id").isin("alpha", "beta", "root"), "ann").otherwise("cid").alias("author")
    )
    found = sorted(tuple(r) for r in people.person_rollup(log, "author", "views").collect())
    assert found == [("ann", 0, ["beta", "alpha", "root"], 3, 400), ("cid", 0, ["gamma", "%16", "delta"], 3, 205)]


def test_graph(built):
    tables = dict(built["last"])
    tables["main"] = tables["main"].withColumn("author", F.lit("ann")).fillna("zed", ["updater"])
    found = stages.build_graph(tables)
    edges = [tuple(r) for r in found["edges"].collect()]
    assert len(edges) == len(set(edges))
    of = {}
    for _, src, relation, _, dst in edges:
        of.setdefault(relation, set()).add((src, dst))
    assert of[graph.RELATED_TO] >= {("alpha", "beta"), ("alpha", "delta"), ("root", "unknown")}
    assert of[graph.CHILD_OF] == {
        ("alpha", "root"), ("beta", "root"), ("gamma", "unknown"), ("delta", "unknown"), ("root", "unknown"),
    }
    assert ("alpha", "Cat") in of[graph.CONTAINS] and of[graph.SIMILAR_TO] == {("alpha", "i1"), ("alpha", "i2")}
    # root has no views and delta no status, so they are no complete entries.
    assert {s for s, _ in of[graph.CREATED_BY]} == {"%16", "alpha", "beta", "gamma"}
    assert of[graph.CREATED] == {(d, s) for s, d in of[graph.CREATED_BY]}
    nodes = [tuple(r) for r in found["nodes"].collect()]
    assert graph.new_rows(found["nodes"], found["nodes"]).count() == 0
    assert sum(1 for n in nodes if n[0] == graph.AUTHOR) == 1


def test_relational(built):
    found = stages.build_relational(built["last"])
    assert {r["check_name"]: r["n_keys"] for r in found["constraints"].collect()} == dict.fromkeys(
        ["memes_key", "authors_key", "updaters_key", "memes_author", "memes_updater"], 0
    )
    assert {r["year"]: r["n"] for r in found["per_year"].collect()} == {2010: 1, 2011: 3, 2012: 2}
    assert {r["n"] for r in found["too_long"].collect()} == {0}
    row = found["memes"].filter("meme_id = 'alpha'").first()
    assert row["alt_img_urls"].startswith('["http://a/1"') and row["added"] == datetime.datetime(2010, 1, 1)


# --- sources and sinks ---


def test_delimited_text_keeps_white_space(spark, tmp_path):
    texts = {"a": " x ", "b": 'y;"z"\n', "c": None, "d": "\tw"}
    write.write_delimited(spark.createDataFrame(list(texts.items()), "id string, t string"), str(tmp_path / "t"))
    assert {r.id: r.t for r in read.read_delimited(spark, str(tmp_path / "t"), ["id", "t"]).collect()} == texts


def test_main_table_survives_files(spark, built, tmp_path):
    main = built["last"]["main"]
    write.write_delimited(main, str(tmp_path / "main"))
    back = read.read_main(spark, str(tmp_path / "main"), has_lists=True)
    assert back.columns == main.columns
    order = ["id"]
    assert [tuple(r) for r in back.orderBy(*order).collect()] == [tuple(r) for r in main.orderBy(*order).collect()]


def test_split_and_keyed(spark, built, tmp_path):
    parts = write.split_main(built["last"]["main"])
    assert not set(schemas.MAIN_LIST_COLUMNS) & set(parts["main"].columns)
    assert parts["similar_img_urls"].count() == 5 and parts["image_recogn"].count() == 6
    write.write_keyed(parts["image_recogn"], str(tmp_path / "keyed"))
    back = read.read_records(
        spark, str(tmp_path / "keyed"), "id string, image_recogn_labels array<string>, image_recogn_scores array<double>", True
    )
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, parts["image_recogn"].collect()))


def test_keyed_files_split_anywhere(spark, tmp_path):
    records = {f"http://h/{i}": {"a": [f"x{i}", '}, "q'], "b": {"c": {"z": i}}} for i in range(1500)}
    (tmp_path / "k.json").write_text(json.dumps(records))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        record = "a array<string>, b struct<c:struct<z:int>>"
        found = read.read_keyed(spark, str(tmp_path / "k.json"), record, separator='}, "http')
        assert found.rdd.getNumPartitions() > 8
        assert {r["id"]: r["b"]["c"]["z"] for r in found.collect()} == {k: v["b"]["c"]["z"] for k, v in records.items()}
        columns = {"u": {f"i{i}": [f"v{i}", "w"] if i % 3 else None for i in range(1500)}}
        (tmp_path / "c.json").write_text(json.dumps(columns))
        whole = read.read_column_keyed(spark, str(tmp_path / "c.json"), "u")
        cut = read.read_column_keyed(spark, str(tmp_path / "c.json"), "u", separator='], "')
        assert {r["id"]: r["u"] for r in whole.collect()} == columns["u"]
        assert {r["id"]: r["u"] for r in cut.collect()} == columns["u"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_append_and_create_twice(spark, tmp_path):
    records = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "id string, n int")
    for _ in range(2):
        write.append_new(records, str(tmp_path / "r"), "id")
    assert spark.read.parquet(str(tmp_path / "r")).count() == 3
    write.append_new(spark.createDataFrame([("a", 9), ("c", 9)], "id string, n int"), str(tmp_path / "r"), "id")
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "r")).collect()) == [1, 2, 2, 9]
    for n in (1, 2):
        write.create_table(records.limit(n).withColumn("t", F.array("id")), str(tmp_path / "t"), "id string, t string")
    assert spark.read.parquet(str(tmp_path / "t")).first().asDict() == {"id": "a", "t": '["a"]'}


def test_log_keeps_broken_lines_visible(spark, tmp_path):
    (tmp_path / "log.txt").write_text("1,h/a,200,5,ann,bob,2012-01-01,2012-01-02\nx,h/b,200,5,a,b,,\n")
    found = {r["id"]: r for r in read.read_scrape_log(spark, str(tmp_path / "log.txt")).collect()}
    assert found["a"]["_corrupt_record"] is None and str(found["a"]["added"]) == "2012-01-01"
    assert found["b"]["_corrupt_record"] is not None and found["b"]["row_no"] is None


def test_whole_job_leaves_only_its_tables(spark, folder, tmp_path):
    def stored():
        return sorted(p.name for p in Path(session.shared_folder(spark)).iterdir())

    before = stored()
    raw = {name: str(folder / f"{name}.json") for name in ("entries", "vision", "entities")}
    job.run(spark, **raw, log=str(folder / "log.txt"), output=str(tmp_path / "final"))
    assert stored() == before
    written = {p.name for p in (tmp_path / "final").iterdir()}
    assert written == {"main", "main_with_lists", "similar_img_urls", "image_recogn", *job.BY_COLUMN, *job.KEYED, "graph", "tables", "rejects"}
    memes, rejects = (spark.read.parquet(str(tmp_path / f"final/{name}/memes")) for name in ("tables", "rejects"))
    assert memes.count() + rejects.count() == 6
    authors = spark.read.parquet(str(tmp_path / "final/tables/authors"))
    assert quality.orphans(memes, "author", authors, "author_id").count() == quality.duplicate_keys(memes, "meme_id").count() == 0
    job.run(spark, **raw, log=str(folder / "log.txt"), output=str(tmp_path / "plain"), model=False)
    assert {p.name for p in (tmp_path / "plain").iterdir()} == written - {"graph", "tables"}
    assert {p.name for p in (tmp_path / "plain/rejects").iterdir()} == {"raw_entries"}
    assert read.read_main(spark, str(tmp_path / "final/main_with_lists"), has_lists=True).count() == 6


def test_job_sets_bad_records_aside(spark, folder, tmp_path):
    whole = (folder / "entries.json").read_text()
    (tmp_path / "entries.json").write_text("[{\"title\": 1, \"added\": [\"no\"]}, " + whole[1:])
    whole = (folder / "vision.json").read_text()
    (tmp_path / "vision.json").write_text('{"https://site.example/entries/bad": {"error": 5, "webDetection": [1]}, ' + whole[1:])
    raw = {"entries": str(tmp_path / "entries.json"), "vision": str(tmp_path / "vision.json"), "entities": str(folder / "entities.json")}
    job.run(spark, **raw, log=str(folder / "log.txt"), output=str(tmp_path / "out"), model=False, strict=False)
    for name, rows in (("vision", 1), ("entities", 0)):
        assert spark.read.parquet(str(tmp_path / f"out/rejects/raw_{name}")).count() == rows
    bad = spark.read.parquet(str(tmp_path / "out/rejects/raw_entries")).collect()
    assert [(r["nth"], r["reason"]) for r in bad] == [(0, split.MALFORMED)]
    assert read.read_main(spark, str(tmp_path / "out/main_with_lists"), has_lists=True).count() == 6


def exchanges(df):
    return re.findall(r"Exchange \w+", df._jdf.queryExecution().executedPlan().toString())


def test_cascades_join_bucket_by_bucket(spark, built):
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {n: spark.conf.get(n) for n in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        rows = spark.range(1_000).select(F.col("id").cast("string"), F.lit("x").alias("text"))
        stored = session.cut(rows)
        tables = {n: buckets.cut_by(rows, 6) for n in ("main", "refs", "textual")}
        gone = buckets.cut_by(rows.filter("id % 3 = 0").select("id"), 6)
        kept = joins.cascade(tables, gone)
        for name, table in kept.items():
            assert exchanges(table) == []
            assert sorted(map(tuple, table.collect())) == sorted(map(tuple, joins.without(stored, gone).collect()))
        assert exchanges(joins.without(stored, gone)) != []
        every = joins.add_flag(joins.add_columns(kept["main"], tables["refs"].withColumnRenamed("text", "more"), "more"), gone, "gone")
        assert exchanges(every) == [] and exchanges(joins.subtract_ids(tables["main"], gone)) == []
        for name in ("refs", "textual"):
            # The table as the build keeps it: a bucketed scan on both sides.
            assert exchanges(built["last"][name]) == []
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_buckets(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("", 4)], "id string, n int")
    stored = buckets.cut_by(rows, 3)
    assert sorted(r["n"] for r in stored.collect()) == [1, 2, 3, 4] and stored.schema == rows.schema
    assert buckets.cut_by(rows.limit(0), 3).collect() == []
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("stored_")]
    assert buckets.bucket_count(stored) == 1
    size = buckets.stored_bytes(stored)
    assert buckets.bucket_count(stored, bucket_bytes=1 + size // 10) == 10
    assert buckets.bucket_count(stored, least_bytes=1) == spark.sparkContext.defaultParallelism


def test_files_of_one_body(spark, tmp_path):
    rows = spark.createDataFrame([(f"k{i}", ['], "x', f"v{i}"] if i % 3 else None, i) for i in range(50)] + [(None, ["w"], 1)], "id string, u array<string>, n int")
    write.write_array(rows, str(tmp_path / "a"), records=7)
    write.write_object(rows, str(tmp_path / "o"), records=7)
    write.write_column_object(rows.select("id", "u"), str(tmp_path / "c"), "u", records=7)
    known = sorted(tuple(r) for r in rows.filter("id is not null").collect())
    again = [tuple(r) for r in read.read_records(spark, str(tmp_path / "a"), "id string, u array<string>, n int").collect()]
    assert sorted(again, key=str) == sorted([*known, (None, ["w"], 1)], key=str)
    for separator in (None, '}, "k'):
        assert sorted(tuple(r) for r in read.read_keyed(spark, str(tmp_path / "o"), "u array<string>, n int", separator=separator).collect()) == known
    for separator in (None, '], "'):
        back = read.read_column_keyed(spark, str(tmp_path / "c"), "u", separator=separator)
        assert sorted(tuple(r) for r in back.collect()) == [r[:2] for r in known]
    write.write_object(rows.limit(0), str(tmp_path / "none"))
    assert read.read_keyed(spark, str(tmp_path / "none"), "u array<string>, n int").collect() == []
