"""Table operators on hand-made rows, with hot keys, several runs and shuffled input."""

import random

import pytest
from pyspark.sql import functions as F

from catalog_engine.functions.lists import score_order
from catalog_engine.operators import filters, graph, groups, inverted, joins, people, quality, relations


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_keep_first(spark):
    df = spark.createDataFrame([("t", "u", 5), ("t", "u", 2), ("t", "u", 9), ("t", None, 1)], "t string, u string, o int")
    assert rows(groups.keep_first(df, ["t", "u"], [F.col("o")])) == [("t", None, 1), ("t", "u", 2)]
    assert rows(groups.keep_first(df, [groups.text_key("t", "u")], [F.col("o")])) == [("t", None, 1), ("t", "u", 2)]


def test_deny_titles_keeps_missing(spark):
    df = spark.createDataFrame([("Grass",), ("grape",), (None,), ("x.y",)], "t string")
    assert rows(filters.deny_titles(df, "t", ["ra"])) == [(None,), ("x.y",)]
    assert rows(filters.deny_titles(df, "t", ["."])) == [(None,), ("Grass",), ("grape",)]


def test_row_filters(spark):
    df = spark.createDataFrame(
        [("a", "en", None, 1), ("b", None, None, None), ("c", "de", "bad", 1)], "id string, lang string, error string, n int"
    )
    assert ids(filters.keep_language(df, "lang")) == ["a", "b"]
    assert ids(filters.drop_errors(df)) == ["a", "b"]
    assert ids(filters.drop_empty(df, ["lang", "n"])) == ["a", "c"]
    assert ids(filters.drop_incomplete(df.drop("error"))) == ["a", "c"]
    assert ids(filters.exclude_values(df, "lang", ["de"])) == ["a", "b"]
    filled = filters.fill_missing(df.withColumn("l", F.when(F.col("n") == 1, F.array("id"))), ["lang", "l"])
    assert rows(filled.select("id", "lang", "l")) == [("a", "en", ["a"]), ("b", "unknown", ["unknown"]), ("c", "de", ["c"])]
    counted = df.select("id", filters.missing_count("lang", "error", "n"), filters.has_any("lang", "error"))
    assert rows(counted) == [("a", 1, True), ("b", 3, False), ("c", 0, True)]
    assert filters.single_value_columns(df) == ["error", "n"] or filters.single_value_columns(df) == []


def test_single_value_columns(spark):
    df = spark.createDataFrame([("a", "x", None), ("b", "x", None)], "a string, b string, c string")
    assert filters.single_value_columns(df) == ["b", "c"]


def test_exclude_lowest_ids(spark):
    df = spark.createDataFrame([(f"h/{c}/{s}",) for c, s in zip("zyxw", "abca")], "url string")
    assert rows(filters.exclude_lowest_ids(df, "url", 2)) == [("h/x/c",), ("h/y/b",)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_the_plain_join(spark, how):
    many = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 90).cast("string")).alias("k"), "id")
    many = many.unionByName(spark.createDataFrame([(None, 1)], "k string, id bigint"))
    few = spark.createDataFrame([("hot", "h"), ("hot", "i"), ("7", "s"), ("none", "n")], "k string, v string")
    found = groups.spread_join(many, few, "k", how, key_rows=100)
    assert rows(found) == rows(many.join(few, "k", how))
    assert rows(groups.spread_join(many, few, "k", how)) == rows(found)


def test_every_hot_key_is_spread_by_its_count(spark):
    many = spark.range(150 * 70).select((F.col("id") % 150).alias("k"), "id").unionByName(spark.range(999).select(F.lit(-1).cast("bigint").alias("k"), "id"))
    shares = {r["k"]: r["_shares"] for r in groups.key_shares(many, "k", 20).collect()}
    assert shares == {**{k: 4 for k in range(150)}, -1: 50}


@pytest.mark.parametrize("list_rows", [7, 100_000])
def test_sorted_lists_are_whole(spark, list_rows):
    values = [("hot", float(i % 10) if i % 50 else None, i) for i in range(1500)]
    values += [(f"k{i % 40}", float(i % 3), i) for i in range(400)]
    random.Random(3).shuffle(values)
    df = spark.createDataFrame(values, "label string, score double, id bigint").repartition(5)
    found = inverted.inverted_lists(df, list_rows=list_rows).orderBy("label", "part").collect()
    assert max(len(r["id"]) for r in found) <= list_rows
    joined = {}
    for r in found:
        assert r["part"] == len(joined.setdefault(r["label"], [])) // list_rows
        joined[r["label"]] += list(zip(r["id"], r["score"]))
    expected = {}
    for label, score, key in values:
        expected.setdefault(label, []).append((key, score))
    for label, items in expected.items():
        items.sort(key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
        assert joined[label] == items


def test_rank_does_not_depend_on_partitions(spark):
    df = spark.range(4000).select(F.when(F.col("id") < 3000, "hot").otherwise((F.col("id") % 7).cast("string")).alias("k"), "id")
    df = df.unionByName(spark.createDataFrame([(None, -1), (None, -2)], "k string, id bigint"))
    found = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for partitions in ("3", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found.append(rows(groups.rank_in_groups(df.orderBy(F.rand(1)), ["k"], [F.col("id")])))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]
    assert [p for k, _, p in found[0] if k == "hot"] == list(range(1, 3001))
    assert [p for k, _, p in found[0] if k is None] == [1, 2]


def test_person_rollup(spark):
    df = spark.createDataFrame(
        [("a", "p", 10), ("b", "p", 30), ("c", "p", None), ("d", None, 5), ("e", "q", None)], "id string, p string, v int"
    )
    assert rows(people.person_rollup(df, "p", "v")) == [("p", 0, ["b", "a", "c"], 3, 40), ("q", 0, ["e"], 1, 0)]
    parts = rows(people.person_rollup(df, "p", "v", list_rows=2))
    assert parts == [("p", 0, ["b", "a"], 3, 40), ("p", 1, ["c"], 3, 40), ("q", 0, ["e"], 1, 0)]


def test_lowest_names(spark):
    df = spark.createDataFrame(
        [("1", "b", "b"), ("2", "a", "c"), ("3", "a", "a"), ("4", "c", None), ("5", "200", "d")], "id string, author string, updater string"
    )
    found = people.blank_lowest_names(df, {"author": "author", "updater": "author"}, most=3)
    # Lowest three author values by row: 200, a, a.
    assert rows(found, "id") == [("1", "b", "b"), ("2", None, "c"), ("3", None, None), ("4", "c", None), ("5", None, "d")]


def test_reconcile_dates(spark):
    df = spark.sql(
        "SELECT 'x' AS id, CAST(NULL AS DATE) AS added, CAST(NULL AS DATE) AS added2, "
        "DATE'2012-01-05' AS updated, CAST(NULL AS DATE) AS updated2, CAST(NULL AS INT) AS year"
    )
    row = people.reconcile_dates(df, ("added", "added2"), ("updated", "updated2"), "year").first()
    assert (str(row["added"]), row["year"]) == ("2012-01-05", 2012)


# --- joins ---


def test_cascade_and_links(spark):
    table = spark.createDataFrame([("x",), ("y",)], "id string")
    dropped = spark.createDataFrame([("x",)], "id string")
    kept = joins.cascade({"a": table, "b": table}, dropped)
    again = joins.cascade(kept, dropped)
    assert [ids(t) for t in again.values()] == [["y"], ["y"]]
    edges = spark.createDataFrame([("x", "y"), ("y", "x"), ("y", "z")], "src string, dst string")
    assert rows(joins.drop_links(edges, dropped)) == [("y", "z")]
    assert rows(joins.union_ids(table, dropped)) == [("x",), ("y",)]
    assert rows(joins.subtract_ids(table, dropped)) == [("y",)]


# --- relations ---


def completed(listed):
    """Every sibling list after one pass, by the definition."""
    found = {}
    for m, names in listed.items():
        for s in {m, *names}:
            found.setdefault(s, set()).update({m, *names} - {s})
    return {s: sorted(n) for s, n in found.items() if n}


def sibling_edges(spark, listed):
    pairs = [(m, s) for m, names in listed.items() for s in names]
    random.Random(5).shuffle(pairs)
    return spark.createDataFrame(pairs, "src string, dst string").repartition(4)


CASES = [
    {"a": ["b", "c"], "c": ["d"]},
    {"a": ["b", "c"], "b": ["a", "c"], "c": ["a", "b"], "x": ["y"], "y": ["x"]},
    {"hub": [f"m{i:03}" for i in range(60)], "m001": ["m002", "z"], "z": ["hub"]},
    {"hub": [f"m{i:04}" for i in range(1_100)]},
]


@pytest.mark.parametrize("listed", CASES)
def test_sibling_completion(spark, listed):
    found = relations.without_equal_groups(relations.sibling_groups(sibling_edges(spark, listed)))
    expected = completed(listed)
    more = {}
    everyone = spark.createDataFrame([(k,) for k in expected], "id string")
    for r in relations.siblings_of(found, everyone).collect():
        more.setdefault(r["id"], []).append(r["sibling"])
    assert {k: sorted(v) for k, v in more.items()} == expected
    first = {}
    for r in relations.first_siblings(found, 5).orderBy("id", "position").collect():
        first.setdefault(r["id"], []).append(r["sibling"])
    assert first == {k: v[:5] for k, v in expected.items()}


def test_equal_groups_are_kept_once(spark):
    found = relations.without_equal_groups(relations.sibling_groups(sibling_edges(spark, CASES[1])))
    assert rows(found) == [("a", "a"), ("a", "b"), ("a", "c"), ("x", "x"), ("x", "y")]
    parents = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", "p"), ("x", "p"), ("y", "q")], "id string, parent string")
    assert rows(relations.set_parents(found, parents)) == [("a", 1, "p"), ("x", 2, "p")]


def test_relations_table(spark):
    entries = spark.createDataFrame(
        [
            ("p", None, None, ["h/c1", "h/p", "h/gone"]),
            ("c1", "h/p", ["h/c2", "h/c1"], None),
            ("c2", "h/p", None, None),
            ("c3", "h/gone", None, None),
            ("q", None, ["h/gone"], ["h/c3"]),
        ],
        "id string, parent string, siblings array<string>, children array<string>",
    )
    edges = relations.known_edges(relations.relation_edges(entries), entries)
    found = rows(relations.relations_table(edges), "id")
    assert found == [
        ("c1", 0, "p", None), ("c2", 0, "p", None), ("p", 0, None, ["c1", "c2"]), ("q", 0, None, ["c3"]),
    ]
    siblings = relations.sibling_groups(relations.of_kind(edges, relations.SIBLING))
    assert ids(relations.related_ids(edges, siblings)) == ["c1", "c2", "p", "q"]
    named = relations.of_kind(edges, "parent").select(F.col("src").alias("id"), F.col("dst").alias("parent"))
    children = relations.complete_children(edges)
    assert rows(relations.parent_agreement(children, named)) == [(1, 0)]
    told = relations.of_kind(edges, "parent").select(F.col("dst").alias("parent"), F.col("src").alias("child"))
    assert told.join(children, ["parent", "child"], "left_anti").count() == 0


# --- graph, quality ---


def test_nodes_are_merged_and_not_added_twice(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), (None, "z")], "id string, u string")
    found = graph.nodes(df, "K", "id", url="u")
    assert rows(found) == [("K", "a", '{"url":"x"}'), ("K", "a", '{"url":"y"}')]
    assert graph.new_rows(found, found).count() == 0


def test_list_edges(spark):
    df = spark.createDataFrame([("a", list("uvwxyzu")), ("b", None), ("a", ["u"])], "id string, l array<string>")
    found = rows(graph.list_edges(df, "E", "id", "R", "L", "l"))
    assert [e[4] for e in found] == list("uvwxy")
    assert graph.list_edges(df, "E", "id", "R", "L", "l", None).count() == 6


def test_constraints(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,), (1,)], "pk int")
    assert rows(quality.orphans(child, "k", parent, "pk")) == [(2, 2)]
    assert rows(quality.duplicate_keys(parent, "pk")) == [(1, 2)]
    assert quality.missing_keys(child, "k").count() == 1
    texts = spark.createDataFrame([("abc", None), ("a", "abcd")], "a string, b string")
    assert rows(quality.too_long(texts, {"a": 2, "b": 4})) == [("a", 2, 1), ("b", 4, 0)]
    assert rows(quality.too_long_rows(texts, {"a": 2, "b": 4})) == [("abc", None)]


def test_profile(spark):
    df = spark.createDataFrame([("a", None, ["x"]), ("b", 1, ["x"])], "s string, n int, l array<string>")
    assert rows(quality.profile(df), "column_name") == [
        ("l", "array<string>", 0, True, 2), ("n", "int", 1, True, 2), ("s", "string", 0, False, 2),
    ]


def test_score_order_puts_missing_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 0.1), ("c", 0.9), ("d", 0.9)], "id string, s double")
    assert [r["id"] for r in df.orderBy(*score_order(F.col("s"), F.col("id"))).collect()] == ["c", "d", "b", "a"]


def test_large_groups_take_their_positions_from_ranges(spark):
    values = [("hot", i % 10, i) for i in range(900)] + [(None, 1, i) for i in range(300)] + [(f"k{i % 9}", 2, i) for i in range(90)]
    df = spark.createDataFrame(values, "k string, n int, id bigint").repartition(4)
    order = [F.col("n"), F.col("id")]
    small, large = [
        rows(groups.sorted_lists(df, ["k"], order, ["id"], 50, key_rows), "k", "part") for key_rows in (100_000, 200)
    ]
    assert small == large and len(small) == 18 + 6 + 9
    assert [i for k, _, some in large if k == "hot" for i in some] == [i for _, i in sorted((i % 10, i) for i in range(900))]


def test_lists_send_their_rows_once(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    text = groups.sorted_lists(df, ["k"], [F.col("id")], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1


def test_rows_without_a_hot_key_are_sent_once_by_a_spread_join(spark):
    many, few = spark.range(1000).select((F.col("id") % 5).alias("k"), "id"), spark.range(5).select(F.col("id").alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = groups.spread_join(many, few, "k")._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("SortMergeJoin") == 1 and text.count("BroadcastHashJoin") == 2


def test_keep_first_by_place(spark):
    values = [("t", "a", 1), ("t", "a", 0), ("t", "b", 0), (None, "a", 2), (None, "b", 1), ("u", "c", 5)]
    df = spark.createDataFrame(values, "t string, file string, nth bigint")
    assert rows(groups.keep_first_placed(df, groups.text_key("t"), ["file", "nth"])) == [(None, "a", 2), ("t", "a", 0), ("u", "c", 5)]
