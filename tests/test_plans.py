"""Physical plans: what reaches the scan, what is limited before a shuffle, and what must not appear at all."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from catalog_engine.operators import groups, people

FOLDER = "/root/testdata/sf0.001"
ROW_LOCAL = [
    "denylist_filter", "short_ids", "section_text", "strip_markers", "keyword_tokens", "keyword_lists", "entity_keywords",
    "struct_fields", "page_links", "page_meta", "page_refs_only", "too_long_rows",
]


def plan(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", ROW_LOCAL)
def test_row_work_has_no_shuffle(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    assert "Exchange" not in text and "Python" not in text


@pytest.mark.parametrize("name", ["graph_edges", "flags", "constraint_report", "null_out_names", "parent_check", "sibling_sets"])
def test_no_cross_join_and_no_python(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(contract.queries()["denylist_filter"](spark, FOLDER))
    assert "EqualTo(p_type,ECONOMY)" in text and "p_retailprice" not in text
    text = plan(contract.queries()["yearly_counts"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text


def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(contract.queries()["dedupe_keep_first"](spark, FOLDER))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_texts_are_not_shuffled_to_find_copies(spark):
    text = plan(contract.queries()["dedupe_keep_first"](spark, FOLDER))
    exchange = text[text.index("Exchange") :].splitlines()[0]
    assert "_text" in exchange and "text#" not in exchange.replace("_text#", "")


def test_a_large_id_set_is_not_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(contract.queries()["semi_anti_split"](spark, FOLDER))
        assert "BroadcastExchange" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_totals_combine_before_the_shuffle(spark):
    df = spark.range(100).select(F.lit("p").alias("person"), F.col("id").alias("views"))
    assert "partial_sum" in plan(people.person_totals(df, "person", "views"))
