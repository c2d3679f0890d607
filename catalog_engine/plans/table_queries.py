"""The operators on the given tables, one query each.

Every query reads its tables whole. Where an operator needs a column the tables
lack (a missing value, a list, a page block), Spark derives it from their
columns, so the work grows with the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from catalog_engine import fixed_values as fixed
from catalog_engine.functions import dates, links, lists, pages, text
from catalog_engine.operators import (
    filters,
    graph,
    groups,
    inverted,
    joins,
    people,
    quality,
    relations,
    report,
)
from catalog_engine.session import cut, new_folder
from catalog_engine.sources import read, write

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters shared with the comparison SQL.
DENIED_WORDS = ["ring", "olt", "red"]
DENIED_TYPE = "ECONOMY"
BLOCKED_LOWEST = 16
EXCLUDED_PAGES = [
    "http://ththre.example.com/fr/825?page=2&ref=x",
    "https://ththin.example.com/en/671?utm_source=feed",
]
SECTION_PLACEHOLDERS = ["tion of", "le la"]
LIST_ROWS = 200
PAGE_SITES = [("ref_net", ".example.net/"), ("ref_org", ".example.org/")]


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def day(moment: str | Column) -> Column:
    return F.to_date(moment).cast("string")


# --- selection ---------------------------------------------------------------


@query
def yearly_counts(spark, folder):
    """Entries per year (report query)."""
    orders = table(spark, folder, "orders")
    return report.entries_per_year(orders, "o_orderdate").select(F.col("year").cast("int").alias("year"), "n")


@query
def dedupe_keep_first(spark, folder):
    """First row of every (language, text)."""
    documents = table(spark, folder, "documents").withColumn("_text", groups.text_key("text"))
    kept = groups.keep_first(documents.drop("text"), ["lang", "_text"], [F.col("doc_id")])
    return kept.select("doc_id", "lang", "source", "n_chars")


@query
def denylist_filter(spark, folder):
    """One category, without listed words; missing names stay."""
    parts = filters.keep_category(table(spark, folder, "part"), "p_type", DENIED_TYPE)
    parts = parts.withColumn("p_name", F.nullif("p_name", F.lit("small ring")))
    return filters.deny_titles(parts, "p_name", DENIED_WORDS).select("p_partkey", "p_name", "p_brand")


@query
def short_ids(spark, folder):
    """Last segment of every link."""
    return table(spark, folder, "pages").select("page_id", text.short_id(F.col("url")).alias("short_id"))


@query
def bottom_k_excluded(spark, folder):
    """Without the lowest short ids and without listed links."""
    found = table(spark, folder, "pages").select("page_id", "url")
    kept = filters.exclude_lowest_ids(found, "url", BLOCKED_LOWEST)
    return filters.exclude_values(kept, "url", EXCLUDED_PAGES).select("page_id", "url")


@query
def safety_cascade(spark, folder):
    """Rows per table after deleting unlabelled, faulty and blocked documents everywhere."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "source")
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"),
        F.nullif("quality", F.lit(1)).alias("error"),
        F.when(F.col("toxic") == 1, "VERY_LIKELY").otherwise("POSSIBLE").alias("adult"),
    )
    benchmark = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"))
    fine = filters.drop_errors(labels.filter(~filters.is_blocked([F.col("adult")])))
    # Used once per table, so it is stored.
    dropped = cut(joins.subtract_ids(joins.union_ids(documents, labels, benchmark), fine))
    kept = joins.cascade({"documents": documents, "labels": labels, "benchmark": benchmark}, dropped)
    counts = [
        t.agg(F.lit(n).alias("table_name"), F.count("*").alias("n"), F.sum("id").alias("id_sum"))
        for n, t in kept.items()
    ]
    return graph.union_all(counts)


@query
def semi_anti_split(spark, folder):
    """Documents with and without a label, by join, semi-join, anti-join and difference."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "quality")
    parts = {
        "inner": documents.join(labels, "id"),
        "semi": joins.restrict(documents, labels),
        "anti": joins.without(documents, labels),
        "difference": joins.subtract_ids(documents, labels),
    }
    return graph.union_all(
        [
            p.agg(F.lit(n).alias("kind"), F.count("*").alias("n"), F.sum("id").alias("id_sum"))
            for n, p in parts.items()
        ]
    )


@query
def language_filter(spark, folder):
    """English documents and those without a language."""
    documents = table(spark, folder, "documents").withColumn("lang", F.nullif("lang", F.lit("de")))
    return (
        filters.keep_language(documents, "lang")
        .groupBy("lang", "source")
        .agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    )


@query
def json_expand(spark, folder):
    """Nested fields as columns, text as numbers, epoch seconds as days."""
    events = table(spark, folder, "events")
    props = F.from_json("props", "map<string,string>")
    rows = events.select(
        "event_type",
        props["k"].alias("k"),
        props["absent"].alias("absent"),
        dates.epoch_date(dates.epoch_seconds(F.col("ts"))).alias("day"),
    )
    return (
        rows.select(
            "event_type",
            F.col("day").cast("string").alias("day"),
            text.to_int(F.col("k")).alias("k"),
            text.year_number(F.concat("k", F.lit(".0"))).alias("year"),
            text.to_int(F.concat("k", F.lit("x"))).alias("no_number"),
            "absent",
        )
        .groupBy("event_type", "day")
        .agg(
            F.count("*").alias("n"),
            F.sum("k").alias("k_sum"),
            F.sum("year").alias("year_sum"),
            F.count("no_number").alias("no_numbers"),
            F.count("absent").alias("absents"),
        )
    )


# --- texts ---------------------------------------------------------------------


@query
def section_text(spark, folder):
    """Texts and images of named sections, straight or through subsections, without placeholders."""
    turns = table(spark, folder, "conversations")
    said = F.split("text", "\n")
    nothing = F.lit(None).cast("array<string>")
    below = F.create_map(
        F.lit("first"), F.struct(said.alias("text"), nothing.alias("images")),
        F.lit("second"), F.struct(F.array("role").alias("text"), F.array("role", "role").alias("images")),
    )
    straight = F.struct(
        said.alias("text"), nothing.alias("images"), F.lit(None).cast(_SUBSECTIONS).alias("subsections")
    )
    nested = F.struct(nothing.alias("text"), nothing.alias("images"), below.alias("subsections"))
    content = F.create_map("role", F.when(F.col("role") == "assistant", straight).otherwise(nested))
    names = ["assistant", "user"]
    rows = turns.select(
        "conv_id",
        "turn",
        text.section_text(content, names, SECTION_PLACEHOLDERS).alias("body"),
        F.array_join(text.section_images(content, names), ",").alias("images"),
    )
    return filters.drop_empty(rows, ["body", "images"])


_SUBSECTIONS = "map<string,struct<text:array<string>,images:array<string>>>"


@query
def strip_markers(spark, folder):
    """Reference markers put in and taken out again."""
    documents = table(spark, folder, "documents")
    marked = F.concat("text", F.lit("["), "doc_id", F.lit("][] [x]"), "text")
    return documents.select("doc_id", text.strip_markers(marked).alias("_t")).select(
        "doc_id", F.md5(F.encode("_t", "utf-8")).alias("digest"), F.length("_t").cast("bigint").alias("n_chars")
    )


@query
def longer_text(spark, folder):
    """The longer of two texts by id, and one text overriding another."""
    documents = table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.when(F.col("lang") != "es", F.col("text")).alias("text")
    )
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), F.col("text").alias("item"))
    # A left join, so a small other side is sent to the texts and the texts stay where they are.
    both = joins.add_columns(documents, items, "item")
    return both.select(
        "id",
        F.md5(F.encode(text.longer_text(F.col("text"), F.col("item")), "utf-8")).alias("longer"),
        F.length(text.override_text(F.col("text"), F.col("item"))).cast("bigint").alias("overridden_chars"),
    )


@query
def keyword_tokens(spark, folder):
    """Sorted distinct words of every whole text, without stop words."""
    documents = table(spark, folder, "documents")
    words = text.keyword_set(F.array("text", "source"), fixed.STOP_WORDS)
    return documents.select("doc_id", words.alias("_w")).select(
        "doc_id",
        F.coalesce(F.size("_w"), F.lit(0)).cast("bigint").alias("n_words"),
        F.md5(F.encode(F.array_join("_w", " "), "utf-8")).alias("digest"),
    )


@query
def keyword_lists(spark, folder):
    """Slugs, cleaned keywords, tags without stop tags, unions, merges and an added label."""
    found = table(spark, folder, "pages")
    path = F.split(F.substring_index("url", "://", -1), "/")
    keywords = text.clean_keywords(
        F.transform(path, lambda p: F.concat(F.lit('#"'), p)), dropped_starts=["m.", "u9", "blog"]
    )
    tags = text.drop_tags(path, ["en", "fr"])
    slugs = text.slug_words(F.array("url", F.replace("url", F.lit("."), F.lit("-"))))
    label = F.nullif(F.element_at(path, 2), F.lit("de"))
    blank = F.when(F.col("url").startswith("https"), F.array(F.lit(""))).otherwise(keywords)

    def joined(items: Column, name: str) -> Column:
        return F.array_join(items, "|").alias(name)

    return found.select(
        "page_id",
        joined(keywords, "keywords"),
        joined(tags, "tags"),
        joined(slugs, "slugs"),
        joined(lists.union_lists(tags, keywords), "united"),
        joined(lists.merge_lists(F.filter(tags, lambda t: t == "es"), keywords), "merged"),
        joined(lists.append_label(blank, label), "labelled"),
        joined(lists.sorted_set(path), "sorted_path"),
    )


@query
def token_counts(spark, folder):
    """Every word with its number of occurrences, and total and distinct counts."""
    documents = table(spark, folder, "documents")
    # One row per word: small next to the texts, and read twice below.
    counts = cut(inverted.tag_counts(inverted.word_rows(documents, F.col("text"), "tag")))
    every = counts.select(F.lit("word").alias("kind"), "tag", "n")
    none = F.lit(None).cast("string").alias("tag")
    totals = inverted.tag_totals(counts).select(
        F.inline(
            F.array(
                F.struct(F.lit("total").alias("kind"), none, F.col("total").alias("n")),
                F.struct(F.lit("distinct").alias("kind"), none, F.col("distinct_tags").alias("n")),
            )
        )
    )
    return every.unionByName(totals)


# --- lists, labels ----------------------------------------------------------------


def _word_counts(spark, folder) -> DataFrame:
    documents = table(spark, folder, "documents")
    return (
        inverted.word_rows(documents, F.col("text"), "label", "doc_id")
        .groupBy("label", "doc_id")
        .agg(F.count("*").cast("double").alias("score"))
        .withColumnRenamed("doc_id", "id")
    )


@query
def inverted_index(spark, folder):
    """Every word's documents and scores, best first, whole: long lists go on in further rows."""
    found = inverted.inverted_lists(_word_counts(spark, folder), list_rows=LIST_ROWS)
    return found.select(
        "label",
        "part",
        F.size("id").cast("bigint").alias("n"),
        F.array_join("id", " ").alias("ids"),
        F.array_join(F.transform("score", lambda s: s.cast("bigint").cast("string")), " ").alias("scores"),
    )


@query
def label_universe(spark, folder):
    """Every label once."""
    documents = table(spark, folder, "documents")
    return inverted.label_universe(inverted.word_rows(documents, F.col("text"), "label"))


@query
def entity_keywords(spark, folder):
    """First occurrence of every form in a text, without listed forms, by score."""
    documents = table(spark, folder, "documents")
    found = F.transform(
        F.split("text", " "),
        lambda w, i: F.struct(
            w.alias("form"),
            F.nullif(F.length(w).cast("string"), F.lit("7")).alias("score"),
            i.cast("string").alias("link"),
        ),
    )
    picked = lists.first_per_form(found, "form", "score", "link", ["the", "la", "der"])
    return documents.select("doc_id", picked.alias("_p")).select(
        "doc_id",
        F.md5(F.encode(F.array_join("_p.keywords", " "), "utf-8")).alias("keywords"),
        F.md5(F.encode(F.array_join(F.transform("_p.scores", lambda s: s.cast("int").cast("string")), " ", "-"), "utf-8")).alias("scores"),
        F.md5(F.encode(F.array_join("_p.links", " "), "utf-8")).alias("links"),
    )


@query
def first_per_key(spark, folder):
    """Per user and event type the first event, and its rank by value among the user's firsts."""
    events = table(spark, folder, "events").select("user_id", "event_type", "value", "event_id", "ts")
    firsts = events.groupBy("user_id", "event_type").agg(
        F.min_by(F.struct("value", "event_id"), F.struct("ts", "event_id")).alias("_f")
    )
    rows = firsts.select("user_id", "event_type", "_f.*")
    # One row per event type is left of a user by now, so a user's rows fit one task.
    by_value = Window.partitionBy("user_id").orderBy(*lists.score_order(F.col("value"), F.col("event_type")))
    return rows.withColumn("position", F.row_number().over(by_value).cast("bigint"))


@query
def struct_fields(spark, folder):
    """Parallel lists, first struct and plucked fields of a list of structs."""
    documents = table(spark, folder, "documents")
    found = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.nullif(line, F.lit("")).alias("label"), F.length(line).alias("size"), i.alias("place")
        ),
    )
    found = F.when(F.col("lang") != "es", found)
    return documents.select(
        "doc_id",
        F.md5(F.encode(F.array_join(lists.field_list(found, "label", "string"), "|", "-"), "utf-8")).alias("labels"),
        F.array_join(lists.first_items(lists.field_list(found, "size", "int"), 5), "|").alias("sizes"),
        F.md5(F.encode(lists.first_struct_field(found, "label"), "utf-8")).alias("first_label"),
        F.md5(F.encode(F.array_join(lists.pluck(found, "label"), "|"), "utf-8")).alias("plucked"),
    )


@query
def pylist_roundtrip(spark, folder):
    """Lists and number lists read back from their printed form."""
    items = table(spark, folder, "lineitem")
    names = F.concat(
        F.lit("['"), "l_returnflag", F.lit("', '"), "l_linestatus", F.lit("', '"), F.col("l_linenumber").cast("string"), F.lit("']")
    )
    numbers = F.concat(F.lit("["), F.col("l_quantity").cast("string"), F.lit(", "), F.col("l_linenumber").cast("string"), F.lit("]"))
    printed = items.select(
        F.when(F.col("l_linenumber") == 7, "[]").otherwise(names).alias("names"), numbers.alias("numbers")
    )
    parsed = printed.select(
        text.printed_list(F.col("names")).alias("names"), text.printed_numbers(F.col("numbers")).alias("numbers")
    )
    return (
        parsed.groupBy(F.array_join("names", "+").alias("names"), F.size("names").cast("bigint").alias("n_names"))
        .agg(
            F.count("*").alias("n"),
            F.sum(F.get("numbers", F.lit(0)).cast("bigint")).alias("first_sum"),
            F.sum(F.get("numbers", F.lit(1)).cast("bigint")).alias("second_sum"),
        )
    )


# --- pages -----------------------------------------------------------------------


def _anchors() -> Column:
    """List of ``struct<key, value>``: the text of every anchor, and a link made of its target."""
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)">[^<]*</a>'), F.lit(1))
    host = F.substring_index(F.substring_index("url", "://", -1), "/", 1)
    return F.transform(
        hrefs,
        lambda h, i: F.struct(
            h.substr(F.lit(2), F.length(h)).alias("key"),
            F.concat(
                F.when(i % 2 == 0, F.lit("https://")).otherwise(F.lit("see ")),
                F.when(i % 3 == 0, host).otherwise(F.lit("www.example.net")),
                h,
            ).alias("value"),
        ),
    )


@query
def page_links(spark, folder):
    """Links of a page: usable ones by site, the first six outside one host, and a topped-up list."""
    found = table(spark, folder, "pages")
    refs = links.classify_links(_anchors(), PAGE_SITES, "ref_other", "The")
    urls = F.transform(_anchors(), lambda a: F.struct(a["value"].alias("url")))
    elsewhere = links.collect_urls(urls, 6, "example.net")
    every = links.collect_urls(urls, 3)
    rows = found.select(
        "page_id",
        refs.alias("_refs"),
        F.array_join(elsewhere, " ").alias("elsewhere"),
        F.array_join(links.top_up(elsewhere, every, 4), " ").alias("topped_up"),
    )
    return rows.select("page_id", "_refs.*", "elsewhere", "topped_up").withColumn(
        "has_refs", filters.has_any("ref_net", "ref_org", "ref_other")
    )


@query
def page_refs_only(spark, folder):
    """Only pages with at least one usable link."""
    found = page_links(spark, folder).select("page_id", "ref_net", "ref_org", "ref_other")
    return filters.drop_empty(found, ["ref_net", "ref_org", "ref_other"])


@query
def page_meta(spark, folder):
    """Views, people and days read off pages; failed pages keep defaults."""
    found = table(spark, folder, "pages")
    size = F.length("html")
    day_text = F.date_add(F.lit("2020-01-01").cast("date"), F.col("page_id").cast("int")).cast("string")
    author_block = F.concat(
        F.lit('<div class="author-info"><p>Added <abbr title="'), day_text, F.lit('T10:00:00">long ago</abbr> by <a href="/users/'),
        text.short_id(F.col("url")), F.lit('">x</a></p><p class="u">Updated by <a href="/users/u'), "page_id",
        F.lit('">y</a> <abbr title="2021-05-06T01:02:03">z</abbr></p></div>'),
    )
    full = F.concat(
        F.lit('<div class="big views" title="'), F.format_number(size, 0), F.lit(' Views"></div>'), "html", author_block
    )
    status = F.when(F.col("url").endswith(".html"), 404).otherwise(200)
    html = F.when(F.col("url").contains("utm_source"), F.col("html")).otherwise(full)
    return found.select("page_id", status.alias("code"), pages.page_record(status, html).alias("_r")).select("page_id", "code", "_r.*")


# --- joins, people -----------------------------------------------------------------


@query
def flags(spark, folder):
    """Which tables know an id, and how many of its columns are missing."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang")
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), "quality", "toxic")
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"))
    every = joins.add_flag(joins.align(documents, labels), items, "has_item")
    return every.select(
        "id",
        "lang",
        filters.has_any("quality", "toxic").alias("has_label"),
        "has_item",
        filters.missing_count("lang", "quality", "toxic").cast("bigint").alias("n_missing"),
    )


@query
def fill_and_drop(spark, folder):
    """Documents with labels added: complete ones, and all with missing values filled."""
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    labels = table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").cast("string").alias("quality")
    )
    every = cut(joins.add_columns(documents, labels, "quality").withColumnRenamed("quality", "grade"))
    filled = filters.fill_missing(every, ["grade"])
    complete = filters.drop_incomplete(every)
    return (
        filled.groupBy("lang", "grade")
        .agg(F.count("*").alias("n"))
        .withColumn("kind", F.lit("filled"))
        .unionByName(
            complete.groupBy("lang", "grade").agg(F.count("*").alias("n")).withColumn("kind", F.lit("complete"))
        )
    )


@query
def date_reconcile(spark, folder):
    """Earliest and latest day of an order over two tables, and the year inferred from them."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        dates.iso_date(F.when(F.col("o_orderstatus") != "P", day("o_orderdate")).otherwise("")).alias("added"),
        F.nullif(F.year("o_orderdate"), F.lit(1997)).alias("year"),
    )
    # The lines are combined per order before the join, so a huge order is one row in it.
    lines = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.min(F.to_date("l_shipdate")).alias("added2"), F.max(F.to_date("l_shipdate")).alias("updated2"))
    )
    every = orders.withColumn("updated", F.col("added")).join(lines, "id", "left")
    rows = people.reconcile_dates(every, ("added", "added2"), ("updated", "updated2"), "year")
    return rows.select(
        "id", F.col("added").cast("string").alias("added"), F.col("updated").cast("string").alias("updated"), "year"
    )


@query
def null_out_names(spark, folder):
    """The lowest names and listed names are no names."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("author"), F.col("c_mktsegment").alias("updater")
    )
    customers = filters.blank_values(customers, "updater", ["BUILDING"])
    named = people.blank_lowest_names(
        customers, {"author": "author", "updater": "author"}, literals=["Customer#000000100", "MACHINERY"]
    )
    return named.select("id", "author", "updater")


@query
def person_rollup(spark, folder):
    """Per customer the orders by price, their number and total; long lists go on in further rows."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.nullif("o_custkey", F.lit(1)).alias("person"),
        F.nullif(F.round(F.col("o_totalprice")).cast("bigint"), F.lit(0)).alias("views"),
    )
    found = people.person_rollup(orders, "person", "views", list_rows=10)
    return found.select("person", "part", F.array_join("meme_ids", " ").alias("meme_ids"), "meme_counts", "tot_views")


# --- relations ------------------------------------------------------------------------


def _part_siblings(spark, folder) -> DataFrame:
    """Edges: the lowest part of an order lists the order's other parts."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    lead = lines.groupBy("l_orderkey").agg(F.min("l_partkey").alias("lead"))
    pairs = groups.spread_join(lines, lead, "l_orderkey")
    edges = (
        pairs.filter("lead <> l_partkey")
        .select(F.col("lead").cast("string").alias("src"), F.col("l_partkey").cast("string").alias("dst"))
        .distinct()
    )
    return edges.withColumn("kind", F.lit(relations.SIBLING))


@query
def sibling_closure(spark, folder):
    """Completed siblings, the first ones as the graph takes them, after unknown and dropped parts are gone."""
    edges = cut(_part_siblings(spark, folder))
    parts = table(spark, folder, "part").select(F.col("p_partkey").cast("string").alias("id"), "p_type")
    known = relations.known_edges(edges, parts)
    dropped = parts.filter(F.col("p_type") == "SMALL").select("id")
    kept = cut(joins.drop_links(known, dropped))
    members = relations.sibling_groups(relations.of_kind(kept, relations.SIBLING))
    members = cut(relations.without_equal_groups(members))
    first = relations.first_siblings(members, fixed.LIST_EDGES)
    return first.groupBy("id").agg(
        F.array_join(F.sort_array(F.collect_list("sibling")), " ").alias("siblings")
    )


@query
def sibling_groups(spark, folder):
    """The whole completion: every member of every distinct group."""
    edges = cut(_part_siblings(spark, folder))
    return relations.without_equal_groups(relations.sibling_groups(edges.select("src", "dst")))


@query
def sibling_sets(spark, folder):
    """Distinct part sets of orders, and how many brands their parts have."""
    lines = table(spark, folder, "lineitem")
    members = lines.select(F.col("l_orderkey").alias("group_id"), F.col("l_partkey").alias("member")).distinct()
    sets = cut(relations.without_equal_groups(members))
    brands = table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("parent"))
    sizes = relations.distinct_sets(sets).select("group_id", "n_members")
    return relations.set_parents(sets, brands).join(sizes, "group_id").select(
        "group_id", "n_members", "n_parents", "parent"
    )


@query
def list_order(spark, folder):
    """Place of every page in the order of the list of its link's segments."""
    found = table(spark, folder, "pages").select("page_id", F.split("url", "/").alias("path"), F.lit(0).alias("_all"))
    placed = groups.rank_in_groups(found, ["_all"], [F.col("path"), F.col("page_id")])
    return placed.select("page_id", "position", F.array_join("path", " ").alias("path"))


def _places(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Entries with parent and children links: regions, nations and suppliers."""
    none = F.lit(None).cast("string")
    none_list = F.lit(None).cast("array<string>")

    def link(kind: str, key: str) -> Column:
        return F.concat(F.lit(f"places/{kind}"), F.col(key).cast("string"))

    region = table(spark, folder, "region").select(
        link("r", "r_regionkey").alias("url"), none.alias("parent"), none_list.alias("children")
    )
    nation = table(spark, folder, "nation").select(
        link("n", "n_nationkey").alias("url"),
        # Region 4 is misnamed, so its nations have a parent that is no entry.
        F.when(F.col("n_regionkey") == 4, "places/lost").otherwise(link("r", "n_regionkey")).alias("parent"),
        none_list.alias("children"),
    )
    supplier = table(spark, folder, "supplier").select(
        link("s", "s_suppkey").alias("url"),
        F.when(F.col("s_acctbal") > 0, link("n", "s_nationkey")).alias("parent"),
        F.array(link("n", "s_nationkey"), link("s", "s_suppkey"), F.lit("places/nowhere")).alias("children"),
    )
    every = region.unionByName(nation).unionByName(supplier)
    entries = every.withColumn("id", text.short_id(F.col("url"))).withColumn("siblings", none_list)
    return entries, relations.known_edges(relations.relation_edges(entries), entries)


@query
def parent_child(spark, folder):
    """Parents resolved to entries, children completed from parents, as one relations table."""
    _, edges = _places(spark, folder)
    found = relations.relations_table(edges, list_rows=50)
    return found.select(
        "id", "part", "parent", F.array_join("children", " ").alias("children")
    )


@query
def family_edges(spark, folder):
    """Edges from entries to their parent and to every child."""
    _, edges = _places(spark, folder)
    _, found = graph.family_graph(relations.relations_table(edges, list_rows=50))
    return found


@query
def parent_check(spark, folder):
    """Children that name no parent, or another one."""
    _, edges = _places(spark, folder)
    edges = cut(edges)
    named = relations.of_kind(edges, relations.PARENT).select(F.col("src").alias("id"), F.col("dst").alias("parent"))
    return relations.parent_agreement(relations.complete_children(edges), named)


# --- graph ------------------------------------------------------------------------------


def _order_tables(spark, folder) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("author"),
        day("o_orderdate").alias("updated"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("template"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("views"),
    )
    lines = table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"), "l_linenumber", "l_partkey")
    return orders, lines


@query
def graph_nodes(spark, folder):
    """Distinct nodes per kind, with properties."""
    orders, lines = _order_tables(spark, folder)
    return graph.union_all(
        [
            graph.nodes(orders, graph.ENTRY, "id", views="views"),
            graph.nodes(orders, graph.AUTHOR, "author"),
            graph.nodes(orders, graph.UPDATE, "updated"),
            graph.nodes(orders, graph.TEMPLATE, "template"),
            graph.nodes(lines, graph.SIBLING, "l_partkey"),
        ]
    )


@query
def graph_edges(spark, folder):
    """Distinct edges per relation, with the first five parts of every order."""
    orders, lines = _order_tables(spark, folder)
    firsts = groups.first_n(lines.distinct(), ["id"], [F.col("l_partkey"), F.col("l_linenumber")], fixed.LIST_EDGES)
    found = graph.union_all(
        [
            graph.fan_edges(
                orders,
                graph.ENTRY,
                "id",
                [
                    (graph.CREATED_BY, graph.AUTHOR, "author"),
                    (graph.BASED_ON, graph.TEMPLATE, "template"),
                    (graph.UPDATED_ON, graph.UPDATE, "updated"),
                ],
            ),
            graph.edges(orders, graph.AUTHOR, "author", graph.CREATED, graph.ENTRY, "id"),
            graph.edges(firsts, graph.ENTRY, "id", graph.RELATED_TO, graph.SIBLING, "l_partkey"),
        ]
    )
    return found.groupBy("relation", "dst_kind").agg(
        F.count("*").alias("n"), F.count_distinct("src").alias("n_src"), F.count_distinct("dst").alias("n_dst")
    )


@query
def list_edges(spark, folder):
    """Edges to the first items of a list column, and to all of them."""
    turns = table(spark, folder, "conversations").select(
        "conv_id",
        F.split("text", " ").alias("labels"),
        F.nullif(F.split("text", "\n"), F.array("text")).alias("similar_images"),
    )
    return graph.list_edges(turns, graph.ENTRY, "conv_id", graph.CONTAINS, graph.LABEL, "labels").unionByName(
        graph.list_edges(turns, graph.ENTRY, "conv_id", graph.SIMILAR_TO, graph.SIMILAR, "similar_images", None)
    )


@query
def new_nodes(spark, folder):
    """Nodes of the labelled documents that are not stored with the benchmark yet."""
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"))
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"))
    return graph.new_rows(graph.nodes(labels, graph.ENTRY, "id"), graph.nodes(items, graph.ENTRY, "id"))


# --- quality --------------------------------------------------------------------------------


@query
def constraint_report(spark, folder):
    """Violations of keys, references and length limits."""
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    documents = table(spark, folder, "documents")
    labels = table(spark, folder, "labels")
    lines = table(spark, folder, "lineitem")
    lengths = quality.too_long(documents, {"text": 1000, "source": 255}).select("column_name", "n")
    return quality.constraint_report(
        [
            ("orders_key", quality.duplicate_keys(orders, "o_orderkey")),
            ("lineitem_order_key", quality.duplicate_keys(lines, "l_orderkey")),
            ("labels_missing", quality.missing_keys(labels, "doc_id", "quality").select(F.lit(1).alias("n"))),
            ("orders_customer", quality.orphans(orders, "o_custkey", customers, "c_custkey")),
            ("documents_label", quality.orphans(documents, "doc_id", labels, "doc_id")),
            ("customer_orders", quality.orphans(customers, "c_custkey", orders, "o_custkey")),
            ("too_long", lengths.filter("n > 0")),
        ]
    )


@query
def too_long_rows(spark, folder):
    """The rows over a length limit."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "source", "n_chars")
    return quality.too_long_rows(documents, {"text": 1000, "source": 4}).select("doc_id", "source", "n_chars")


@query
def profile(spark, folder):
    """Type, missing values and single-value columns of a table."""
    documents = table(spark, folder, "documents").withColumn("lang", F.nullif("lang", F.lit("es")))
    return quality.profile(documents.withColumn("kind", F.lit("document")))


# --- sources and sinks ------------------------------------------------------------------------


@query
def delimited_roundtrip(spark, folder):
    """Documents written as delimited text with a list column, and read back with types."""
    path = new_folder(spark, "delimited")
    documents = table(spark, folder, "documents")
    write.write_delimited(
        documents.select("doc_id", F.split("text", "\n").alias("lines"), "lang", "n_chars", F.nullif("source", F.lit("src1")).alias("source")),
        path,
    )
    back = read.read_delimited(spark, path, ["doc_id", "lines", "lang", "n_chars", "source"])
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.md5(F.encode(F.array_join(read.typed_list(F.col("lines")), "\n"), "utf-8")).alias("digest"),
        "lang",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        "source",
    )


@query
def keyed_roundtrip(spark, folder):
    """Documents written as JSON lines with their key, and read back."""
    path = new_folder(spark, "keyed")
    documents = table(spark, folder, "documents").select(
        "doc_id", F.split("text", " ").alias("words"), F.nullif("lang", F.lit("de")).alias("lang")
    )
    write.write_keyed(documents, path, "doc_id")
    back = read.read_records(spark, path, "doc_id bigint, words array<string>, lang string", lines=True)
    return back.select(
        "doc_id", F.md5(F.encode(F.array_join("words", " "), "utf-8")).alias("digest"), "lang"
    )


@query
def append_and_create(spark, folder):
    """Records appended twice are stored once; a created table is left alone."""
    stored, created = new_folder(spark, "records"), new_folder(spark, "typed")
    orders = table(spark, folder, "orders")
    records = orders.select(F.col("o_orderkey").alias("id"), "o_custkey", "o_orderdate")
    write.append_new(records.filter(F.col("o_orderstatus") == "F"), stored, "id")
    write.append_new(records, stored, "id")
    typed = "author_id string, tot_views bigint"
    write.create_table(people.person_totals(orders.withColumn("one", F.lit(1)), "o_custkey", "one"), created, typed, author_id="o_custkey")
    write.create_table(orders.limit(0).select("o_custkey", F.lit(0).cast("bigint").alias("tot_views")), created, typed, author_id="o_custkey")
    rows = spark.read.parquet(stored).agg(
        F.lit("records").alias("name"), F.count("*").alias("n"), F.sum("o_custkey").cast("bigint").alias("total")
    )
    totals = spark.read.parquet(created).agg(
        F.lit("persons").alias("name"), F.count("author_id").alias("n"), F.sum("tot_views").cast("bigint").alias("total")
    )
    return rows.unionByName(totals)
