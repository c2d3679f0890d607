"""Queries of what is read from split files, and of tables that are stored and grow."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog_engine import schemas
from catalog_engine.operators import filters, graph, groups, quality, relations
from catalog_engine.plans.derived_catalogue import job_output, raw_vision, seen
from catalog_engine.plans.table_queries import LIST_ROWS, _order_tables, _part_siblings, query, table
from catalog_engine.session import cut, new_folder
from catalog_engine.sources import split, store, write

# Every so manyth entry is asked for its whole list of siblings.
ASKED = 100
DROPPED_POSITIONS = [0, 5, 7]
FIRST_DAYS = "1996-01-01"
LONGEST_PRIORITY = 8


# --- whole lists of siblings ------------------------------------------------------------


@query
def sibling_lists(spark, folder):
    """All siblings of every hundredth part, whole and sorted, against all rows."""
    edges = cut(_part_siblings(spark, folder))
    members = cut(relations.without_equal_groups(relations.sibling_groups(edges.select("src", "dst"))))
    asked = table(spark, folder, "part").filter(F.col("p_partkey") % ASKED == 0).select(F.col("p_partkey").cast("string").alias("id"))
    found = relations.sibling_lists(members, asked, list_rows=LIST_ROWS)
    return found.select("id", "part", F.size("siblings").cast("bigint").alias("n"), F.array_join("siblings", " ").alias("siblings"))


@query
def catalogue_family(spark, folder):
    """The relations table with parents and children of all entries, and whole siblings of every hundredth."""
    tables = seen(spark, folder)
    asked = tables["main"].filter(F.substring("id", 2, 20).cast("bigint") % ASKED == 0).select("id")
    found = relations.relations_table(tables["edges"], LIST_ROWS, cut(tables["sibling_groups"]), asked)
    return found.select(
        "id", "part", "parent", F.array_join("children", " ").alias("children"), F.array_join("siblings", " ").alias("siblings")
    )


# --- split files --------------------------------------------------------------------------


@query
def array_with_rejects(spark, folder):
    """Documents in arrays with bad records among them: the good rows, and every bad record with its reason."""
    path = new_folder(spark, "arrays")
    number = F.col("doc_id")
    record = (
        F.when(number % 50 == 7, F.concat(F.lit('{"doc_id": "no '), number.cast("string"), F.lit('"}')))
        .when(number % 50 == 8, F.concat(F.lit('{"doc_id": '), number.cast("string"), F.lit(",, }")))
        .otherwise(F.to_json(F.struct("doc_id", "text", "lang")))
    )
    write.write_bodies(table(spark, folder, "documents"), record, "[", "]", path)
    good, bad = split.read_array(spark, path, "doc_id bigint, text string, lang string")
    rows = good.select("doc_id", F.md5(F.encode("text", "utf-8")).alias("digest"), "lang", F.lit(None).cast("string").alias("reason"))
    none = F.lit(None)
    return rows.unionByName(
        bad.select(none.cast("bigint").alias("doc_id"), F.md5(F.encode("value", "utf-8")).alias("digest"), none.cast("string").alias("lang"), "reason")
    )


@query
def object_split(spark, folder):
    """Image recognition written as objects keyed by link, and read back without being told where a record ends."""
    path = new_folder(spark, "objects")
    write.write_object(raw_vision(table(spark, folder, "labels")), path)
    back, _ = split.read_object(spark, path, schemas.VISION_RECORD)
    return back.select(
        "id", F.col("safeSearchAnnotation.adult").alias("adult"), "error",
        F.array_join("labelAnnotations.description", " ").alias("labels"),
        F.array_join("webDetection.fullMatchingImages.url", " ").alias("links"),
    )


@query
def first_in_source(spark, folder):
    """The first copy of every text by its place in several files, without some positions."""
    path = new_folder(spark, "lines")
    documents = table(spark, folder, "documents").select("doc_id", "text", (2 - F.col("doc_id") % 3).alias("place"))
    # Sorted ranges: the files of a place follow each other in the order of their numbers, and no task takes a whole place.
    documents.repartitionByRange("place", "doc_id").sortWithinPartitions("place", "doc_id").write.partitionBy("place").json(path)
    rows, _ = split.read_lines(spark, path, "doc_id bigint, text string")
    placed = filters.exclude_positions(split.with_ordinal(rows), DROPPED_POSITIONS)
    kept = groups.keep_first(placed.withColumn("_text", groups.text_key("text")).drop("text"), ["_text"], [F.col("ordinal")])
    return kept.select("doc_id", F.col("ordinal").cast("bigint").alias("ordinal"))


# --- stored tables ----------------------------------------------------------------------------


@query
def append_batches(spark, folder):
    """The first order of every customer in two batches, one of them run twice, beside what a killed run left."""
    path = new_folder(spark, "batches")
    orders = table(spark, folder, "orders").select(
        F.nullif("o_custkey", F.lit(1)).alias("person"), F.col("o_orderkey").alias("id"), "o_orderstatus"
    )
    rows = orders.select("person", "id")
    store.append_batch(orders.filter("o_orderstatus = 'F'").select("person", "id"), path, ["person"], "one", ["id"])
    rows.write.parquet(f"{path}/_staged-killed")
    store.append_batch(rows, path, ["person"], "two", ["id"])
    store.append_batch(rows, path, ["person"], "two", ["id"])
    return store.read_batches(spark, path, rows.schema)


def _nodes(orders: DataFrame, lines: DataFrame) -> DataFrame:
    return graph.union_all(
        [
            graph.nodes(orders, graph.ENTRY, "id", views="views"),
            graph.nodes(orders, graph.AUTHOR, "author"),
            graph.nodes(orders, graph.UPDATE, "updated"),
            graph.nodes(orders, graph.TEMPLATE, "template"),
            graph.nodes(lines, graph.SIBLING, "l_partkey"),
        ]
    )


def _edges(orders: DataFrame, lines: DataFrame) -> DataFrame:
    spokes = [(graph.CREATED_BY, graph.AUTHOR, "author"), (graph.BASED_ON, graph.TEMPLATE, "template")]
    return graph.union_all(
        [graph.fan_edges(orders, graph.ENTRY, "id", spokes), graph.edges(lines, graph.ENTRY, "id", graph.RELATED_TO, graph.SIBLING, "l_partkey")]
    )


@query
def stored_nodes(spark, folder):
    """Nodes stored for the first days, then merged with those of all days."""
    orders, lines = _order_tables(spark, folder)
    early = orders.filter(F.col("updated") < FIRST_DAYS)
    found = store.BucketStore(spark, new_folder(spark, "nodes"), graph.NODES, graph.NODE_KEYS)
    found.merge(_nodes(early, lines.join(early.select("id"), "id", "left_semi")), bucket_rows=10_000)
    found.merge(_nodes(orders, lines))
    return found.read()


@query
def stored_edges(spark, folder):
    """Edges stored for the first days, to which those of the other days are added."""
    orders, lines = _order_tables(spark, folder)
    found = store.BucketStore(spark, new_folder(spark, "edges"), graph.EDGES, graph.EDGE_KEYS)
    for some in (F.col("updated") < FIRST_DAYS, F.col("updated") >= FIRST_DAYS):
        part = orders.filter(some)
        found.merge(_edges(part, lines.join(part.select("id"), "id", "left_semi")), whole=False, bucket_rows=10_000)
    return found.read()


@query
def gated_orders(spark, folder):
    """Orders with planted faults, each row with what it breaks: keys, customers, lengths."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    again = orders.filter(F.col("o_orderkey") % 97 == 0).withColumn("o_orderpriority", F.lit("again"))
    rows = orders.unionByName(again).withColumn("o_orderkey", F.when(F.col("o_orderkey") % 101 != 5, F.col("o_orderkey")))
    solvent = table(spark, folder, "customer").filter("c_acctbal > 0")
    good, bad = quality.gate(
        rows, "o_orderkey", [("o_custkey", solvent, "c_custkey")], {"o_orderpriority": LONGEST_PRIORITY}, ["o_orderpriority"]
    )
    return good.withColumn("reasons", F.lit("")).unionByName(bad.withColumn("reasons", F.array_join("reasons", "; ")))


@query
def job_model(spark, folder):
    """The stored graph and the typed tables as the whole job wrote them, and every rejected entry with its reasons."""
    output = job_output(spark, folder, model=True)

    def typed(name: str, key: str) -> DataFrame:
        good = spark.read.parquet(f"{output}/tables/{name}").withColumn("reasons", F.lit(""))
        bad = spark.read.parquet(f"{output}/rejects/{name}").withColumn("reasons", F.array_join("reasons", "; "))
        return good.unionByName(bad).select(F.lit(name).alias("kind"), F.col(key).alias("key"), "reasons")

    nodes = store.BucketStore(spark, f"{output}/graph/nodes", graph.NODES, graph.NODE_KEYS).read()
    edges = store.BucketStore(spark, f"{output}/graph/edges", graph.EDGES, graph.EDGE_KEYS).read()
    return graph.union_all(
        [
            *[typed(name, key) for name, key in (("memes", "meme_id"), ("authors", "author_id"), ("updaters", "updater_id"))],
            nodes.select(F.lit("node").alias("kind"), F.concat_ws(" ", "kind", "key").alias("key"), F.col("properties").alias("reasons")),
            edges.select(
                F.lit("edge").alias("kind"), F.concat_ws(" ", "src_kind", "src").alias("key"),
                F.concat_ws(" ", "relation", "dst_kind", "dst").alias("reasons"),
            ),
        ]
    ).withColumnRenamed("reasons", "detail")
