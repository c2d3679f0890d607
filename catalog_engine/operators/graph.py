"""Property graph: one node per kind and properties, one edge per pair and relation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from catalog_engine import fixed_values as fixed
from catalog_engine.functions.lists import first_items

# Node labels and relation names of the graph.
ENTRY = "Meme_name"
AUTHOR = "Meme_author"
UPDATE = "Recent_update"
TEMPLATE = "Meme_template"
PARENT = "Meme_parent"
SIBLING = "Meme_siblings"
CHILD = "Meme_children"
LABEL = "image_recogn_labels"
SIMILAR = "Similar_images"
CREATED_BY = "IS_CREATED_BY"
BASED_ON = "BASED_ON"
UPDATED_ON = "RECENTLY_UPDATED_ON"
CREATED = "CREATED"
CHILD_OF = "IS_CHILD_OF"
RELATED_TO = "IS_RELATED_TO"
PARENT_TO = "IS_PARENT_TO"
BELONGS_TO = "BELONGS_TO"
CONTAINS = "CONTAINS"
SIMILAR_TO = "IS_SIMILAR_TO_FOREIGN_LINK"
# Node and edge tables as they are stored, and what their buckets are drawn by.
NODES, NODE_KEYS = "kind string, key string, properties string", ["kind", "key"]
EDGES, EDGE_KEYS = "src_kind string, src string, relation string, dst_kind string, dst string", ["src_kind", "src", "relation", "dst_kind", "dst"]


def nodes(df: DataFrame, kind: str, key: str, **properties: Column | str) -> DataFrame:
    """Distinct nodes ``(kind, key, properties)``; a node without key is none."""
    named = {n: F.col(v) if isinstance(v, str) else v for n, v in properties.items()}
    props = [F.lit(n) if i == 0 else v.cast("string") for n, v in named.items() for i in (0, 1)]
    values = F.create_map(*props) if props else F.create_map().cast("map<string,string>")
    # A map cannot be compared, so equal nodes are found by their printed properties.
    return (
        df.filter(F.col(key).isNotNull())
        .select(
            F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"), F.to_json(values).alias("properties")
        )
        .distinct()
    )


def edges(df: DataFrame, src_kind: str, src: str, relation: str, dst_kind: str, dst: str) -> DataFrame:
    """Distinct edges between two columns of a table."""
    return (
        df.filter(F.col(src).isNotNull() & F.col(dst).isNotNull())
        .select(*_edge(src_kind, src, relation, dst_kind, dst))
        .distinct()
    )


def list_edges(
    df: DataFrame, src_kind: str, src: str, relation: str, dst_kind: str, items: str, most: int | None = fixed.LIST_EDGES
) -> DataFrame:
    """Distinct edges to the items of a list column, the first ``most`` of them."""
    listed = F.col(items) if most is None else first_items(F.col(items), most)
    exploded = df.filter(F.col(src).isNotNull()).select(F.col(src), F.explode(listed).alias("_item"))
    return edges(exploded, src_kind, src, relation, dst_kind, "_item")


def _edge(src_kind: str, src: str, relation: str, dst_kind: str, dst: str) -> list[Column]:
    return [
        F.lit(src_kind).alias("src_kind"),
        F.col(src).cast("string").alias("src"),
        F.lit(relation).alias("relation"),
        F.lit(dst_kind).alias("dst_kind"),
        F.col(dst).cast("string").alias("dst"),
    ]


def fan_edges(df: DataFrame, src_kind: str, src: str, targets: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Several edges per row in one scan: ``targets`` are (relation, target kind, target column)."""
    spokes = F.array(
        *[
            F.struct(
                F.lit(relation).alias("relation"), F.lit(kind).alias("dst_kind"), F.col(column).cast("string").alias("dst")
            )
            for relation, kind, column in targets
        ]
    )
    return (
        df.filter(F.col(src).isNotNull())
        .select(F.lit(src_kind).alias("src_kind"), F.col(src).cast("string").alias("src"), F.inline(spokes))
        .filter(F.col("dst").isNotNull())
        .distinct()
    )


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def new_rows(found: DataFrame, existing: DataFrame) -> DataFrame:
    """Nodes or edges that are not stored yet, so that a second run adds nothing."""
    return found.join(existing, found.columns, "left_anti")


def family_graph(relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The other form of the family edges: BELONGS_TO the parent, IS_PARENT_TO every child, with their nodes."""
    every_child = relations.select("id", F.explode("children").alias("child"))
    found_nodes = [nodes(relations, PARENT, "parent"), nodes(every_child, CHILD, "child")]
    found_edges = [
        edges(relations, ENTRY, "id", BELONGS_TO, PARENT, "parent"),
        edges(every_child, ENTRY, "id", PARENT_TO, CHILD, "child"),
    ]
    return union_all(found_nodes), union_all(found_edges)


def entry_graph(
    main: DataFrame,
    relations: DataFrame,
    siblings: DataFrame,
    similar: DataFrame | None = None,
    most: int = fixed.LIST_EDGES,
    contains: str = CONTAINS,
) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the catalogue.

    ``main`` gives authors, templates and update days of entries without any
    missing plain value, and the labels of all; ``relations`` the parents, and
    ``siblings`` the first siblings as (id, sibling). An entry of one of the two
    that has nothing in the other gets ``unknown`` there.
    """
    facts = ["id", "url", "views", "author", "updated", "template_image_url"]
    plain = [n for n, t in main.dtypes if not t.startswith("array")]
    complete = main.select(*plain).na.drop("any").select(*facts)
    unknown = F.lit(fixed.UNKNOWN)
    related = relations.select("id").union(siblings.select("id")).distinct()
    named = relations.filter("part = 0").select("id", "parent")
    family = related.join(named, "id", "left").select("id", F.coalesce("parent", unknown).alias("parent"))
    beside = related.join(siblings.select("id", "sibling"), "id", "left").select("id", F.coalesce("sibling", unknown).alias("sibling"))
    labelled = main.select(
        "id", F.coalesce("image_recogn_labels", F.array(F.lit(fixed.UNKNOWN))).alias("labels")
    )
    found_edges = [
        fan_edges(
            complete,
            ENTRY,
            "id",
            [
                (CREATED_BY, AUTHOR, "author"),
                (BASED_ON, TEMPLATE, "template_image_url"),
                (UPDATED_ON, UPDATE, "updated"),
            ],
        ),
        edges(complete, AUTHOR, "author", CREATED, ENTRY, "id"),
        edges(family, ENTRY, "id", CHILD_OF, PARENT, "parent"),
        edges(beside, ENTRY, "id", RELATED_TO, SIBLING, "sibling"),
        list_edges(labelled, ENTRY, "id", contains, LABEL, "labels", most),
    ]
    found_nodes = [
        nodes(complete, ENTRY, "id", url="url", views="views"),
        nodes(complete, AUTHOR, "author"),
        nodes(complete, UPDATE, "updated"),
        nodes(complete, TEMPLATE, "template_image_url"),
        nodes(family, PARENT, "parent"),
        nodes(beside, SIBLING, "sibling"),
        nodes(labelled.select(F.explode(first_items(F.col("labels"), most)).alias("label")), LABEL, "label"),
        # Entries seen only in these tables have an id and nothing else.
        nodes(related.union(labelled.select("id")).join(complete.select("id"), "id", "left_anti"), ENTRY, "id"),
    ]
    if similar is not None:
        found_edges.append(list_edges(similar, ENTRY, "id", SIMILAR_TO, SIMILAR, "similar_images", None))
        found_nodes.append(nodes(similar.select(F.explode("similar_images").alias("link")), SIMILAR, "link"))
    return union_all(found_nodes), union_all(found_edges)
