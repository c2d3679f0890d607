"""Parents, children and siblings.

Relations are kept as edges ``(src, dst, kind)``. A sibling completion joins
every member of a sibling list with every other member. Written out as pairs
that grows with the square of a list, so it is kept as ``(group_id, member)``
rows instead: the siblings of an entry are the members of the groups it is in,
without itself. That is the same set in linear size, for every entry.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from catalog_engine.functions.text import short_id
from catalog_engine.operators.groups import LIST_ROWS, first_n, sorted_lists, spread_join
from catalog_engine.session import cut

PARENT, CHILD, SIBLING = "parent", "child", "sibling"


def relation_edges(
    entries: DataFrame, key: str = "id", parent: str = "parent", siblings: str = "siblings", children: str = "children"
) -> DataFrame:
    """Link columns -> distinct edges between short ids, before any check."""

    def linked(links: Column, kind: str) -> Column:
        return F.transform(links, lambda u: F.struct(short_id(u).alias("dst"), F.lit(kind).alias("kind")))

    one = F.when(F.col(parent).isNotNull(), F.array(F.col(parent)))
    none = F.array().cast("array<struct<dst:string,kind:string>>")
    every = F.concat(
        *[
            F.coalesce(linked(links, kind), none)
            for links, kind in ((one, PARENT), (F.col(siblings), SIBLING), (F.col(children), CHILD))
        ]
    )
    return entries.select(F.col(key).alias("src"), F.inline(every)).distinct()


def known_edges(edges: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Edges whose target is an entry; siblings and children must not be the entry itself."""
    proper = edges.filter((F.col("kind") == PARENT) | (F.col("src") != F.col("dst")))
    targets = ids.select(F.col(key).alias("dst")).distinct()
    return spread_join(proper, targets, "dst", "left_semi").select("src", "dst", "kind")


def of_kind(edges: DataFrame, kind: str) -> DataFrame:
    return edges.filter(F.col("kind") == kind).select("src", "dst")


# --- siblings --------------------------------------------------------------


def sibling_groups(siblings: DataFrame) -> DataFrame:
    """Edges (src, dst) -> group rows: every listing entry with all it lists."""
    listed = siblings.select(F.col("src").alias("group_id"), F.col("dst").alias("member"))
    own = siblings.select(F.col("src").alias("group_id"), F.col("src").alias("member"))
    return listed.union(own).distinct()


def set_signatures(groups: DataFrame) -> DataFrame:
    """Per group its size and an order-free 128-bit signature of its members.

    Sum and exclusive-or of hashes combine before the shuffle: no member list is built.
    """
    member = F.col("member")
    return groups.groupBy("group_id").agg(
        F.count("*").alias("n_members"),
        F.sum(F.xxhash64(member).cast("decimal(38,0)")).alias("_sum"),
        F.bit_xor(F.xxhash64(F.lit("x"), member)).alias("_xor"),
    )


def same_sets(groups: DataFrame, signatures: Callable[[DataFrame], DataFrame] = set_signatures) -> DataFrame:
    """Per group (group_id, n_members, first): the lowest group that has exactly the same members.

    Signatures only propose: every member of a group is then looked up in the
    lowest group of its signature, by a join on (group, member) that spreads a
    large group. Groups that differ in spite of their signature go through again
    among themselves.
    """
    signed = signatures(groups)
    signs = [c for c in signed.columns if c != "group_id"]
    signed, left = cut(signed), None
    found = []
    while True:
        firsts = signed.groupBy(*signs).agg(F.min("group_id").alias("first"))
        proposed = signed.join(firsts, signs).select("group_id", "n_members", "first")
        found.append(proposed.filter("group_id = first"))
        others = cut(proposed.filter("group_id <> first"))
        members = groups.join(others, "group_id").select("group_id", "n_members", "member", "first")
        of_first = groups.select(F.col("group_id").alias("first"), "member")
        equal = (
            members.join(of_first, ["first", "member"], "left_semi")
            .groupBy("group_id", "n_members", "first")
            .agg(F.count("*").alias("n_same"))
            .filter("n_same = n_members")
            .select("group_id", "n_members", "first")
        )
        equal = cut(equal)
        found.append(equal)
        left = others.count() - equal.count()
        if not left:
            break
        signed = cut(signed.join(others.select("group_id"), "group_id", "left_semi").join(equal.select("group_id"), "group_id", "left_anti"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def distinct_sets(groups: DataFrame, signatures: Callable[[DataFrame], DataFrame] = set_signatures) -> DataFrame:
    """Distinct member sets: the lowest group id that has the set, its size, and how many groups have it."""
    same = same_sets(groups, signatures)
    return same.groupBy(F.col("first").alias("group_id")).agg(F.max("n_members").alias("n_members"), F.count("*").alias("n_groups"))


def without_equal_groups(groups: DataFrame) -> DataFrame:
    """One group per distinct member set. Consistent siblings all have the same one."""
    return spread_join(groups, distinct_sets(groups).select("group_id"), "group_id", "left_semi").select(
        "group_id", "member"
    )


def first_siblings(groups: DataFrame, most: int) -> DataFrame:
    """The ``most`` lowest siblings of every entry: (id, sibling, position).

    One group contributes no more than its ``most`` + 1 lowest members (one may
    be the entry itself), so no list is ever built.
    """
    lowest = first_n(groups, ["group_id"], [F.col("member")], most + 1).select(
        "group_id", F.col("member").alias("sibling")
    )
    pairs = spread_join(groups.withColumnRenamed("member", "id"), lowest, "group_id")
    found = pairs.filter(F.col("sibling") != F.col("id")).select("id", "sibling").distinct()
    return first_n(found, ["id"], [F.col("sibling")], most)


def siblings_of(groups: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """All siblings of the given entries as (id, sibling)."""
    wanted = ids.select(F.col(key).alias("id")).distinct()
    asked = spread_join(groups.withColumnRenamed("member", "id"), wanted, "id")
    return (
        spread_join(groups.withColumnRenamed("member", "sibling"), asked, "group_id")
        .filter(F.col("sibling") != F.col("id"))
        .select("id", "sibling")
        .distinct()
    )


def sibling_lists(groups: DataFrame, ids: DataFrame | None = None, key: str = "id", list_rows: int = LIST_ROWS) -> DataFrame:
    """Whole sorted sibling lists (id, part, siblings) of the given entries, or of all.

    A group's members are spread over tasks where it is large, an entry that is
    in several groups has each sibling once, and a list with more than
    ``list_rows`` siblings goes on in further parts. Lists of all entries grow
    with the square of a group; ``groups`` holds the same in linear size.
    """
    wanted = groups.select(F.col("member").alias("id")) if ids is None else ids.select(F.col(key).alias("id"))
    lists = sorted_lists(siblings_of(groups, wanted), ["id"], [F.col("sibling")], ["sibling"], list_rows)
    return lists.withColumnRenamed("sibling", "siblings")


def drop_members(groups: DataFrame, dropped: DataFrame) -> DataFrame:
    """Group rows without dropped entries. A group outlives the entry it was listed by: the others stay siblings."""
    gone = dropped.select(F.col("id").alias("member"))
    return spread_join(groups, gone, "member", "left_anti").select("group_id", "member")


def related_ids(edges: DataFrame, groups: DataFrame) -> DataFrame:
    """Ids with a parent, a child or a sibling."""
    parent, child = F.col("kind") == PARENT, F.col("kind") == CHILD
    ends = F.when(parent, F.array("src", "dst")).when(child, F.array("src"))
    several = groups.groupBy("group_id").agg(F.count("*").alias("n")).filter("n > 1")
    beside = spread_join(groups, several.select("group_id"), "group_id", "left_semi")
    return edges.select(F.explode(ends).alias("id")).union(beside.select(F.col("member").alias("id"))).distinct()


def set_parents(groups: DataFrame, parents: DataFrame) -> DataFrame:
    """Per group how many different parents its members have, and the lowest one.

    ``parents`` has one (id, parent) row per entry. Several parents break the rule that siblings share one.
    """
    family = parents.select(F.col("id").alias("member"), "parent")
    return (
        spread_join(groups, family, "member", "left")
        .groupBy("group_id")
        .agg(F.count_distinct("parent").alias("n_parents"), F.min("parent").alias("parent"))
    )


# --- parents and children --------------------------------------------------


def complete_children(edges: DataFrame) -> DataFrame:
    """Child edges (parent, child), with those that only the child's parent link tells."""
    told = of_kind(edges, PARENT).select(F.col("dst").alias("parent"), F.col("src").alias("child"))
    listed = of_kind(edges, CHILD).select(F.col("src").alias("parent"), F.col("dst").alias("child"))
    return listed.union(told).distinct()


def parent_agreement(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Child edges whose child names no parent, or another one: one row of counts."""
    named = parents.select(F.col("id").alias("child"), F.col("parent").alias("_named"))
    return (
        spread_join(children, named, "child", "left")
        .agg(
            F.count_if(F.col("_named").isNull()).alias("no_parent"),
            F.count_if(F.col("_named") != F.col("parent")).alias("other_parent"),
        )
    )


def relations_table(
    edges: DataFrame, list_rows: int = LIST_ROWS, groups: DataFrame | None = None, sibling_ids: DataFrame | None = None
) -> DataFrame:
    """Per entry its parent and sorted children; entries without any are left out.

    ``part`` numbers the rows of an entry with more children than one list
    holds; the parent is on its part 0. With ``groups`` the siblings of the
    entries ``sibling_ids`` (by default all) stand beside them, sorted, whole and
    continued by part in the same way.
    """
    parents = of_kind(edges, PARENT).groupBy("src").agg(F.min("dst").alias("parent"))
    children = sorted_lists(
        complete_children(edges), ["parent"], [F.col("child")], ["child"], list_rows
    ).select(F.col("parent").alias("id"), "part", F.col("child").alias("children"))
    first_rows = parents.select(F.col("src").alias("id"), F.lit(0).cast("bigint").alias("part"), "parent")
    found = first_rows.join(children, ["id", "part"], "full").select("id", "part", "parent", "children")
    if groups is None:
        return found
    beside = sibling_lists(groups, sibling_ids, list_rows=list_rows)
    return found.join(beside, ["id", "part"], "full").select("id", "part", "parent", "children", "siblings")
