"""Lists inside one row as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from catalog_engine import fixed_values as fixed
from catalog_engine.functions.text import no_strings, none_if_empty


def first_items(items: Column, most: int) -> Column:
    return F.slice(items, 1, most)


def sorted_set(items: Column) -> Column:
    return F.sort_array(F.array_distinct(items))


def union_lists(first: Column, second: Column) -> Column:
    """Distinct items of both lists, sorted; a missing list counts as empty."""
    return F.sort_array(F.array_union(F.coalesce(first, no_strings()), F.coalesce(second, no_strings())))


def merge_lists(first: Column, second: Column) -> Column:
    """Both lists in order with repetitions; when one is missing or empty, the other as it is."""
    first_empty = F.coalesce(F.size(first), F.lit(0)) < 1
    second_empty = F.coalesce(F.size(second), F.lit(0)) < 1
    return F.when(first_empty, second).when(second_empty, first).otherwise(F.concat(first, second))


def append_label(keywords: Column, label: Column) -> Column:
    """Add a label to a list; a list holding only an empty text is replaced by it."""
    blank = (F.size(keywords) == 1) & (F.get(keywords, F.lit(0)) == "")
    kept = F.when(keywords.isNull() | blank, no_strings()).otherwise(keywords)
    return F.when(label.isNull(), keywords).otherwise(F.array_append(kept, label))


def pluck(structs: Column, field: str) -> Column:
    """One optional field of every struct; NULL when no struct has it."""
    return none_if_empty(F.filter(F.transform(structs, lambda s: s[field]), F.isnotnull))


def field_list(structs: Column, field: str, type_name: str) -> Column:
    """One field of every struct, missing list -> empty list."""
    return F.coalesce(F.transform(structs, lambda s: s[field]), F.array().cast(f"array<{type_name}>"))


def first_struct_field(structs: Column, field: str) -> Column:
    return F.get(structs, F.lit(0))[field]


def score_order(score: Column, *ties: Column) -> list[Column]:
    """Ascending sort key for: highest score first, missing scores last, then the ties."""
    return [score.isNull(), -score, *ties]


def first_per_form(
    found: Column,
    form: str,
    score: str,
    link: str,
    dropped: Sequence[str] = fixed.DROPPED_ENTITIES,
) -> Column:
    """List of structs -> ``struct<keywords, scores, links>`` sorted by score, NULL when nothing is left.

    Of several structs with one form the first in the list counts. Sorting by
    form and position puts it first among its equals, so one look at the
    neighbour decides; no struct is compared with all others.
    """
    kept = F.filter(
        F.transform(
            found,
            lambda x, i: F.struct(
                x[form].alias("form"),
                i.alias("position"),
                x[score].try_cast("double").alias("score"),
                x[link].alias("link"),
            ),
        ),
        lambda x: ~x["form"].isin(*dropped) if dropped else x["form"].isNotNull(),
    )
    by_form = F.sort_array(kept)

    def opens_form(ordered: Column):
        return lambda x, i: (i == 0) | ~x["form"].eqNullSafe(F.get(ordered, i - 1)["form"])

    # A one-element list binds the sorted list, so it is not sorted again per element.
    firsts = F.flatten(F.transform(F.array(by_form), lambda ordered: F.filter(ordered, opens_form(ordered))))
    ranked = F.sort_array(
        F.transform(
            firsts,
            lambda x: F.struct(
                x["score"].isNull().alias("unscored"),
                (-x["score"]).alias("rank"),
                x["form"].alias("form"),
                x["score"].alias("score"),
                x["link"].alias("link"),
            ),
        )
    )
    lists = F.transform(
        F.array(ranked),
        lambda r: F.struct(
            F.transform(r, lambda x: x["form"]).alias("keywords"),
            F.transform(r, lambda x: x["score"]).alias("scores"),
            F.transform(r, lambda x: x["link"]).alias("links"),
        ),
    )
    return F.get(F.filter(lists, lambda both: F.size(both["keywords"]) > 0), F.lit(0))
