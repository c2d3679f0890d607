"""Link checks, link classes and link lists as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from catalog_engine import fixed_values as fixed
from catalog_engine.functions.text import any_of, contains_any, no_strings, none_if_empty


def is_link(
    value: Column,
    starts: Sequence[str] = fixed.LINK_STARTS,
    parts: Sequence[str] = fixed.LINK_PARTS,
    rejects: Sequence[str] = fixed.LINK_REJECTS,
    reject_start: str = fixed.LINK_REJECT_START,
    min_length: int = fixed.LINK_MIN_LENGTH,
) -> Column:
    """Looks like a link, and not like one of an excluded site."""
    accepted = any_of([value.startswith(s) for s in starts]) | contains_any(value, parts)
    rejected = contains_any(value, rejects) | value.startswith(reject_start)
    return accepted & ~rejected & (F.length(value) >= min_length)


def classify_links(
    entries: Column,
    sites: Sequence[tuple[str, str]] = fixed.LINK_SITES,
    other: str = fixed.LINK_OTHER,
    skipped_key: str = fixed.LINK_SKIPPED_KEY,
    **checks,
) -> Column:
    """List of ``struct<key, value>`` -> one struct with a field per site.

    A link belongs to the first site whose text it contains. The last link of a
    site wins; of the links that belong to no site, the first one does.
    """
    usable = F.filter(entries, lambda e: (e["key"] != skipped_key) & is_link(e["value"], **checks))

    def site_of(value: Column) -> Column:
        chosen = F.when(F.lit(False), "")
        for name, part in sites:
            chosen = chosen.when(value.contains(part), name)
        return chosen.otherwise(other)

    placed = F.transform(
        usable, lambda e: F.struct(site_of(e["value"]).alias("site"), e["value"].alias("value"))
    )

    def pick(found: Column, name: str, position: int) -> Column:
        mine = F.filter(found, lambda p: p["site"] == name)
        return F.try_element_at(mine, F.lit(position))["value"].alias(name)

    # A one-element list names the checked links, so they are not checked again per site.
    refs = F.transform(
        F.array(placed),
        lambda found: F.struct(*[pick(found, name, -1) for name, _ in sites], pick(found, other, 1)),
    )
    return F.get(refs, F.lit(0))


def collect_urls(images: Column, most: int, excluded_host: str | None = None) -> Column:
    """First ``most`` urls of a list of ``struct<url>``, optionally without one host; NULL when none."""
    urls = F.transform(images, lambda i: i["url"])
    if excluded_host:
        urls = F.filter(urls, lambda u: ~u.contains(excluded_host))
    return none_if_empty(F.slice(urls, 1, most))


def top_up(first: Column, second: Column, most: int) -> Column:
    """The first list, filled from the second up to ``most``; NULL when both are empty."""
    both = F.concat(F.coalesce(first, no_strings()), F.coalesce(second, no_strings()))
    return none_if_empty(F.slice(both, 1, most))
