"""Facts read off a raw page: view counter, and who added and updated the entry and when."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The blocks of a page and the words that mark its paragraphs.
VIEWS_TAG = r"""(<div\b[^>]*\bclass=["'](?:[^"']* )?views(?: [^"']*)?["'][^>]*>)"""
AUTHOR_START = r"""<div\b[^>]*\bclass=["'](?:[^"']* )?author-info(?: [^"']*)?["'][^>]*>"""
BLOCK_START, BLOCK_END = r"<div\b", "</div>"
PARAGRAPH = r"(?s)<p\b[^>]*>(.*?)</p>"
TITLE = r"""\btitle=["']([^"']*)["']"""
FIRST_LINK = r"""(?s)<a\b[^>]*\bhref=["']([^"']*)["']"""
FIRST_DATE = r"""(?s)<abbr\b[^>]*\btitle=["']([^"']*)["']"""
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
ADDED, UPDATED = "Added", "Updated"


def _found(html: Column, pattern: str) -> Column:
    """First group of the first match; NULL without a match."""
    return F.get(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), F.lit(0))


def view_count(text: Column) -> Column:
    """``136,011 Views`` -> 136011."""
    return F.replace(F.substring_index(text, " ", 1), F.lit(","), F.lit("")).try_cast("int")


def page_views(html: Column) -> Column:
    return view_count(_found(_found(html, VIEWS_TAG), TITLE))


def author_block(html: Column) -> Column:
    """Inside of the author block, to the end of the block whatever blocks lie in it; NULL without one."""
    after = F.get(F.split(html, AUTHOR_START, 2), F.lit(1))
    nothing = F.struct(F.lit(1).alias("depth"), F.lit("").alias("text"))

    def piece(state: Column, part: Column) -> Column:
        # One block more for every start in the part, one less for the end that follows it.
        depth = state["depth"] + F.regexp_count(part, F.lit(BLOCK_START)) - 1
        inside = F.struct(depth.alias("depth"), F.concat(state["text"], part, F.lit(BLOCK_END)).alias("text"))
        return F.when(state["depth"] < 1, state).otherwise(inside)

    return F.when(after.isNotNull(), F.aggregate(F.split(after, BLOCK_END), nothing, piece)["text"])


def decoded(text: Column) -> Column:
    """Common character references as the characters they stand for."""
    for name, character in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(character))
    return text


def page_authors(html: Column) -> Column:
    """``struct<author, added, updater, updated>``; the last matching paragraph counts."""
    paragraphs = F.transform(
        F.regexp_extract_all(author_block(html), F.lit(PARAGRAPH), F.lit(1)),
        lambda p: F.struct(p.alias("html"), F.regexp_replace(p, r"(?s)<[^>]*>", "").alias("text")),
    )

    def person(found: Column) -> Column:
        link = _found(F.try_element_at(found, F.lit(-1))["html"], FIRST_LINK)
        return decoded(F.substring_index(link, "users/", -1))

    def day(found: Column) -> Column:
        return F.substring_index(_found(F.try_element_at(found, F.lit(-1))["html"], FIRST_DATE), "T", 1)

    def facts(every: Column) -> Column:
        added = F.filter(every, lambda p: p["text"].contains(ADDED))
        updated = F.filter(every, lambda p: p["text"].contains(UPDATED) & ~p["text"].contains(ADDED))
        return F.struct(
            person(added).alias("author"),
            day(added).alias("added"),
            person(updated).alias("updater"),
            day(updated).alias("updated"),
        )

    # A one-element list names the paragraphs, so the block is looked for once.
    return F.get(F.transform(F.array(paragraphs), facts), F.lit(0))


def page_record(status: Column, html: Column) -> Column:
    """Facts of a scrape record as one struct; a failed page keeps its status, zero views and blanks."""
    names = ("author", "updater", "added", "updated")
    blank = F.lit("")
    failed = F.struct(F.lit(0).alias("views"), *[blank.alias(n) for n in names])

    def found(people: Column) -> Column:
        return F.struct(page_views(html).alias("views"), *[people[n].alias(n) for n in names])

    read = F.get(F.transform(F.array(page_authors(html)), found), F.lit(0))
    return F.when(status == 200, read).otherwise(failed)
