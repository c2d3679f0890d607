"""Ids, numbers, section texts and keywords as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from catalog_engine import fixed_values as fixed

_NO_STRINGS = "array<string>"


def no_strings() -> Column:
    """Empty list of strings."""
    return F.array().cast(_NO_STRINGS)


def none_if_empty(items: Column) -> Column:
    """The list, or NULL when it is empty. It is named once, so it is computed once."""
    return F.get(F.filter(F.array(items), lambda i: F.size(i) > 0), F.lit(0))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    """Whether any of the literal parts occurs in the text.

    Each is looked for by itself: a pattern of many parts tries all of them at every character.
    """
    return any_of([text.contains(p) for p in parts])


# --- ids and numbers -------------------------------------------------------


def short_id(url: Column) -> Column:
    """Last segment of a link; the whole text when it has no slash."""
    return F.substring_index(url, "/", -1)


def to_int(text: Column) -> Column:
    """Integer, or NULL when the text is not one."""
    return text.try_cast("int")


def year_number(text: Column) -> Column:
    """Year text such as ``2011`` or ``2011.0`` as an integer."""
    return text.cast("string").try_cast("double").try_cast("int")


def slug_words(links: Column) -> Column:
    """List of links -> list of readable words from their last segment."""
    return F.transform(links, lambda t: F.replace(short_id(t), F.lit("-"), F.lit(" ")))


# --- keyword and tag lists -------------------------------------------------


def clean_keywords(
    keywords: Column,
    deleted_chars: str = fixed.KEYWORD_DELETED_CHARS,
    deleted_fragment: str = fixed.KEYWORD_DELETED_FRAGMENT,
    dropped_starts: Sequence[str] = fixed.KEYWORD_DROPPED_STARTS,
) -> Column:
    """Delete characters and a literal fragment, then drop keywords by their start."""
    # The fragment holds a brace, so it must not be read as a pattern.
    cleaned = F.transform(
        keywords,
        lambda t: F.replace(F.translate(t, deleted_chars, ""), F.lit(deleted_fragment), F.lit("")),
    )
    kept = F.filter(cleaned, lambda t: ~any_of([t.startswith(s) for s in dropped_starts]))
    return F.coalesce(kept, no_strings())


def drop_tags(tags: Column, dropped: Sequence[str] = fixed.DROPPED_TAGS) -> Column:
    """Remove exact matches; a missing list becomes an empty one."""
    return F.coalesce(F.filter(tags, lambda t: ~t.isin(*dropped)), no_strings())


def split_words(
    text: Column, deleted: str = fixed.PUNCTUATION_AND_DIGITS, other_space: str = fixed.OTHER_WHITE_SPACE
) -> Column:
    """Lower-case words of a text, in order and with repetitions, some possibly empty.

    Words are separated by blanks. Other white space is trimmed off both ends
    of a word, then characters are deleted from it. Both are done on the text
    as a whole; word by word only where other white space touches a blank.
    """
    trimmed = F.btrim(F.lower(text), F.lit(other_space))
    alike = F.translate(trimmed, other_space, "\n" * len(other_space))
    touches = alike.contains(" \n") | alike.contains("\n ")
    by_word = F.array_join(F.transform(F.split(trimmed, " "), lambda w: F.btrim(w, F.lit(other_space))), " ")
    return F.split(F.translate(F.when(touches, by_word).otherwise(trimmed), deleted, ""), " ")


def is_word(word: Column) -> Column:
    """Longer than one character."""
    return F.length(word) > 1


def keyword_set(phrases: Column, dropped: Sequence[str] = ()) -> Column:
    """List of phrases -> sorted distinct words without the dropped ones; NULL when none is left."""
    words = F.filter(split_words(F.array_join(phrases, " ")), is_word)
    removed = F.array(*[F.lit(w) for w in dropped]) if dropped else no_strings()
    return none_if_empty(F.sort_array(F.array_except(words, removed)))


def drop_words(words: Column, dropped: Sequence[str] = fixed.STOP_WORDS) -> Column:
    """Remove stop words from a word list, sorted and distinct; NULL when none is left."""
    removed = F.array(*[F.lit(w) for w in dropped]) if dropped else no_strings()
    return none_if_empty(F.sort_array(F.array_except(words, removed)))


# --- sections --------------------------------------------------------------


def _section_items(content: Column, names: Sequence[str], field: str) -> Column:
    """Items of one field over the named sections, in document order.

    A section's subsections only count when the section has no such field itself.
    """
    picked = F.filter(F.map_entries(content), lambda e: e["key"].isin(*names))

    def items(entry: Column) -> Column:
        section = entry["value"]
        below = F.transform(F.map_values(section["subsections"]), lambda s: s[field])
        return F.coalesce(section[field], F.flatten(F.filter(below, F.isnotnull)), no_strings())

    return F.flatten(F.transform(picked, items))


def section_text(
    content: Column, names: Sequence[str], placeholders: Sequence[str] = fixed.PLACEHOLDER_TEXTS
) -> Column:
    """Texts of the named sections, one per line; NULL when there is none."""

    def is_placeholder(text: Column) -> Column:
        # A one-element list names the lowered text, so it is lowered once.
        found = F.transform(F.array(F.lower(text)), lambda low: contains_any(low, placeholders))
        return F.get(found, F.lit(0))

    items = _section_items(content, names, "text")
    kept = F.filter(items, lambda t: ~is_placeholder(t)) if placeholders else items
    return F.concat(F.array_join(none_if_empty(kept), "\n"), F.lit("\n"))


def section_images(content: Column, names: Sequence[str]) -> Column:
    """Images of the named sections; NULL when there is none."""
    return none_if_empty(_section_items(content, names, "images"))


def strip_markers(text: Column) -> Column:
    """Delete reference markers such as ``[3]`` or ``[]``; an empty text is NULL."""

    def stripped(t: Column) -> Column:
        # A text without a bracket needs no pattern.
        return F.when(t.contains("["), F.regexp_replace(t, r"\[[0-9]*\]", "")).when(t != "", t)

    # A one-element list names the text, so it is made once.
    return F.get(F.transform(F.array(text), stripped), F.lit(0))


# --- choosing between texts ------------------------------------------------


def longer_text(first: Column, second: Column) -> Column:
    """The longer text; the second on a tie, the only one when one is missing."""
    return F.when(second.isNull(), first).when(F.length(first) > F.length(second), first).otherwise(second)


def override_text(old: Column, new: Column) -> Column:
    """The new text unless it is missing or empty."""
    return F.coalesce(F.nullif(new, F.lit("")), old)


# --- printed lists ---------------------------------------------------------


def printed_list(text: Column) -> Column:
    """``['a', 'b']`` as a list of strings; ``[]`` is an empty list."""
    inner = F.btrim(text, F.lit("[]'"))
    return F.when(inner == "", no_strings()).otherwise(F.split(inner, "', '"))


def printed_numbers(text: Column) -> Column:
    """``[0.9, 0.8]`` as a list of numbers."""
    inner = F.btrim(text, F.lit("[]'"))
    numbers = F.transform(F.split(inner, ", "), lambda n: n.try_cast("double"))
    return F.when(inner == "", F.array().cast("array<double>")).otherwise(numbers)
