"""Dates as column expressions. Nothing here depends on a session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DAY = 86_400


def epoch_date(seconds: Column) -> Column:
    """UTC day of an epoch second; NULL stays NULL."""
    return F.date_from_unix_date(F.floor(seconds / _DAY).cast("int"))


def epoch_seconds(moment: Column) -> Column:
    """Epoch second of a timestamp without time zone."""
    day = F.unix_date(F.to_date(moment)).cast("bigint") * _DAY
    return day + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)


def iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text as a date; blank or malformed text is NULL."""
    return F.try_to_date(F.nullif(text, F.lit("")), "yyyy-MM-dd")


def earliest(first: Column, second: Column) -> Column:
    """The earlier of two dates; a missing one does not count."""
    return F.least(first, second)


def latest(first: Column, second: Column) -> Column:
    """The later of two dates; a missing one does not count."""
    return F.greatest(first, second)


def inferred_added(added: Column, updated: Column) -> Column:
    return F.coalesce(added, updated)


def inferred_year(year: Column, added: Column) -> Column:
    return F.coalesce(year, F.year(added))
