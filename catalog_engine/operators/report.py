"""The report query of the relational model."""

from __future__ import annotations

from pyspark.sql import DataFrame


def entries_per_year(entries: DataFrame, added: str = "added") -> DataFrame:
    return entries.sparkSession.sql(
        f"SELECT EXTRACT(YEAR FROM {added}) AS year, COUNT(*) AS n FROM {{entries}} "
        f"GROUP BY EXTRACT(YEAR FROM {added})",
        entries=entries,
    )
