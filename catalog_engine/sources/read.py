"""Readers. Every one takes a schema, so no pass over the data is spent on guessing one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import MapType, StringType, StructType

from catalog_engine import schemas
from catalog_engine.functions import dates
from catalog_engine.functions.text import printed_list, printed_numbers, short_id, to_int, year_number


def read_records(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """Array of JSON records, or one record per line.

    A file holding one array is read by one task; ``lines`` is the layout that splits.
    """
    return spark.read.schema(schema).option("multiLine", not lines).json(path)


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Position in source order, increasing but with gaps."""
    return df.withColumn(name, F.monotonically_increasing_id())


def read_keyed(
    spark: SparkSession, path: str, record: str, key: str = "id", separator: str | None = None
) -> DataFrame:
    """One JSON object ``{key: record, ...}`` -> a row per key.

    Without ``separator`` a file is read whole. With it, the text between two
    records, such as ``}, "http`` for records keyed by links, many tasks read
    one file. It must occur nowhere else; a wrong cut gives a malformed piece
    and stops the read, it never drops a record.
    """
    pieces = _members(spark, path, separator, "{", "}}")
    parsed = F.from_json("value", MapType(StringType(), StructType.fromDDL(record)), {"mode": "FAILFAST"})
    return pieces.select(F.explode(parsed).alias(key, "_record")).select(key, "_record.*")


def read_column_keyed(
    spark: SparkSession,
    path: str,
    column: str,
    key: str = "id",
    item: str = "array<string>",
    separator: str | None = None,
) -> DataFrame:
    """One JSON object ``{column: {key: list, ...}}`` -> a row per key. ``separator`` such as ``],"`` as above."""
    pieces = _members(spark, path, separator, f'{{"{column}":{{', "]}}")
    parsed = F.from_json("value", f"map<string, map<string, {item}>>", {"mode": "FAILFAST"})
    return pieces.select(F.explode(F.element_at(parsed, F.lit(column))).alias(key, column))


def _members(spark: SparkSession, path: str, separator: str | None, opening: str, closing: str) -> DataFrame:
    """The file's object whole, or pieces of its members, each closed to an object of its own."""
    if separator is None:
        return spark.read.text(path, wholetext=True)
    end, start = separator.split(",", 1)
    if not closing.startswith(end):
        raise ValueError(f"the separator must start with the end of a record, {closing[0]},")
    pieces = spark.read.option("lineSep", separator).text(path)
    piece = F.ltrim("value")
    opened = F.when(piece.startswith("{"), piece).otherwise(F.concat(F.lit(opening + start.lstrip()), piece))
    # The separator took the end of every piece but the last one of a file. The
    # parser stops where the object ends, so one end too many does no harm.
    return pieces.select(F.concat(opened, F.lit(closing)).alias("value"))


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ";") -> DataFrame:
    """Delimited file with a header line, as text columns."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def read_scrape_log(spark: SparkSession, path: str) -> DataFrame:
    """Header-less scrape log, typed, with the short id of the link."""
    log = (
        spark.read.schema(schemas.SCRAPE_LOG)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
    )
    return log.withColumns(
        {
            "added": dates.iso_date(F.col("added")),
            "updated": dates.iso_date(F.col("updated")),
            "id": short_id(F.col("url")),
        }
    )


def typed_list(column: Column, numbers: bool = False) -> Column:
    """List column of a delimited file: printed form, or the JSON form ``write_delimited`` gives."""
    if numbers:
        return F.coalesce(F.from_json(column, "array<double>"), printed_numbers(column))
    # A printed list is only JSON if its items are in double quotes or missing; else the parser gives NULL.
    return F.coalesce(F.from_json(column, "array<string>", {"allowSingleQuotes": "false"}), printed_list(column))


def read_main(spark: SparkSession, path: str, has_lists: bool, sep: str = ";") -> DataFrame:
    """Main table with its dates, year, flags and, where it has them, lists."""
    columns = schemas.MAIN_TEXT_COLUMNS + (schemas.MAIN_LIST_COLUMNS if has_lists else [])
    text = read_delimited(spark, path, columns, sep)
    typed = {
        "views": to_int(F.col("views")),
        "year": year_number(F.col("year")),
        "added": dates.iso_date(F.col("added")),
        "updated": dates.iso_date(F.col("updated")),
        **{f: F.col(f).try_cast("boolean") for f in schemas.FLAGS},
    }
    if has_lists:
        for name in schemas.MAIN_LIST_COLUMNS:
            typed[name] = typed_list(F.col(name), name in schemas.NUMBER_LISTS)
    return text.withColumns(typed)
