"""Writers. A result is written by all tasks in parallel, into a folder."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from catalog_engine import schemas
from catalog_engine.operators.filters import drop_empty

# Records, and characters of them, of a file whose layout is one array or one object. A file is put together in one row.
FILE_RECORDS = 10_000
FILE_CHARS = 32_000_000


def write_delimited(df: DataFrame, path: str, sep: str = ";") -> None:
    """Delimited text with a header line; a list is written as JSON, which the text cannot hold itself."""
    lists = {n: F.to_json(n) for n, t in df.dtypes if t.startswith(("array", "map", "struct"))}
    flat = df.withColumns(lists) if lists else df
    (
        flat.write.option("sep", sep)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_keyed(df: DataFrame, path: str, key: str = "id") -> None:
    """One JSON record per line with the key as a field; a single object would need a single task."""
    df.select(key, *[c for c in df.columns if c != key]).write.option("ignoreNullFields", False).json(path)


def write_bodies(
    df: DataFrame, record: Column, opening: str, closing: str, path: str, records: int = FILE_RECORDS, chars: int = FILE_CHARS,
    compression: str = "none",
) -> None:
    """Files of one body each, in source order, with at most ``records`` records.

    After every ``records`` records, and every ``chars`` characters, a body is
    closed, so it has those of one record more at most, however long records are. Every task closes the bodies
    of its own rows as they come, so no record is sent to another one.
    """

    def bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, size, nth = [], 0, 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if n == records or size // chars > nth:
                    yield pa.RecordBatch.from_pydict({"value": [opening + ", ".join(held) + closing]})
                    n, size = (0, 0) if n == records else (n, size)
                    held, nth = [], size // chars
                n += 1
                if text is not None:
                    held.append(text)
                    size += len(text) + 2
        if n:
            yield pa.RecordBatch.from_pydict({"value": [opening + ", ".join(held) + closing]})

    whole = df.select(record.alias("record")).mapInArrow(bodies, "value string")
    whole.write.option("maxRecordsPerFile", 1).option("compression", compression).text(path)


def write_array(
    df: DataFrame, path: str, records: int = FILE_RECORDS, chars: int = FILE_CHARS, compression: str = "none"
) -> None:
    """Files that hold one JSON array of records each."""
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    write_bodies(df, record, "[", "]", path, records, chars, compression)


def write_object(df: DataFrame, path: str, key: str = "id", records: int = FILE_RECORDS, chars: int = FILE_CHARS) -> None:
    """Files that hold one JSON object ``{key: record, ...}`` each; rows without a key cannot be held."""
    fields = F.struct(*[F.col(f"`{c}`") for c in df.columns if c != key])
    write_bodies(df.filter(F.col(key).isNotNull()), _member(F.col(key), fields), "{", "}", path, records, chars)


def write_column_object(
    df: DataFrame, path: str, column: str, key: str = "id", records: int = FILE_RECORDS, chars: int = FILE_CHARS
) -> None:
    """Files that hold one JSON object ``{column: {key: list, ...}}`` each; rows without a key cannot be held."""
    held = df.filter(F.col(key).isNotNull())
    write_bodies(held, _member(F.col(key), F.col(column)), f'{{"{column}": {{', "}}", path, records, chars)


def _member(key: Column, value: Column) -> Column:
    """``"key":value`` of an object."""
    whole = F.to_json(F.create_map(key.cast("string"), value))
    return F.substring(whole, F.lit(2), F.length(whole) - 2)


def append_new(df: DataFrame, path: str, key: str) -> None:
    """Append the records whose key is not stored yet, so that a second run adds nothing."""
    try:
        stored = df.sparkSession.read.schema(df.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        fresh = df
    else:
        fresh = df.join(stored.select(key), key, "left_anti")
    fresh.write.mode("append").parquet(path)


def as_table(df: DataFrame, declared: str, **renamed: str) -> DataFrame:
    """The declared columns in their order and types; a list becomes its printed JSON."""
    kinds = dict(df.dtypes)
    columns = []
    for field in StructType.fromDDL(declared):
        source = renamed.get(field.name, field.name)
        value = F.to_json(source) if kinds[source].startswith("array") else F.col(source)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def create_table(df: DataFrame, path: str, declared: str, **renamed: str) -> None:
    """Typed table, left alone when it exists."""
    as_table(df, declared, **renamed).write.mode("ignore").parquet(path)


def split_main(main: DataFrame, key: str = "id") -> dict[str, DataFrame]:
    """The list-free main table, and one table per group of list columns."""
    lists = schemas.MAIN_LIST_COLUMNS

    def side(columns: Sequence[str], sparse: bool) -> DataFrame:
        part = main.select(key, *columns)
        return drop_empty(part, columns) if sparse else part

    return {
        "main": main.drop(*lists),
        "similar_img_urls": side(["similar_images", "similar_images2"], True),
        "image_recogn": side(["image_recogn_labels", "image_recogn_scores"], False),
        "alternative_urls": side(["alt_img_urls"], True),
        "search_keywords": side(["search_keywords"], False),
    }
