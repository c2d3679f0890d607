"""Files that are one JSON array or one JSON object, read by many tasks.

Spark cuts such a file at closing braces, so a piece may begin anywhere: inside a
text, or deep inside a record. Where it begins follows from what stands before
it, and only two small facts of that are needed: whether an odd number of quotes
came before, and how many braces are open. Both are running sums. They are taken
in every block of a file by itself, and a block starts where the blocks before
it ended, which is one row a block. Pieces then are put together to records, and
a record whose parts lie in two blocks is found like any other.

A file that one task reads whole, because it is compressed or no larger than a
block, needs none of this: the task knows where every piece begins, and puts the
records together while it reads. Nothing of such a file is stored or sent for it.

A record has a place: its file and its number in it, from 0 without gaps. A file
whose braces do not close, or with anything but separators outside its records,
leaves a fragment, which is reported and never dropped.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from catalog_engine.operators.groups import rank_in_groups
from catalog_engine.session import cut

CUT_OFF = "cut off or outside of any record"
MALFORMED = "not a record of the schema"
BLOCK = ["file", "block"]
# An escaped character; the line ends are those that a dot of Spark's patterns leaves out.
ESCAPED = re.compile("\\\\[^\n\r\u0085\u2028\u2029]")
# Where none of these stands, no quote or opening brace is escaped.
ESCAPES_THAT_COUNT = ("\\\\", '\\"', "\\{")
SPACES = " \t\n\x0b\f\r"


def file_blocks(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """Lines of the files with their place: file, start of the block read, and a number that increases in it.

    ``is_whole`` tells that the block is all of its file. A file has no place in Spark's order of tasks, but a block has one in its
    file, and a task reads a block from its start to its end.
    """
    reader = spark.read.option("lineSep", line_sep) if line_sep else spark.read
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("_metadata.file_size").alias("size"),
        (F.col("_metadata.file_block_length") >= F.col("_metadata.file_size")).alias("is_whole"),
        "value",
    )


def carried(pieces: DataFrame, amount: str, name: str) -> DataFrame:
    """Per block the sum of ``amount`` over the blocks of its file before it: one row a block, whatever their size."""
    sums = pieces.groupBy(*BLOCK).agg(F.sum(amount).alias(name))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn(name, F.coalesce(F.sum(name).over(earlier), F.lit(0)))


def before(pieces: DataFrame, amount: str, name: str) -> DataFrame:
    """``pieces`` with the sum of ``amount`` over all pieces of the file before each one."""
    inside = Window.partitionBy(*BLOCK).orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return placed.join(carried(pieces, amount, "_carried"), BLOCK).withColumn(name, F.col("_inside") + F.col("_carried")).drop("_inside", "_carried")


def numbered_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """(file, line, value) of all lines; ``line`` counts from 0 without gaps in every file, over all its blocks.

    Every line counts, empty ones too.
    """
    lines = cut(file_blocks(spark, path, line_sep).drop("is_whole").withColumn("one", F.lit(1)))
    return before(lines, "one", "line").select("file", "line", "value")


def without_escapes(text: Column) -> Column:
    """A piece without escaped characters, so that every quote left opens or closes a text."""
    return F.regexp_replace(text, r"\\.", "")


def count_of(text: Column, sign: str) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))).cast("bigint")


def measured(pieces: DataFrame) -> DataFrame:
    """Pieces with their quotes, the braces each opens if it begins outside of a text and inside of one, and their bytes."""
    bare = without_escapes(F.col("value"))
    # Texts are taken out to count braces; a piece that begins inside one gets its opening quote.
    opens = {
        name: count_of(F.regexp_replace(F.concat(F.lit(quote), bare), r'"[^"]*("|$)', ""), "{")
        for name, quote in (("opens_outside", ""), ("opens_inside", '"'))
    }
    return pieces.withColumns({"quotes": count_of(bare, '"'), **opens, "bytes": F.octet_length("value").cast("bigint") + 1})


def assembled(spark: SparkSession, path: str, depth: int) -> DataFrame:
    """Records and what is in none, as (file, record, value, ends); ``ends`` is 1 for a record."""
    pieces = file_blocks(spark, path, "}")
    whole, parts = (pieces.filter(chosen).drop("is_whole") for chosen in (F.col("is_whole"), ~F.col("is_whole")))
    return assembled_files(whole, depth).unionByName(assembled_blocks(parts, depth))


def assembled_files(pieces: DataFrame, depth: int) -> DataFrame:
    """``assembled`` of files that one task reads whole, as they are read: no text is stored, sent or sorted.

    The task knows whether a piece begins inside a text, so a piece is looked through once and without patterns.
    """

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held, before = [], [], None
        quotes = opened = nth = size = 0

        def take(row: tuple, last: bool) -> None:
            """The piece is added to its record, which is done if the brace after the piece leaves it."""
            nonlocal quotes, opened, nth
            file, value, _, _ = row
            bare = ESCAPED.sub("", value) if any(e in value for e in ESCAPES_THAT_COUNT) else value
            if "{" in bare:
                # Every second part between quotes is outside of texts.
                parts = bare.split('"')
                opened += "".join(parts[quotes % 2 :: 2]).count("{")
                quotes += len(parts) - 1
            else:
                quotes += bare.count('"')
            closes = not last and quotes % 2 == 0
            opened -= closes
            held.append(value if last else value + "}")
            if closes and opened == depth - 1:
                done.append((file, nth, "".join(held), 1))
                held.clear()
                nth += 1

        def end_file() -> None:
            """The last piece of a file is followed by its end and not by a brace, unless a brace is the file's last character."""
            nonlocal quotes, opened, nth, size
            take(before, size > before[-1])
            if held:
                done.append((before[0], nth, "".join(held), 0))
            held.clear()
            quotes = opened = nth = size = 0

        def given() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)
            done.clear()
            return batch

        names, types = ["file", "record", "value", "ends"], [pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if before is not None:
                    take(before, False) if before[0] == row[0] else end_file()
                before, size = row, size + row[-2]
            if done:
                yield given()
        if before is not None:
            end_file()
            if done:
                yield given()

    rows = pieces.select("file", "value", (F.octet_length("value").cast("bigint") + 1).alias("bytes"), "size")
    return rows.mapInArrow(records, "file string, record bigint, value string, ends bigint")


def assembled_blocks(pieces: DataFrame, depth: int) -> DataFrame:
    """``assembled`` of files read in blocks by several tasks.

    The text is stored once as it is read, and sent once, by block. Where a block
    starts is settled before, on columns without the text: how many braces a piece
    opens is counted for both cases, that it begins inside a text and that it does
    not, and the case is chosen when the quotes before it are known.
    """
    pieces = cut(measured(pieces))
    facts = pieces.drop("value")
    # The last piece of a file is followed by its end and not by a brace, unless a brace is the file's last character.
    ends = facts.groupBy("file").agg(
        F.max(F.struct("block", "nth")).alias("_end"), F.sum("bytes").alias("_bytes"), F.max("size").alias("_size")
    )
    ends = ends.select("file", F.when(F.col("_bytes") > F.col("_size"), F.col("_end")).alias("_end"))
    inside = Window.partitionBy(*BLOCK).orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)

    def so_far(amount: str, start: str) -> Column:
        return F.col(start) + F.coalesce(F.sum(amount).over(inside), F.lit(0))

    def with_change(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("quotes_before", so_far("quotes", "quotes_at"))
        within, after = F.col("quotes_before") % 2 == 1, (F.col("quotes_before") + F.col("quotes")) % 2 == 1
        is_last = F.coalesce(F.struct("block", "nth") == F.col("_end"), F.lit(False))
        rows = rows.withColumns({"is_last": is_last, "closes": F.when(after | is_last, 0).otherwise(1).cast("bigint")})
        return rows.withColumn("change", F.when(within, F.col("opens_inside")).otherwise(F.col("opens_outside")) - F.col("closes"))

    def with_ends(rows: DataFrame) -> DataFrame:
        # A record ends at the brace that leaves it. Whatever follows belongs to the next one.
        left = (F.col("closes") == 1) & (so_far("change", "open_at") + F.col("change") == depth - 1)
        return with_change(rows).withColumn("ends", left.cast("bigint"))

    def started(rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(starts), BLOCK)  # one row a block

    starts = cut(carried(facts, "quotes", "quotes_at").join(ends, "file"))
    starts = cut(starts.join(carried(with_change(started(facts)), "change", "open_at"), BLOCK))
    starts = cut(starts.join(carried(with_ends(started(facts)), "ends", "record_at"), BLOCK))
    rows = with_ends(started(pieces)).withColumn("record", so_far("ends", "record_at"))
    text = F.when(F.col("is_last"), F.col("value")).otherwise(F.concat("value", F.lit("}")))
    # The shuffle by block serves this step too.
    parts = rows.groupBy(*BLOCK, "record").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("nth", text.alias("text"))))["text"], "").alias("value"),
        F.max("ends").alias("ends"),
        F.max("record_at").alias("record_at"),
    )
    # Only records that may lie in several blocks are sent again.
    in_one = (F.col("ends") == 1) & ((F.col("record") > F.col("record_at")) | (F.col("block") == 0))
    torn = parts.filter(~in_one).groupBy("file", "record").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("block", "value")))["value"], "").alias("value"), F.max("ends").alias("ends")
    )
    return parts.filter(in_one).select("file", "record", "value", "ends").unionByName(torn)


def split_members(spark: SparkSession, path: str, depth: int = 1) -> DataFrame:
    """Records of the files at ``path``, and the fragments that are in none, which have a ``reason``: (file, nth, value, reason).

    ``depth`` is how many braces are open inside a record: 1 for an array of
    objects, 2 for an object of objects; there ``value`` begins with the key. A
    record is at most what one row holds; a file has any size.
    """
    whole = assembled(spark, path, depth)
    opening = r"^[\s,]*" + (r"(\[[\s,]*)?" if depth == 1 else r"(\{[\s,]*)?")
    closing = r"^\s*\]?\s*$" if depth == 1 else r"^\s*\}?\s*$"
    # An empty array or object has no record, and its brackets are no fragment.
    nothing = F.col("value").rlike(closing) | F.col("value").rlike(r"^\s*(\[\s*\]|\{\s*\})?\s*$")
    is_record = F.col("ends") == 1
    # Only the first record of a file needs a pattern.
    cleaned = F.when(F.col("record") == 0, F.regexp_replace("value", opening, "")).otherwise(F.ltrim("value", F.lit(SPACES + ",")))
    return whole.filter(is_record | ~nothing).select(
        "file", F.col("record").alias("nth"), F.when(is_record, cleaned).otherwise(F.col("value")).alias("value"),
        F.when(~is_record, CUT_OFF).alias("reason"),
    )


def checked_records(
    members: DataFrame, schema: str, value: Column | None = None, extra: Mapping[str, Column] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Typed rows (file, nth, extra, fields) and rejects (file, nth, reason, value) of records in JSON.

    A record is rejected whole if it is no JSON object, or a field has another type than the schema's.
    Members that have a ``reason`` already are rejected with it. Of good records the text is not stored beside the fields.
    """
    fields = StructType.fromDDL(schema).add("_corrupt_record", "string")
    parsed = members.withColumn(
        "_r", F.from_json(F.col("value") if value is None else value, fields, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    )
    bad = F.when(F.col("_r").isNull() | F.col("_r._corrupt_record").isNotNull(), MALFORMED)
    parsed = parsed.withColumn("reason", F.coalesce("reason", bad) if "reason" in members.columns else bad)
    parsed = parsed.select(
        "file", "nth", "reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("value"),
        *[column.alias(name) for name, column in (extra or {}).items()],
        F.when(F.col("reason").isNull(), F.col("_r")).alias("_r"),
    )
    parsed = cut(parsed)
    names = [f.name for f in StructType.fromDDL(schema)]
    good = parsed.filter(F.col("reason").isNull()).select("file", "nth", *(extra or {}), *[F.col(f"_r.`{n}`").alias(n) for n in names])
    return good, parsed.filter(F.col("reason").isNotNull()).select("file", "nth", "reason", "value")


def read_array(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Records of files that are one array each, read by many tasks, and the rejects with their place and reason.

    Every brace that closes a record counts as one, so rows and rejects together
    are all records of the files.
    """
    return checked_records(split_members(spark, path, 1), schema)


def read_object(spark: SparkSession, path: str, schema: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """The same for files that are one object ``{key: record, ...}`` each; the key is a column."""
    # The brackets of a whole object are put back, so that the key is read as JSON too.
    pair = F.from_json(F.concat(F.lit("{"), "value", F.lit("}")), "map<string,string>")
    members = split_members(spark, path, 2).withColumn("_pair", F.map_entries(pair))
    return checked_records(members, schema, F.col("_pair")[0]["value"], {key: F.col("_pair")[0]["key"]})


def read_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """The same for files with one record a line; empty lines count and hold no record."""
    lines = numbered_lines(spark, path).withColumnRenamed("line", "nth").filter(F.trim("value") != "")
    return checked_records(lines, schema)


def with_ordinal(rows: DataFrame, name: str = "ordinal") -> DataFrame:
    """Rows (file, nth) with their position in the source: files in order of their paths, records in order, without gaps.

    Files are counted first, and a file starts where those before it ended: one row a file.
    """
    sizes = rows.groupBy("file").agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    # Rejected records leave gaps in nth, so a file's rows are ranked by ranges and not taken as they are numbered.
    placed = rank_in_groups(rows, ["file"], [F.col("nth")])
    return placed.join(starts, "file").withColumn(name, F.col("_start") + F.col("position") - 1).drop("_start", "position")
