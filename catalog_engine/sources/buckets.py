"""Tables stored in buckets of their key: joins, cascades and groups by that key need no exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from catalog_engine.session import new_folder

# A bucket is read by one task, so its size on disk, compressed, is what a task is given.
BUCKET_BYTES = 64 << 20
# Small tables are spread over the cores, but not into pieces smaller than this.
LEAST_BYTES = 1 << 20


def stored_bytes(stored: DataFrame) -> int:
    """Size on disk of a table that is read from files."""
    return int(stored._jdf.queryExecution().analyzed().stats().sizeInBytes())


def bucket_count(stored: DataFrame, bucket_bytes: int = BUCKET_BYTES, least_bytes: int = LEAST_BYTES) -> int:
    """How many buckets a stored table takes, by its measured size."""
    size = stored_bytes(stored)
    cores = stored.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-size // bucket_bytes), min(cores, -(-size // least_bytes)))


def cut_by(df: DataFrame, buckets: int, key: str = "id") -> DataFrame:
    """The rows, stored in the shared folder in buckets of the key and read back.

    Tables with the same key and number of buckets are joined bucket by bucket.
    A key should have few rows: all of one key lie in one bucket, which no later
    join can split. Null keys share a bucket. The table's name is only needed to
    tell Spark of the buckets, and is given up again; the files stay.
    """
    spark = df.sparkSession
    name = f"stored_{uuid.uuid4().hex}"
    # One file a bucket: rows are sent by the same hash that buckets are made of.
    placed = df.repartition(buckets, key)
    placed.write.bucketBy(buckets, key).option("compression", "zstd").option("path", new_folder(spark, "buckets")).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"drop table {name}")
    return stored
