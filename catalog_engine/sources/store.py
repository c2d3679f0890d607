"""Stored tables that grow: batches that can be run again, and buckets of which only changed ones are rewritten."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from catalog_engine.operators.groups import keep_first
from catalog_engine.session import cut

# Rows of a bucket on average, when a store is made.
BUCKET_ROWS = 1_000_000


def _files(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    files, where = _files(spark, path)
    return files.exists(where)


# --- batches --------------------------------------------------------------------


def read_batches(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """All committed batches below ``path``; none is an empty table."""
    wanted = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    with_batch = StructType([*wanted.fields]).add("batch", "string")
    try:
        return spark.read.schema(with_batch).parquet(path).select(*wanted.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], wanted)


def append_batch(df: DataFrame, path: str, keys: Sequence[str], batch: str, order: Sequence[str] | None = None) -> bool:
    """Store the rows of ``df`` with new keys as batch ``batch``; False if that batch is stored already.

    Keys are compared with null as a value like others, and of rows with equal
    keys the first by ``order`` (all columns by default) is kept, so neither a
    second run nor repeated or missing keys store a row twice. The batch is
    written beside the store and moved into it in one step at the end: a run
    that is killed leaves a folder that no reader sees, and the batch can run
    again.
    """
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/batch={batch}"
    if exists(spark, target):
        return False
    first = keep_first(df, list(keys), [F.col(c) for c in (order or df.columns)])
    stored = read_batches(spark, path, df.schema).select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    fresh = first.join(stored, same, "left_anti")
    staged = f"{path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    fresh.write.parquet(staged)
    files, source = _files(spark, staged)
    if not files.rename(source, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise RuntimeError(f"batch {batch} was stored by another run")
    return True


# --- buckets --------------------------------------------------------------------


def bucket_of(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class BucketStore:
    """A table stored in a folder for each bucket of its keys.

    ``merge`` replaces the rows of changed keys. What changed is found bucket by
    bucket, and only buckets with a change are written again, so a small change
    costs its buckets and not the table. The number of buckets is set when the
    store is made and kept beside it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str, keys: Sequence[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def read(self) -> DataFrame:
        """The newest version of every bucket."""
        if not exists(self.spark, f"{self.path}/versions"):
            return self.spark.createDataFrame([], self.schema)
        return self._rows(self._versions()).select(*self.schema.fieldNames())

    def _versions(self) -> DataFrame:
        """(bucket, version) of the last commit: a row a bucket."""
        commits = self.spark.read.schema("bucket int, version string, turn int").parquet(f"{self.path}/versions")
        newest = commits.groupBy("bucket").agg(F.max(F.struct("turn", "version")).alias("last"))
        return newest.select("bucket", F.col("last.version").alias("version"))

    def _rows(self, versions: DataFrame) -> DataFrame:
        with_place = StructType([*self.schema.fields]).add("version", "string").add("bucket", "integer")
        stored = self.spark.read.schema(with_place).parquet(f"{self.path}/rows")
        return stored.join(F.broadcast(versions), ["bucket", "version"])  # one row a bucket

    def _turn(self) -> int:
        commits = self.spark.read.schema("turn int").parquet(f"{self.path}/versions")
        return commits.agg(F.max("turn")).first()[0] + 1

    def merge(self, rows: DataFrame, whole: bool = True, bucket_rows: int = BUCKET_ROWS) -> int:
        """Bring the store to ``rows``; the number of buckets that were written.

        ``whole``: ``rows`` are the whole table, and stored rows that it lacks
        go. Otherwise they are added, or replace those of their keys. Equal rows
        are stored once. All versions appear at once, with the file that names
        them.
        """
        names = self.schema.fieldNames()
        rows = rows.select(*names).distinct()
        made = exists(self.spark, f"{self.path}/versions")
        if made:
            buckets, turn = self.spark.read.parquet(f"{self.path}/settings").first()["buckets"], self._turn()
        else:
            rows = cut(rows)
            buckets, turn = max(1, -(-rows.count() // bucket_rows)), 0
        fresh = cut(rows.withColumn("bucket", bucket_of(self.keys, buckets)))
        stored = self._rows(self._versions()).select(*names, "bucket") if made else fresh.limit(0)
        if whole:
            wanted = fresh
        else:
            keys = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
            changed = fresh.select(F.col("bucket").alias("_bucket"), *[F.col(k).alias(f"_{k}") for k in self.keys])
            same = F.col("bucket") == F.col("_bucket")
            for key in keys:
                same = same & key
            wanted = stored.join(changed, same, "left_anti").unionByName(fresh)
        changes = self._changed(stored, wanted)
        if made and not changes:
            return 0
        version = uuid.uuid4().hex
        some = self.spark.createDataFrame([(b,) for b in changes], "bucket int")
        touched = wanted.join(F.broadcast(some), "bucket") if made else wanted  # a row a bucket
        touched = touched.withColumn("version", F.lit(version)).repartition(F.col("bucket"))
        touched.write.mode("append").partitionBy("version", "bucket").parquet(f"{self.path}/rows")
        if not made:
            self.spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/settings")
            changes = list(range(buckets))
        commit = self.spark.createDataFrame([(b, version, turn) for b in changes], "bucket int, version string, turn int").coalesce(1)
        commit.write.mode("append").parquet(f"{self.path}/versions")
        return len(changes)

    def _changed(self, stored: DataFrame, wanted: DataFrame) -> list[int]:
        """Buckets whose rows differ: number, sum and exclusive-or of row hashes combine before the shuffle."""
        row = [F.col(n) for n in self.schema.fieldNames()]

        def signs(df: DataFrame, suffix: str) -> DataFrame:
            return df.groupBy("bucket").agg(
                F.count("*").alias(f"n{suffix}"),
                F.sum(F.xxhash64(*row).cast("decimal(38,0)")).alias(f"s{suffix}"),
                F.bit_xor(F.xxhash64(F.lit("x"), *row)).alias(f"x{suffix}"),
            )

        both = signs(stored, "1").join(signs(wanted, "2"), "bucket", "full")
        same = F.col("n1").eqNullSafe(F.col("n2")) & F.col("s1").eqNullSafe(F.col("s2")) & F.col("x1").eqNullSafe(F.col("x2"))
        return [r["bucket"] for r in both.filter(~same).select("bucket").collect()]  # a row a bucket at most
