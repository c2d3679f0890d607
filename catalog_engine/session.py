"""Session settings, and the shared folder for results that must not be recomputed."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "catalog_engine", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators are designed for.

    No shuffle partition count is fixed here: on a cluster it comes from the
    submit configuration, and adaptive execution coalesces and splits from there.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A folder of this machine is only taken in local mode, where driver and
    executors are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="catalog-checkpoint-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path under the shared folder, or under that of the current run."""
    return f"{(_run_folder.get() or shared_folder(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def stored_for_a_run(spark: SparkSession) -> Iterator[None]:
    """What is stored inside is removed at the end, so results must be written by then."""
    folder = new_folder(spark, "run")
    before = _run_folder.set(folder)
    try:
        yield
    finally:
        _run_folder.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """The rows, stored in the shared folder and read back.

    Later stages start from the stored table, even after an executor is lost,
    and read only the columns they use. Unlike a checkpointed RDD it is
    columnar and tells its size, so joins with it are planned by that.
    """
    path = new_folder(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
