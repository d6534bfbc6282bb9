"""Where work files go: the shared folder the cluster names in ``spark.checkpoint.dir``, else the warehouse."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder, or a work folder in the warehouse; all executors see both."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return (configured or f"{spark.conf.get(WAREHOUSE_DIR)}/_work").rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A folder nobody has written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid4().hex}"


_held: ContextVar[list[str] | None] = ContextVar("work tables to delete", default=None)


def kept(df: DataFrame, label: str) -> DataFrame:
    """Write a work table and read it again: it is evaluated once, and its lineage ends there.

    Within ``released`` the table goes when that ends; else it stays until the shared folder is cleared.
    """
    path = fresh_path(df.sparkSession, label)
    if (held := _held.get()) is not None:
        held.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete at the end the work tables made inside; what is made from them must be written or fetched by then."""
    held: list[str] = []
    before = _held.set(held)
    try:
        yield
    finally:
        _held.reset(before)
        for path in held:
            release(spark, path)


def release(spark: SparkSession, path: str) -> bool:
    """Delete a work folder on whatever file system it is on; whether there was one."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def work_folder(spark: SparkSession, label: str) -> Iterator[str]:
    """A folder for one run, deleted when the run is over; results must be written elsewhere."""
    path = fresh_path(spark, label)
    try:
        yield path
    finally:
        release(spark, path)
