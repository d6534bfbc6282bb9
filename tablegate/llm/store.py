"""Work tables and files in the folder all executors share."""

from __future__ import annotations

import os
from uuid import uuid4

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tablegate.sources.workspace import fresh_path


def kept(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it again, which cuts its lineage and survives lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"
SPARK_S_OWN = "67108864b"  # fixed value: the setting's default


def bounded_batches(df: DataFrame) -> DataFrame:
    """df itself; from now on its session hands Python workers some MB at a time, unless it was told how many.

    By default a batch of long texts has 64 MB, several times over in the JVM and in the worker.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_SETTING, SPARK_S_OWN) == SPARK_S_OWN:
        conf.set(BATCH_SETTING, BATCH_BYTES)
    return df


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder in the shared one for files that tasks write themselves."""
    path = fresh_path(spark, label)
    jvm = spark._jvm.org.apache.hadoop.fs
    target = jvm.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(target)
    return system.makeQualified(target).toString()


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path and the path in it."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), uri[5:].replace("//", "", 1) if uri.startswith("file://") else uri[5:]
    return fs.FileSystem.from_uri(uri)


def attempt_name(folder: str, number: int, ending: str) -> str:
    """A file name no other attempt at the same task uses; only files named in a finished index count."""
    return os.path.join(folder, f"{number:06d}-{uuid4().hex}{ending}")
