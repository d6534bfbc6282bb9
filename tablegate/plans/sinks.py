"""Table sinks: SNK-1, SNK-2, SNK-3, SNK-4.

Tables are Parquet files at a location of their own, so replacing one never moves or deletes data: the new
version is written beside the old, checked, and the catalog entry is switched to it. A job that dies half
way leaves the published version untouched. Old versions stay on disk until the caller removes them.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager
from dataclasses import dataclass
from math import ceil
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.reconcile import reconcile_fingerprints, table_fingerprint
from tablegate.sources.slices import SLICE, by_name, file_url, footers, list_files, numbered_schemas
from tablegate.sources.stores import existing, hadoop_path
from tablegate.sources.workspace import kept, release

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's name for the folder of NULL
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
INFLATION = 3  # shuffled rows per byte of compressed Parquet, roughly


@dataclass(frozen=True)
class Published:
    table: str
    location: str
    previous_location: str | None


def ensure_schema(spark: SparkSession, table: str) -> None:
    """Create the schema a table name lives in, so that a first run on an empty catalog works."""
    if "." in table:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {table.rsplit('.', 1)[0]}")


def table_root(spark: SparkSession, table: str) -> str:
    """The folder of the table's schema."""
    database = table.rsplit(".", 1)[0] if "." in table else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def table_location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.head()["data_type"]


def _layout(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema]


def _described(schema: T.StructType) -> dict[str, str]:
    return {f.name: f.metadata["comment"] for f in schema if f.metadata.get("comment")}


def _text(words: str) -> str:
    return "'" + words.replace("\\", "\\\\").replace("'", "\\'") + "'"


def overwrite_table(
    df: DataFrame,
    table: str,
    root: str | None = None,
    table_format: str = "parquet",
    partition_by: tuple[str, ...] = (),
    check: Callable[[DataFrame], None] | None = None,
) -> Published:
    """SNK-1: replace a table by a new version, which ``check`` may refuse before it is published.

    Because the new version has a location of its own, ``df`` may read the table it replaces (SNK-5). Publishing is one
    catalog call that sets the table's location, so that readers find the old version or the new one and never none. Columns
    that the new version adds at the end are declared first, which is true of the old one too (there they are NULL). Where
    columns go, move or change type, or the table is partitioned, the catalog has no such call: the new version is a table
    of its own that takes the name, which is unbound between two renames. ``replace_slices`` needs no rename.
    """
    spark = df.sparkSession
    ensure_schema(spark, table)
    version = uuid4().hex
    short = table.rsplit(".", 1)[-1]
    location = f"{root or table_root(spark, table)}/{short}/version-{version}"
    there = spark.catalog.tableExists(table)
    old = spark.table(table).schema if there else None
    own = _layout(df.schema)
    if there and not partition_by and not partition_columns(spark, table) and own[: len(old)] == _layout(old):
        df.write.format(table_format).save(location)
        if check is not None:
            check(spark.read.format(table_format).schema(df.schema).load(location))
        previous = table_location(spark, table)
        if len(own) > len(old):
            added = ", ".join(f"`{name}` {kind}" for name, kind in own[len(old) :])
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
        spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(location)}")
        told = _described(old)
        for name, words in _described(df.schema).items():
            if told.get(name) != words:
                spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{name}` COMMENT {_text(words)}")
        return Published(table, location, previous)

    staged, retired = f"{table}__staged_{version}", f"{table}__retired_{version}"
    try:
        writer = df.write.format(table_format).option("path", location)
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(staged)
        if check is not None:
            check(spark.table(staged))
        previous = None
        if there:
            previous = table_location(spark, table)
            spark.sql(f"ALTER TABLE {table} RENAME TO {retired}")
        try:
            spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
        except Exception:
            if previous is not None:
                spark.sql(f"ALTER TABLE {retired} RENAME TO {table}")
            raise
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {staged}")
        raise
    if previous is not None:
        spark.sql(f"DROP TABLE IF EXISTS {retired}")
    return Published(table, location, previous)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def slice_locations(spark: SparkSession, table: str) -> dict[str, str]:
    """Where each slice of a table partitioned by one column is."""
    column = partition_columns(spark, table)[0]
    found = {}
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        name = unquote(r["partition"].split("=", 1)[1])
        told = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (`{column}` = {_text(name)})")
        found[name] = told.filter("col_name = 'Location'").head()["data_type"]
    return found


def replace_slices(df: DataFrame, table: str, slice_column: str, root: str | None = None, table_format: str = "parquet") -> dict[str, Published]:
    """SNK-1 for single slices: those that ``df`` has rows of are replaced or added, all others are left alone.

    The table is partitioned by ``slice_column``, a string, and created if need be. The new rows are written beside the old
    ones, and each slice is switched by one catalog call that sets its partition's location; no file of any slice is moved
    or deleted, so ``df`` may read the table. A run that dies leaves each slice old or new. Returns the slices switched.
    """
    spark = df.sparkSession
    ensure_schema(spark, table)
    short = table.rsplit(".", 1)[-1]
    home = f"{root or table_root(spark, table)}/{short}"
    columns = [c for c in df.columns if c != slice_column]
    rows = df.select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{slice_column}`").cast("string"))
    location = f"{home}/version-{uuid4().hex}"
    rows.write.format(table_format).partitionBy(slice_column).save(location)
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (f" COMMENT {_text(f.metadata['comment'])}" if f.metadata.get("comment") else "") for f in rows.schema)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({declared}) USING {table_format} PARTITIONED BY (`{slice_column}`) LOCATION {_text(f'{home}/slices')}")
    if _layout(spark.table(table).schema) != _layout(rows.schema):
        raise ValueError(f"the slices' columns are not those of {table}")
    known = slice_locations(spark, table)
    done = {}
    for name, folder in sorted(_written_folders(spark, location, slice_column).items()):
        part = f"PARTITION (`{slice_column}` = {_text(name)})"
        if name in known:
            spark.sql(f"ALTER TABLE {table} {part} SET LOCATION {_text(folder)}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD {part} LOCATION {_text(folder)}")
        done[name] = Published(table, folder, known.get(name))
    return done


def drop_slice(spark: SparkSession, table: str, name: str) -> Published | None:
    """Take a slice out of a table partitioned by slice; its files stay. None if there is no such slice."""
    known = slice_locations(spark, table).get(name)
    if known is None:
        return None
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{partition_columns(spark, table)[0]}` = {_text(name)})")
    return Published(table, "", known)


def _written_folders(spark: SparkSession, location: str, column: str) -> dict[str, str]:
    """The folders in which Spark has put the values of a partition column; names escape what paths can't hold."""
    system, target = hadoop_path(spark, location)
    folders = [status.getPath().getName() for status in system.listStatus(target) if status.isDirectory()]
    found = {unquote(f.split("=", 1)[1]): f"{location}/{f}" for f in folders if f.startswith(f"{column}=")}
    if NO_VALUE in found:
        raise ValueError(f"rows without a value of {column} belong to no slice")
    return found


def remove_retired(spark: SparkSession, published: Published) -> bool:
    """Delete the version a publication replaced, unless the table has gone back to it; whether something went."""
    retired = published.previous_location
    if retired is None or (spark.catalog.tableExists(published.table) and table_location(spark, published.table) == retired):
        return False
    return release(spark, retired)


def append_table(df: DataFrame, table: str, root: str | None = None, table_format: str = "parquet") -> None:
    """SNK-2: append rows of a fixed schema, creating schema and table on first use.

    Any number of writers may append at once, first ones too: the table is created only if nobody else has done so, and the
    rows are written to a folder that readers pass over and then take their place by one rename, so that a reader sees all
    of an append or nothing. (On a store without atomic renames, such as an object store, it may see a part for a while.)
    """
    spark = df.sparkSession
    ensure_schema(spark, table)
    location = f"{root or table_root(spark, table)}/{table.rsplit('.', 1)[-1]}/log"
    if not spark.catalog.tableExists(table):
        declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({declared}) USING {table_format} OPTIONS (recursiveFileLookup 'true') LOCATION {_text(location)}")
    if _layout(spark.table(table).schema) != _layout(df.schema):
        raise ValueError(f"the rows' columns are not those of {table}")
    location = table_location(spark, table)
    batch = uuid4().hex
    df.write.format(table_format).save(f"{location}/_staged-{batch}")
    system, staged = hadoop_path(spark, f"{location}/_staged-{batch}")
    if not system.rename(staged, hadoop_path(spark, f"{location}/batch-{batch}")[1]):
        raise OSError(f"the rows written to {staged.toString()} could not be moved into {table}")
    spark.catalog.refreshTable(table)


def published_columns(spark: SparkSession, table: str) -> DataFrame:
    """SNK-4: (position, column_name, data_type, description) as published in the catalog."""
    rows = [
        (i, f.name, f.dataType.simpleString(), f.metadata.get("comment"))
        for i, f in enumerate(spark.table(table).schema)
    ]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, description string")


COPY_BYTES = 64 << 30  # of files that are copied, verified and entered in the manifest together
# The copy's manifest; a file is known by its path, length and time, its rows by number and fingerprint.
COPIED = "url string, length bigint, modified timestamp, slice string, rows bigint, hash_xor bigint, hash_sum decimal(38,0), copy string"


def copied_files(spark: SparkSession, destination: str) -> DataFrame:
    """The manifest of a copy: the files that have arrived whole, and where."""
    place = f"{destination}/manifest"
    if not existing(spark, [place]):
        return spark.createDataFrame([], COPIED)
    return spark.read.schema(COPIED).option("recursiveFileLookup", "true").parquet(place)


def _copied_together(spark: SparkSession, files: list, schema: T.StructType, destination: str) -> None:
    """Copy some files of one schema, compare each with its copy, and enter those that agree in the manifest."""
    target = f"{destination}/files-{uuid4().hex}"
    columns = [F.col(f"`{c}`") for c in schema.names]
    numbers = spark.createDataFrame(
        [(f["url"], f["length"], f["modified"], f["slice"], i) for i, f in enumerate(files)], "url string, length bigint, modified timestamp, slice string, _file int"
    )
    read = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*[f["path"] for f in files])
    source = read.select(*columns, file_url(F.col("_metadata.file_path")).alias("url")).join(numbers.select("url", "_file"), "url").drop("url")
    source.write.partitionBy("_file").parquet(target)
    copy = spark.read.schema(source.schema).parquet(target)
    left, right = (table_fingerprint(df, ["_file"], schema.names) for df in (source, copy))
    alike = reconcile_fingerprints(left, right, ["_file"]).select("_file", "matches")
    told = numbers.join(right, "_file", "left").join(alike, "_file", "left")
    # A file without rows has no fingerprint on either side, and has arrived.
    arrived = told.filter(F.coalesce("matches", F.lit(True))).select(
        "url", "length", "modified", "slice", F.coalesce("rows", F.lit(0)).alias("rows"), "hash_xor", F.col("hash_sum").cast("decimal(38,0)").alias("hash_sum"),
        F.concat(F.lit(f"{target}/_file="), "_file").alias("copy"),
    )
    arrived.coalesce(1).write.parquet(f"{destination}/manifest/{uuid4().hex}")


def verified_copy(spark: SparkSession, paths: list[str], destination: str, batch_bytes: int = COPY_BYTES) -> DataFrame:
    """SNK-3: copy slices below ``destination`` and compare both sides file by file.

    Returns (slice, left_rows, right_rows, matches, safe_to_drop); ``safe_to_drop`` is TRUE only when every file of every
    slice has arrived whole. Dropping the source stays the caller's act. Files are copied ``batch_bytes`` at a time, and
    those that agree with their copy are entered in a manifest (``copied_files``) with the number and fingerprint of their
    rows. A run that stopped is taken up by running it again: only files the manifest lacks, as they are now, are copied.
    """
    store = {name: i for i, name in enumerate(sorted(by_name(paths)))}
    told = footers(spark, paths)
    listed = list_files(spark, paths).select(F.col("url"), F.col("modificationTime").alias("modified"))
    schemas, numbered = numbered_schemas(spark, told)
    names = F.get(F.lit(list(store)), F.col(SLICE)).alias("slice")
    files = told.join(numbered.select("path", "schema_no"), "path", "left").join(listed, "url")
    files = kept(files.select("path", file_url(F.col("url")).alias("url"), "length", "modified", names, "rows", "schema_no"), "to-copy")
    missing = files.filter("schema_no IS NOT NULL").join(copied_files(spark, destination), ["url", "length", "modified", "slice"], "left_anti").orderBy("schema_no", "url")
    held: list = []
    for f in [*missing.collect(), None]:  # as many as Spark's own listing holds on the driver
        if held and (f is None or f["schema_no"] != held[0]["schema_no"] or sum(h["length"] for h in held) + f["length"] > batch_bytes):
            _copied_together(spark, held, schemas[held[0]["schema_no"]], destination)
            held = []
        held.append(f)
    arrived = copied_files(spark, destination).select("url", "length", "modified", "slice", F.col("rows").alias("arrived")).distinct()
    seen = files.join(arrived, ["url", "length", "modified", "slice"], "left").groupBy("slice").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("arrived"), F.lit(0)).alias("right_rows"),
        F.every(F.coalesce(F.col("rows") == F.col("arrived"), F.lit(False))).alias("matches"),
    )
    # A slice without files: 0 rows arrived out of 0.
    slices = spark.createDataFrame([(n,) for n in store], "slice string")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("left_rows", "right_rows")]
    compared = slices.join(seen, "slice", "left").select("slice", *counts, F.coalesce("matches", F.lit(True)).alias("matches"))
    written = kept(compared, "verdicts")  # so that asking for the verdict does not compare again
    return written.withColumn("safe_to_drop", written.agg(F.every("matches")).scalar())


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """Raise the shuffle partition count in proportion to the input for the work inside.

    Adaptive execution merges partitions that turn out small, so erring upwards is cheap.
    """
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    wanted = ceil(input_bytes * INFLATION / TARGET_PARTITION_BYTES)
    spark.conf.set(SHUFFLE_PARTITIONS, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)
