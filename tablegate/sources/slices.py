"""Reading slices: SRC-1, SRC-2 and SRC-4.

A slice is a Parquet file, or a folder of them however nested, that landed as one; its name is the last part of its path.
Slices of one schema share a scan, so plans grow with the number of schemas and not of slices. Which slice a row is from
follows from its file: a dictionary of the slices' paths, spelled as Spark spells them, is joined to the leading part of
the file's path. What the join attaches is the slice's number; names are put in its place at the end.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyarrow import parquet
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.sources.stores import DRIVER_THREADS, LOCAL, TAIL_BYTES, Store, Tail, qualified, split_by_reach, tail_by_hadoop, tail_by_task
from tablegate.sources.workspace import kept

SOURCE_FILE = "_source_file"
SLICE = "_slice"  # a slice's place among the sorted names
MAGIC = b"PAR1"  # fixed value: how a Parquet file begins and ends


def slice_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def by_name(paths: list[str]) -> dict[str, str]:
    """Slice name to path, in the order given."""
    named = {slice_name(p): p for p in paths}
    if len(named) != len(paths):
        raise ValueError("two slices share a name; lineage could not tell them apart")
    return named


def file_url(path: Column) -> Column:
    """One spelling of a file's path: some parts of Spark write ``file:/a``, others ``file:///a``."""
    return F.regexp_replace(path, LOCAL, "file:/")


def with_slice(df: DataFrame, file_path: Column, paths: list[str]) -> DataFrame:
    """SRC-4: adds the number of the slice each row's file belongs to; a file of none is an error.

    ``file_path`` is a path as ``_metadata.file_path`` has it. A path is cut to as many parts as a slice's has and looked
    up; slices of several depths are looked up one depth after another, the deepest that holds the file counting.
    """
    spark = df.sparkSession
    numbers = {name: i for i, name in enumerate(sorted(by_name(paths)))}
    depths: dict[int, list[tuple[str, int]]] = {}
    for path in paths:
        uri = re.sub(LOCAL, "file:/", qualified(spark, path))
        depths.setdefault(uri.count("/") + 1, []).append((uri, numbers[slice_name(path)]))
    columns, found = df.columns, []
    out = df.withColumn("__file", file_url(file_path))
    for depth in sorted(depths, reverse=True):
        uris, own = zip(*depths[depth])
        # From an Arrow table, so that Spark knows its size: a row per slice, which it broadcasts or not by itself.
        known = spark.createDataFrame(pa.table({f"__uri_{depth}": uris, f"__no_{depth}": pa.array(own, pa.int32())}))
        out = out.join(known, F.substring_index("__file", "/", depth) == F.col(f"__uri_{depth}"), "left")
        found.append(F.col(f"__no_{depth}"))
    nobody = F.raise_error(F.concat(F.lit("a file of no slice: "), F.col("__file"))).cast("int")
    return out.select(*[F.col(f"`{c}`") for c in columns], F.coalesce(*found, nobody).alias(SLICE))


def name_of(number: Column, paths: list[str]) -> Column:
    """The name a slice's number stands for."""
    return F.get(F.lit(sorted(by_name(paths))), number)


def list_files(spark: SparkSession, paths: list[str], pattern: str = "*.parquet") -> DataFrame:
    """(path, url, length, modificationTime) of the files below the paths; their content is not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    return reader.load(list(paths)).select("path", F.col("_metadata.file_path").alias("url"), "length", "modificationTime")


def footer_of(tail: Tail) -> tuple[int | None, str | None, str | None]:
    """Rows and schema (as Spark's JSON) that a file's footer declares, or what is wrong with it.

    Failing to read the bytes is raised: a store that is down or refuses is not a damaged file.
    """
    from pyspark.sql.pandas.types import from_arrow_schema

    body = tail(TAIL_BYTES)
    if len(body) < 12 or body[-4:] != MAGIC:
        return None, None, "not a Parquet file: it doesn't end as one"
    wanted = int.from_bytes(body[-8:-4], "little") + 8
    if wanted > len(body):
        body = tail(wanted)
    try:
        found = parquet.read_metadata(pa.BufferReader(MAGIC + body[-wanted:]))
        own = (found.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
        return found.num_rows, own.decode() if own else from_arrow_schema(found.schema.to_arrow_schema(), True).json(), None
    except Exception as error:
        return None, None, str(error)[:500] or type(error).__name__


FOOTERS = "path string, url string, length long, _slice int, rows long, schema string, error string"


def footers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SRC-2 for every file: (path, url, length, _slice, rows, schema, error); no row is touched, each footer is read once.

    ``error`` says how a file is damaged. Files that can't be reached are no damage: that is an error of the whole read.
    """
    names = [c.split()[0] for c in FOOTERS.split(", ")]
    store = Store.of(spark, *paths)
    near, far = split_by_reach(spark, paths, store)

    def listed(some: list[str]) -> DataFrame:
        return with_slice(list_files(spark, some), F.col("url"), paths).select("path", "url", "length", SLICE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [footer_of(tail_by_task(store, url)) for url in batch.column(1).to_pylist()]
            extra = [pa.array([t[k] for t in told], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names)

    parts = []
    if near:
        parts.append(listed(near).repartition(spark.sparkContext.defaultParallelism).mapInArrow(run, FOOTERS))
    if far:
        files = listed(far).collect()  # as many as Spark's own listing holds on the driver
        with ThreadPoolExecutor(DRIVER_THREADS) as pool:
            told = pool.map(lambda f: footer_of(tail_by_hadoop(spark, f["path"])), files)
            parts.append(spark.createDataFrame([(*f, *t) for f, t in zip(files, told)], FOOTERS))
    return kept(reduce(DataFrame.unionAll, parts), "footers")


@dataclass(frozen=True)
class Layout:
    """Files of a slice that share a schema: all of the slice's, or some."""

    slice: str
    schema: T.StructType
    example: str
    alone: bool  # whether the slice has no other schema

    @property
    def label(self) -> str:
        return self.slice if self.alone else f"{self.slice}/{slice_name(self.example)}"


def spark_schemas(spark: SparkSession, told: DataFrame) -> dict[str, T.StructType]:
    """What Spark makes of each distinct schema that footers declare; it reads one file of each."""
    examples = {r["schema"]: r["path"] for r in told.filter("schema IS NOT NULL").groupBy("schema").agg(F.min("path").alias("path")).collect()}
    with ThreadPoolExecutor(DRIVER_THREADS) as pool:
        return dict(zip(examples, pool.map(lambda p: spark.read.parquet(p).schema, examples.values())))


def numbered_schemas(spark: SparkSession, told: DataFrame) -> tuple[list[T.StructType], DataFrame]:
    """The distinct schemas as Spark understands them, and (path, _slice, rows, schema_no) of the readable files."""
    known = spark_schemas(spark, told)
    distinct = {s.json(): s for s in known.values()}
    order = {text: i for i, text in enumerate(sorted(distinct))}
    numbers = spark.createDataFrame(pa.table({"schema": list(known), "schema_no": pa.array([order[s.json()] for s in known.values()], pa.int32())}))
    return [distinct[t] for t in order], told.join(numbers, "schema").select("path", SLICE, "rows", "schema_no")


def layouts(spark: SparkSession, paths: list[str], told: DataFrame | None = None) -> list[Layout]:
    """The distinct schemas of each slice's readable files, each with the first file that has it."""
    schemas, files = numbered_schemas(spark, footers(spark, paths) if told is None else told)
    found = files.groupBy(SLICE, "schema_no").agg(F.min("path").alias("path")).collect()
    names, own = sorted(by_name(paths)), Counter(r[SLICE] for r in found)
    ordered = sorted(found, key=lambda r: (names[r[SLICE]], r["path"]))
    return [Layout(names[r[SLICE]], schemas[r["schema_no"]], r["path"], own[r[SLICE]] == 1) for r in ordered]


def read_schemas(spark: SparkSession, paths: list[str]) -> dict[str, T.StructType]:
    """SRC-2: slice to schema, of all its files; one whose files differ has an entry ``slice/file`` for each schema.

    An unreadable file is an error here.
    """
    told = footers(spark, paths)
    broken = told.filter("error IS NOT NULL").select("path", "error").head()
    if broken is not None:
        raise ValueError(f"the footer of {broken['path']} cannot be read: {broken['error']}")
    order = {name: i for i, name in enumerate(by_name(paths))}
    return {x.label: x.schema for x in sorted(layouts(spark, paths, told), key=lambda x: order[x.slice])}


def scan_slices(
    spark: SparkSession,
    paths: list[str],
    schemas: dict[str, T.StructType] | None = None,
    skip_corrupt: bool = False,
    file_columns: bool = False,
    numbered: bool = False,
) -> list[DataFrame]:
    """SRC-1: one scan per distinct schema, with the lineage column ``_source_file``, or ``_slice`` if numbered.

    ``schemas`` is what ``read_schemas`` returned. ``file_columns`` also keeps path and size of the file behind each row.
    Folder names below a slice are not columns.
    """
    named = by_name(paths)
    schemas = schemas if schemas is not None else read_schemas(spark, paths)
    groups: dict[str, list[str]] = {}
    mixed = [named[n] for n in named if n not in schemas]
    for name, schema in schemas.items():
        if name in named:
            groups.setdefault(schema.json(), []).append(named[name])
    if mixed:
        own, files = numbered_schemas(spark, footers(spark, mixed))
        for r in files.select("path", "schema_no").collect():
            groups.setdefault(own[r["schema_no"]].json(), []).append(r["path"])
    extra = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_bytes")]
    scans = []
    for text, places in groups.items():
        schema = next(s for s in schemas.values() if s.json() == text)
        reader = spark.read.schema(schema).option("ignoreCorruptFiles", str(skip_corrupt).lower())
        rows = reader.option("recursiveFileLookup", "true").parquet(*places)
        columns = [F.col(f"`{c}`") for c in schema.names]
        rows = with_slice(rows.select(*columns, F.col("_metadata.file_path").alias("__path"), *(extra if file_columns else [])), F.col("__path"), paths)
        lineage = F.col(SLICE) if numbered else name_of(F.col(SLICE), paths).alias(SOURCE_FILE)
        scans.append(rows.select(*columns, lineage, *(["_path", "_bytes"] if file_columns else [])))
    return scans
