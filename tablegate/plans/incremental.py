"""Adding one slice to a published table: SET-2 and DUP-1 for a slice that lands after others.

Beside the table stands an index of its rows' 64-bit fingerprints with their slices, bucketed by the fingerprint, so that a
new slice's fingerprints are shuffled to the index and the index stays where it is. A row whose fingerprint the index
doesn't know is new. The others are compared in full, and only with rows of the same fingerprints, in the slices that the
index names: of a slice without copies elsewhere nothing but fingerprints is ever compared.

The index may know more than the table holds (a slice that was replaced, a run that died in between): that costs a
comparison and never a row. So it is written first.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.functions.families import families_of
from tablegate.functions.fingerprint import row_hash
from tablegate.operators.schema import SchemaDriftError, assert_uniform
from tablegate.operators.slices import CAST_LOSS, COPIES
from tablegate.plans.ingest import INGESTED_AT, IngestResult, collapsed_slices
from tablegate.plans.runlog import PASSED, RAISE, logged_run
from tablegate.plans.sinks import Published, drop_slice, ensure_schema, replace_slices, table_root
from tablegate.sources.slices import SOURCE_FILE, read_schemas, slice_name
from tablegate.sources.workspace import kept, released

PRINT = "_print"
BUCKETS = 64


def index_name(table: str) -> str:
    return f"{table}__prints"


def _as_published(rows: DataFrame, published: T.StructType) -> DataFrame:
    """rows with the published table's spelling, order and types of the source columns; other families raise."""
    own, theirs = (families_of(s, fold_case=True) for s in (rows.drop(SOURCE_FILE, COPIES, CAST_LOSS).schema, published))
    if own != theirs:
        odd = sorted(c for c in own.keys() | theirs.keys() if own.get(c) != theirs.get(c))
        raise SchemaDriftError("; ".join(f"column '{c}' is '{own.get(c, 'missing')}', but '{theirs.get(c, 'missing')}' in the table" for c in odd))
    columns = [F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in published]
    return rows.select(*columns, SOURCE_FILE, COPIES, CAST_LOSS)


def new_rows(fresh: DataFrame, published: DataFrame, index: DataFrame, columns: list[str], own: str) -> DataFrame:
    """The rows of ``fresh``, which are distinct and have their fingerprints, that no other slice of the table holds."""
    others = index.filter(F.col("slice") != own)
    suspects = kept(fresh.join(others, PRINT, "left_semi"), "suspects")
    prints = suspects.select(PRINT).distinct()
    where = [r["slice"] for r in others.join(prints, PRINT, "left_semi").select("slice").distinct().collect()]
    old = published.filter(F.col(SOURCE_FILE).isin(where)).select(*[F.col(f"`{c}`") for c in columns], row_hash(columns).alias(PRINT))
    old = old.join(prints, PRINT, "left_semi")
    told = [COPIES, CAST_LOSS, SOURCE_FILE]
    both = suspects.withColumn("_old", F.lit(0)).unionByName(old.withColumn("_old", F.lit(1)), allowMissingColumns=True)
    apart = both.groupBy(PRINT, *[F.col(f"`{c}`") for c in columns]).agg(F.max("_old").alias("_old"), *[F.max(c).alias(c) for c in told])
    unknown = fresh.join(prints, PRINT, "left_anti")
    return unknown.unionByName(apart.filter("_old = 0").drop("_old"))


def add_slice(
    spark: SparkSession,
    path: str,
    drift: dict[str, str],
    table: str,
    log_table: str,
    root: str | None = None,
    run_ts: datetime | None = None,
    on_schema_error: str = RAISE,
    buckets: int = BUCKETS,
) -> IngestResult | None:
    """Add a slice, or replace it if it has landed before; None when a schema error was only reported.

    The table then holds what ``ingest`` makes of all slices at once, if they are added in the order of their names: a row
    that several slices hold stands once, under the first that brought it. The table is partitioned by slice, and other
    slices' files are not touched. A row that a later slice held as well doesn't come back when the slice that has it
    re-lands without it, until the later one is added again.
    """
    result, own = None, slice_name(path)
    with logged_run(spark, "bronze", log_table, root, on_schema_error) as run, released(spark):
        schemas = read_schemas(spark, [path])
        assert_uniform(schemas, list(drift))
        rows = collapsed_slices(spark, [path], drift, schemas)
        there = spark.catalog.tableExists(table)
        published = spark.table(table) if there else None
        if there:
            rows = _as_published(rows, T.StructType([f for f in published.schema if f.name not in (SOURCE_FILE, INGESTED_AT)]))
        run.schema_check = PASSED
        columns = [c for c in rows.columns if c not in (SOURCE_FILE, COPIES, CAST_LOSS)]
        fresh = kept(rows.withColumn(PRINT, row_hash(columns)), "fresh")
        if there:
            fresh_rows = kept(new_rows(fresh, published, spark.table(index_name(table)), columns, own), "new")
        else:
            fresh_rows = fresh
        ensure_schema(spark, table)
        home = f"{root or table_root(spark, table)}/{index_name(table).rsplit('.', 1)[-1]}"
        prints = fresh_rows.select(PRINT, F.col(SOURCE_FILE).alias("slice"))
        writer = prints.repartition(buckets, PRINT).write.bucketBy(buckets, PRINT).sortBy(PRINT).format("parquet").mode("append")
        (writer if spark.catalog.tableExists(index_name(table)) else writer.option("path", home)).saveAsTable(index_name(table))
        stamp = F.lit(run_ts or run.executed_at).cast("timestamp").alias(INGESTED_AT)
        done = replace_slices(fresh_rows.select(*[F.col(f"`{c}`") for c in columns], stamp, SOURCE_FILE), table, SOURCE_FILE, root)
        location = done.get(own) or drop_slice(spark, table, own)
        read = fresh.agg(F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows"), F.coalesce(F.sum(CAST_LOSS), F.lit(0)).alias("loss")).first()
        run.rows_read, run.rows_written = read["rows"], fresh_rows.count()
        run.counts = {"duplicates_removed": run.rows_read - run.rows_written, "cast_loss_count": read["loss"]}
        run.watched = ["duplicates_removed"]
        result = IngestResult(run.rows_read, run.rows_written, run.counts["duplicates_removed"], read["loss"], location or Published(table, "", None))
    return result
