"""Slice ingestion: scan, conform, stack, collapse copies, stamp, write.

The writing job also counts: the counts are observed behind any shuffle, in the stage that writes, where
Spark counts each partition once even if tasks are lost and run again.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators.schema import assert_uniform
from tablegate.operators.slices import CAST_LOSS, COPIES, accounting_metrics, collapse_copies, conform, union_slices
from tablegate.plans.runlog import PASSED, RAISE, logged_run
from tablegate.plans.sinks import Published, overwrite_table, sized_shuffles
from tablegate.sources.manifest import slice_sizes
from tablegate.sources.slices import SLICE, SOURCE_FILE, name_of, read_schemas, scan_slices
from tablegate.sources.workspace import released

INGESTED_AT = "_ingested_at"


@dataclass(frozen=True)
class IngestResult:
    rows_read: int
    rows_written: int
    duplicates_removed: int
    cast_loss_count: int
    published: Published


def conformed_slices(
    spark: SparkSession,
    paths: list[str],
    drift: dict[str, str],
    schemas: dict[str, T.StructType] | None = None,
    numbered: bool = False,
) -> DataFrame:
    """All slices stacked under one schema, with lineage (a number if asked) and cast-loss columns; copies still in."""
    schemas = schemas or read_schemas(spark, paths)
    assert_uniform(schemas, list(drift))
    return union_slices([conform(part, drift, count_loss=True) for part in scan_slices(spark, paths, schemas, numbered=numbered)])


def collapsed_slices(
    spark: SparkSession, paths: list[str], drift: dict[str, str], schemas: dict[str, T.StructType] | None = None
) -> DataFrame:
    """The rows to publish: distinct over the source columns, with lineage and copy counts."""
    rows = conformed_slices(spark, paths, drift, schemas, numbered=True)
    rows = collapse_copies(rows, [SLICE], SLICE, sums=[CAST_LOSS])
    return rows.withColumn(SLICE, name_of(F.col(SLICE), paths)).withColumnRenamed(SLICE, SOURCE_FILE)


def ingest(
    spark: SparkSession,
    paths: list[str],
    drift: dict[str, str],
    table: str,
    log_table: str,
    root: str | None = None,
    run_ts: datetime | None = None,
    on_schema_error: str = RAISE,
    partition_by: tuple[str, ...] = (),
) -> IngestResult | None:
    """Build the ingested table from its slices; None when a schema error was only reported."""
    result = None
    with logged_run(spark, "bronze", log_table, root, on_schema_error) as run, released(spark):
        schemas = read_schemas(spark, paths)
        assert_uniform(schemas, list(drift))
        run.schema_check = PASSED
        input_bytes = slice_sizes(spark, paths).agg(F.sum("size_bytes")).head()[0] or 0
        counted = Observation()
        stamp = F.lit(run_ts or run.executed_at).cast("timestamp").alias(INGESTED_AT)
        with sized_shuffles(spark, input_bytes):
            rows = collapsed_slices(spark, paths, drift, schemas).observe(
                counted, *accounting_metrics(), F.coalesce(F.sum(CAST_LOSS), F.lit(0)).alias("cast_loss_count")
            )
            published = overwrite_table(
                rows.drop(COPIES, CAST_LOSS).select("*", stamp), table, root, partition_by=partition_by
            )
        counts = counted.get
        run.rows_read, run.rows_written = counts["rows_read"], counts["rows_written"]
        run.counts = {n: counts[n] for n in ("duplicates_removed", "cast_loss_count")}
        run.watched = ["duplicates_removed"]
        result = IngestResult(**counts, published=published)
    return result
