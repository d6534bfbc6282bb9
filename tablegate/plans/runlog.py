"""The run log: LOG-1, LOG-3, LOG-4, SNK-5 and TOP-3 (LOG-2's sentence comes from the same expression).

One row per run of a stage, appended whether the run passed or failed.
"""

from __future__ import annotations

import logging
import time
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegate.functions.text import alert_text
from tablegate.operators.quality import ALERT_THRESHOLD
from tablegate.operators.schema import SchemaDriftError
from tablegate.plans.sinks import Published, append_table, overwrite_table

LOGGER = logging.getLogger(__name__)

PASSED, FAILED = "pass", "failed"  # fixed values: states of a run and of its schema check
RAISE, REPORT = "raise", "report"

# Columns of the run log; ``error`` says why a run failed.
LOG_COLUMNS = {
    "pipeline_stage": "string",
    "executed_at": "timestamp",
    "status": "string",
    "rows_read": "bigint",
    "rows_written": "bigint",
    "schema_check_status": "string",
    "duration_seconds": "double",
    "metrics": "string",
    "alerts": "array<string>",
    "error": "string",
}


@dataclass
class Run:
    """What a stage reports about itself; ``watched`` names the counts that may raise an alert."""

    stage: str
    executed_at: datetime
    rows_read: int | None = None
    rows_written: int | None = None
    counts: dict[str, int] = field(default_factory=dict)
    watched: list[str] = field(default_factory=list)
    schema_check: str | None = None
    status: str = FAILED
    duration: float | None = None
    error: str | None = None


def log_rows(spark: SparkSession, runs: list[Run], threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """LOG-1: runs as log rows, metrics as JSON text, alerts derived from the watched counts (LOG-2)."""
    return reduce(DataFrame.unionAll, [_log_row(spark, run, threshold) for run in runs])


def _log_row(spark: SparkSession, run: Run, threshold: float) -> DataFrame:
    counts = F.create_map(*[F.lit(part) for entry in run.counts.items() for part in entry])
    metrics = F.to_json(counts.cast("map<string,bigint>"), {"ignoreNullFields": "false"})
    loud = []
    for name in run.watched:
        share = F.try_divide(F.lit(run.counts.get(name)).cast("double"), F.lit(run.rows_read).cast("double"))
        loud.append(F.when(share > threshold, alert_text(F.lit(name), share, threshold)))
    alerts = F.filter(F.array(*loud).cast("array<string>"), lambda alert: alert.isNotNull())
    reported = {
        "pipeline_stage": run.stage,
        "executed_at": run.executed_at,
        "status": run.status,
        "rows_read": run.rows_read,
        "rows_written": run.rows_written,
        "schema_check_status": run.schema_check,
        "duration_seconds": run.duration,
        "metrics": metrics,
        "alerts": alerts,
        "error": run.error,
    }
    one_row = spark.sql("SELECT 1")
    return one_row.select(*[F.lit(reported[name]).cast(kind).alias(name) for name, kind in LOG_COLUMNS.items()])


@contextmanager
def logged_run(spark: SparkSession, stage: str, log_table: str, root: str | None = None, on_schema_error: str = RAISE):
    """LOG-3: run a stage, append its log row whatever happens, and say its alerts aloud.

    A schema error is expected: with ``report`` it ends as a ``failed`` row and no exception, with ``raise``
    (the default) the exception also leaves. Any other error is logged and always leaves. The row of a
    run that passed is written outside the guarded part, so that a failing log write cannot record a
    success as a failure.
    """
    run = Run(stage, datetime.now(timezone.utc))
    start = time.monotonic()

    def append() -> None:
        run.duration = time.monotonic() - start
        rows = log_rows(spark, [run])
        row = rows.head()
        append_table(spark.createDataFrame([row], rows.schema), log_table, root)
        for alert in row["alerts"]:
            LOGGER.warning("ALERT [%s]: %s", stage, alert)

    try:
        yield run
    except SchemaDriftError as exc:
        run.schema_check, run.error = FAILED, str(exc)
        append()
        if on_schema_error == RAISE:
            raise
        return
    except Exception as exc:
        run.error = f"{type(exc).__name__}: {exc}"
        append()
        raise
    run.status = PASSED
    append()


def latest_runs(log: DataFrame) -> DataFrame:
    """TOP-3: the newest row of every stage."""
    newest = F.max_by(F.struct(*[F.col(c) for c in log.columns]), F.col("executed_at"))
    return log.groupBy("pipeline_stage").agg(newest.alias("run")).select("run.*")


def metric_history(log: DataFrame) -> DataFrame:
    """LOG-4: every metric of every run, its share of the rows read, and its change since the run before.

    The window covers one metric of one stage, which grows by one row per run.
    """
    counts = F.from_json("metrics", "map<string,bigint>")
    long = log.select("pipeline_stage", "executed_at", "rows_read", F.explode(counts).alias("metric", "value"))
    before = F.lag("value").over(Window.partitionBy("pipeline_stage", "metric").orderBy("executed_at"))
    return long.select(
        "*",
        F.try_divide(F.col("value").cast("double"), F.col("rows_read").cast("double")).alias("share"),
        before.alias("previous_value"),
        (F.col("value") - before).alias("change"),
    )


def prune_log(spark: SparkSession, log_table: str, wrong: str, root: str | None = None) -> Published:
    """SNK-5: remove the log rows a condition names; rows on which it is NULL stay."""
    kept = spark.table(log_table).filter(~F.coalesce(F.expr(wrong), F.lit(False)))
    return overwrite_table(kept, log_table, root)
