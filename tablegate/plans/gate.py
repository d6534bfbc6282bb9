"""The contract gate (SRC-3): one scan of the upstream table writes the clean table and counts on the way.

There is no shuffle, so the scan's own stage writes, and the counts observed in it are exact even when
tasks are lost and run again. The scan reads only the columns the contract names.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablegate.contract import Contract
from tablegate.operators.quality import (
    QUALITY_FLAGS,
    drop_mask,
    fails,
    published_columns,
)
from tablegate.operators.schema import assert_contract, assert_exact_columns
from tablegate.plans.runlog import PASSED, RAISE, logged_run
from tablegate.plans.sinks import Published, overwrite_table

FILTERED = "_dropped"


@dataclass(frozen=True)
class GateResult:
    rows_read: int
    rows_written: int
    total_dropped: int
    undetermined_count: int
    rule_counts: dict[str, int]
    published: Published


def gated(source: DataFrame, contract: Contract, counted: Observation, run_ts: datetime) -> DataFrame:
    """The rows to publish, with all counts observed over the unfiltered input.

    Each rule is evaluated once per row: the flags are columns, the counts and the filter read them.
    """
    flags = [fails(r).alias(r.metric) for r in contract.counted_rules]
    flagged = source.select("*", *flags, drop_mask(contract).alias(FILTERED))
    mask = F.col(FILTERED)
    observed = flagged.observe(
        counted,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(mask).alias("total_dropped"),
        F.count_if(~mask).alias("rows_written"),
        F.count_if(mask.isNull()).alias("undetermined_count"),
        *[F.count_if(F.col(f"`{r.metric}`")).alias(r.metric) for r in contract.counted_rules],
    )
    return observed.filter(~mask).select(*published_columns(contract, run_ts))


def build(
    spark: SparkSession,
    upstream: str | DataFrame,
    contract: Contract,
    table: str,
    log_table: str,
    root: str | None = None,
    run_ts: datetime | None = None,
    on_schema_error: str = RAISE,
    enforce_not_null: bool = False,
    partition_by: tuple[str, ...] = (),
) -> GateResult | None:
    """Check the upstream table against the contract, publish what passes, log the run."""
    contract = contract.enforcing_not_null() if enforce_not_null else contract
    expected = [c.name for c in contract.business_columns]
    expected += [QUALITY_FLAGS] if contract.flag_rules else []
    expected += [c.name for c in contract.audit_columns]
    result = None
    with logged_run(spark, "silver", log_table, root, on_schema_error) as run:
        source = spark.table(upstream) if isinstance(upstream, str) else upstream
        assert_contract(source.schema, contract)
        run.schema_check = PASSED
        counted = Observation()
        clean = gated(source, contract, counted, run_ts or run.executed_at)
        published = overwrite_table(
            clean,
            table,
            root,
            partition_by=partition_by,
            check=lambda written: assert_exact_columns(written.schema, expected),
        )
        counts = dict(counted.get)
        per_rule = {r.metric: counts.pop(r.metric) for r in contract.counted_rules}
        run.rows_read, run.rows_written = counts["rows_read"], counts["rows_written"]
        run.counts = {**per_rule, "total_dropped": counts["total_dropped"]}
        run.counts["undetermined_count"] = counts["undetermined_count"]
        run.watched = list(per_rule)
        result = GateResult(**counts, rule_counts=per_rule, published=published)
    return result
