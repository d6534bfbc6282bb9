"""Contract rules as columns, counts and row sets.

Covers FLT-1 .. FLT-7, FLT-11, PRJ-2, PRJ-3, QLT-1 .. QLT-7 and LOG-2. The conditions of FLT-2, FLT-3, FLT-4 and
FLT-5 are text in the contract; FLT-6 is the policy that evaluates nothing.

Every rule is one boolean column over the unfiltered input, so all counts come out of a single scan and
a rule's count does not depend on the other rules. A row is dropped where the OR of the drop rules is
TRUE and kept where it is FALSE; where a NULL leaves it unknown the row is neither, and is counted as
undetermined, so that read = written + dropped + undetermined.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.contract import Contract, Rule
from tablegate.functions.text import alert_text

FLAG_PREFIX = "_fails_"
QUALITY_FLAGS = "_quality_flags"
ALERT_THRESHOLD = 0.01  # fixed value: alerts fire strictly above 1 %


def fails(rule: Rule) -> Column:
    """FLT-1 .. FLT-5: a rule's condition as a boolean column."""
    return F.expr(rule.condition).cast("boolean")


def drop_mask(contract: Contract) -> Column:
    """FLT-7: OR of the drop rules; FALSE when there are none."""
    return reduce(or_, [fails(r) for r in contract.drop_rules], F.lit(False))


def flag_rules(df: DataFrame, contract: Contract) -> DataFrame:
    """FLT-1: the input with one ``_fails_<rule>`` column per evaluated rule (FLT-6 rules have none)."""
    return df.select("*", *[fails(r).alias(FLAG_PREFIX + r.id) for r in contract.counted_rules])


def quality_flags(contract: Contract) -> Column:
    """QLT-6: ids of the ``flag`` rules a row fails."""
    named = [F.when(fails(r), F.lit(r.id)) for r in contract.flag_rules]
    return F.filter(F.array(*named), lambda rule_id: rule_id.isNotNull())


def published_columns(contract: Contract, run_ts: datetime | None = None) -> list[Column]:
    """PRJ-3: business columns in contract order, quality flags if any, audit columns (PRJ-2).

    Each column carries its contract description as a comment, which ``saveAsTable`` publishes (SNK-4).
    """

    def described(column: Column, name: str, text: str) -> Column:
        return column.alias(name, metadata={"comment": text}) if text else column.alias(name)

    columns = [described(F.col(f"`{c.name}`"), c.name, c.description) for c in contract.business_columns]
    if contract.flag_rules:
        columns.append(quality_flags(contract).alias(QUALITY_FLAGS))
    if run_ts is not None:
        columns += [described(F.lit(run_ts).cast("timestamp"), c.name, c.description) for c in contract.audit_columns]
    return columns


def clean(df: DataFrame, contract: Contract, run_ts: datetime | None = None) -> DataFrame:
    """Rows no drop rule rejects, projected to the contract."""
    return df.filter(~drop_mask(contract)).select(*published_columns(contract, run_ts))


def failed_ids(contract: Contract) -> Column:
    named = [F.when(fails(r), F.lit(r.id)) for r in contract.drop_rules]
    return F.filter(F.array(*named).cast("array<string>"), lambda rule_id: rule_id.isNotNull())


def quarantine(df: DataFrame, contract: Contract) -> DataFrame:
    """The dropped rows, whole, with the ids of the rules they fail."""
    return df.filter(drop_mask(contract)).select("*", failed_ids(contract).alias("_failed_rules"))


def undetermined(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows on which the drop rules give neither TRUE nor FALSE."""
    return df.filter(drop_mask(contract).isNull())


def total_metrics(contract: Contract) -> list[Column]:
    """QLT-2, QLT-3 as aggregates: rows read, dropped at least once, kept, undetermined."""
    mask = drop_mask(contract)
    return [
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(mask).alias("total_dropped"),
        F.count_if(~mask).alias("rows_written"),
        F.count_if(mask.isNull()).alias("undetermined_count"),
    ]


def rule_metrics(contract: Contract) -> list[Column]:
    """QLT-1 as aggregates: one ``<rule>_count`` per evaluated rule."""
    return [F.count_if(fails(r)).alias(r.metric) for r in contract.counted_rules]


def rule_totals(df: DataFrame, contract: Contract) -> DataFrame:
    """QLT-2 and QLT-3 in one row."""
    return df.agg(*total_metrics(contract))


def rule_counts(df: DataFrame, contract: Contract, by: Iterable[str] = ()) -> DataFrame:
    """QLT-1, or QLT-7 with ``by``: (by..., rule_id, policy, failed_count, rows_read), one scan in all."""
    by = list(by)
    rules = contract.counted_rules
    counted = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows_read"), *rule_metrics(contract))
    per_rule = F.array(
        *[
            F.struct(
                F.lit(r.id).alias("rule_id"),
                F.lit(r.policy).alias("policy"),
                F.col(f"`{r.metric}`").alias("failed_count"),
            )
            for r in rules
        ]
    ).cast("array<struct<rule_id:string,policy:string,failed_count:bigint>>")
    return counted.select(*by, "rows_read", F.inline(per_rule))


def failed_share() -> Column:
    """Share of the rows read that fail a counted rule; NULL where nothing was read."""
    return F.try_divide(F.col("failed_count").cast("double"), F.col("rows_read").cast("double"))


def above_share(counts: DataFrame, limit: float) -> DataFrame:
    """Counts whose share of the rows read is strictly above ``limit``; none where nothing was read."""
    return counts.withColumn("share", failed_share()).filter(F.col("share") > limit)


def rule_alerts(counts: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """LOG-2: one alert sentence per rule above the threshold."""
    name = F.concat(F.col("rule_id"), F.lit("_count"))
    return above_share(counts, threshold).withColumn("alert", alert_text(name, F.col("share"), threshold))


def rule_overlap(df: DataFrame, contract: Contract) -> DataFrame:
    """QLT-4: how many rows fail 0, 1, 2, ... drop rules."""
    failed = reduce(
        lambda total, r: total + F.coalesce(fails(r).cast("int"), F.lit(0)), contract.drop_rules, F.lit(0)
    )
    return df.groupBy(failed.alias("rules_failed")).agg(F.count(F.lit(1)).alias("row_count"))


def unparseable_counts(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """QLT-5: cells that hold something which does not parse as the expected Spark type."""
    bad = [
        F.count_if(F.col(f"`{c}`").isNotNull() & F.col(f"`{c}`").try_cast(t).isNull()).alias(f"bad_{i}")
        for i, (c, t) in enumerate(expected.items())
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(t).alias("expected_type"),
                F.col(f"bad_{i}").alias("unparseable_count"),
            )
            for i, (c, t) in enumerate(expected.items())
        ]
    )
    return df.agg(F.count(F.lit(1)).alias("rows_read"), *bad).select("rows_read", F.inline(rows))


def violations(published: DataFrame, contract: Contract) -> DataFrame:
    """FLT-11: the drop rules applied to the published table; every count should be zero."""
    return rule_counts(published, contract).filter(F.col("policy") == "drop").drop("policy")
