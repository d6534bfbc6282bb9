"""Profile of a sliced table: AGG-1 .. AGG-6 and FLT-8 as grouped passes over all slices at once.

``profile`` computes volume, nulls, conditions and statistics of every slice in one aggregate; the
``*_rows`` functions turn that one-row-per-slice table into long form and Catalyst prunes whatever a
given long form does not use. Only duplicates need a second pass, because they group by the whole row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The quantiles of a profile.
QUANTILES = (0.25, 0.5, 0.75, 0.95, 0.99)
SKETCH_SIZE = 4000  # of a quantile sketch, some sixty kilobytes when full
RANK_ERROR = 0.002  # what the true rank of a sketched quantile may be off by, as a share of the values
SALTS = 64  # groups a slice's sketches are merged in before they meet


def percentage(count: Column, rows: Column) -> Column:
    """Share in percent with four digits; 0.0 where there are no rows."""
    return F.when(rows == 0, F.lit(0.0)).otherwise(F.round(F.lit(100.0) * count / F.nullif(rows, F.lit(0)), 4))


def quantile_name(q: float) -> str:
    return f"p{100 * q:g}".replace(".", "_")


def profile(
    df: DataFrame,
    slice_column: str,
    required: list[str],
    conditions: dict[str, Column],
    measures: list[str],
    sketch_size: int = SKETCH_SIZE,
) -> DataFrame:
    """One row per slice. A required column the input lacks gets a NULL count instead of an error.

    Aggregation goes through groups of a slice's tasks, so that no task merges the sketches of a whole slice from every
    task that read some of it. NaN has no place among the quantiles.
    """
    present = set(df.columns)
    counts = {f"nulls_{c}": F.count_if(F.col(f"`{c}`").isNull()) for c in required if c in present}
    counts |= {f"count_{name}": F.count_if(condition) for name, condition in conditions.items()}
    value = {m: F.col(f"`{m}`").cast("double") for m in measures}
    parts = [c.alias(name) for name, c in {"row_count": F.count(F.lit(1)), **counts}.items()]
    whole = [F.sum(f"`{name}`").alias(name) for name in ("row_count", *counts)]
    whole += [F.lit(None).cast("bigint").alias(f"nulls_{c}") for c in required if c not in present]
    for m in measures:
        ordered = F.when(~F.isnan(value[m]), value[m])
        parts += [
            F.min(value[m]).alias(f"min_{m}"),
            F.max(value[m]).alias(f"max_{m}"),
            F.sum(value[m]).alias(f"sum_{m}"),
            F.count(value[m]).alias(f"n_{m}"),
            F.count(ordered).alias(f"ordered_{m}"),
            F.kll_sketch_agg_double(ordered, sketch_size).alias(f"sketch_{m}"),
        ]
        sketch = F.kll_merge_agg_double(f"`sketch_{m}`", sketch_size)
        found = [F.kll_sketch_get_quantile_double(sketch, F.lit(q)) for q in QUANTILES]
        whole += [
            F.min(f"`min_{m}`").alias(f"min_{m}"),
            F.max(f"`max_{m}`").alias(f"max_{m}"),
            F.try_divide(F.sum(f"`sum_{m}`"), F.sum(f"`n_{m}`")).alias(f"mean_{m}"),
            F.when(F.sum(f"`ordered_{m}`") > 0, F.array(*found)).alias(f"quantiles_{m}"),
        ]
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_salt")
    grouped = df.groupBy(F.col(slice_column).alias("slice"), salt).agg(*parts)
    return grouped.groupBy("slice").agg(*whole)


def with_empty_slices(spark: SparkSession, profiled: DataFrame, slices: list[str]) -> DataFrame:
    """Add the expected slices that hold no row at all: counts 0, statistics NULL."""
    expected = spark.createDataFrame([(s,) for s in slices], "slice string")
    counts = [f.name for f in profiled.schema if f.dataType.typeName() == "long"]
    return expected.join(profiled, "slice", "left").fillna(0, subset=counts)


def volume_rows(profiled: DataFrame) -> DataFrame:
    """AGG-1."""
    return profiled.select("slice", "row_count")


def null_rows(profiled: DataFrame, required: list[str]) -> DataFrame:
    """AGG-2: (slice, column_name, present, null_count, null_pct)."""
    rows = F.inline(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.col(f"`nulls_{c}`").alias("null_count"))
                for c in required
            ]
        )
    )
    return profiled.select("slice", "row_count", rows).select(
        "slice",
        "column_name",
        F.col("null_count").isNotNull().alias("present"),
        "null_count",
        percentage(F.col("null_count"), F.col("row_count")).alias("null_pct"),
    )


def condition_rows(profiled: DataFrame, names: list[str]) -> DataFrame:
    """AGG-3: (slice, condition, matched_count, matched_pct)."""
    rows = F.inline(
        F.array(
            *[F.struct(F.lit(n).alias("condition"), F.col(f"`count_{n}`").alias("matched_count")) for n in names]
        )
    )
    return profiled.select("slice", "row_count", rows).select(
        "slice",
        "condition",
        "matched_count",
        percentage(F.col("matched_count"), F.col("row_count")).alias("matched_pct"),
    )


def stat_rows(profiled: DataFrame, measures: list[str]) -> DataFrame:
    """AGG-4: (slice, measure, min, max, mean)."""
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("measure"),
                F.col(f"`min_{m}`").alias("min_value"),
                F.col(f"`max_{m}`").alias("max_value"),
                F.col(f"`mean_{m}`").alias("mean_value"),
            )
            for m in measures
        ]
    )
    return profiled.select("slice", F.inline(rows))


def quantile_rows(profiled: DataFrame, measures: list[str]) -> DataFrame:
    """AGG-5: (slice, measure, p25, p50, p75, p95, p99), each an element of the data."""
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias("measure"),
                *[F.get(F.col(f"`quantiles_{m}`"), i).alias(quantile_name(q)) for i, q in enumerate(QUANTILES)],
            )
            for m in measures
        ]
    )
    return profiled.select("slice", F.inline(rows))


def finding_rows(profiled: DataFrame, required: list[str], conditions: list[str], measures: list[str]) -> DataFrame:
    """The whole profile in long form from its one pass: (slice, subject, metric, value)."""
    rows = F.col("row_count")

    def finding(subject: str, metric: str, value: Column) -> Column:
        return F.struct(
            F.lit(subject).alias("subject"), F.lit(metric).alias("metric"), value.cast("double").alias("value")
        )

    found = [finding("rows", "count", rows)]
    for kind, prefix, subjects in (("null", "nulls_", required), ("match", "count_", conditions)):
        for name in subjects:
            count = F.col(f"`{prefix}{name}`")
            found += [finding(name, f"{kind}_count", count), finding(name, f"{kind}_pct", percentage(count, rows))]
    for name in measures:
        found += [finding(name, stat, F.col(f"`{stat}_{name}`")) for stat in ("min", "max", "mean")]
        sketch = F.col(f"`quantiles_{name}`")
        found += [finding(name, quantile_name(q), F.get(sketch, i)) for i, q in enumerate(QUANTILES)]
    return profiled.select("slice", F.inline(F.array(*found)))


def duplicate_rows(df: DataFrame, slice_column: str) -> DataFrame:
    """AGG-6: (slice, row_count, duplicate_count, duplicate_pct).

    Copies collapse on the map side before the one shuffle on whole rows, so neither a large slice nor a
    row with many copies meets in one task. The per-slice sums then combine on the map side again.
    """
    source = [c for c in df.columns if c != slice_column]
    copies = df.groupBy(F.col(slice_column).alias("slice"), *[F.col(f"`{c}`") for c in source]).agg(
        F.count(F.lit(1)).alias("_copies")
    )
    return (
        copies.groupBy("slice")
        .agg(F.sum("_copies").alias("row_count"), F.sum(F.col("_copies") - 1).alias("duplicate_count"))
        .withColumn("duplicate_pct", percentage(F.col("duplicate_count"), F.col("row_count")))
    )
