"""Comparing tables and metrics between layers: REC-1 and REC-2 (REC-1 by a tree of fingerprints is in ``plans/reconcile.py``).

No row is ever paired with another: both sides are tagged, stacked and grouped, so copies collapse
before the shuffle and one shuffle serves both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.functions.fingerprint import fingerprint


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """REC-1, exact: the rows whose number of copies differs, with both numbers.

    Both inputs must have the same column names; columns are matched by name.
    """
    columns = left.columns
    sides = left.select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select("*", F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    copies = sides.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(
        F.sum("_l").alias("left_copies"), F.sum("_r").alias("right_copies")
    )
    return copies.filter(F.col("left_copies") != F.col("right_copies"))


def table_fingerprint(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Row count and order-independent hash of the rows under each key; nothing but these is shuffled."""
    return df.groupBy(*keys).agg(*fingerprint(columns or [c for c in df.columns if c not in keys]))


def reconcile_fingerprints(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """REC-1 by fingerprint: (keys..., left_rows, right_rows, matches) for every key of either side.

    ``left`` and ``right`` are ``table_fingerprint`` results. A full outer join on small tables would do as
    well; grouping the two stacked treats NULL keys as equal.
    """
    stacked = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1)))

    def of(side: int, column: str):
        return F.max(F.when(F.col("_side") == side, F.col(column)))

    return (
        stacked.groupBy(*keys)
        .agg(
            F.coalesce(of(0, "rows"), F.lit(0)).alias("left_rows"),
            F.coalesce(of(1, "rows"), F.lit(0)).alias("right_rows"),
            (of(0, "hash_xor").eqNullSafe(of(1, "hash_xor")) & of(0, "hash_sum").eqNullSafe(of(1, "hash_sum"))).alias(
                "_same"
            ),
        )
        .withColumn("matches", F.col("_same") & (F.col("left_rows") == F.col("right_rows")))
        .drop("_same")
    )


def reconcile_metrics(left: DataFrame, right: DataFrame) -> DataFrame:
    """REC-2: two (metric, value) tables side by side; a metric only one side reports does not match."""
    return (
        left.withColumnRenamed("value", "left_value")
        .join(right.withColumnRenamed("value", "right_value"), "metric", "full_outer")
        .withColumn("matches", F.col("left_value").eqNullSafe(F.col("right_value")))
    )
