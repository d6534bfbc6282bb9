"""Leave-one-out size outliers (MAN-1) without a self-join and without ranking every row.

The median of all *other* values depends only on the two or three middle values of the whole list and on whether the
row's own value lies below or above them. So one row of order statistics, found by narrowing (``plans/quantiles.py``), is
all each row needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.plans.quantiles import at_ranks

TOLERANCE = 0.5  # fixed value: share of the median a size may deviate


def leave_one_out(df: DataFrame, measure: str, tolerance: float = TOLERANCE) -> DataFrame:
    """MAN-1: adds ``median_of_others`` and ``is_outlier``.

    A value is an outlier when it deviates from the median of the others by more than ``tolerance`` times
    that median, or when that median is 0. With no others, both columns are NULL. The input is read once per turn of the
    narrowing and once more for the result.
    """
    middle = F.ceil(F.col("n") / 2)
    ranks = {"below": middle - 1, "mid": middle, "above": middle + 1}
    values = at_ranks(df.select(F.lit(0).alias("__all"), measure), "__all", [measure], ranks)
    v = F.col(f"`{measure}`").cast("double")
    found = values.select("n", *ranks).first() or dict.fromkeys(("n", *ranks))
    n, below, mid, above = (F.lit(found[name]).cast(kind) for name, kind in (("n", "bigint"), *((r, "double") for r in ranks)))

    # Odd n leaves an even number of others: the mean of the two values around the gap the row leaves.
    # Even n leaves an odd number: the middle of the others lies across the middle from the row.
    around_gap = F.when(v < mid, mid + above).when(v > mid, below + mid).otherwise(below + above) / 2
    across = F.when(v <= mid, above).otherwise(mid)
    of_others = F.when((n > 1) & v.isNotNull(), F.when(n % 2 == 1, around_gap).otherwise(across))

    median = F.col("median_of_others")
    return (
        df.withColumn("median_of_others", of_others)
        .withColumn("is_outlier", (median == 0) | (F.abs(v - median) > F.lit(tolerance) * median))
    )
