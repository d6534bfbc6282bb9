"""Calendar aggregations and small reports over a cleaned table.

Covers AGG-7 .. AGG-13, FLT-10, TOP-1, TOP-2 and TOP-4. Group keys are derived from a timestamp and have few
values, so each aggregate combines on the map side and ships a handful of rows per task, whatever
the share of one hour or month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablegate.functions.calendar import day_key, hour_key, in_month, month_name, month_start


def avg_by(df: DataFrame, key: Column, key_name: str, measure: str, digits: int = 2) -> DataFrame:
    """Rounded average and row count per key, ordered by key (TOP-1)."""
    return (
        df.groupBy(key.alias(key_name))
        .agg(F.round(F.avg(measure), digits).alias(f"avg_{measure}"), F.count(F.lit(1)).alias("trip_count"))
        .orderBy(key_name)
    )


def avg_by_month(df: DataFrame, ts: str, measure: str) -> DataFrame:
    """AGG-7: month as text such as 2024-01."""
    return avg_by(df, month_start(ts), "month", measure).withColumn("month", month_name(F.col("month")))


def avg_by_hour(df: DataFrame, ts: str, measure: str, year: int, month: int) -> DataFrame:
    """AGG-8: by hour of day within one month; hours without rows stay absent."""
    return avg_by(df.filter(in_month(ts, year, month)), hour_key(ts), "pickup_hour", measure)


def daily_counts(df: DataFrame, ts: str) -> DataFrame:
    """AGG-9."""
    return df.groupBy(day_key(ts).alias("trip_date")).agg(F.count(F.lit(1)).alias("trip_count")).orderBy("trip_date")


def total(df: DataFrame, measure: str) -> DataFrame:
    """AGG-10."""
    return df.agg(F.sum(measure).alias(f"total_{measure}"))


def avg_one_month(df: DataFrame, ts: str, measure: str, year: int, month: int) -> DataFrame:
    """AGG-11."""
    return df.filter(in_month(ts, year, month)).agg(F.avg(measure).alias(f"avg_{measure}"))


def avg_of_period_totals(df: DataFrame, ts: str, measure: str) -> DataFrame:
    """AGG-12: mean of the monthly totals and mean of the daily totals, from one scan.

    Monthly totals are sums of the daily ones. As with AVG over subqueries, a period whose measure is
    NULL throughout has no total and does not count.
    """
    by_day = df.groupBy(day_key(ts).alias("day")).agg(F.sum(measure).alias("day_total"))
    by_month = by_day.groupBy(F.trunc("day", "month").alias("month")).agg(
        F.sum("day_total").alias("month_total"), F.count("day_total").alias("days")
    )
    return by_month.agg(
        F.avg("month_total").alias("avg_monthly_total"),
        F.try_divide(F.sum("month_total"), F.sum("days").cast("double")).alias("avg_daily_total"),
    )


def extremes(series: DataFrame, key: str, value: str) -> DataFrame:
    """AGG-13: keys with the lowest and highest value; ties go to the smallest key."""
    lowest = F.min(F.struct(F.col(value).alias("v"), F.col(key).alias("k")))
    highest = F.min_by(F.struct(F.col(value).alias("v"), F.col(key).alias("k")), F.struct(-F.col(value), F.col(key)))
    return (
        series.filter(F.col(value).isNotNull())
        .agg(lowest.alias("lo"), highest.alias("hi"))
        .select(
            F.col("lo.k").alias(f"lowest_{key}"),
            F.col("lo.v").alias(f"lowest_{value}"),
            F.col("hi.k").alias(f"highest_{key}"),
            F.col("hi.v").alias(f"highest_{value}"),
        )
    )


def threshold_count(df: DataFrame, measure: str, above: float) -> DataFrame:
    """FLT-10."""
    return df.filter(F.col(measure) > above).agg(F.count(F.lit(1)).alias("trip_count"))


def busiest(df: DataFrame, key: Column, key_name: str, limit: int = 1) -> DataFrame:
    """TOP-2: the keys with most rows; equal counts go to the smaller key."""
    counts = df.groupBy(key.alias(key_name)).agg(F.count(F.lit(1)).alias("trip_count"))
    return counts.orderBy(F.desc("trip_count"), F.asc(key_name)).limit(limit)


def preview(df: DataFrame, rows: int) -> DataFrame:
    """TOP-4: the first rows of a result, for showing, and how many there are in all (total_rows)."""
    return df.limit(rows).withColumn("total_rows", df.agg(F.count(F.lit(1))).scalar())
