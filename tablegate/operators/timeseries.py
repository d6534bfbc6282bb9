"""Daily series: gaps (TS-1), trend plus weekly pattern and trends that break (TS-2).

Both work on the daily table (one row per series and day), which the count by (series, day) has already
shrunk to at most one row per calendar day and series. A window over one series is therefore bounded
by the calendar, and any number of series runs side by side on the one shuffle by series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablegate.functions.calendar import day_key


def daily_series(df: DataFrame, ts: str, keys: list[str]) -> DataFrame:
    """(keys..., day, y) with y the number of rows of the series on that day; undated rows have none."""
    return df.filter(F.col(ts).isNotNull()).groupBy(*keys, day_key(ts).alias("day")).agg(F.count(F.lit(1)).alias("y"))


def missing_days(series: DataFrame, keys: list[str]) -> DataFrame:
    """TS-1: the days between the first and the last of a series on which it has no row.

    Each day looks at the next one present and lists the days between the two, so no calendar table and
    no join is needed and only the gaps themselves are produced.
    """
    following = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    gaps = series.withColumn("_next", following).filter(F.datediff("_next", "day") > 1)
    between = F.sequence(F.date_add("day", 1), F.date_sub("_next", 1))
    return gaps.select(*keys, F.explode(between).alias("missing_day"))


def weekly_decomposition(series: DataFrame, keys: list[str]) -> DataFrame:
    """TS-2: additive split of a daily series into linear trend, weekly effect and remainder.

    The trend is the least-squares line over the day number; the weekly effect is the mean of what the
    line leaves per weekday, centred so that the effects of the weekdays present sum to zero. In-sample
    only, no yearly term. It answers the same question as a fitted forecasting model (is volume rising,
    which weekdays are strong) without its changepoints, Fourier terms and uncertainty band, so its
    numbers differ from such a model's.
    """
    whole = Window.partitionBy(*keys)
    weekday = Window.partitionBy(*keys, "weekday")
    trend = (
        series.withColumn("x", F.datediff("day", F.min("day").over(whole)).cast("double"))
        .withColumn("weekday", F.dayofweek("day"))
        .withColumn("slope", F.coalesce(F.regr_slope("y", "x").over(whole), F.lit(0.0)))
        .withColumn("intercept", F.avg("y").over(whole) - F.col("slope") * F.avg("x").over(whole))
        .withColumn("trend", F.col("intercept") + F.col("slope") * F.col("x"))
        .withColumn("detrended", F.col("y") - F.col("trend"))
    )
    effects = trend.withColumn("effect", F.avg("detrended").over(weekday)).withColumn(
        "weight", F.lit(1.0) / F.count(F.lit(1)).over(weekday)
    )
    # Each weekday weighs 1 in all, so this is the plain mean of the weekday effects.
    centre = F.sum(F.col("effect") * F.col("weight")).over(whole) / F.sum("weight").over(whole)
    weekly = F.col("effect") - centre
    return effects.select(
        *keys,
        "day",
        "y",
        "trend",
        weekly.alias("weekly"),
        (F.col("detrended") - weekly).alias("remainder"),
    )


LEAST_DAYS, LEAST_GAIN = 7, 0.2  # days on either side of a break; share of the unexplained squares it must explain


def trend_breaks(series: DataFrame, keys: list[str], least_days: int = LEAST_DAYS, least_gain: float = LEAST_GAIN) -> DataFrame:
    """TS-2 with a changepoint: (keys..., day, y, break_day, gain, trend), the trend a line that may bend on one day.

    ``y = a + b x + c max(0, x - k)`` is fitted by least squares for every day k of the series that has ``least_days`` days
    on either side; the day that explains most is the break (the earlier of two that explain the same), if it explains at
    least ``least_gain`` of what a straight line leaves; else ``break_day`` is NULL and the trend the straight line. ``gain``
    is the share that the best day explains, NULL where no day qualifies.

    The normal equations of all days come from running sums over the days after each, so a series costs one sort.
    """
    whole = Window.partitionBy(*keys)
    after = Window.partitionBy(*keys).orderBy("x").rowsBetween(1, Window.unboundedFollowing)
    order = Window.partitionBy(*keys).orderBy("x")
    s = series.withColumn("_d", F.datediff("day", F.min("day").over(whole)).cast("double")).withColumn("_y", F.col("y").cast("double"))
    # Centred, which keeps the sums small and makes the constant drop out.
    s = s.withColumn("x", F.col("_d") - F.avg("_d").over(whole)).withColumn("_z", F.col("_y") - F.avg("_y").over(whole))
    x, z, n = F.col("x"), F.col("_z"), F.count(F.lit(1)).over(whole)
    s = s.select("*", n.alias("_n"), F.row_number().over(order).alias("_i"), F.avg("_y").over(whole).alias("_mean"))
    s = s.select("*", *[F.sum(e).over(whole).alias(name) for name, e in (("_xx", x * x), ("_xy", x * z), ("_yy", z * z))])
    sums = (("_m", F.lit(1.0)), ("_a", x), ("_b", x * x), ("_c", z), ("_e", x * z))
    s = s.select("*", *[F.coalesce(F.sum(e).over(after), F.lit(0.0)).alias(name) for name, e in sums])
    m, a, b, c, e = (F.col(name) for name, _ in sums)
    s = s.withColumn("_h", (a - x * m) / F.col("_n"))  # the hinge's mean, for a break on this day
    hh = b - 2 * x * a + x * x * m - F.col("_n") * F.col("_h") * F.col("_h")
    s = s.select("*", hh.alias("_hh"), (b - x * a).alias("_xh"), (e - x * c).alias("_hy"))
    det = F.col("_xx") * F.col("_hh") - F.col("_xh") * F.col("_xh")
    bend = F.try_divide(F.col("_xx") * F.col("_hy") - F.col("_xh") * F.col("_xy"), det)
    slope = F.try_divide(F.col("_hh") * F.col("_xy") - F.col("_xh") * F.col("_hy"), det)
    s = s.select("*", slope.alias("_slope"), bend.alias("_bend"), F.try_divide(F.col("_xy"), F.col("_xx")).alias("_line"))
    left = F.col("_yy") - F.coalesce(F.col("_line") * F.col("_xy"), F.lit(0.0))
    gained = F.col("_slope") * F.col("_xy") + F.col("_bend") * F.col("_hy") - F.col("_line") * F.col("_xy")
    fits = (F.col("_i") >= least_days) & (F.col("_n") - F.col("_i") >= least_days) & (left > 1e-9 * F.col("_yy"))
    share = F.when(fits, F.round(gained / left, 9))
    candidate = F.struct(share.alias("gain"), (-x).alias("early"), x.alias("x"), F.col("day").alias("day"), "_slope", "_bend", "_h")
    s = s.withColumn("_best", F.max(F.when(share.isNotNull(), candidate)).over(whole))
    best = F.col("_best")
    breaks = F.coalesce(best["gain"] >= least_gain, F.lit(False))
    bent = best["_slope"] * x + best["_bend"] * (F.greatest(x - best["x"], F.lit(0.0)) - best["_h"])
    trend = F.col("_mean") + F.when(breaks, bent).otherwise(F.coalesce(F.col("_line"), F.lit(0.0)) * x)
    return s.select(*keys, "day", "y", F.when(breaks, best["day"]).alias("break_day"), best["gain"].alias("gain"), trend.alias("trend"))
