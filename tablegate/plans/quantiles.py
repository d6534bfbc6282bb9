"""Exact values at ranks (AGG-5, exact form; MAN-1) by narrowing, without sorting the table.

A sketch of every slice and measure brackets each wanted rank between two values. One conditional aggregate counts exactly
how many values lie below the bracket and inside it, which shows whether it holds the rank; if not, the bracket moves to the
side on which the rank is. A bracket with many values is sketched and narrowed again: each turn keeps a small share of them.
Only what is left inside, a bounded number of values, is sorted. Nothing is written, and the driver holds a bracket per
slice, measure and rank. The table is read once per turn, so a frame that is dear to make should be persisted.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegate.operators.profile import QUANTILES, quantile_name

CUTS = 64  # parts of equal rank into which a sketch cuts a bracket
SKETCH_ACCURACY = 2000  # a cut is off by about a two-thousandth of the values, far less than a part
SORTED_ROWS = 100_000  # values that are sorted together, at most

def _cells(df: DataFrame, slice_column: str, measures: list[str]) -> DataFrame:
    """(of, measure, v): every value; ``of`` is the slice as text, so that one plan serves slices of any type."""
    cells = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"`{m}`").cast("double").alias("v")) for m in measures])
    return df.select(_key(slice_column).alias("of"), F.inline(cells)).filter(F.col("v").isNotNull())


def _key(slice_column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(slice_column).cast("string")), F.lit("NULL"))


Interval = tuple[str, str, float, float]  # measure, slice, lowest and highest value


def _intervals(brackets: list[dict]) -> list[Interval]:
    return list(dict.fromkeys((b["measure"], b["of"], b["low"], b["high"]) for b in brackets))


def _looked_up(spark: SparkSession, values: DataFrame, intervals: list[Interval]) -> DataFrame:
    """values with ``own``, the intervals of their slice and measure with their numbers.

    The dictionary is made from Arrow, so that Spark knows its size and broadcasts it or not by itself.
    """
    held: dict[tuple[str, str], list[dict]] = {}
    for number, (measure, of, low, high) in enumerate(intervals):
        held.setdefault((measure, of), []).append({"number": number, "low": low, "high": high})
    kind = pa.list_(pa.struct([("number", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]))
    columns = [pa.array([k[0] for k in held], pa.string()), pa.array([k[1] for k in held], pa.string()), pa.array(list(held.values()), kind)]
    return values.join(spark.createDataFrame(pa.table(columns, ["measure", "of", "own"])), ["measure", "of"])


def _inside(spark: SparkSession, values: DataFrame, intervals: list[Interval]) -> DataFrame:
    """(number, v): the values that lie in each interval."""
    v = F.col("v")
    hit = F.filter("own", lambda i: (v >= i["low"]) & (v <= i["high"]))
    return _looked_up(spark, values, intervals).select("v", F.explode(F.transform(hit, lambda i: i["number"])).alias("number"))


def _narrowed(spark: SparkSession, values: DataFrame, brackets: list[dict]) -> None:
    """Set low and high of each bracket nearer to its rank, by a sketch of the values that lie inside."""
    intervals = _intervals(brackets)
    shares = [k / CUTS for k in range(CUTS + 1)]
    sketched = _inside(spark, values, intervals).groupBy("number").agg(F.percentile_approx("v", shares, SKETCH_ACCURACY).alias("cuts"))
    found = {intervals[r["number"]]: r["cuts"] for r in sketched.collect()}
    for b in brackets:
        own = found[b["measure"], b["of"], b["low"], b["high"]]
        # The rank among the values inside; one part more on either side than the sketch may be off.
        at = (b["rank"] - b["below"] - 1) * CUTS // max(1, b["inside"])
        b["wide_low"], b["wide_high"] = b["low"], b["high"]
        b["low"], b["high"] = own[max(0, at - 1)], own[min(CUTS, at + 2)]


def _counted(spark: SparkSession, values: DataFrame, brackets: list[dict]) -> None:
    """Count exactly what lies below and inside each bracket, and move those that miss their rank."""
    intervals, v = _intervals(brackets), F.col("v")
    sides = F.filter(
        F.transform("own", lambda i: F.struct(i["number"].alias("number"), (v < i["low"]).alias("below"), ((v >= i["low"]) & (v <= i["high"])).alias("inside"))),
        lambda i: i["below"] | i["inside"],
    )
    told = _looked_up(spark, values, intervals).select(F.inline(sides))
    counts = told.groupBy("number").agg(F.count_if("below").alias("below"), F.count_if("inside").alias("inside"))
    found = {intervals[r["number"]]: (r["below"], r["inside"]) for r in counts.collect()}
    missed = []
    for b in brackets:
        b["below"], b["inside"] = found[b["measure"], b["of"], b["low"], b["high"]]
        if b["rank"] <= b["below"]:
            b["low"], b["high"] = b["wide_low"], b["low"]
            missed.append(b)
        elif b["rank"] > b["below"] + b["inside"]:
            b["low"], b["high"] = b["high"], b["wide_high"]
            missed.append(b)
    if missed:
        _counted(spark, values, missed)


def _merged(brackets: list[dict]) -> list[dict]:
    """Brackets of one slice and measure that overlap, as one, with the ranks of all."""
    merged: list[dict] = []
    for b in sorted(brackets, key=lambda b: (b["measure"], b["of"], b["below"], b["low"])):
        last = merged[-1] if merged else None
        if last and (last["measure"], last["of"]) == (b["measure"], b["of"]) and (b["low"] <= last["high"] or last["high"] != last["high"]):
            last["high"] = last["high"] if last["high"] != last["high"] or last["high"] >= b["high"] else b["high"]
            last["ranks"].append(b["rank"])
        else:
            merged.append({k: b[k] for k in ("measure", "of", "low", "high", "below")} | {"ranks": [b["rank"]]})
    return merged


def at_ranks(df: DataFrame, slice_column: str, measures: list[str], ranks: dict[str, Column]) -> DataFrame:
    """(slice, measure, n, a column per rank): the values at the given ranks, 1 the smallest; NULLs do not count.

    Ranks are expressions over ``n``, the number of values; one outside 1..n gives NULL. NaN is the largest value.
    """
    spark = df.sparkSession
    values = _cells(df, slice_column, measures)
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("bigint").alias("rank")) for name, rank in ranks.items()])
    whole = values.groupBy("measure", "of").agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    told = whole.select("measure", "of", "n", "low", "high", wanted.alias("wanted")).collect()  # a row per slice and measure
    brackets = [
        {"measure": r["measure"], "of": r["of"], "name": w["name"], "rank": w["rank"], "low": r["low"], "high": r["high"], "below": 0, "inside": r["n"]}
        for r in told
        for w in r["wanted"]
        if w["rank"] is not None and 1 <= w["rank"] <= r["n"]
    ]
    same = lambda b: b["low"] == b["high"] or b["low"] != b["low"]  # noqa: E731  one value is left, NaN perhaps
    while large := [b for b in brackets if b["inside"] > SORTED_ROWS and not same(b)]:
        before = repr([(b["low"], b["high"]) for b in large])
        _narrowed(spark, values, large)
        _counted(spark, values, large)
        if before == repr([(b["low"], b["high"]) for b in large]):  # as when a few values make up nearly all
            _halved(spark, values, large)

    found = {(b["measure"], b["of"], b["name"]): b["low"] for b in brackets if same(b)}
    rest = _merged([b for b in brackets if not same(b)])
    if rest:
        copies = _inside(spark, values, _intervals(rest)).groupBy("number", "v").agg(F.count(F.lit(1)).alias("c"))
        columns = [pa.array(range(len(rest)), pa.int32()), pa.array([b["below"] for b in rest], pa.int64()), pa.array([sorted(set(b["ranks"])) for b in rest], pa.list_(pa.int64()))]
        order = Window.partitionBy("number").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = copies.withColumn("upto", F.sum("c").over(order)).join(spark.createDataFrame(pa.table(columns, ["number", "below", "ranks"])), "number")
        upto = F.col("below") + F.col("upto")
        hit = F.filter("ranks", lambda r: (r <= upto) & (r > upto - F.col("c")))
        for r in placed.select("number", "v", F.explode(hit).alias("rank")).collect():
            at = rest[r["number"]]["measure"], rest[r["number"]]["of"]
            found |= {(*at, b["name"]): r["v"] for b in brackets if (b["measure"], b["of"]) == at and b["rank"] == r["rank"]}
    kind = df.schema[slice_column].dataType
    rows = [(None if r["of"] == "NULL" else r["of"][1:], r["measure"], r["n"], *[found.get((r["measure"], r["of"], name)) for name in ranks]) for r in told]
    columns = ", ".join(f"`{name}` double" for name in ranks)
    made = spark.createDataFrame(rows, f"slice string, measure string, n bigint{', ' + columns if columns else ''}")
    return made.withColumn("slice", F.col("slice").cast(kind))


def _halved(spark: SparkSession, values: DataFrame, brackets: list[dict]) -> None:
    """Narrow brackets that a sketch can't: to their end values if these hold the rank, else to what lies between them."""
    intervals = _intervals(brackets)
    ends = spark.createDataFrame(pa.table([pa.array(range(len(intervals)), pa.int32()), [i[2] for i in intervals], [i[3] for i in intervals]], ["number", "low", "high"]))
    joined = _inside(spark, values, intervals).join(ends, "number").groupBy("number").agg(
        F.count_if(F.col("v") == F.col("low")).alias("lowest"),
        F.count_if(F.col("v") == F.col("high")).alias("highest"),
        F.min(F.when(F.col("v") > F.col("low"), F.col("v"))).alias("second"),
        F.max(F.when(F.col("v") < F.col("high"), F.col("v"))).alias("last_but_one"),
    )
    found = {intervals[r["number"]]: r for r in joined.collect()}
    for b in brackets:
        own = found[b["measure"], b["of"], b["low"], b["high"]]
        if b["rank"] <= b["below"] + own["lowest"]:
            b["high"], b["inside"] = b["low"], own["lowest"]
        elif b["rank"] > b["below"] + b["inside"] - own["highest"]:
            b["below"] += b["inside"] - own["highest"]
            b["low"], b["inside"] = b["high"], own["highest"]
        else:
            b["below"], b["inside"] = b["below"] + own["lowest"], b["inside"] - own["lowest"] - own["highest"]
            b["low"], b["high"] = own["second"], own["last_but_one"]


def exact_quantiles(
    df: DataFrame, slice_column: str, measures: list[str], quantiles: tuple[float, ...] = QUANTILES
) -> DataFrame:
    """(slice, measure, p25, p50, ...), linearly interpolated between neighbouring values; NULLs do not count."""
    # A quantile lies between two neighbouring ranks, or on one of them.
    place = {quantile_name(q): F.lit(q) * (F.col("n") - 1) for q in quantiles}
    ranks = {f"{name}_low": F.floor(p) + 1 for name, p in place.items()} | {f"{name}_high": F.ceil(p) + 1 for name, p in place.items()}
    found = at_ranks(df, slice_column, measures, ranks)
    between = [
        (F.col(f"{name}_low") + (F.col(f"{name}_high") - F.col(f"{name}_low")) * (p - F.floor(p))).alias(name)
        for name, p in place.items()
    ]
    return found.select("slice", "measure", *between)
