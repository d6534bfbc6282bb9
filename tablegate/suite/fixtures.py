"""Views the registered queries run on, derived by Spark from the given tables.

``trips`` shapes the events as trip records and plants every defect the contract looks for. The weekly
extracts are those trips as they would land: one folder per week, each reaching one day into the next week
(so that Mondays arrive twice), the oldest in a layout whose column types and spelling differ.
"""

from __future__ import annotations

from datetime import date, timedelta
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate import contract as contracts
from tablegate.contract import Contract
from tablegate.sources.workspace import fresh_path

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
WINDOW = ("2024-01-03", "2024-01-29")  # fixed values: the contract's reporting window
OLD_LAYOUT_BEFORE = "2024-01-01"  # extracts named before this day have the old layout
DRIFT = {"passenger_count": "int", "ratecodeid": "int"}
REQUIRED = ["VendorID", "passenger_count", "total_amount", PICKUP, DROPOFF]

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_extracts: dict[tuple[str, str], list[str]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips: some passengers missing or zero, some amounts negative, some ends before starts."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type",
        "user_id AS VendorID",
        "CASE WHEN event_id % 23 = 0 THEN NULL ELSE CAST(event_id % 7 AS INT) END AS passenger_count",
        "value - 5.0 AS total_amount",
        f"ts AS {PICKUP}",
        f"ts + make_dt_interval(0, 0, CAST(event_id % 61 AS INT) - 1, 0) AS {DROPOFF}",
    )


def trips_with_unknown_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips of which some have no amount, so that the amount rule cannot decide them."""
    amount = F.when(F.col("event_id") % 1000 != 1, F.col("total_amount"))
    return trips(spark, sf_dir).withColumn("total_amount", amount)


def trips_as_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips whose passenger count is text as typed in, some of it no number."""
    typed = (
        F.when(F.col("event_id") % 17 == 0, "n/a")
        .when(F.col("event_id") % 19 == 0, "")
        .otherwise(F.col("passenger_count").cast("string"))
    )
    return trips(spark, sf_dir).select(
        typed.alias("passenger_text"), F.col("event_id").cast("string").alias("id_text"), "event_type"
    )


def week_of(day: Column) -> Column:
    """The Monday on or before a day."""
    return F.date_sub(F.next_day(day, "MON"), 7)


def trips_by_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips(spark, sf_dir).withColumn("week", week_of(F.to_date(PICKUP)).cast("string"))


def trips_contract() -> Contract:
    return contracts.load(str(files("tablegate") / "contracts" / "trips.yaml"))


def contract_with(*rules: contracts.Rule) -> Contract:
    """The trip contract with further rules."""
    base = trips_contract()
    return Contract(base.name, base.version, base.table, base.columns, base.rules + rules)


def weekly_extracts(spark: SparkSession, sf_dir: str) -> list[str]:
    """Write the weekly extracts once per application and table folder; returns their paths in order."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _extracts:
        _extracts[key] = _write_extracts(spark, sf_dir)
    return _extracts[key]


def monthly_orders(spark: SparkSession, sf_dir: str) -> list[str]:
    """Orders landed as a folder a month; the last one nested by status, the first with customers as double."""
    key = (spark.sparkContext.applicationId, f"{sf_dir} orders")
    if key not in _extracts:
        root = fresh_path(spark, "months")
        landed = table(spark, sf_dir, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
        months = sorted(r[0] for r in landed.select("month").distinct().collect())  # one a month of the calendar
        old, nested = months[0], months[-1]
        kinds = {"old": F.col("month") == old, "nested": F.col("month") == nested, "new": ~F.col("month").isin(old, nested)}
        for kind, own in kinds.items():
            rows = landed.filter(own).withColumn("slice", F.concat(F.lit("orders "), "month")).drop("month")
            if kind == "old":
                rows = rows.withColumn("o_custkey", F.col("o_custkey").cast("double"))
            split = rows.withColumn("status", F.col("o_orderstatus")) if kind == "nested" else rows
            by = ["slice", "status"] if kind == "nested" else ["slice"]
            split.repartition(*by).write.partitionBy(*by).parquet(f"{root}/{kind}")
        _extracts[key] = [_renamed(spark, f"{root}/{kind}", m) for m in months for kind in [_kind_of(m, old, nested)]]
    return _extracts[key]


def _kind_of(month: str, old: str, nested: str) -> str:
    return "old" if month == old else "nested" if month == nested else "new"


def _renamed(spark: SparkSession, folder: str, month: str) -> str:
    """Give a partition folder the name a landed slice has, with its space."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    system.rename(path(f"{folder}/slice=orders {month}"), path(f"{folder}/orders {month}"))
    return f"{folder}/orders {month}"


def _write_extracts(spark: SparkSession, sf_dir: str) -> list[str]:
    root = fresh_path(spark, "extracts")
    own_week, week_before = week_of(F.to_date(PICKUP)), week_of(F.date_sub(F.to_date(PICKUP), 1))
    weeks = F.array_distinct(F.transform(F.array(own_week, week_before), lambda d: d.cast("string")))
    landed = (
        trips(spark, sf_dir)
        .withColumn("RatecodeID", F.col("event_id") % 6 + 1)
        .withColumn("airport_fee", F.when(F.col("event_id") % 10 == 0, 1.25).otherwise(0.0))
        .withColumn("slice", F.explode(weeks))
    )
    old = landed.filter(F.col("slice") < OLD_LAYOUT_BEFORE)
    new = landed.filter(F.col("slice") >= OLD_LAYOUT_BEFORE)
    as_double = {c: F.col(c).cast("double") for c in ("passenger_count", "RatecodeID")}
    as_bigint = {c: F.col(c).cast("bigint") for c in ("passenger_count", "RatecodeID")}
    old.withColumns(as_double).write.partitionBy("slice").parquet(f"{root}/old")
    new.withColumns(as_bigint).withColumnRenamed("airport_fee", "Airport_fee").write.partitionBy("slice").parquet(
        f"{root}/new"
    )
    first, last = landed.agg(F.min("slice"), F.max("slice")).head()
    names, week = [], date.fromisoformat(first)
    while week <= date.fromisoformat(last):
        names.append(week.isoformat())
        week += timedelta(days=7)
    return [f"{root}/{'old' if n < OLD_LAYOUT_BEFORE else 'new'}/slice={n}" for n in names]
