from __future__ import annotations

from datetime import datetime
from uuid import uuid4

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tablegate.contract import Contract, Rule
from tablegate.operators import quality
from tablegate.operators.schema import SchemaDriftError
from tablegate.plans import gate, runlog, sinks
from tablegate.suite import fixtures as fx


@pytest.fixture
def names():
    tag = uuid4().hex
    return f"gated.t_{tag}", f"gated.log_{tag}"


def small(spark, rows):
    return spark.createDataFrame(
        rows,
        "VendorID bigint, passenger_count int, total_amount double, "
        "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz",
    )


def trip(amount=5.0, passengers=1, start="2024-01-10 10:00:00", end="2024-01-10 10:30:00"):
    return (1, passengers, amount, datetime.fromisoformat(start), datetime.fromisoformat(end))


def test_golden_counts_at_this_scale(spark, sf_dir, names, caplog):
    table, log = names
    result = gate.build(spark, fx.trips(spark, sf_dir), fx.trips_contract(), table, log)
    assert (result.rows_read, result.rows_written, result.total_dropped, result.undetermined_count) == (
        10000,
        6269,
        3731,
        0,
    )
    assert result.rule_counts == {
        "total_amount_negative_or_zero_count": 971,
        "passenger_count_null_or_zero_count": 1801,
        "dropoff_before_pickup_count": 164,
        "out_of_range_dates_count": 1391,
    }
    published = spark.table(table)
    assert published.columns == [c.name for c in fx.trips_contract().columns]
    assert published.count() == 6269
    row = spark.table(log).head()
    assert (row.pipeline_stage, row.status, row.error) == ("silver", "pass", None)
    assert [a.split(":")[0] for a in row.alerts] == list(result.rule_counts)
    assert "ALERT [silver]: dropoff_before_pickup_count: 1.64% > 1% threshold" in caplog.messages


def test_gate_is_one_job_without_shuffle(spark, sf_dir, names):
    plan = gate.gated(fx.trips(spark, sf_dir), fx.trips_contract(), Observation(), datetime(2024, 2, 1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("FileScan") == 1


def test_boundaries_of_the_rules(spark):
    rows = [
        trip(amount=0.0),
        trip(amount=0.01),
        trip(end="2024-01-10 10:00:00"),
        trip(end="2024-01-10 09:59:59"),
        trip(start="2024-01-03 00:00:00", end="2024-01-03 00:00:00"),
        trip(start="2024-01-28 23:59:00", end="2024-01-29 00:00:00"),
        trip(amount=float("nan")),
    ]
    flags = quality.flag_rules(small(spark, rows), fx.trips_contract())
    failed = [[r[f] for f in flags.columns if f.startswith("_fails_")] for r in flags.collect()]
    assert failed == [
        [True, False, False, False],
        [False, False, False, False],
        [False, False, False, False],
        [False, False, True, False],
        [False, False, False, False],
        [False, False, False, True],
        [False, False, False, False],
    ]


def test_null_measure_is_undetermined_unless_not_null_is_enforced(spark, names):
    table, log = names
    rows = [trip(), trip(amount=None), trip(amount=None, passengers=0)]
    result = gate.build(spark, small(spark, rows), fx.trips_contract(), table, log)
    assert (result.rows_read, result.rows_written, result.total_dropped, result.undetermined_count) == (3, 1, 1, 1)
    strict = gate.build(spark, small(spark, rows), fx.trips_contract(), table, log, enforce_not_null=True)
    assert (strict.rows_written, strict.total_dropped, strict.undetermined_count) == (1, 2, 0)
    assert strict.rule_counts["not_null_total_amount_count"] == 2


def test_empty_input(spark, names):
    table, log = names
    result = gate.build(spark, small(spark, []), fx.trips_contract(), table, log)
    assert (result.rows_read, result.rows_written) == (0, 0)
    assert spark.table(log).head().alerts == []


def test_contract_without_drop_rules_keeps_everything(spark, names):
    table, log = names
    base = fx.trips_contract()
    contract = Contract(base.name, base.version, base.table, base.columns, (base.rules[-1],))
    assert gate.build(spark, small(spark, [trip(amount=-1.0)]), contract, table, log).rows_written == 1
    assert quality.rule_counts(small(spark, [trip()]), contract).count() == 0


def test_flag_rules_add_a_column_and_drop_nothing(spark, names):
    table, log = names
    contract = fx.contract_with(Rule("large", "flag", "total_amount > 100"))
    result = gate.build(spark, small(spark, [trip(), trip(amount=200.0)]), contract, table, log)
    assert result.rows_written == 2 and result.rule_counts["large_count"] == 1
    flags = {r.total_amount: r._quality_flags for r in spark.table(table).collect()}
    assert flags == {5.0: [], 200.0: ["large"]}


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda df: df.drop("total_amount"), "total_amount.*None"),
        (lambda df: df.withColumn("total_amount", F.col("total_amount").cast("string")), "total_amount.*'string'"),
        (lambda df: df.withColumnRenamed("VendorID", "vendorid"), "VendorID"),
    ],
)
def test_incompatible_source_is_logged_and_raised(spark, names, change, message):
    table, log = names
    with pytest.raises(SchemaDriftError, match=message):
        gate.build(spark, change(small(spark, [trip()])), fx.trips_contract(), table, log)
    row = spark.table(log).head()
    assert (row.status, row.schema_check_status, row.rows_read) == ("failed", "failed", None)
    assert not spark.catalog.tableExists(table)


def test_log_can_be_pruned_and_appended_to(spark, names):
    table, log = names
    source = small(spark, [trip(), trip(amount=-1.0)])
    gate.build(spark, source.drop("VendorID"), fx.trips_contract(), table, log, on_schema_error=runlog.REPORT)
    gate.build(spark, source, fx.trips_contract(), table, log)
    runlog.prune_log(spark, log, "status = 'failed' AND rows_read IS NULL")
    gate.build(spark, source, fx.trips_contract(), table, log)
    assert [r.status for r in spark.table(log).collect()] == ["pass", "pass"]


def test_gate_reads_a_table_by_name(spark, names):
    table, log = names
    sinks.overwrite_table(small(spark, [trip(), trip(amount=-1.0)]), table + "_up")
    assert gate.build(spark, table + "_up", fx.trips_contract(), table, log).rows_written == 1


def test_reported_schema_error_does_not_raise(spark, names):
    table, log = names
    source = small(spark, [trip()]).drop("total_amount")
    assert gate.build(spark, source, fx.trips_contract(), table, log, on_schema_error=runlog.REPORT) is None
    assert "total_amount" in spark.table(log).head().error


def test_unexpected_error_is_logged_and_raised(spark, names):
    table, log = names
    contract = fx.contract_with(Rule("broken", "drop", "no_such_column > 1"))
    with pytest.raises(Exception, match="no_such_column"):
        gate.build(spark, small(spark, [trip()]), contract, table, log, on_schema_error=runlog.REPORT)
    row = spark.table(log).head()
    assert row.status == "failed" and "no_such_column" in row.error


def test_refused_version_is_not_published(spark, names):
    table, _ = names
    first = sinks.overwrite_table(spark.range(3).toDF("x"), table)

    def refuse(_):
        raise SchemaDriftError("no")

    with pytest.raises(SchemaDriftError):
        sinks.overwrite_table(spark.range(5).toDF("x"), table, check=refuse)
    assert spark.table(table).count() == 3
    assert sinks.table_location(spark, table) == first.location or first.location in sinks.table_location(spark, table)
    leftovers = [t.name for t in spark.catalog.listTables("gated") if "__" in t.name]
    assert leftovers == []


def test_table_can_be_overwritten_from_itself_and_keeps_its_old_version(spark, names):
    table, _ = names
    first = sinks.overwrite_table(spark.range(10).toDF("x"), table)
    second = sinks.overwrite_table(spark.table(table).filter("x >= 4"), table)
    assert spark.table(table).count() == 6
    assert first.location in second.previous_location
    assert spark.read.parquet(first.location).count() == 10


def test_partitioned_table_and_published_comments(spark, sf_dir, names):
    table, log = names
    gate.build(
        spark, fx.trips(spark, sf_dir), fx.trips_contract(), table, log, partition_by=()
    )
    described = {r.column_name: r.description for r in sinks.published_columns(spark, table).collect()}
    assert described["total_amount"].startswith("Amount charged")
    partitioned = sinks.overwrite_table(spark.range(6).selectExpr("id", "id % 3 AS p"), table, partition_by=("p",))
    assert spark.table(table).filter("p = 1").count() == 2
    assert partitioned.previous_location is not None


def test_alert_threshold_is_strict(spark):
    counts = spark.createDataFrame(
        [("at", "drop", 1, 100), ("above", "drop", 2, 100), ("none", "drop", 0, 0)],
        "rule_id string, policy string, failed_count bigint, rows_read bigint",
    )
    assert [r.alert for r in quality.rule_alerts(counts).collect()] == ["above_count: 2.00% > 1% threshold"]
