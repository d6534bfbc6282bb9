from __future__ import annotations

import math
import random
import statistics
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.contract import load
from tablegate.functions import calendar
from tablegate.functions.families import family_of
from tablegate.functions.fingerprint import row_hash
from tablegate.functions.text import number_text
from tablegate.operators import analytics, quality, reconcile, timeseries
from tablegate.plans import outliers, quantiles
from tablegate.plans import reconcile as tree
from tablegate.plans import runlog
from tablegate.suite import fixtures as fx

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.mark.parametrize(
    "data_type, family",
    [
        (T.ByteType(), "integer"),
        (T.LongType(), "integer"),
        (T.FloatType(), "floating"),
        (T.DecimalType(10, 2), "floating"),
        (T.BooleanType(), "boolean"),
        (T.StringType(), "string"),
        (T.VarcharType(5), "string"),
        (T.DateType(), "timestamp_or_date"),
        (T.TimestampNTZType(), "timestamp_or_date"),
        (T.ArrayType(T.IntegerType()), "other"),
        (T.BinaryType(), "other"),
    ],
)
def test_families(data_type, family):
    assert family_of(data_type) == family


def brute_force(values, tolerance):
    for i, v in enumerate(values):
        others = values[:i] + values[i + 1 :]
        median = statistics.median(others) if others else None
        yield median, None if median is None else median == 0 or abs(v - median) > tolerance * median


@pytest.mark.parametrize("count", [1, 2, 3, 4, 7, 8, 40, 41])
def test_leave_one_out_equals_brute_force(spark, count):
    rng = random.Random(count)
    values = [rng.choice([0, 1, 2, 3, 5, 8, 100]) for _ in range(count)]
    rows = spark.createDataFrame(list(enumerate(values)), "k int, v int")
    got = {r.k: (r.median_of_others, r.is_outlier) for r in outliers.leave_one_out(rows, "v").collect()}
    assert [got[i] for i in range(count)] == list(brute_force(values, 0.5))


def test_leave_one_out_ignores_missing_values(spark):
    rows = spark.createDataFrame([(1, None), (2, 4), (3, 6)], "k int, v int")
    got = {r.k: (r.median_of_others, r.is_outlier) for r in outliers.leave_one_out(rows, "v").collect()}
    assert got == {1: (None, None), 2: (6.0, False), 3: (4.0, False)}


def test_row_hash_tells_null_positions_apart(spark):
    rows = spark.createDataFrame([(None, 1), (1, None), (None, None)], "a int, b int")
    assert rows.select(row_hash(["a", "b"])).distinct().count() == 3


def test_fingerprints_notice_copies_that_cancel_under_xor(spark):
    left = spark.createDataFrame([("k", 1), ("k", 1)], "key string, v int")
    right = spark.createDataFrame([("k", 2), ("k", 2)], "key string, v int")
    prints = [reconcile.table_fingerprint(t, ["key"]) for t in (left, right)]
    (row,) = reconcile.reconcile_fingerprints(*prints, ["key"]).collect()
    assert (row.left_rows, row.right_rows, row.matches) == (2, 2, False)


def test_reconciliation_with_missing_and_null_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 1), ("b", 2)], "key string, v int")
    right = spark.createDataFrame([(None, 1), ("a", 1), ("c", 3)], "key string, v int")
    prints = [reconcile.table_fingerprint(t, ["key"]) for t in (left, right)]

    def verdicts(compared):
        return {r.key: (r.left_rows, r.right_rows, r.matches) for r in compared.collect()}

    by_print = verdicts(reconcile.reconcile_fingerprints(*prints, ["key"]))
    exact = verdicts(tree.reconcile_exact(left, right, ["key"]))
    assert by_print == exact == {None: (1, 1, True), "a": (1, 1, True), "b": (1, 0, False), "c": (0, 1, False)}


def test_row_differences_count_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([("x", 2), (None, 1), ("y", 3)], "b string, a int")
    got = {(r.a, r.b): (r.left_copies, r.right_copies) for r in reconcile.row_differences(left, right).collect()}
    assert got == {(1, None): (2, 1), (3, "y"): (0, 1)}


def test_metrics_of_one_side_do_not_match(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "metric string, value bigint")
    right = spark.createDataFrame([("a", 1), ("c", None)], "metric string, value bigint")
    got = {r.metric: r.matches for r in reconcile.reconcile_metrics(left, right).collect()}
    assert got["a"] is True and got["b"] is False


def test_number_text(spark):
    row = spark.sql("SELECT 434378880.73D AS a, -1234.5D AS b, 0.005D AS c, CAST(NULL AS DOUBLE) AS d")
    assert tuple(row.select(*[number_text(c) for c in "abcd"]).head())[:2] == ("434.378.880,73", "-1.234,50")
    assert row.select(number_text("d")).head()[0] is None


def test_calendar_filter_reaches_the_scan(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders").filter(calendar.in_month("o_orderdate", 1996, 12))
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_clean_prunes_columns_and_pushes_filters(spark, sf_dir):
    contract = load(
        {
            "contract": {"name": "o", "version": "v1"},
            "columns": [{"name": "o_orderkey", "type": "integer"}, {"name": "o_totalprice", "type": "decimal"}],
            "quality_rules": [{"id": "cheap", "policy": "drop", "condition": "o_totalprice <= 1000"}],
        }
    )
    plan = quality.clean(fx.table(spark, sf_dir, "orders"), contract)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    assert "GreaterThan(o_totalprice,1000.0)" in plan


def test_extremes_break_ties_by_key(spark):
    rows = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 5.0), (0, 5.0), (9, None)], "hour int, v double")
    assert tuple(analytics.extremes(rows, "hour", "v").head()) == (1, 1.0, 0, 5.0)


def test_period_totals_leave_out_periods_without_a_value(spark):
    days = [((1, 1), 10.0), ((1, 1), 5.0), ((1, 2), None), ((2, 1), 3.0)]
    rows = spark.createDataFrame(
        [(datetime(2024, month, day), v) for (month, day), v in days],
        "ts timestamp_ntz, v double",
    )
    assert tuple(analytics.avg_of_period_totals(rows, "ts", "v").head()) == (9.0, 9.0)


def test_decomposition_adds_up_and_finds_the_pattern(spark):
    start = date(2024, 1, 1)
    pattern = [-30, -10, 0, 0, 10, 10, 20]
    rows = [("s", start + timedelta(days=i), 1000 + 7 * i + pattern[i % 7]) for i in range(140)]
    rows += [("one", start, 5)]
    series = spark.createDataFrame(rows, "key string, day date, y bigint")
    parts = timeseries.weekly_decomposition(series, ["key"]).orderBy("key", "day").collect()
    by_key = {k: [r for r in parts if r.key == k] for k in ("s", "one")}
    assert [(r.trend, r.weekly, r.remainder) for r in by_key["one"]] == [(5.0, 0.0, 0.0)]
    whole = by_key["s"]
    assert all(abs(r.trend + r.weekly + r.remainder - r.y) < 1e-9 for r in whole)
    assert abs(sum(r.weekly for r in whole[:7])) < 1e-9
    slope, intercept = np.polyfit(range(140), [r[2] for r in rows[:140]], 1)
    assert np.allclose([r.trend for r in whole], intercept + slope * np.arange(140))
    assert int(np.argmin([r.weekly for r in whole[:7]])) == 0 and int(np.argmax([r.weekly for r in whole[:7]])) == 6


def test_missing_days(spark):
    days = [("a", date(2024, 1, 1)), ("a", date(2024, 1, 4)), ("a", date(2024, 1, 5)), ("b", date(2024, 1, 2))]
    series = spark.createDataFrame(days, "key string, day date")
    got = sorted((r.key, r.missing_day.isoformat()) for r in timeseries.missing_days(series, ["key"]).collect())
    assert got == [("a", "2024-01-02"), ("a", "2024-01-03")]


def test_metric_history_and_latest_run(spark):
    at = datetime(2024, 1, 1)
    runs = [
        runlog.Run("silver", at + timedelta(days=i), 100, 90, {"bad_count": i * 5}, ["bad_count"], "pass", "pass", 1.0)
        for i in range(3)
    ]
    log = runlog.log_rows(spark, runs)
    assert [r.alerts for r in log.orderBy("executed_at").collect()] == [
        [],
        ["bad_count: 5.00% > 1% threshold"],
        ["bad_count: 10.00% > 1% threshold"],
    ]
    history = runlog.metric_history(log).orderBy("executed_at").collect()
    assert [(r.value, r.previous_value, r.change) for r in history] == [(0, None, None), (5, 0, 5), (10, 5, 5)]
    (latest,) = runlog.latest_runs(log).collect()
    assert latest.executed_at == at + timedelta(days=2)


values = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(-3, 3)),
        st.one_of(st.none(), st.sampled_from([-1.0, 0.0, 2.5, float("nan")])),
    ),
    max_size=30,
)
RULES = [
    {"id": "a_low", "policy": "drop", "condition": "a < 0"},
    {"id": "b_low", "policy": "drop", "condition": "b <= 0"},
    {"id": "a_missing", "policy": "drop", "condition": "a IS NULL"},
]


def contract_of(rules):
    return load(
        {
            "contract": {"name": "h", "version": "v1"},
            "columns": [{"name": "a", "type": "integer"}, {"name": "b", "type": "decimal"}],
            "quality_rules": rules,
        }
    )


@FEW
@given(values)
def test_accounting_holds_and_rule_order_does_not_matter(spark, rows):
    df = spark.createDataFrame(rows, "a int, b double")
    contract = contract_of(RULES)
    totals = quality.rule_totals(df, contract).head()
    assert totals.rows_read == totals.rows_written + totals.total_dropped + totals.undetermined_count == len(rows)
    assert quality.clean(df, contract).count() == totals.rows_written
    assert quality.quarantine(df, contract).count() == totals.total_dropped
    assert quality.undetermined(df, contract).count() == totals.undetermined_count
    counts = {r.rule_id: r.failed_count for r in quality.rule_counts(df, contract).collect()}
    turned = {r.rule_id: r.failed_count for r in quality.rule_counts(df, contract_of(RULES[::-1])).collect()}
    assert counts == turned
    assert max(counts.values()) <= totals.total_dropped <= sum(counts.values())
    assert all(r.failed_count == 0 for r in quality.violations(quality.clean(df, contract), contract).collect())


def test_one_changed_row_brings_few_rows_to_comparison(spark):
    """Of a key with 50,000 rows only those under the same leading bits of the hash are compared in full."""
    left = spark.range(100_000).selectExpr("id % 2 AS key", "id", "concat('row ', id) AS text").union(spark.sql("SELECT CAST(NULL AS BIGINT), 7L, 'x'"))
    right = left.withColumn("text", F.when(F.col("id") == 4242, "changed").otherwise(F.col("text")))
    prints = reconcile.reconcile_fingerprints(reconcile.table_fingerprint(left, ["key"]), reconcile.table_fingerprint(right, ["key"]), ["key"])
    assert 2 <= tree.differing_rows(left, right, ["key"], prints).count() < 10
    got = {r["key"]: (r["left_rows"], r["right_rows"], r["only_left"], r["only_right"], r["matches"]) for r in tree.reconcile_exact(left, right, ["key"]).collect()}
    assert got == {0: (50_000, 50_000, 1, 1, False), 1: (50_000, 50_000, 0, 0, True), None: (1, 1, 0, 0, True)}


@pytest.mark.parametrize("at_most", [5, 50])
def test_ranks_by_narrowing_are_those_of_a_sort(spark, monkeypatch, at_most):
    monkeypatch.setattr(quantiles, "SORTED_ROWS", at_most)
    draw = random.Random(3)
    cells = {"even": [draw.random() for _ in range(400)], "few": [draw.choice([1.0, 2.0, 2.0, 5.0]) for _ in range(300)], "one": [7.0] * 200}
    cells |= {"ends": [0.0] * 90 + [draw.random() for _ in range(20)] + [9.0] * 90, "nan": [float("nan")] * 60 + [1.5, 2.5, float("inf"), -float("inf")], None: [3.0, 1.0]}
    df = spark.createDataFrame([(s, v) for s, own in cells.items() for v in own] + [("even", None), ("void", None)], "s string, v double")
    ranks = {f"r{q}": F.ceil(F.col("n") * F.lit(q)) + 1 for q in (0.0, 0.1, 0.33, 0.5, 0.9, 0.99, 1.0)}
    found = {r["slice"]: r for r in quantiles.at_ranks(df, "s", ["v"], ranks).collect()}
    assert found.keys() == cells.keys()
    for name, own in cells.items():
        ordered = sorted(own, key=lambda v: (v != v, v))
        for q in (0.0, 0.1, 0.33, 0.5, 0.9, 0.99, 1.0):
            rank = math.ceil(len(own) * q) + 1
            want = ordered[rank - 1] if rank <= len(own) else None
            assert repr(found[name][f"r{q}"]) == repr(want), (name, q)


def test_a_planted_break_is_found(spark):
    start = date(2024, 1, 1)
    line = lambda k: 100 + 2 * k
    bent = lambda k: 100 + 2 * k - 5 * max(0, k - 40)
    rows = [(s, start + timedelta(days=k), f(k) + (k * 7919) % 5) for s, f in (("bent", bent), ("line", line)) for k in range(100) if k % 11]
    rows += [("short", start + timedelta(days=k), k) for k in range(9)] + [("one", start, 3)] + [("flat", start + timedelta(days=k), 5) for k in range(30)]
    got = {}
    for r in timeseries.trend_breaks(spark.createDataFrame(rows, "s string, day date, y long"), ["s"]).collect():
        got.setdefault(r["s"], []).append(r)
    breaks = {s: {r["break_day"] for r in own} for s, own in got.items()}
    assert abs((breaks["bent"].pop() - start).days - 40) <= 2 and all(breaks[s] == {None} for s in ("line", "short", "one", "flat"))
    assert all(abs(r["trend"] - r["y"]) < 4 for s in ("bent", "line", "one", "flat") for r in got[s])
    x = np.array([(r["day"] - start).days for r in got["bent"]], float)
    k = (got["bent"][0]["break_day"] - start).days
    design = np.column_stack([np.ones_like(x), x, np.maximum(0, x - k)])
    y = np.array([r["y"] for r in got["bent"]], float)
    assert np.allclose(design @ np.linalg.lstsq(design, y, rcond=None)[0], [r["trend"] for r in got["bent"]])
