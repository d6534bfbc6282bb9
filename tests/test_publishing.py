"""Replacing tables and slices under readers' eyes, and appending from several sides."""

from __future__ import annotations

import os
import threading
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tablegate.plans import runlog, sinks


@pytest.fixture
def table(spark):
    name = f"t_{uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_readers_never_find_the_name_unbound(spark, table, tmp_path):
    version = lambda k: spark.range(100).select(F.lit(k).alias("version"), "id")
    sinks.overwrite_table(version(0), table, str(tmp_path))
    stop, seen, wrong = threading.Event(), set(), []

    def read():
        while not stop.is_set():
            try:
                found = spark.table(table).groupBy("version").count().collect()
                seen.update(r["version"] for r in found)
                wrong.extend(found if [r["count"] for r in found] != [100] else [])
            except Exception as error:
                wrong.append(error)

    readers = [threading.Thread(target=read) for _ in range(2)]
    [r.start() for r in readers]
    for k in range(1, 7):
        sinks.overwrite_table(version(k), table, str(tmp_path))
    stop.set()
    [r.join() for r in readers]
    assert not wrong and len(seen) > 1


def test_columns_may_be_added_described_moved_and_dropped(spark, table, tmp_path):
    first = sinks.overwrite_table(spark.range(3).toDF("a"), table, str(tmp_path))
    told = spark.range(2).select(F.col("id").alias("a", metadata={"comment": "it's a \\ number"}), F.lit("x").alias("b"))
    second = sinks.overwrite_table(told, table, str(tmp_path))
    assert second.previous_location.endswith(first.location.split("/")[-1])
    assert [(r["column_name"], r["description"]) for r in sinks.published_columns(spark, table).collect()] == [("a", "it's a \\ number"), ("b", None)]
    assert sorted(map(tuple, spark.table(table).collect())) == [(0, "x"), (1, "x")]
    sinks.overwrite_table(spark.range(1).select(F.lit("y").alias("b"), "id"), table, str(tmp_path))
    assert [tuple(r) for r in spark.table(table).collect()] == [("y", 0)]

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError):
        sinks.overwrite_table(spark.range(9).select(F.lit("z").alias("b"), "id"), table, str(tmp_path), check=refuse)
    assert spark.table(table).count() == 1
    own = spark.table(table)
    sinks.overwrite_table(own.unionAll(own), table, str(tmp_path))
    assert spark.table(table).count() == 2


def test_one_slice_is_replaced_and_others_keep_their_files(spark, table, tmp_path):
    rows = spark.range(30).select("id", F.concat(F.lit("month=2023-0"), F.col("id") % 3).alias("slice"))
    sinks.replace_slices(rows, table, "slice", str(tmp_path))
    files = lambda: {f: os.stat(f).st_mtime_ns for d, _, names in os.walk(tmp_path) for f in (os.path.join(d, n) for n in names)}
    before = files()
    again = spark.range(5).select((F.col("id") + 100).alias("id"), F.lit("month=2023-01").alias("slice"))
    done = sinks.replace_slices(again.unionAll(again.limit(1).withColumn("slice", F.lit("it's new/ok"))), table, "slice", str(tmp_path))
    assert done.keys() == {"month=2023-01", "it's new/ok"} and done["it's new/ok"].previous_location is None
    assert {r["slice"]: r["count"] for r in spark.table(table).groupBy("slice").count().collect()} == {"month=2023-00": 10, "month=2023-01": 5, "month=2023-02": 10, "it's new/ok": 1}
    after = files()
    assert before.items() <= after.items()
    own = spark.table(table).filter("slice = 'month=2023-02'")
    sinks.replace_slices(own.filter("id > 10"), table, "slice", str(tmp_path))
    assert spark.table(table).filter("slice = 'month=2023-02'").count() == 7 and spark.table(table).count() == 23
    assert sinks.replace_slices(own.limit(0), table, "slice", str(tmp_path)) == {}
    with pytest.raises(ValueError):
        sinks.replace_slices(own.withColumn("more", F.lit(1)), table, "slice", str(tmp_path))


def test_two_first_appends_at_once(spark, table, tmp_path):
    barrier, failed = threading.Barrier(4), []

    def append(k):
        try:
            barrier.wait()
            sinks.append_table(spark.range(3).select(F.lit(k).alias("writer"), "id"), table, str(tmp_path))
        except Exception as error:
            failed.append(error)

    writers = [threading.Thread(target=append, args=(k,)) for k in range(4)]
    [w.start() for w in writers]
    [w.join() for w in writers]
    assert not failed
    assert {r["writer"]: r["count"] for r in spark.table(table).groupBy("writer").count().collect()} == dict.fromkeys(range(4), 3)


def test_what_is_staged_is_not_seen(spark, table, tmp_path):
    sinks.append_table(spark.range(3), table, str(tmp_path))
    spark.range(50).write.parquet(f"{sinks.table_location(spark, table)}/_staged-left-by-a-dead-run")
    spark.catalog.refreshTable(table)
    assert spark.table(table).count() == 3
    with pytest.raises(ValueError):
        sinks.append_table(spark.range(3).toDF("other"), table, str(tmp_path))


def test_runs_that_log_at_once_all_stand_in_the_log(spark, table, tmp_path):
    def run(k):
        with runlog.logged_run(spark, f"stage{k}", table, str(tmp_path)) as own:
            own.rows_read = k

    runs = [threading.Thread(target=run, args=(k,)) for k in range(3)]
    [r.start() for r in runs]
    [r.join() for r in runs]
    assert sorted(r["rows_read"] for r in spark.table(table).collect()) == [0, 1, 2]
    assert runlog.prune_log(spark, table, "rows_read = 1", str(tmp_path)).table == table
    with runlog.logged_run(spark, "later", table, str(tmp_path)) as own:
        own.rows_read = 9
    assert sorted(r["rows_read"] for r in spark.table(table).collect()) == [0, 2, 9]


def test_a_copy_that_stopped_goes_on_where_it_was(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "landed", str(tmp_path / "copy")
    for k in range(4):
        spark.range(10 * k).selectExpr("id", *["CAST(id AS STRING) AS late"] * (k == 3)).repartition(2).write.parquet(f"{source}/s {k}")
    paths = [f"{source}/s {k}" for k in range(4)]
    real, copied = sinks._copied_together, []

    def watched(spark, files, *rest):
        if len(copied) == 3:
            raise OSError("the machine is gone")
        copied.append([f["url"] for f in files])
        real(spark, files, *rest)

    monkeypatch.setattr(sinks, "_copied_together", watched)
    with pytest.raises(OSError):
        sinks.verified_copy(spark, paths, target, batch_bytes=1)
    assert sinks.copied_files(spark, target).count() == 3
    before = sum(copied, [])
    copied.clear()
    copied_now = []
    monkeypatch.setattr(sinks, "_copied_together", lambda spark, files, *rest: (copied_now.extend(f["url"] for f in files), real(spark, files, *rest)))
    told = {r["slice"]: r for r in sinks.verified_copy(spark, paths, target).collect()}
    assert {n: (r["left_rows"], r["right_rows"], r["matches"], r["safe_to_drop"]) for n, r in told.items()} == {f"s {k}": (10 * k, 10 * k, True, True) for k in range(4)}
    assert not {*before} & {*copied_now} and len(before) + len(copied_now) == sinks.copied_files(spark, target).count()
    rows = [r for f in sinks.copied_files(spark, target).collect() if f["rows"] for r in spark.read.parquet(f["copy"]).select("id").collect()]
    assert len(rows) == 60
    copied_now.clear()
    spark.range(5).coalesce(1).write.mode("append").parquet(paths[1])  # one file more: only that is missing
    again = {r["slice"]: r["right_rows"] for r in sinks.verified_copy(spark, paths, target).collect()}
    assert again["s 1"] == 15 and len(copied_now) == 1


def test_a_copy_that_differs_is_not_entered(spark, tmp_path, monkeypatch):
    spark.range(8).coalesce(1).write.parquet(f"{tmp_path}/s")
    real = sinks.table_fingerprint
    calls = []

    def wrong(df, keys, columns):
        calls.append(1)
        return real(df.filter("id <> 3") if len(calls) == 2 else df, keys, columns)

    monkeypatch.setattr(sinks, "table_fingerprint", wrong)
    told = sinks.verified_copy(spark, [f"{tmp_path}/s"], f"{tmp_path}/copy").collect()[0]
    assert (told["left_rows"], told["right_rows"], told["matches"], told["safe_to_drop"]) == (8, 0, False, False)
    assert sinks.verified_copy(spark, [f"{tmp_path}/s"], f"{tmp_path}/copy").collect()[0]["safe_to_drop"]
