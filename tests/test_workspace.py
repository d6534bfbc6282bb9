from __future__ import annotations

from pathlib import Path

from tablegate.plans import sinks
from tablegate.sources.workspace import fresh_path, release, shared_dir, work_folder


def test_work_goes_where_the_session_says_else_to_the_warehouse(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_work").rstrip("/")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_a_run_s_folder_is_released(spark, tmp_path):
    try:
        with work_folder(spark, "run") as path:
            spark.range(3).write.parquet(path)
            assert spark.read.parquet(path).count() == 3
            raise ValueError
    except ValueError:
        pass
    assert not release(spark, path)


def test_retired_versions_can_go_and_published_ones_stay(spark, tmp_path):
    first = sinks.overwrite_table(spark.range(3).toDF("id"), "versions_t", str(tmp_path))
    assert not sinks.remove_retired(spark, first)
    second = sinks.overwrite_table(spark.range(5).toDF("id"), "versions_t", str(tmp_path))
    assert sinks.remove_retired(spark, second) and not sinks.remove_retired(spark, second)
    assert spark.table("versions_t").count() == 5 and not Path(first.location).exists()
    spark.sql("DROP TABLE versions_t")
