"""Slices added one by one against all at once."""

from __future__ import annotations

from uuid import uuid4

import pytest

from tablegate.operators.schema import SchemaDriftError
from tablegate.plans import incremental, ingest, sinks

COLUMNS = "id int, amount double, note string"


@pytest.fixture
def names(spark):
    made = [f"t_{uuid4().hex}" for _ in range(3)]
    yield made
    for name in (*made, incremental.index_name(made[0])):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def land(spark, path, rows, columns=COLUMNS):
    spark.createDataFrame(rows, columns).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.select("id", "amount", "note", "_source_file").collect())


def test_slices_one_by_one_are_all_at_once(spark, tmp_path, names):
    table, log, whole = names
    nan = float("nan")
    slices = [
        [(1, 1.0, "a"), (1, 1.0, "a"), (2, nan, None), (3, 0.0, "z")],
        [(1, 1.0, "a"), (2, nan, None), (3, -0.0, "z"), (4, None, None)],
        [(1, 1.0, "b"), (4, None, None), (4, None, None), (5, 2.5, "e")],
        [(1, 1.0, "a"), (5, 2.5, "e")],
    ]
    paths = [land(spark, f"{tmp_path}/s{k}", rows) for k, rows in enumerate(slices)]
    results = [incremental.add_slice(spark, p, {"id": "int"}, table, log, str(tmp_path / "tables")) for p in paths]
    ingest.ingest(spark, paths, {"id": "int"}, whole, log, str(tmp_path / "tables"))
    assert rows_of(spark.table(table)) == rows_of(spark.table(whole))
    assert [(r.rows_read, r.rows_written, r.duplicates_removed) for r in results] == [(4, 3, 1), (4, 1, 3), (4, 2, 2), (2, 0, 2)]
    assert sinks.slice_locations(spark, table).keys() == {"s0", "s1", "s2"}


def test_a_slice_that_lands_again_replaces_itself(spark, tmp_path, names):
    table, log, _ = names
    root = str(tmp_path / "tables")
    a, b = land(spark, f"{tmp_path}/a", [(1, 1.0, "a"), (2, 2.0, "b")]), land(spark, f"{tmp_path}/b", [(2, 2.0, "b"), (3, 3.0, "c")])
    for path in (a, b):
        incremental.add_slice(spark, path, {}, table, log, root)
    others = sinks.slice_locations(spark, table)["b"]
    land(spark, a, [(1, 1.5, "a"), (3, 3.0, "c")])
    again = incremental.add_slice(spark, a, {}, table, log, root)
    assert (again.rows_read, again.rows_written) == (2, 1) and sinks.slice_locations(spark, table)["b"] == others
    assert rows_of(spark.table(table)) == ["(1, 1.5, 'a', 'a')", "(3, 3.0, 'c', 'b')"]
    land(spark, a, [(3, 3.0, "c")])
    assert incremental.add_slice(spark, a, {}, table, log, root).rows_written == 0
    assert rows_of(spark.table(table)) == ["(3, 3.0, 'c', 'b')"]


def test_equal_fingerprints_alone_make_no_copy(spark):
    fresh = spark.createDataFrame([(7, 1, "x", "new", 1, 0), (7, 2, "y", "new", 1, 0), (8, 3, "z", "new", 1, 0)], "_print long, id int, note string, _source_file string, _copies long, _cast_loss long")
    published = spark.createDataFrame([(1, "x", "old"), (9, "w", "old")], "id int, note string, _source_file string")
    from unittest.mock import patch

    from pyspark.sql import functions as F

    with patch.object(incremental, "row_hash", lambda columns: F.lit(7).cast("long")):  # every row collides
        index = spark.createDataFrame([(7, "old"), (7, "new")], "_print long, slice string")
        got = incremental.new_rows(fresh, published, index, ["id", "note"], "new")
        assert sorted(r["id"] for r in got.collect()) == [2, 3]


def test_other_columns_are_an_error(spark, tmp_path, names):
    table, log, _ = names
    root = str(tmp_path / "tables")
    incremental.add_slice(spark, land(spark, f"{tmp_path}/a", [(1, 1.0, "a")]), {}, table, log, root)
    odd = land(spark, f"{tmp_path}/b", [(1, "1.0", "a")], "id int, amount string, note string")
    with pytest.raises(SchemaDriftError, match="amount"):
        incremental.add_slice(spark, odd, {}, table, log, root)
    assert incremental.add_slice(spark, odd, {}, table, log, root, on_schema_error="report") is None
    wide = land(spark, f"{tmp_path}/c", [("a", 1, 1.0)], "NOTE string, ID long, amount double")
    assert incremental.add_slice(spark, wide, {}, table, log, root).rows_written == 0
