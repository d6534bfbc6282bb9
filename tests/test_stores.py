"""Footers in stores that pyarrow can and can't open, damage told apart from failing access, work tables."""

from __future__ import annotations

import os

import pytest
from pyarrow import fs

from tablegate.operators import schema
from tablegate.sources import manifest, slices, workspace
from tablegate.sources.stores import Store


@pytest.fixture
def mounted(spark, tmp_path):
    """A folder with slices, and the same through a scheme only Hadoop knows."""
    spark._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{tmp_path.name}.link./in", f"file://{tmp_path}")
    for k in range(12):
        spark.range(k, 2 * k + 1).selectExpr("id", "cast(id as string) AS name", *["id AS late"] * (k == 7)).coalesce(1).write.parquet(f"{tmp_path}/s{k:02d}")
    return str(tmp_path), f"viewfs://{tmp_path.name}/in"


def jobs_of(spark, name, function):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return function(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_footers_where_pyarrow_has_no_file_system(spark, mounted):
    near, far = mounted
    told = {}
    for at in mounted:
        rows = slices.footers(spark, [f"{at}/s{k:02d}" for k in range(12)]).collect()
        told[at] = sorted((r["path"].rsplit("/", 1)[-1], r["length"], r["_slice"], r["rows"], r["schema"], r["error"]) for r in rows)
    assert told[near] == told[far] and sorted(r[3] for r in told[far]) == list(range(1, 13))
    few, of_few = jobs_of(spark, "few", lambda: slices.footers(spark, [f"{far}/s{k:02d}" for k in range(2)]))
    many, of_many = jobs_of(spark, "many", lambda: slices.footers(spark, [f"{far}/s{k:02d}" for k in range(12)]))
    assert (few.count(), many.count()) == (2, 12) and of_many == of_few


def test_slices_of_both_stores_side_by_side(spark, mounted):
    near, far = mounted
    paths = [f"{near}/s01", f"{far}/s02", f"{far}/s03"]
    seen = {r["slice"]: r for r in manifest.slice_readability(spark, paths).collect()}
    assert {n: (r["rows_declared"], r["rows_decoded"], r["is_readable"]) for n, r in seen.items()} == {f"s{k:02d}": (k + 1, k + 1, True) for k in (1, 2, 3)}
    schemas = slices.read_schemas(spark, [f"{far}/s{k:02d}" for k in range(12)])
    drift = schema.drift_report(spark, schemas, ["id"]).collect()
    assert [(r["column_name"], r["slices_present"]) for r in drift] == [("late", ["s07"])]


def test_damage_is_not_failing_access(spark, mounted):
    near, far = mounted
    broken = next(f"{near}/s05/{n}" for n in os.listdir(f"{near}/s05") if n.endswith(".parquet"))
    whole = open(broken, "rb").read()
    for body in (b"", b"PAR1", whole[:-9], whole[:-8] + (10**6).to_bytes(4, "little") + b"PAR1", b"PAR1" + bytes(40) + (40).to_bytes(4, "little") + b"PAR1"):
        with open(broken, "wb") as f:
            f.write(body)
        os.path.exists(crc := f"{near}/s05/.{os.path.basename(broken)}.crc") and os.remove(crc)
        for at in mounted:
            seen = {r["slice"]: r for r in manifest.slice_readability(spark, [f"{at}/s04", f"{at}/s05"]).collect()}
            assert seen["s04"]["is_readable"] and not seen["s05"]["is_readable"]
            if not body:  # Spark lists no empty files: the slice has none
                continue
            with pytest.raises(ValueError, match="cannot be read"):
                slices.read_schemas(spark, [f"{at}/s04", f"{at}/s05"])

    def refused(n):
        raise PermissionError("403")

    with pytest.raises(PermissionError):
        slices.footer_of(refused)


def test_long_footers_take_a_second_read(spark, tmp_path):
    spark.range(3).selectExpr("id", *[f"id + {k} AS {'long_' * 30}{k}" for k in range(400)]).coalesce(1).write.parquet(f"{tmp_path}/wide")
    file = next(f"{tmp_path}/wide/{n}" for n in os.listdir(f"{tmp_path}/wide") if n.endswith(".parquet"))
    asked = []

    def tail(n):
        asked.append(n)
        return open(file, "rb").read()[-n:]

    rows, text, error = slices.footer_of(tail)
    assert (rows, error) == (3, None) and text.count("long_0") >= 0 and len(asked) == 2


def test_object_stores_take_hadoop_s_settings(spark):
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.s3a.access.key", "key")
    conf.set("fs.s3a.secret.key", "secret")
    conf.set("fs.s3a.bucket.own.endpoint", "http://store.local:9000")
    try:
        found = dict(conf.getPropsWithPrefix("fs.s3a."))
        assert found["access.key"] == "key"
        store = Store({f"fs.s3a.{k}": v for k, v in found.items()})
    finally:
        for name in ("access.key", "secret.key", "bucket.own.endpoint"):
            conf.unset(f"fs.s3a.{name}")
    system, place = store.opened("s3a://own/a%20b/c.parquet")
    assert isinstance(system, fs.S3FileSystem) and place == "own/a b/c.parquet"
    assert store.opened("s3a://other/x")[1] == "other/x" and not store.reaches("nobody://knows/this")
    assert isinstance(store.opened("file:///tmp/a%20b")[0], fs.LocalFileSystem) and store.opened("file:/tmp/a%20b")[1] == "/tmp/a b"


def test_work_tables_go_where_asked(spark):
    with workspace.released(spark):
        rows = workspace.kept(spark.range(5), "inside")
        place = rows.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
        assert rows.count() == 5 and os.path.isdir(place)
    outside = workspace.kept(spark.range(3), "outside")
    assert not os.path.exists(place) and outside.count() == 3
