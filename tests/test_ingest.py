from __future__ import annotations

from uuid import uuid4

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.operators import profile, schema, slices
from tablegate.operators.schema import SchemaDriftError
from tablegate.plans import ingest, quantiles, runlog, sinks
from tablegate.sources import manifest
from tablegate.sources import slices as landed
from tablegate.suite import fixtures as fx

DRIFT = {"n": "int"}


@pytest.fixture
def land(spark, tmp_path):
    """Write slices and return their paths."""

    def write(**frames):
        paths = []
        for name, frame in frames.items():
            paths.append(str(tmp_path / name))
            frame.coalesce(1).write.parquet(paths[-1])
        return paths

    return write


@pytest.fixture
def names():
    tag = uuid4().hex
    return f"landed.t_{tag}", f"landed.log_{tag}"


def old(spark, rows):
    return spark.createDataFrame(rows, "id bigint, n double, fee double")


def new(spark, rows):
    return spark.createDataFrame(rows, "id bigint, n bigint, Fee double")


def test_drifted_slices_become_one_table(spark, land, names):
    table, log = names
    paths = land(a=old(spark, [(1, 1.0, 0.5), (2, None, 0.5)]), b=new(spark, [(1, 1, 0.5), (3, 4, 0.0), (3, 4, 0.0)]))
    result = ingest.ingest(spark, paths, DRIFT, table, log)
    assert (result.rows_read, result.rows_written, result.duplicates_removed, result.cast_loss_count) == (5, 3, 2, 0)
    published = spark.table(table)
    assert published.dtypes == [
        ("id", "bigint"),
        ("n", "int"),
        ("fee", "double"),
        ("_source_file", "string"),
        ("_ingested_at", "timestamp"),
    ]
    assert sorted((r.id, r.n, r._source_file) for r in published.collect()) == [(1, 1, "a"), (2, None, "a"), (3, 4, "b")]
    assert published.select("_ingested_at").distinct().count() == 1
    row = spark.table(log).head()
    assert (row.pipeline_stage, row.status, row.rows_read) == ("bronze", "pass", 5)
    assert row.alerts == ["duplicates_removed: 40.00% > 1% threshold"]


def test_result_does_not_depend_on_the_order_of_slices(spark, land):
    paths = land(a=old(spark, [(1, 1.0, 0.5)]), b=new(spark, [(1, 1, 0.5), (2, 2, 0.0)]), c=new(spark, [(2, 2, 0.0)]))
    expected = {(1, 1, "a", 2), (2, 2, "b", 2)}
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        rows = ingest.collapsed_slices(spark, [paths[i] for i in order], DRIFT)
        assert {(r.id, r.n, r._source_file, r._copies) for r in rows.collect()} == expected


@pytest.mark.parametrize("many", [3, 80])
def test_names_do_not_depend_on_the_number_of_slices(spark, tmp_path, names, many):
    """Names with a space, one slice nested, one a file below another's folder name."""
    table, log = names
    rows = spark.range(many * 3).selectExpr("id", "id AS n", "0.5 AS fee", f"concat('trips ', lpad(id % {many}, 2, '0')) AS slice")
    for r in range(many):
        name = f"trips {r:02d}"
        own = rows.filter(F.col("slice") == name).drop("slice").coalesce(1)
        own.write.parquet(str(tmp_path / name / ("day=1/part" if r == 1 else "")))
    paths = [str(tmp_path / f"trips {r:02d}") for r in range(many)]
    result = ingest.ingest(spark, paths, {}, table, log)
    assert result.rows_read == result.rows_written == many * 3
    got = sorted((r.id, r._source_file) for r in spark.table(table).collect())
    assert got == [(i, f"trips {i % many:02d}") for i in range(many * 3)]


def test_a_file_of_no_slice_is_an_error(spark, land):
    paths = land(a=spark.range(3).toDF("id"), b=spark.range(3).toDF("id"))
    rows = spark.read.parquet(*paths).select(F.col("_metadata.file_path").alias("p"))
    with pytest.raises(Exception, match="a file of no slice"):
        landed.with_slice(rows, F.col("p"), paths[:1]).collect()


def test_every_file_of_a_slice_counts(spark, tmp_path):
    """Whichever file a reader would open first, a slice whose files differ fails the same way."""
    spark.createDataFrame([(1, 0.5)], "id bigint, amount double").coalesce(1).write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([(2,)], "id bigint").coalesce(1).write.mode("append").parquet(str(tmp_path / "a"))
    spark.createDataFrame([(3, 0.5)], "id bigint, amount double").write.parquet(str(tmp_path / "b"))
    paths = [str(tmp_path / "b"), str(tmp_path / "a")]
    schemas = landed.read_schemas(spark, paths)
    assert len(schemas) == 3 and list(schemas)[0] == "b"
    with pytest.raises(SchemaDriftError, match=r"slice 'a/part-.*parquet': column 'amount' is 'missing', but 'floating' in slice 'b'"):
        schema.assert_uniform(schemas, [])
    assert sum(s.count() for s in landed.scan_slices(spark, paths, schemas)) == 3


def test_one_damaged_file_among_four(spark, tmp_path):
    frame = spark.range(0, 400, 1, 4).selectExpr("id", "hash(id) AS n")
    for name in ("whole one", "footer", "page"):
        frame.write.parquet(str(tmp_path / name))
    for name, cut in (("footer", slice(-8, None)), ("page", slice(4, 60))):
        victim = sorted((tmp_path / name).glob("*.parquet"))[0]
        content = bytearray(victim.read_bytes())
        content[cut] = b"\x00" * len(content[cut])
        victim.write_bytes(bytes(content))
        for crc in (tmp_path / name).glob(".*.crc"):
            crc.unlink()
    paths = [str(tmp_path / n) for n in ("whole one", "footer", "page", "absent")]
    got = {r.slice: (r.files_listed, r.files_decoded, r.rows_decoded, r.is_readable) for r in manifest.slice_readability(spark, paths).collect()}
    assert got == {"whole one": (4, 4, 400, True), "footer": (4, 3, 300, False), "page": (4, 3, 300, False), "absent": (0, 0, 0, False)}
    status = {r.slice: r.verification_status for r in manifest.manifest_status(spark, list(got), paths).collect()}
    assert status == {"whole one": "verified", "footer": "incomplete", "page": "incomplete", "absent": "incomplete"}


def test_collapse_shuffles_once_and_hashes(spark, sf_dir):
    plan = ingest.collapsed_slices(spark, fx.weekly_extracts(spark, sf_dir), fx.DRIFT)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text


def test_lossy_casts_are_counted(spark, land, names):
    table, log = names
    paths = land(a=old(spark, [(1, 1.9, 0.0), (2, float("nan"), 0.0), (3, 3.0, 0.0), (4, None, 0.0)]))
    result = ingest.ingest(spark, paths, DRIFT, table, log)
    assert result.cast_loss_count == 2
    assert {r.id: r.n for r in spark.table(table).collect()} == {1: 1, 2: None, 3: 3, 4: None}


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda df: df.withColumn("extra", F.lit(1)), "slice 'b'.*extra"),
        (lambda df: df.drop("Fee"), "slice 'b'.*fee"),
        (lambda df: df.withColumn("Fee", F.col("Fee").cast("string")), "slice 'b'.*'fee' is 'string', but 'floating'"),
    ],
)
def test_unknown_drift_stops_the_ingest(spark, land, names, change, message):
    table, log = names
    paths = land(a=old(spark, [(1, 1.0, 0.5)]), b=change(new(spark, [(1, 1, 0.5)])))
    with pytest.raises(SchemaDriftError, match=message):
        ingest.ingest(spark, paths, DRIFT, table, log)
    assert ingest.ingest(spark, paths, DRIFT, table, log, on_schema_error=runlog.REPORT) is None
    assert [r.status for r in spark.table(log).collect()] == ["failed", "failed"]
    assert not spark.catalog.tableExists(table)


def test_width_and_case_are_not_drift(spark, land):
    narrow = spark.createDataFrame([(1, 2, 0.5)], "id int, n int, FEE float")
    paths = land(a=narrow, b=new(spark, [(1, 2, 0.5)]))
    schemas = landed.read_schemas(spark, paths)
    schema.assert_uniform(schemas, [])
    assert schema.drift_report(spark, schemas, ["id"]).count() == 0
    assert ingest.collapsed_slices(spark, paths, {}).count() == 1


def test_drift_report_lists_critical_columns_first(spark, land):
    paths = land(
        a=spark.createDataFrame([(1, 1.0, "x")], "id bigint, z_key double, a_note string"),
        b=spark.createDataFrame([(1, 1)], "id bigint, Z_Key bigint"),
    )
    schemas = landed.read_schemas(spark, paths)
    report = schema.drift_report(spark, schemas, ["id", "z_key"]).collect()
    assert [(r.column_name, r.severity, r.slices_present) for r in report] == [
        ("z_key", "critical", ["a", "b"]),
        ("a_note", "informational", ["a"]),
    ]
    assert report[0].type_family_by_slice == {"a": "floating", "b": "integer"}


def test_one_scan_per_schema(spark, sf_dir):
    paths = fx.weekly_extracts(spark, sf_dir)
    together = landed.scan_slices(spark, paths)
    got = {r[0]: r[1] for s in together for r in slices.rows_per_slice(s, "_source_file").collect()}
    assert len(together) == 2 and got == {landed.slice_name(p): spark.read.parquet(p).count() for p in paths}


def test_slices_of_one_name_are_refused(spark):
    with pytest.raises(ValueError, match="share a name"):
        landed.by_name(["/x/a", "/y/a"])


def test_slice_that_is_a_single_file_is_named_after_it(spark, sf_dir):
    (scan,) = landed.scan_slices(spark, [f"{sf_dir}/region.parquet"])
    assert {r[0] for r in scan.select("_source_file").collect()} == {"region.parquet"}


def test_empty_slice_is_ingested_and_profiled(spark, land):
    paths = land(a=old(spark, []), b=new(spark, [(1, 1, 0.5)]))
    assert ingest.collapsed_slices(spark, paths, DRIFT).count() == 1
    rows = ingest.conformed_slices(spark, paths, DRIFT).drop("_cast_loss")
    profiled = profile.profile(rows, "_source_file", ["n"], {"low": F.col("n") < 1}, ["fee"])
    whole = profile.with_empty_slices(spark, profiled, ["a", "b"])
    nulls = {r.slice: (r.null_count, r.null_pct) for r in profile.null_rows(whole, ["n"]).collect()}
    assert nulls == {"a": (0, 0.0), "b": (0, 0.0)}
    conditions = {r.slice: (r.matched_count, r.matched_pct) for r in profile.condition_rows(whole, ["low"]).collect()}
    assert conditions["a"] == (0, 0.0)
    quantiles = {r.slice: r.p50 for r in profile.quantile_rows(whole, ["fee"]).collect()}
    assert quantiles == {"a": None, "b": 0.5}


def test_nothing_but_empty_slices(spark, land, names):
    table, log = names
    result = ingest.ingest(spark, land(a=old(spark, []), b=new(spark, [])), DRIFT, table, log)
    assert (result.rows_read, result.rows_written, result.duplicates_removed, result.cast_loss_count) == (0, 0, 0, 0)
    assert spark.table(table).count() == 0 and spark.table(log).head().alerts == []


def test_quantile_rank_error_is_within_the_accuracy(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem").withColumn("s", F.lit("all"))
    row = profile.quantile_rows(profile.profile(lines, "s", [], {}, ["l_extendedprice"]), ["l_extendedprice"]).head()
    prices = sorted(r[0] for r in lines.select("l_extendedprice").collect())
    for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95), ("p99", 0.99)):
        below = sum(p < row[name] for p in prices)
        upto = sum(p <= row[name] for p in prices)
        slack = len(prices) * profile.RANK_ERROR + 1
        assert below - slack <= q * len(prices) <= upto + slack


@pytest.mark.parametrize("rows", [1, 2, 3, 5000])
def test_exact_quantiles_equal_numpy(spark, rows):
    """Most rows in one slice, a third of them one value, some missing, one measure missing throughout."""
    df = spark.range(rows).select(
        F.when(F.col("id") % 10 == 0, "small").otherwise("hot").alias("s"),
        F.when(F.col("id") % 3 == 0, 7.5).when(F.col("id") % 11 == 1, None).otherwise(F.hash("id") / 1e5).alias("a"),
        F.when(F.col("id") > 1, F.col("id") * F.col("id")).alias("b"),
        F.lit(None).cast("double").alias("none"),
    )
    got = {
        (r.slice, r.measure): [r.p25, r.p50, r.p75, r.p95, r.p99]
        for r in quantiles.exact_quantiles(df, "s", ["a", "b", "none"]).collect()
    }
    cells = {}
    for r in df.collect():
        for m in ("a", "b"):
            if r[m] is not None:
                cells.setdefault((r.s, m), []).append(float(r[m]))
    assert got.keys() == cells.keys()
    for key, found in got.items():
        assert found == pytest.approx(list(np.quantile(cells[key], profile.QUANTILES)), rel=1e-12)


def test_copy_is_verified_slice_by_slice(spark, land, tmp_path):
    paths = land(a=old(spark, [(1, 1.0, 0.5), (2, None, 0.5)]), b=new(spark, [(1, 1, 0.5), (1, 1, 0.5)]))
    result = sinks.verified_copy(spark, paths, str(tmp_path / "copy")).collect()
    assert sorted((r.slice, r.left_rows, r.right_rows, r.matches, r.safe_to_drop) for r in result) == [
        ("a", 2, 2, True, True),
        ("b", 2, 2, True, True),
    ]


def test_damaged_slices_are_found(spark, land, tmp_path):
    frame = spark.range(0, 200_000, 1, 1).selectExpr("id", "hash(id) AS n", "cast(id AS double) AS fee")
    paths = land(a=frame, b=frame, c=frame, d=frame.limit(0), e=frame)
    (damaged,) = (tmp_path / "b").glob("*.parquet")
    content = bytearray(damaged.read_bytes())
    content[1000:200_000] = b"\x00" * 199_000
    damaged.write_bytes(bytes(content))
    (beheaded,) = (tmp_path / "c").glob("*.parquet")
    beheaded.write_bytes(beheaded.read_bytes()[:-500])
    for crc in list((tmp_path / "b").glob(".*.crc")) + list((tmp_path / "c").glob(".*.crc")):
        crc.write_bytes(b"")
    readable = {r.slice: r.is_readable for r in manifest.slice_readability(spark, paths).collect()}
    assert readable == {"a": True, "b": False, "c": False, "d": True, "e": True}
    status = {
        r.slice: r.verification_status
        for r in manifest.manifest_status(spark, ["a", "b", "c", "d", "e", "f"], paths).collect()
    }
    assert status == {
        "a": "verified",
        "b": "incomplete",
        "c": "incomplete",
        "d": "incomplete",
        "e": "verified",
        "f": "incomplete",
    }


def test_one_slice_cannot_be_compared(spark, land):
    (path,) = land(a=spark.range(10).toDF("id"))
    (row,) = manifest.manifest_status(spark, ["a"], [path]).collect()
    assert (row.is_readable, row.is_outlier, row.verification_status) == (True, None, "undetermined")


def test_manifest_reads_no_content(spark, sf_dir):
    plan = manifest.file_manifest(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_shuffles_are_sized_by_the_input_and_restored(spark):
    before = spark.conf.get(sinks.SHUFFLE_PARTITIONS)
    with sinks.sized_shuffles(spark, 100 * 2**30):
        assert int(spark.conf.get(sinks.SHUFFLE_PARTITIONS)) == 2400
    with sinks.sized_shuffles(spark, 1000):
        assert spark.conf.get(sinks.SHUFFLE_PARTITIONS) == before
    assert spark.conf.get(sinks.SHUFFLE_PARTITIONS) == before


def test_drift_of_very_many_slices(spark):
    """A hundred thousand slices of three schemas: a bit for each, and no list of them."""
    kind = lambda x, more=(): T.StructType([T.StructField("id", T.LongType()), T.StructField("X", x), *more])
    usual, odd, wider = kind(T.IntegerType()), kind(T.DoubleType()), kind(T.LongType(), (T.StructField("late", T.StringType()),))
    schemas = {f"s{k:06d}": odd if k % 40_000 == 7 else wider if k >= 99_990 else usual for k in range(100_000)}
    found = {(r["column_name"], r["type_family"]): r for r in schema.drift_bitmaps(spark, schemas, ["x"]).collect()}
    assert {k: (r["slices"], r["first_slice"], r["severity"]) for k, r in found.items()} == {
        ("x", "floating"): (3, "s000007", "critical"),
        ("x", "integer"): (99_997, "s000000", "critical"),
        ("late", "string"): (10, "s099990", "informational"),
        ("late", None): (99_990, "s000000", "informational"),
    }
    bits = {(b["bucket"] - 1) * 32768 + i * 8 + j + 1 for b in found["x", "floating"]["bitmaps"] for i, byte in enumerate(b["bitmap"]) for j in range(8) if byte >> j & 1}
    assert bits == {8, 40_008, 80_008}
