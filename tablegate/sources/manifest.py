"""What has landed: SRC-5, SRC-6, MAN-2 and MAN-3."""

from __future__ import annotations

from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegate.functions.fingerprint import row_hash
from tablegate.plans.outliers import TOLERANCE, leave_one_out
from tablegate.sources import slices as landed
from tablegate.sources.slices import SLICE, by_name, file_url, name_of
from tablegate.sources.stores import existing

# Verification states of a slice.
VERIFIED, INCOMPLETE, UNDETERMINED = "verified", "incomplete", "undetermined"


def file_manifest(spark: SparkSession, *locations: str, pattern: str = "*.parquet") -> DataFrame:
    """SRC-6: (path, length, modificationTime) of the files; their content is not read."""
    return landed.list_files(spark, list(locations), pattern).drop("url")


def slice_sizes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(slice, size_bytes, files) of the slices that hold at least one file."""
    there = existing(spark, paths)
    if not there:
        return spark.createDataFrame([], "slice string, size_bytes bigint, files bigint")
    listed = landed.with_slice(landed.list_files(spark, there), F.col("url"), there)
    sizes = listed.groupBy(SLICE).agg(F.sum("length").alias("size_bytes"), F.count(F.lit(1)).alias("files"))
    return sizes.select(name_of(F.col(SLICE), there).alias("slice"), "size_bytes", "files")


def file_readability(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(slice, path, rows_declared, rows_decoded) of every listed file, every value of every column decoded.

    Rows are declared by the footer, NULL where it can't be read. The decoding scan skips the rest of a file it cannot
    read, so a file is whole when both numbers agree.
    """
    told = landed.footers(spark, paths)
    schemas, files = landed.numbered_schemas(spark, told)
    found = files.groupBy(SLICE, "schema_no").agg(F.count("path").alias("files")).collect()
    schemas_of = Counter(r[SLICE] for r in found)
    names, places = sorted(by_name(paths)), by_name(paths)
    listed: dict[int, list[str]] = {}
    for r in found:
        if schemas_of[r[SLICE]] == 1:
            listed.setdefault(r["schema_no"], []).append(places[names[r[SLICE]]])
    mixed = [n for n, count in schemas_of.items() if count > 1]
    for r in files.filter(F.col(SLICE).isin(mixed)).select("path", "schema_no").collect() if mixed else []:
        listed.setdefault(r["schema_no"], []).append(r["path"])
    decoded = []
    for number, where in listed.items():
        reader = spark.read.schema(schemas[number]).option("ignoreCorruptFiles", "true").option("recursiveFileLookup", "true")
        hashed = row_hash(schemas[number].names)
        # A plain count would be answered without decoding; the sign of the hash needs every column.
        rows = reader.parquet(*where).groupBy(file_url(F.col("_metadata.file_path")).alias("file"))
        decoded.append(rows.agg((F.count_if(hashed >= 0) + F.count_if(hashed < 0)).alias("rows_decoded")))
    files = told.select(name_of(F.col(SLICE), paths).alias("slice"), "path", file_url(F.col("url")).alias("file"), F.col("rows").alias("rows_declared"))
    if not decoded:
        return files.select("slice", "path", "rows_declared", F.lit(0).cast("bigint").alias("rows_decoded"))
    files = files.join(reduce(DataFrame.unionByName, decoded), "file", "left")
    return files.select("slice", "path", "rows_declared", F.coalesce("rows_decoded", F.lit(0)).alias("rows_decoded"))


def slice_readability(spark: SparkSession, paths: list[str]) -> DataFrame:
    """SRC-5: (slice, files_listed, files_decoded, rows_declared, rows_decoded, is_readable).

    A slice is readable if it exists, holds a file, and every one of its files was decoded in full.
    """
    slices = spark.createDataFrame([(n,) for n in by_name(paths)], "slice string")
    counts = ["files_listed", "files_decoded", "rows_declared", "rows_decoded"]
    there = existing(spark, paths)
    if not there:
        return slices.select("slice", *[F.lit(0).cast("bigint").alias(c) for c in counts], F.lit(False).alias("is_readable"))
    whole = F.coalesce(F.col("rows_declared") == F.col("rows_decoded"), F.lit(False))
    seen = file_readability(spark, there).groupBy("slice").agg(
        F.count(F.lit(1)).alias("files_listed"),
        F.count_if(whole).alias("files_decoded"),
        F.coalesce(F.sum("rows_declared"), F.lit(0)).alias("rows_declared"),
        F.sum("rows_decoded").alias("rows_decoded"),
    )
    known = slices.join(seen, "slice", "left")
    readable = F.coalesce(F.col("files_listed") == F.col("files_decoded"), F.lit(False))
    return known.select("slice", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], readable.alias("is_readable"))


def manifest_status(
    spark: SparkSession, expected: list[str], paths: list[str], tolerance: float = TOLERANCE
) -> DataFrame:
    """MAN-2: verification state of every expected slice; ``paths`` are where the slices should have landed.

    ``verified`` means landed, not empty on disk, of a size in line with the others, and readable; where the
    size cannot be compared because no other slice landed, the state is ``undetermined``. A path that does not exist
    is size 0 and ``incomplete``.
    """
    sizes = leave_one_out(slice_sizes(spark, paths), "size_bytes", tolerance)
    slices = spark.createDataFrame([(n,) for n in expected], "slice string")
    joined = slices.join(sizes, "slice", "left").join(slice_readability(spark, paths), "slice", "left")
    landed_bytes = F.coalesce(F.col("size_bytes"), F.lit(0)) > 0
    status = (
        F.when(~landed_bytes | ~F.coalesce("is_readable", F.lit(False)) | F.col("is_outlier"), INCOMPLETE)
        .when(F.col("is_outlier").isNull(), UNDETERMINED)
        .otherwise(VERIFIED)
    )
    return joined.select(
        "slice",
        F.coalesce(F.col("size_bytes"), F.lit(0)).alias("size_bytes"),
        F.coalesce(F.col("rows_decoded"), F.lit(0)).alias("row_count"),
        "is_outlier",
        F.coalesce(F.col("is_readable"), F.lit(False)).alias("is_readable"),
        status.alias("verification_status"),
    )


def out_of_proportion(slices: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """MAN-3 over (slice, row_count, size_bytes): adds ``bytes_per_row``, ``median_of_others`` and ``is_outlier``."""
    each = slices.withColumn("bytes_per_row", F.try_divide(F.col("size_bytes"), F.col("row_count")))
    return leave_one_out(each, "bytes_per_row", tolerance)


def bytes_per_row(spark: SparkSession, paths: list[str], tolerance: float = TOLERANCE) -> DataFrame:
    """MAN-3: slices whose bytes per row are out of line with the others; only footers are read."""
    sums = landed.footers(spark, paths).groupBy(SLICE)
    sums = sums.agg(F.sum("rows").alias("row_count"), F.sum("length").alias("size_bytes"))
    return out_of_proportion(sums.select(name_of(F.col(SLICE), paths).alias("slice"), "row_count", "size_bytes"), tolerance)
