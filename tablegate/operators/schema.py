"""Schema checks: SCH-2 .. SCH-5.

Schemas are metadata, known on the driver before any row is read, so the gates are plain checks that
raise. The drift report is a DataFrame, because with many slices it is a table to query.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablegate.contract import Contract
from tablegate.functions.families import families_of

# Severities of a drift report.
CRITICAL, INFORMATIONAL = "critical", "informational"


class SchemaDriftError(ValueError):
    """A schema differs from what the table or its contract allows."""


Families = dict[str, str]  # of a schema's columns, names lower-cased


def distinct_schemas(schemas: dict[str, T.StructType]) -> tuple[list[Families], list[int]]:
    """The distinct schemas, and which of them each slice has, slices in order of their names.

    Schemas that differ in nothing but widths are one, so there are few, whatever the number of slices.
    """
    numbers: dict[tuple, int] = {}
    own = [numbers.setdefault(tuple(sorted(families_of(schemas[name], fold_case=True).items())), len(numbers)) for name in sorted(schemas)]
    return [dict(key) for key in numbers], own


def _deviating(spark: SparkSession, schemas: dict[str, T.StructType]) -> tuple[DataFrame, DataFrame]:
    """(schema_no, column_name, type_family), NULL where a schema lacks the column, of the columns that deviate, and
    (slice, slice_no, schema_no) of every slice, numbered from 1 in order of their names."""
    distinct, own = distinct_schemas(schemas)
    spread = {c: {f.get(c) for f in distinct} for c in sorted(set().union(*distinct))} if distinct else {}
    rows = [(no, c, families.get(c)) for c, found in spread.items() if len(found) > 1 for no, families in enumerate(distinct)]
    columns = [pa.array(sorted(schemas), pa.string()), pa.array(range(1, len(own) + 1), pa.int64()), pa.array(own, pa.int32())]
    slices = spark.createDataFrame(pa.table(columns, ["slice", "slice_no", "schema_no"]))
    return spark.createDataFrame(rows, "schema_no int, column_name string, type_family string"), slices


def _severity(required: list[str]) -> list[Column]:
    needed = [c.lower() for c in required]
    is_required = F.col("column_name").isin(needed) if needed else F.lit(False)
    return [is_required.alias("is_required"), F.when(is_required, CRITICAL).otherwise(INFORMATIONAL).alias("severity")]


def drift_bitmaps(spark: SparkSession, schemas: dict[str, T.StructType], required: list[str]) -> DataFrame:
    """SCH-2: (column_name, type_family, slices, first_slice, bitmaps, is_required, severity) of every column that deviates.

    A column deviates if its family differs between slices or some slice lacks it; a required one is ``critical``, any
    other ``informational``. There is a row per family of such a column, and one with a NULL family for the slices that
    lack it. ``bitmaps`` hold a bit for each slice, numbered from 1 in order of their names, in buckets of 32,768: bit i of
    bucket b is slice ``(b - 1) * 32768 + i + 1``.
    """
    odd, slices = _deviating(spark, schemas)
    wide = odd.join(slices, "schema_no")
    bucket, bit = F.bitmap_bucket_number("slice_no"), F.bitmap_bit_position("slice_no")
    parts = wide.groupBy("column_name", "type_family", bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(bit).alias("bitmap"), F.count(F.lit(1)).alias("slices"), F.min("slice").alias("first_slice")
    )
    whole = parts.groupBy("column_name", "type_family").agg(
        F.sum("slices").alias("slices"), F.min("first_slice").alias("first_slice"), F.array_sort(F.collect_list(F.struct("bucket", "bitmap"))).alias("bitmaps")
    )
    return whole.select("*", *_severity(required)).orderBy("severity", "column_name", "type_family")


def drift_report(spark: SparkSession, schemas: dict[str, T.StructType], required: list[str]) -> DataFrame:
    """SCH-2 with names: (column_name, slices_present, type_family_by_slice, is_required, severity), critical ones first.

    For reading; the names of all slices stand in a row, so for very many slices take ``drift_bitmaps``.
    """
    odd, slices = _deviating(spark, schemas)
    named = odd.filter("type_family IS NOT NULL").join(slices, "schema_no").groupBy("column_name")
    rows = named.agg(F.array_sort(F.collect_list(F.struct("slice", "type_family"))).alias("own"))
    own = [F.col("own.slice").alias("slices_present"), F.map_from_entries("own").alias("type_family_by_slice")]
    return rows.select("column_name", *own, *_severity(required)).orderBy("severity", "column_name")


def deviations(schemas: dict[str, T.StructType], allowed_drift: list[str]) -> list[tuple[str, str, str | None, str | None]]:
    """SCH-3: (slice or file, column, family or None, the first slice's family or None) wherever they differ.

    Families of columns in ``allowed_drift`` may differ; no column may be missing on either side.
    """
    known = {c.lower() for c in allowed_drift}
    families = {name: families_of(schema, fold_case=True) for name, schema in schemas.items()}
    baseline = next(iter(families.values()), {})
    return [
        (name, column, found.get(column), baseline.get(column))
        for name, found in families.items()
        for column in sorted(found.keys() | baseline.keys())
        if found.get(column) != baseline.get(column)
        and (column not in known or column not in found or column not in baseline)
    ]


def assert_uniform(schemas: dict[str, T.StructType], allowed_drift: list[str]) -> None:
    """SCH-3 as a gate: raises once, naming every deviation."""
    found = deviations(schemas, allowed_drift)
    if found:
        first = next(iter(schemas))
        told = [
            f"slice '{name}': column '{column}' is '{own or 'missing'}', but '{other or 'missing'}' in slice '{first}'"
            for name, column, own, other in found
        ]
        raise SchemaDriftError("; ".join(told))


def contract_compatibility(schema: T.StructType, contract: Contract) -> list[tuple[str, str, str, str | None, bool]]:
    """SCH-4: (column, declared type, expected family, family found or None, compatible) per business column.

    Names compare case-sensitively: the contract names the columns it publishes.
    """
    found = families_of(schema)
    return [
        (c.name, c.type, c.family, found.get(c.name), found.get(c.name) == c.family) for c in contract.business_columns
    ]


def assert_contract(schema: T.StructType, contract: Contract) -> None:
    """SCH-4 as a gate."""
    for name, declared, expected, actual, compatible in contract_compatibility(schema, contract):
        if not compatible:
            raise SchemaDriftError(
                f"column '{name}': declared '{declared}' (family '{expected}'), found family '{actual}'"
            )


def assert_exact_columns(schema: T.StructType, expected: list[str]) -> None:
    """SCH-5: the published table has exactly these columns, in this order."""
    if schema.names != expected:
        raise SchemaDriftError(f"published columns {schema.names} are not the contract's {expected}")
