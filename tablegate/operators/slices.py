"""Putting slices together: PRJ-1, SET-1 .. SET-3, DUP-1 and LOG-5.

De-duplication is one hash aggregate on the source columns. Copies collapse before the shuffle, so a row
repeated a billion times reaches its task as one row per map task, and the same aggregate yields the
copy counts that the accounting needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COPIES = "_copies"
CAST_LOSS = "_cast_loss"


def actual_name(df: DataFrame, name: str) -> str | None:
    """The input's own spelling of a column."""
    return next((c for c in df.columns if c.lower() == name.lower()), None)


def conform(df: DataFrame, targets: dict[str, str], count_loss: bool = False) -> DataFrame:
    """PRJ-1: cast the columns known to drift, whatever their spelling; a value that does not fit becomes NULL.

    With ``count_loss`` a column ``_cast_loss`` holds how many cells of the row changed value or became
    NULL by the cast (1.9 to 1, NaN to NULL).
    """
    types = dict(df.dtypes)
    casts: dict[str, Column] = {}
    losses: list[Column] = []
    for name, target in targets.items():
        column = actual_name(df, name)
        if column is None:
            continue
        source = F.col(f"`{column}`")
        casts[column] = source.try_cast(target).alias(column)
        if types[column] != target:
            back = source.try_cast(target).cast(types[column])
            losses.append((source.isNotNull() & (back.isNull() | (back != source))).cast("int"))
    kept = [casts.get(c, F.col(f"`{c}`")) for c in df.columns]
    if count_loss:
        kept.append(reduce(lambda a, b: a + b, losses, F.lit(0)).alias(CAST_LOSS))
    return df.select(*kept)


def cast_loss_count(df: DataFrame, targets: dict[str, str]) -> DataFrame:
    """How many cells ``conform`` would change: (rows_read, cast_loss_count)."""
    return conform(df, targets, count_loss=True).agg(
        F.count(F.lit(1)).alias("rows_read"), F.sum(CAST_LOSS).alias("cast_loss_count")
    )


def union_slices(parts: list[DataFrame]) -> DataFrame:
    """SET-1: union by name, no column may be missing; the first part's spelling of a name wins."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=False), parts)


def collapse_copies(df: DataFrame, metadata: list[str], lineage: str | None = None, sums: list[str] | None = None) -> DataFrame:
    """SET-2 (SET-3 without ``metadata``): one row per distinct source row, and its number of copies.

    ``metadata`` columns take no part in the comparison and are dropped, but for ``lineage``: the surviving row has the
    smallest one among its copies. It should be a number, such as a slice's, since the minimum of a string forces Spark
    from hash to sort aggregation. ``sums`` are added up over the copies.
    """
    sums = sums or []
    keys = [F.col(f"`{c}`") for c in df.columns if c not in {*metadata, *sums}]
    first = [F.min(lineage).alias(lineage)] if lineage is not None else []
    return df.groupBy(*keys).agg(*first, F.count(F.lit(1)).alias(COPIES), *[F.sum(s).alias(s) for s in sums])


def rows_per_slice(df: DataFrame, lineage: str) -> DataFrame:
    """LOG-5: how many rows of a table came from each slice."""
    return df.groupBy(lineage).agg(F.count(F.lit(1)).alias("row_count"))


def accounting_metrics() -> list[Column]:
    """DUP-1 as aggregates over collapsed rows."""
    return [
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_written"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("duplicates_removed"),
    ]


def ingest_accounting(collapsed: DataFrame) -> DataFrame:
    """DUP-1 in one row: rows read, rows written, duplicates removed."""
    return collapsed.agg(*accounting_metrics())
