"""Calendar predicates and keys (FLT-8, FLT-9, and the calendar scalars of section 2.9)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_window(column: str, start: str, end: str) -> Column:
    """Half-open test ``start <= column < end``."""
    return (F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end))


def out_of_window(columns: list[str], start: str, end: str) -> Column:
    """FLT-8: TRUE where any of the timestamps lies outside the half-open window."""
    inside = in_window(columns[0], start, end)
    for column in columns[1:]:
        inside = inside & in_window(column, start, end)
    return ~inside


def in_month(column: str, year: int, month: int) -> Column:
    """FLT-9 as a range, so that both bounds reach the Parquet scan as pushed filters."""
    first = date(year, month, 1)
    following = date(year + month // 12, month % 12 + 1, 1)
    return in_window(column, f"{first} 00:00:00", f"{following} 00:00:00")


def in_month_by_parts(column: str, year: int, month: int) -> Column:
    """FLT-9 as written in the analysis SQL; same rows, but only IS NOT NULL is pushed down."""
    return (F.year(column) == year) & (F.month(column) == month)


def month_start(column: str) -> Column:
    """First day of the month; grouping by it and naming the groups later is cheaper than naming every row."""
    return F.trunc(F.to_date(column), "month")


def month_name(start: Column) -> Column:
    """2024-01 for the first day of a month."""
    return F.date_format(start, "yyyy-MM")


def day_key(column: str) -> Column:
    return F.to_date(column)


def hour_key(column: str) -> Column:
    return F.hour(column)
