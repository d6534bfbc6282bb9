"""Report texts: number text (PRJ-4) and the alert sentence used by LOG-2."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(column: str | Column, digits: int = 2) -> Column:
    """PRJ-4: 1234567.891 as ``1.234.567,89``."""
    value = F.col(column) if isinstance(column, str) else column
    return F.translate(F.format_number(value, digits), ",.", ".,")


def alert_text(name: Column, share: Column, threshold: float) -> Column:
    """``passenger_count_null_or_zero_count: 4.34% > 1% threshold``."""
    return F.format_string(f"%s: %.2f%% > {100 * threshold:g}%% threshold", name, share * 100)
