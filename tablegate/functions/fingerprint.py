"""Row and table fingerprints for reconciliation (used by REC-1, SNK-3 and SRC-5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of a row.

    ``xxhash64`` skips NULLs, so (NULL, 1) and (1, NULL) would hash alike; hashing whether each value is
    NULL along with it keeps them apart.
    """
    parts: list[Column] = []
    for name in columns:
        value = F.col(f"`{name}`")
        parts += [value.isNull(), value]
    return F.xxhash64(*parts)


def fingerprint(columns: list[str]) -> list[Column]:
    """Order-independent aggregates of a row set: count, XOR of the hashes and their exact sum.

    XOR alone cancels even numbers of copies; the sum keeps them. Sixty-four-bit hashes summed as
    decimal(38,0) stay exact up to 10^19 rows.
    """
    h = row_hash(columns)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor(h).alias("hash_xor"),
        F.sum(h.cast("decimal(38,0)")).alias("hash_sum"),
    ]
