"""REC-1 by a tree of fingerprints, descended only where two tables differ.

Which parts differ is written down level by level: a small table whose size Spark knows, so that it is broadcast to the
rows where it is small, and they stay where they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablegate.functions.fingerprint import row_hash
from tablegate.operators.reconcile import reconcile_fingerprints, table_fingerprint
from tablegate.sources.workspace import kept

LEVEL_BITS, LEVELS = 10, 2  # branches of a node, and levels below a key, of the tree of fingerprints


def differing_rows(left: DataFrame, right: DataFrame, keys: list[str], prints: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The rows of both sides (``_l`` and ``_r`` say which) that must be compared in full.

    A tree of fingerprints by leading bits of the rows' hashes stands below every key, and is descended only where both
    sides differ: the first level splits the keys whose fingerprints (``prints``) differ into 1024 parts each, the second
    only those parts that differ, and so on. Of each level nothing but fingerprints is shuffled, and in the end the rows of
    the last parts that differ: about a millionth of a key for one changed row.
    """
    columns = [c for c in left.columns if c not in keys]
    hashed = lambda df, side: df.withColumn("_h", row_hash(columns)).withColumn("_l", F.lit(1 - side)).withColumn("_r", F.lit(side))
    rows = hashed(left, 0).unionByName(hashed(right, 1))
    part = F.lit(0).cast("long")
    differing = prints.filter(~F.col("matches")).select(*keys, part.alias("_part"))
    for level in range(levels + 1):
        known = differing.select(*[F.col(k).alias(f"_differing_{k}") for k in keys], F.col("_part").alias("_differing_part"))
        here = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_differing_{k}")) for k in keys], part == F.col("_differing_part"))
        rows = rows.join(known, here, "left_semi")
        if level == levels:
            break
        part = F.shiftrightunsigned("_h", 64 - LEVEL_BITS * (level + 1))
        own = rows.withColumn("_part", part).groupBy(*keys, "_part")
        sides = own.agg(
            *[F.sum(side).alias(f"{side}_rows") for side in ("_l", "_r")],
            *[F.bit_xor(F.when(F.col(side) == 1, F.col("_h"))).alias(f"{side}_xor") for side in ("_l", "_r")],
            *[F.sum(F.when(F.col(side) == 1, F.col("_h").cast("decimal(38,0)"))).alias(f"{side}_sum") for side in ("_l", "_r")],
        )
        same = reduce(lambda a, b: a & b, [F.col(f"_l_{x}").eqNullSafe(F.col(f"_r_{x}")) for x in ("rows", "xor", "sum")])
        differing = kept(sides.filter(~same).select(*keys, "_part"), "differing")
    return rows.drop("_h")


def reconcile_exact(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """REC-1 per key: rows on either side and how many of them the other side lacks.

    Fingerprints come first, a few numbers per key; then a tree of them (``differing_rows``), so that whole rows are
    shuffled only where these differ. Parts whose counts and both 64-bit hashes agree are taken as equal;
    ``row_differences`` compares every row.
    """
    columns = [c for c in left.columns if c not in keys]
    prints = kept(reconcile_fingerprints(table_fingerprint(left, keys, columns), table_fingerprint(right, keys, columns), keys), "prints")
    sides = differing_rows(left, right, keys, prints)
    copies = sides.groupBy(*[F.col(f"`{c}`") for c in left.columns]).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    surplus = F.col("_l") - F.col("_r")
    lacking = copies.groupBy(*keys).agg(
        F.sum(F.greatest(surplus, F.lit(0))).alias("only_left"), F.sum(F.greatest(-surplus, F.lit(0))).alias("only_right")
    )
    # Stacked and grouped rather than joined, as keys may be NULL.
    none = F.lit(None).cast("bigint")
    told = prints.select(*keys, "left_rows", "right_rows", none.alias("only_left"), none.alias("only_right"))
    told = told.unionByName(lacking.select(*keys, none.alias("left_rows"), none.alias("right_rows"), "only_left", "only_right"))
    found = told.groupBy(*keys).agg(*[F.coalesce(F.max(c), F.lit(0).cast("bigint")).alias(c) for c in ("left_rows", "right_rows", "only_left", "only_right")])
    return found.withColumn("matches", (F.col("only_left") == 0) & (F.col("only_right") == 0))
