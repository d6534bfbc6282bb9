"""Type families (SCH-1).

Width never counts as drift (int vs bigint, float vs double vs decimal); kind does (bigint vs double).
"""

from __future__ import annotations

from pyspark.sql import types as T

# Family names and the Spark type names each one covers.
FAMILIES = {
    "integer": {"byte", "short", "integer", "long"},
    "floating": {"float", "double", "decimal"},
    "boolean": {"boolean"},
    "string": {"string", "char", "varchar"},
    "timestamp_or_date": {"date", "timestamp", "timestamp_ntz"},
}
OTHER = "other"

# Business types a contract may declare, and the family each one stands for.
BUSINESS_TYPES = {
    "integer": "integer",
    "decimal": "floating",
    "timestamp": "timestamp_or_date",
}


def family_of(data_type: T.DataType) -> str:
    """SCH-1: the family a Spark type belongs to."""
    name = data_type.typeName()
    return next((family for family, members in FAMILIES.items() if name in members), OTHER)


def families_of(schema: T.StructType, fold_case: bool = False) -> dict[str, str]:
    """Column name to family, lower-casing the names where ``fold_case`` is set."""
    return {(f.name.lower() if fold_case else f.name): family_of(f.dataType) for f in schema}
