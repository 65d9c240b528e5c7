"""The declared raw schema and column classes (plain data)."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType

RAW_COLUMNS = ("brand", "model", "model_year", "milage", "fuel_type", "engine", "transmission",
               "ext_col", "int_col", "accident", "clean_title", "price")
DECLARED_TYPES = {c: ("int64" if c == "model_year" else "str") for c in RAW_COLUMNS}
NUMERICAL_COLUMNS = ("model_year",)
CATEGORICAL_COLUMNS = ("brand", "model", "fuel_type", "engine", "transmission", "ext_col", "int_col",
                       "accident", "clean_title")
DIRTY_TEXT_COLUMNS = ("milage", "price")
SYSTEM_ID_COLUMN = "_id"

_SPARK = {"str": StringType(), "int64": LongType()}


def raw_schema(key: str | None = None) -> StructType:
    """Explicit StructType for reads (dirty text stays string)."""
    fields = [StructField(key, LongType(), True)] if key else []
    fields += [StructField(c, _SPARK[DECLARED_TYPES[c]], True) for c in RAW_COLUMNS]
    return StructType(fields)
