"""V1-V4: schema checks against the declared spec.

V1-V3 read only ``df.schema`` (no job). V4 adds a one-aggregation count of
values per column that fail a coercing parse.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from kiln.functions import text as T
from kiln.sources import spec as S

_TYPES = {"str": StringType(), "int64": LongType()}


def column_count_ok(df: DataFrame, declared: Sequence[str] = S.RAW_COLUMNS) -> bool:
    """V1: number of columns equals the declared count."""
    return len(df.columns) == len(declared)


def missing_columns(df: DataFrame, classes: Mapping[str, Sequence[str]] | None = None) -> list[tuple[str, str]]:
    """V2: (class, column) for every declared column not present."""
    classes = classes or {"numerical": S.NUMERICAL_COLUMNS, "categorical": S.CATEGORICAL_COLUMNS}
    have = set(df.columns)
    return [(k, c) for k, cols in classes.items() for c in cols if c not in have]


@dataclass
class ValidationResult:
    ok: bool
    messages: list = field(default_factory=list)

    def message(self) -> str:
        return "; ".join(self.messages)

    def frame(self, spark: SparkSession) -> DataFrame:
        """K4 report row ``(validation_status, message)``."""
        return spark.createDataFrame([(self.ok, self.message())], "validation_status boolean, message string")

    def raise_if_failed(self) -> None:
        if not self.ok:
            raise ValueError(f"data validation failed: {self.message()}")


def validate(parts: Mapping[str, DataFrame], declared: Sequence[str] = S.RAW_COLUMNS,
             classes: Mapping[str, Sequence[str]] | None = None) -> ValidationResult:
    """V3: column count and presence for every named part (train/test)."""
    msgs = []
    for name, df in parts.items():
        if not column_count_ok(df, declared):
            msgs.append(f"{name}: expected {len(declared)} columns, found {len(df.columns)}")
        miss = missing_columns(df, classes)
        if miss:
            msgs.append(f"{name}: missing " + ", ".join(f"{k} column {c}" for k, c in miss))
    return ValidationResult(not msgs, msgs)


REASONS, QUARANTINE = "_reasons", "_quarantined"


def row_reasons(df: DataFrame, declared: Mapping[str, str] = S.DECLARED_TYPES, numeric_text: Sequence[str] = S.DIRTY_TEXT_COLUMNS,
                required: Sequence[str] = ("brand", "price")) -> Column:
    """Array of what is wrong with a row: ``missing <column>`` for required columns without a value, ``unparsable
    <column>`` for numbers that don't parse. Columns that the table lacks are the schema check's business."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required if c in df.columns]
    for c in declared:
        if c not in df.columns:
            continue
        if c in numeric_text:
            parsed = T.clean_currency(F.col(c)) if c == "price" else T.clean_distance(F.col(c))
        elif declared[c] == "int64":
            parsed = F.col(c).cast("string").try_cast("bigint")
        else:
            continue
        checks.append(F.when(F.col(c).isNotNull() & parsed.isNull(), F.lit(f"unparsable {c}")))
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def route_rows(df: DataFrame, **options) -> DataFrame:
    """V4, enforcing: every row with ``_reasons`` and ``_quarantined`` (any reason), in one lazy pass."""
    return df.withColumn(REASONS, row_reasons(df, **options)).withColumn(QUARANTINE, F.size(REASONS) > 0)


def accept_rows(df: DataFrame, quarantine_path: str, **options) -> DataFrame:
    """V4, enforcing: rows without a reason; the others are written, reasons included, to ``quarantine_path``.

    Every row is in exactly one of the two."""
    routed = route_rows(df, **options)
    routed.filter(QUARANTINE).drop(QUARANTINE).write.mode("overwrite").parquet(quarantine_path)
    return routed.filter(~F.col(QUARANTINE)).drop(REASONS, QUARANTINE)


def castability(df: DataFrame, declared: Mapping[str, str] = S.DECLARED_TYPES,
                numeric_text: Sequence[str] = S.DIRTY_TEXT_COLUMNS) -> DataFrame:
    """V4: per declared column: type matches, non-null count, and for numeric
    text columns the count of values that do not parse as numbers after
    stripping currency/distance decorations."""
    cols = [c for c in declared if c in df.columns]
    aggs = []
    for c in cols:
        aggs.append(F.count(F.col(c)).alias(f"{c}__n"))
        if c in numeric_text:
            parsed = T.clean_currency(F.col(c)) if c == "price" else T.clean_distance(F.col(c))
            aggs.append(F.count(F.when(F.col(c).isNotNull() & parsed.isNull(), F.lit(1))).alias(f"{c}__bad"))
        elif declared[c] == "int64":
            aggs.append(F.count(F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast("bigint").isNull(),
                                       F.lit(1))).alias(f"{c}__bad"))
        else:
            aggs.append(F.lit(0).cast("bigint").alias(f"{c}__bad"))
    wide = df.agg(*aggs)
    types = {f.name: f.dataType for f in df.schema.fields}
    stack = ", ".join(f"'{c}', '{declared[c]}', {str(types[c] == _TYPES[declared[c]]).lower()}, "
                      f"`{c}__n`, `{c}__bad`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) AS (column_name, declared_type, type_ok, "
                           f"n_non_null, n_unparsable)")
