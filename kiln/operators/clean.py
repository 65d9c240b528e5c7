"""Cleaning rules for the dirty listing columns, fused into one projection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions import text as T
from kiln.operators.base import Transformer, replace_columns


@dataclass(frozen=True)
class ColumnRule:
    """``target = fn(source)``; ``drop_source`` removes the source column."""

    source: str
    target: str
    fn: Callable[[Column], Column]
    drop_source: bool = True


def price_rule() -> ColumnRule:
    return ColumnRule("price", "price_usd", T.clean_currency)


def mileage_rule() -> ColumnRule:
    return ColumnRule("milage", "mileage_num", T.clean_distance)


def fuel_type_rule() -> ColumnRule:
    return ColumnRule("fuel_type", "fuel_type", T.clean_junk, drop_source=False)


def clean_title_rule() -> ColumnRule:
    return ColumnRule("clean_title", "has_clean_title", T.yes_flag)


def default_rules() -> list[ColumnRule]:
    """C5 default chain: price, mileage, fuel type, clean title (in that order)."""
    return [price_rule(), mileage_rule(), fuel_type_rule(), clean_title_rule()]


@dataclass
class Cleaner(Transformer):
    """Apply column rules whose source exists; absent sources are skipped."""

    rules: Sequence[ColumnRule] = field(default_factory=default_rules)

    def transform(self, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        new, drop = {}, []
        for r in self.rules:
            if r.source not in have:
                continue
            new[r.target] = r.fn(F.col(r.source))
            if r.drop_source and r.source != r.target:
                drop.append(r.source)
        return replace_columns(df, new, drop)


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist (no-op otherwise)."""
    return df.drop(*[c for c in cols if c in df.columns])
