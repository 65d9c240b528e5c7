"""Grouped, tiered and rule-based imputation.

Fits share the passes of one selection (medians, quantile edges) or one count of
(group, value) pairs (modes) for the group and the global statistic (``ranks.py``):
no group's values and no column's distinct values meet in one task. Transforms
are size-checked lookup joins plus one ``coalesce`` chain. ``approx=True`` takes
a fixed-size quantile sketch in one pass instead of exact medians.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions import rules as R
from kiln.functions import text as T
from kiln.operators.base import Estimator, Model, ParamTable, Transformer, replace_columns
from kiln.operators.ranks import column_modes, column_quantiles, modes, quantiles


def medians(df: DataFrame, target: str, sets: Sequence[Sequence[str]], approx: bool = False) -> DataFrame:
    """(gs, keys.., _fill): the median of ``target`` in every group of every grouping set."""
    if not approx:
        return quantiles(df, [target], [0.5], sets, computed=True).withColumn("_fill", F.col("q")[0]).drop("column_name", "n", "q")
    keys = list(dict.fromkeys(k for s in sets for k in s))
    masks = [sum((k not in s) << (len(keys) - 1 - i) for i, k in enumerate(keys)) for s in sets]
    stats = df.groupingSets([list(s) for s in sets], *keys).agg(
        F.percentile_approx(F.col(target), 0.5, 10000).alias("_fill"), F.grouping_id(*keys).alias("_gid"))
    return stats.select(F.array_position(F.array(*[F.lit(m).cast("long") for m in masks]), F.col("_gid").cast("long")).cast("int").alias("gs"),
                        *keys, "_fill").withColumn("gs", F.col("gs") - 1)


def fill_tables(stats: DataFrame, sets: Sequence[Sequence[str]]) -> tuple[list[ParamTable], object]:
    """A lookup table for every grouping set with keys, and the value of the one without.

    Groups with a null key are left out (a null key never matches a lookup,
    exactly like a dictionary lookup on a missing key).
    """
    full = next((i for i, s in enumerate(sets) if not s), None)
    head = stats.limit(ParamTable.COLLECT_MAX_ROWS + 1).collect()
    tables = []
    if len(head) <= ParamTable.COLLECT_MAX_ROWS:
        for i, s in enumerate(sets):
            if s:
                rows = [tuple(r[c] for c in [*s, "_fill"]) for r in head if r["gs"] == i and all(r[k] is not None for k in s)]
                tables.append(ParamTable.from_rows(stats.sparkSession, rows, stats.select(*s, "_fill").schema, list(s)))
        return tables, next((r["_fill"] for r in head if r["gs"] == full), None)
    stats = stats.persist()
    for i, s in enumerate(sets):
        if s:
            tables.append(ParamTable(stats.filter(F.col("gs") == i).dropna(subset=list(s)).select(*s, "_fill"), list(s)))
    glob = stats.filter(F.col("gs") == full).select("_fill").first()
    stats.unpersist()
    return tables, (glob[0] if glob is not None else None)


# ----------------------------------------------------------------- I1 / I3

@dataclass
class GroupMedianImputer(Estimator):
    """Fill ``target`` with the median of its group, then the global median."""

    target: str = "engine_hp"
    by: Sequence[str] = ("brand",)
    global_fallback: bool = True
    approx: bool = False

    def fit(self, df: DataFrame) -> "LookupFillModel":
        sets = [list(self.by), []]
        tables, glob = fill_tables(medians(df, self.target, sets, self.approx), sets)
        return LookupFillModel(self.target, tables, glob if self.global_fallback else None)


@dataclass
class GroupModeImputer(Estimator):
    """I4: fill with the group mode, then the global mode, then ``default``.

    Modes skip nulls and break ties by the smallest value.
    """

    target: str = "fuel_type"
    by: Sequence[str] = ("brand",)
    default: str | None = R.FUEL_DEFAULT

    def fit(self, df: DataFrame) -> "LookupFillModel":
        sets = [list(self.by), []]
        stats = modes(df, [self.target], sets).withColumnRenamed("value", "_fill").drop("column_name", "n")
        tables, glob = fill_tables(stats, sets)
        return LookupFillModel(self.target, tables, glob if glob is not None else self.default)


@dataclass
class LookupFillModel(Model):
    """coalesce(target, tier_1, ..., tier_n, global)."""

    target: str
    tables: list
    global_value: object = None
    bin_model: object = None  # QuantileBinModel adding the ``_bin`` key, if a tier needs it

    def transform(self, df: DataFrame) -> DataFrame:
        cur = df if self.bin_model is None else self.bin_model.transform(df, out="_bin")
        fills = []
        for i, t in enumerate(self.tables):
            cur = t.renamed({"_fill": f"_fill{i}"}).lookup(cur)
            fills.append(F.col(f"_fill{i}"))
        if self.global_value is not None:
            fills.append(F.lit(self.global_value))
        filled = F.coalesce(F.col(self.target), *fills) if fills else F.col(self.target)
        return cur.select(*[filled.alias(c) if c == self.target else F.col(c) for c in df.columns])


# ----------------------------------------------------------------- I2

@dataclass
class EVRuleImputer(Transformer):
    """For EV brands fill missing displacement with 0.0 and missing fuel with ``Electric``."""

    brand: str = "brand"
    displacement: str = "engine_displacement"
    fuel: str | None = "fuel_type"

    def transform(self, df: DataFrame) -> DataFrame:
        ev = T.is_ev_brand(F.col(self.brand))
        new = {}
        if self.displacement in df.columns:
            d = F.col(self.displacement)
            new[self.displacement] = F.when(ev & d.isNull(), F.lit(0.0)).otherwise(d)
        if self.fuel and self.fuel in df.columns:
            f = F.col(self.fuel)
            new[self.fuel] = F.when(ev & f.isNull(), F.lit("Electric")).otherwise(f)
        return replace_columns(df, new)


# ----------------------------------------------------------------- I5

@dataclass
class QuantileBinner(Estimator):
    """K-quantile edges (linear interpolation, duplicates dropped);
    right-closed bins with the lowest edge included; outside -> null."""

    col: str = "engine_hp"
    n_bins: int = 15
    approx: bool = False

    def fit(self, df: DataFrame) -> "QuantileBinModel":
        qs = [i / self.n_bins for i in range(self.n_bins + 1)]
        found = (df.agg(F.percentile_approx(F.col(self.col), qs, 10000).alias("e")).first()["e"] if self.approx
                 else column_quantiles(df, [self.col], qs, computed=True)[self.col])
        return QuantileBinModel(self.col, sorted(set(found or [])))


@dataclass
class QuantileBinModel(Model):
    col: str
    edges: list = field(default_factory=list)

    def bin_expr(self) -> Column:
        x = F.col(self.col)
        if len(self.edges) < 2:
            return F.lit(None).cast("int")
        lo, hi = self.edges[0], self.edges[-1]
        inner = F.array(*[F.lit(float(e)) for e in self.edges])
        below = F.size(F.filter(inner, lambda e: e < x)) - 1
        return (F.when(x.isNull() | (x < lo) | (x > hi), F.lit(None).cast("int"))
                .when(x == lo, F.lit(0)).otherwise(below.cast("int")))

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        return df.withColumn(out or f"{self.col}_bin", self.bin_expr())


# ----------------------------------------------------------------- I6

@dataclass
class TieredBinImputer(Estimator):
    """EV rule, then (group, bin) median -> bin median -> global median.

    Bins are quantile bins of ``bin_source``; when it has no usable values
    only the global median is used.
    """

    target: str = "engine_displacement"
    by: str = "brand"
    bin_source: str = "engine_hp"
    n_bins: int = 15
    approx: bool = False

    def fit(self, df: DataFrame) -> "TieredBinModel":
        binner = (QuantileBinner(self.bin_source, self.n_bins, self.approx).fit(df)
                  if self.bin_source in df.columns else None)
        if binner is None or len(binner.edges) < 2:
            return TieredBinModel(self.target, self.by, None, [], fill_tables(medians(df, self.target, [[]], self.approx), [[]])[1])
        sets = [[self.by, "_bin"], ["_bin"], []]
        tables, glob = fill_tables(medians(binner.transform(df, out="_bin"), self.target, sets, self.approx), sets)
        return TieredBinModel(self.target, self.by, binner, tables, glob)


@dataclass
class TieredBinModel(Model):
    target: str
    by: str
    binner: QuantileBinModel | None
    tables: list
    global_value: object

    def transform(self, df: DataFrame) -> DataFrame:
        cur = EVRuleImputer(brand=self.by, displacement=self.target, fuel=None).transform(df)
        if self.binner is None or not self.tables:
            return replace_columns(cur, {self.target: F.coalesce(F.col(self.target), F.lit(self.global_value))})
        return LookupFillModel(self.target, self.tables, self.global_value, self.binner).transform(cur)


# ----------------------------------------------------------------- I7 / I8 / I9

def default_imputers(approx: bool = False) -> list:
    """I7 default order: hp by brand, EV rule, displacement by (brand, hp),
    fuel mode by brand, displacement by hp bins."""
    return [
        GroupMedianImputer("engine_hp", ("brand",), approx=approx),
        EVRuleImputer(),
        GroupMedianImputer("engine_displacement", ("brand", "engine_hp"), approx=approx),
        GroupModeImputer("fuel_type", ("brand",)),
        TieredBinImputer("engine_displacement", "brand", "engine_hp", 15, approx=approx),
    ]


@dataclass
class ConstantImputer(Estimator):
    """I8: per-column fill with a constant, or with the column mode (``"mode"``)."""

    fills: dict = field(default_factory=lambda: {"fuel_type": "mode", "accident": "None reported",
                                                 "clean_title": "No"})

    def fit(self, df: DataFrame) -> "ConstantFillModel":
        want_mode = [c for c, v in self.fills.items() if v == "mode" and c in df.columns]
        found = column_modes(df, {c: F.col(c) for c in want_mode}) if want_mode else {}
        values = {c: (found.get(c) if v == "mode" else v) for c, v in self.fills.items()}
        return ConstantFillModel({c: v for c, v in values.items() if v is not None})


@dataclass
class ConstantFillModel(Model):
    values: dict

    def transform(self, df: DataFrame) -> DataFrame:
        new = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.values.items() if c in df.columns}
        return replace_columns(df, new)


def grouped_fill(df: DataFrame, target: str, by: Sequence[str], approx: bool = False) -> DataFrame:
    """Fill ``target`` from its own table's group median, then global median.

    Same result as a per-group window median, computed as a group
    aggregate joined back so no group has to sit in a single task.
    """
    return GroupMedianImputer(target, tuple(by), approx=approx).fit(df).transform(df)
