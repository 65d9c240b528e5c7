"""A1-A4: standard, robust and min-max scaling with the zero-spread rules.

One aggregation fits every requested column that exists; the transform is
one projection. Spark ML's scalers differ on these rules (sample std,
approximate quantiles, constant -> midpoint), so they are not used.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.base import Estimator, Model, present, replace_columns
from kiln.operators.ranks import column_quantiles

DEFAULT_COLUMNS = ("brand", "model_year", "mileage_num", "engine_hp", "engine_displacement")
KINDS = ("standard", "robust", "minmax")


@dataclass
class Scaler(Estimator):
    """A4: scaler chosen by ``kind``, fitted on the subset of ``columns`` present.

    standard: (x - mean) / std_pop, std 0 -> 1
    robust:   (x - median) / (q75 - q25), iqr 0 -> 1
    minmax:   (x - min) / (max - min), range 0 -> 1
    """

    columns: Sequence[str] = DEFAULT_COLUMNS
    kind: str = "standard"
    approx: bool = False  # robust: fixed-size quantile sketch instead of exact percentiles

    def fit(self, df: DataFrame) -> "ScalerModel":
        if self.kind not in KINDS:
            raise ValueError(f"unknown scaler {self.kind!r}; expected one of {KINDS}")
        cols = present(df, self.columns)
        if not cols:
            return ScalerModel({})
        aggs = []
        for c in cols:
            x = F.col(c)
            if self.kind == "standard":
                aggs += [F.avg(x).alias(f"{c}__a"), F.stddev_pop(x).alias(f"{c}__b")]
            elif self.kind == "robust" and self.approx:
                aggs += [F.percentile_approx(x, [0.25, 0.5, 0.75], 10000).cast("array<double>").alias(f"{c}__q")]
            elif self.kind == "minmax":
                aggs += [F.min(x).alias(f"{c}__a"), F.max(x).alias(f"{c}__b")]
        row = (df.agg(*aggs).first() if aggs
               else {f"{c}__q": q for c, q in column_quantiles(df, cols, [0.25, 0.5, 0.75]).items()})
        params = {}
        for c in cols:
            if self.kind == "standard":
                center, spread = row[f"{c}__a"], row[f"{c}__b"]
            elif self.kind == "robust":
                q = row[f"{c}__q"]
                center, spread = (q[1], q[2] - q[0]) if q is not None else (None, None)
            else:
                center, spread = row[f"{c}__a"], (None if row[f"{c}__a"] is None
                                                  else row[f"{c}__b"] - row[f"{c}__a"])
            if spread is not None and spread == 0:
                spread = 1.0
            params[c] = (center, spread)
        return ScalerModel(params)


@dataclass
class ScalerModel(Model):
    params: dict

    def transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, (center, spread) in self.params.items():
            if c in df.columns and center is not None:
                new[c] = (F.col(c) - F.lit(float(center))) / F.lit(float(spread))
        return replace_columns(df, new)
