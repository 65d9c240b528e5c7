"""IQR bounds and clipping, log transforms, outlier report, range filter.

All bound fits for all columns share the passes of one selection (exact linear
percentiles, ``ranks.py``; ``approx=True`` takes a fixed-size sketch in one pass).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.operators.base import Estimator, Model, Transformer, present, replace_columns
from kiln.operators.ranks import column_quantiles


def iqr_bounds(df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False, computed: bool = False) -> dict:
    """O1: {column: (lower, upper)} with lower = q1 - k*iqr, upper = q3 + k*iqr (``computed``: see ``ranks.quantiles``)."""
    cols = present(df, columns)
    if not cols:
        return {}
    row = (df.agg(*[F.percentile_approx(F.col(c), [0.25, 0.75], 10000).alias(c) for c in cols]).first() if approx
           else column_quantiles(df, cols, [0.25, 0.75], computed))
    out = {}
    for c in cols:
        q = row[c]
        if q is None or q[0] is None:
            out[c] = (None, None)
            continue
        iqr = q[1] - q[0]
        out[c] = (q[0] - k * iqr, q[1] + k * iqr)
    return out


def clip(c: Column, lower, upper) -> Column:
    """O2: clip to [lower, upper]; nulls stay null (greatest/least skip nulls)."""
    if lower is None or upper is None:
        return c
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(upper)), F.lit(lower)))


@dataclass
class IQRClipper(Estimator):
    """O1 + O2: fit bounds per present column; clip those columns on transform."""

    columns: Sequence[str] = ("engine_hp", "engine_displacement")
    k: float = 1.5
    approx: bool = False

    def fit(self, df: DataFrame) -> "ClipModel":
        return ClipModel(iqr_bounds(df, self.columns, self.k, self.approx, computed=True))


@dataclass
class ClipModel(Model):
    bounds: dict

    def transform(self, df: DataFrame) -> DataFrame:
        new = {c: clip(F.col(c), lo, hi) for c, (lo, hi) in self.bounds.items() if c in df.columns}
        return replace_columns(df, new)


@dataclass
class Log1p(Transformer):
    """O3: log(1 + x) on the listed columns that exist."""

    columns: Sequence[str] = ("price_usd", "mileage_num")

    def transform(self, df: DataFrame) -> DataFrame:
        return replace_columns(df, {c: F.log1p(F.col(c)) for c in present(df, self.columns)})


@dataclass
class Expm1(Transformer):
    """exp(x) - 1, the inverse of O3."""

    columns: Sequence[str] = ("prediction",)

    def transform(self, df: DataFrame) -> DataFrame:
        return replace_columns(df, {c: F.expm1(F.col(c)) for c in present(df, self.columns)})


@dataclass
class OutlierHandler(Estimator):
    """log1p then IQR clip; every step is fitted on the *input* table
    (not sequentially), so all bounds come from one aggregation."""

    log_columns: Sequence[str] = ("price_usd", "mileage_num")
    clip_columns: Sequence[str] = ("engine_hp", "engine_displacement")
    approx: bool = False

    def fit(self, df: DataFrame) -> "OutlierModel":
        return OutlierModel(Log1p(self.log_columns), IQRClipper(self.clip_columns, approx=self.approx).fit(df))


@dataclass
class OutlierModel(Model):
    log: Log1p
    clipper: ClipModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.clipper.transform(self.log.transform(df))


def outlier_report(df: DataFrame, columns: Sequence[str], k: float = 1.5, approx: bool = False) -> DataFrame:
    """Per column, count and percent of rows strictly outside the IQR fences.

    Two passes: bounds (one aggregation), then one conditional-count aggregation
    for all columns, unpivoted to long form.
    """
    bounds = iqr_bounds(df, columns, k, approx)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c, (lo, hi) in bounds.items():
        out = (F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi)) if lo is not None else F.lit(False)
        aggs.append(F.count(F.when(out, F.lit(1))).alias(c))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`, CAST({bounds[c][0]!r} AS DOUBLE), CAST({bounds[c][1]!r} AS DOUBLE)"
                      .replace("None", "NULL") for c in bounds)
    long = wide.selectExpr("_n", f"stack({len(bounds)}, {stack}) AS (column_name, n_outliers, lower_bound, upper_bound)")
    return long.select("column_name", F.col("n_outliers").cast("bigint").alias("n_outliers"),
                       (F.col("n_outliers") * 100.0 / F.col("_n")).alias("pct_outliers"),
                       "lower_bound", "upper_bound")


@dataclass
class RangeFilter(Transformer):
    """Keep rows whose values lie in the declared ranges; unknown (null)
    values are kept, only values known to violate a range are removed."""

    ranges: dict = field(default_factory=lambda: {"price_usd": (1000.0, 500000.0),
                                                  "mileage_num": (None, 500000.0)})

    def transform(self, df: DataFrame) -> DataFrame:
        cond = F.lit(True)
        for c, (lo, hi) in self.ranges.items():
            if c not in df.columns:
                continue
            x = F.col(c)
            if lo is not None:
                cond = cond & F.coalesce(x >= F.lit(lo), F.lit(True))
            if hi is not None:
                cond = cond & F.coalesce(x <= F.lit(hi), F.lit(True))
        return df.filter(cond)
