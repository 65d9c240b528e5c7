"""Linear model fitting, regression metrics, quality and
champion/challenger gates, scoring helpers.

Metrics are one aggregation over (label, prediction) pairs, optionally per
group; both gate decisions are projections of that one-row table. The
multivariate fit is least squares from the Gram matrix (``leastsq.py``), or any
Spark ML regressor.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.functions import rules as R
from kiln.operators.leastsq import LinearModel, fit_linear


@dataclass
class LinearTrainer:
    """M1/M2: OLS with optional intercept on named feature columns.

    ``estimator`` may be any Spark ML regressor taking ``featuresCol`` /
    ``labelCol`` (M2: pluggable algorithm); default is unregularised OLS with
    least-norm coefficients.
    Rows with a null label or feature are dropped before fitting.
    """

    features: Sequence[str]
    label: str = "price_usd"
    fit_intercept: bool = True
    estimator: object = None
    prediction: str = "prediction"

    def fit(self, df: DataFrame) -> PipelineModel | LinearModel:
        cols = list(self.features)
        if self.estimator is None:
            return fit_linear(df, cols, self.label, self.fit_intercept, self.prediction)
        est = self.estimator.setFeaturesCol("_features").setLabelCol(self.label).setPredictionCol(self.prediction)
        clean = df.dropna(subset=[self.label, *cols])
        assembler = VectorAssembler(inputCols=cols, outputCol="_features", handleInvalid="keep")
        return Pipeline(stages=[assembler, est]).fit(clean)


def predict(model: PipelineModel | LinearModel, df: DataFrame, keep: Sequence[str] | None = None,
            prediction: str = "prediction") -> DataFrame:
    """Apply a fitted model; rows with a missing feature get a null prediction
    (the assembler would otherwise carry NaN into every metric)."""
    out = model.transform(df).drop("_features")
    out = out.withColumn(prediction, F.nanvl(F.col(prediction), F.lit(None).cast("double")))
    return out if keep is None else out.select(*keep)


def linear_score(weights: dict, intercept: float = 0.0) -> Column:
    """Intercept + sum(w_i * x_i) with explicit coefficients."""
    expr = F.lit(float(intercept))
    for c, w in weights.items():
        expr = expr + F.lit(float(w)) * F.col(c)
    return expr


def univariate_ols(df: DataFrame, y: str, x: str, by: Sequence[str] = ()) -> DataFrame:
    """M1 (one regressor): slope, intercept, r2 and n from the regr_* aggregates."""
    aggs = [F.regr_slope(F.col(y), F.col(x)).alias("slope"),
            F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
            F.regr_r2(F.col(y), F.col(x)).alias("r2"),
            F.regr_count(F.col(y), F.col(x)).alias("n")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def _r2(sse: Column, sst: Column) -> Column:
    """1 - SSE/SST; a constant label gives 1 when predicted exactly, else 0."""
    return F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0) - sse / sst)


def metric_aggs(y: Column, p: Column) -> list[Column]:
    both = y.isNotNull() & p.isNotNull()
    e = F.when(both, y - p)
    yy = F.when(both, y)
    return [F.count(e).alias("n"), F.sum(e * e).alias("_sse"), F.sum(F.abs(e)).alias("_sae"),
            (F.var_pop(yy) * F.count(yy)).alias("_sst")]


def finish_metrics(df: DataFrame, model_name: str | Column, keys: Sequence[str] = ()) -> DataFrame:
    mse = F.col("_sse") / F.col("n")
    name = model_name if isinstance(model_name, Column) else F.lit(model_name)
    return df.select(*keys, name.alias("model"), mse.alias("mse"), F.sqrt(mse).alias("rmse"),
                     _r2(F.col("_sse"), F.col("_sst")).alias("r2"), (F.col("_sae") / F.col("n")).alias("mae"),
                     F.col("n").cast("bigint").alias("n"))


def regression_metrics(df: DataFrame, label: str, prediction: str, model_name: str = "model",
                       by: Sequence[str] = ()) -> DataFrame:
    """M3-M7: mse, rmse, r2, mae and n in one aggregation (per group if ``by``)."""
    aggs = metric_aggs(F.col(label), F.col(prediction))
    agg = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    return finish_metrics(agg, model_name, by)


def quality_gate(metrics: DataFrame, min_r2: float = R.MIN_R2) -> DataFrame:
    """M8: passes when r2 >= min_r2 (fails below)."""
    return metrics.select("model", "r2", F.lit(float(min_r2)).alias("min_r2"),
                          F.coalesce(F.col("r2") >= F.lit(float(min_r2)), F.lit(False)).alias("passed"))


class QualityGateError(RuntimeError):
    """A trained model is below the minimum R²."""


def require_quality(gate: DataFrame) -> None:
    """M8, enforcing: raise unless every row of ``quality_gate`` passed."""
    failed = gate.filter(~F.col("passed")).collect()  # one row per model
    if failed:
        raise QualityGateError("; ".join(f"{r['model']}: r2 {r['r2']} < {r['min_r2']}" for r in failed))


def champion_challenger(df: DataFrame, label: str, p_new: str, p_old: str | None,
                        min_improvement: float = 0.0) -> DataFrame:
    """Both R² on the same rows in one aggregation; accept the
    challenger when r2_new - r2_old > min_improvement (no champion -> r2_old 0).

    Same rows: those with a label and every prediction compared."""
    y = F.col(label)
    aggs = []
    both = y.isNotNull()
    for p in (p_new, p_old):
        if p is not None:
            both = both & F.col(p).isNotNull()
    for tag, p in (("new", p_new), ("old", p_old)):
        if p is None:
            continue
        e = F.when(both, y - F.col(p))
        aggs += [F.sum(e * e).alias(f"_sse_{tag}"), (F.var_pop(F.when(both, y)) * F.count(e)).alias(f"_sst_{tag}")]
    agg = df.agg(*aggs)
    r2_new = _r2(F.col("_sse_new"), F.col("_sst_new"))
    r2_old = _r2(F.col("_sse_old"), F.col("_sst_old")) if p_old is not None else F.lit(None).cast("double")
    r2_old = F.coalesce(r2_old, F.lit(0.0))
    return agg.select(r2_new.alias("r2_new"), r2_old.alias("r2_old"), (r2_new - r2_old).alias("difference"),
                      F.coalesce((r2_new - r2_old) > F.lit(float(min_improvement)), F.lit(False)).alias("accepted"))


def format_currency(c: Column) -> Column:
    """``$1,234.50``."""
    return F.concat(F.lit("$"), F.format_number(c, 2))
