"""M1: ordinary least squares from the Gram matrix, with least-norm coefficients.

One pass finds the means, a second one adds up the centred products of all
feature pairs: each task multiplies its own rows and hands on one matrix, which
Spark adds up entry by entry. What reaches the driver is a square of the number
of features, whatever the number of rows. The solve finds the rank from the
correlations (so units don't matter) and, where features depend on each other
(a full set of one-hot columns), takes the solution of least norm in the
features' own units, as a solver on the centred rows would.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.base import Model

#: Eigenvalues of the correlation matrix below this share of the largest one count as zero.
RANK_TOLERANCE = 1e-10


@dataclass
class LinearModel(Model):
    """intercept + sum of coefficient times feature; null where a feature is null."""

    features: list
    coefficients: list
    intercept: float
    rank: int
    prediction: str = "prediction"

    def beside(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with the prediction as column ``out``."""
        total = F.lit(float(self.intercept))
        for c, w in zip(self.features, self.coefficients):
            total = total + F.lit(float(w)) * F.col(c)
        return df.withColumn(out, total)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.beside(df, self.prediction)


def centred_products(df: DataFrame, columns: Sequence[str], centre: Sequence[float]) -> np.ndarray:
    """Sum over all rows of the outer product of (row - centre)."""
    k, shift = len(columns), np.array(centre)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            x = np.stack([np.asarray(c.to_numpy(zero_copy_only=False), np.float64) for c in batch.columns], axis=1) - shift
            total += x.T @ x
        yield pa.RecordBatch.from_pydict({"at": np.arange(k * k), "v": total.ravel()})

    rows = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    sums = rows.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(k * k)
    for r in sums:
        out[r["at"]] = r["v"]
    return out.reshape(k, k)


def least_norm(gram: np.ndarray, moment: np.ndarray) -> tuple[np.ndarray, int]:
    """Least-norm b with gram @ b = moment, and the rank of gram."""
    scale = np.sqrt(np.diag(gram))
    scale = np.where(scale > 0, scale, 1.0)
    values, vectors = np.linalg.eigh(gram / np.outer(scale, scale))
    kept = values > RANK_TOLERANCE * max(float(values.max(initial=0.0)), 1e-300)
    b = (vectors[:, kept] @ ((vectors[:, kept].T @ (moment / scale)) / values[kept])) / scale
    if kept.all():
        return b, int(kept.sum())
    free = vectors[:, ~kept] / scale[:, None]  # directions that change no prediction
    q, _ = np.linalg.qr(free)
    return b - q @ (q.T @ b), int(kept.sum())


def fit_linear(df: DataFrame, features: Sequence[str], label: str, intercept: bool = True, prediction: str = "prediction") -> LinearModel:
    """Rows with a null (or NaN) label or feature are left out; without rows all coefficients are 0."""
    features = list(features)
    columns = [*features, label]
    clean = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    means = [0.0] * len(columns)
    if intercept:
        row = clean.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
        means = [row[i] or 0.0 for i in range(len(columns))]
    products = centred_products(clean, columns, means)
    b, rank = least_norm(products[:-1, :-1], products[:-1, -1])
    return LinearModel(features, b.tolist(), float(means[-1] - np.dot(means[:-1], b)) if intercept else 0.0, rank, prediction)
