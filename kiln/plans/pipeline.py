"""The default preparation chain, the training flow with its gates,
and user-supplied steps.

``Preprocessor`` chains clean -> features -> impute -> outliers -> encode.
Its training call (``fit_transform_with_model``) returns the out-of-fold
encoded training matrix and the fitted scoring model; ``ScoringBundle``
couples that model with the fitted regression for batch or stream scoring.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions import rules as R
from kiln.operators import encode as E
from kiln.operators import impute as I
from kiln.operators import model as M
from kiln.operators import outliers as O
from kiln.operators.base import Chain, ChainModel, Estimator, Model, Transformer
from kiln.operators.clean import Cleaner
from kiln.operators.features import FeatureEngineer, FeatureModel
from kiln.operators.split import hash_split
from kiln.operators.validate import validate
from kiln.session import materialize

TARGET = "price_usd"
BASE_FEATURES = ["brand", "model_year", "accident", "mileage_num", "has_clean_title", "is_sport",
                 "is_premium", "is_4WD_AWD", "engine_hp", "engine_displacement"]


@dataclass
class CustomStep(Transformer):
    """A user-supplied step; ``fn(df) -> df`` built from Column rules, or
    from ``mapInPandas``/``pandas_udf`` when the logic is opaque."""

    fn: Callable[[DataFrame], DataFrame]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.fn(df)


@dataclass
class PreprocessModel(Model):
    cleaner: Cleaner
    features: FeatureModel
    imputers: ChainModel
    outliers: O.OutlierModel
    encoder: E.EncoderModel
    extra: list = field(default_factory=list)

    @property
    def feature_names(self) -> list[str]:
        return BASE_FEATURES + self.encoder.one_hot.feature_names

    def transform(self, df: DataFrame) -> DataFrame:
        cur = self.cleaner.transform(df)
        cur = self.features.transform(cur)
        cur = self.imputers.transform(cur)
        cur = self.outliers.transform(cur)
        for step in self.extra:
            cur = step.transform(cur)
        return self.encoder.transform(cur)


@dataclass
class Preprocessor(Estimator):
    """Clean -> features -> impute (sequential fit) -> outliers -> encode.

    ``materialize`` cuts lineage once, after feature extraction, before the
    imputers' dependent fits ("auto": checkpoint to the shared checkpoint
    folder on a cluster, persist locally).
    """

    key: str = "listing_id"
    approx: bool = False
    materialize: str = "auto"
    extra: list = field(default_factory=list)

    def _prepare(self, df: DataFrame):
        cleaner = Cleaner()
        c = cleaner.transform(df)
        feat, fm = FeatureEngineer().fit_transform_with_model(c, self.materialize)
        self.materialized = [feat]
        im = Chain(I.default_imputers(self.approx), materialize="none").fit(feat)
        imp = im.transform(feat)
        om = O.OutlierHandler(approx=self.approx).fit(imp)
        cur = om.transform(imp)
        extra = [s.fit(cur) for s in self.extra]
        for s in extra:
            cur = s.transform(cur)
        return cleaner, fm, im, om, extra, cur

    def fit_transform_with_model(self, df: DataFrame):
        """(OOF-encoded training matrix, scoring model). The materialized
        feature frame is listed in ``self.materialized`` for release once the
        caller has materialized the matrix."""
        cleaner, fm, im, om, extra, cur = self._prepare(df)
        enc = E.CategoricalEncoder(target=E.TargetEncoder(key=self.key))
        matrix, em = enc.fit_transform_with_model(cur)
        return matrix, PreprocessModel(cleaner, fm, im, om, em, extra)

    def fit(self, df: DataFrame) -> PreprocessModel:
        return self.fit_transform_with_model(df)[1]


@dataclass
class ScoringBundle:
    """Fitted preprocessing + regression; scores raw rows to prices."""

    preprocess: PreprocessModel
    regression: PipelineModel | M.LinearModel
    key: str = "listing_id"

    def score(self, raw: DataFrame, keep_label: bool = False) -> DataFrame:
        """Raw rows -> (key, prediction on log scale, price); the label column
        (log) is carried along when ``keep_label`` and present."""
        enc = self.preprocess.transform(raw)
        keep = [self.key] + ([TARGET] if keep_label and TARGET in enc.columns else [])
        enc = E.align_features(enc, self.preprocess.feature_names, keep=keep)
        pred = M.predict(self.regression, enc)
        return pred.select(*keep, "prediction", F.expm1("prediction").alias("price"))


    def beside(self, raw: DataFrame, out: str) -> DataFrame:
        """``raw`` with its log-scale prediction as column ``out`` and, if it has a price, the log label: no join,
        so several models can be scored on one frame."""
        enc = self.preprocess.transform(raw.withColumn("_raw", F.struct(*[F.col(c) for c in raw.columns])).drop(TARGET))
        keep = ["_raw"] + ([TARGET] if TARGET in enc.columns else [])
        pred = M.predict(self.regression, E.align_features(enc, self.preprocess.feature_names, keep=keep))
        label = [F.col(TARGET)] if TARGET in enc.columns and TARGET not in raw.columns else []
        return pred.select(*[F.col("_raw")[c].alias(c) for c in raw.columns], *label, F.col("prediction").alias(out))


@dataclass
class TrainingResult:
    bundle: ScoringBundle
    metrics: DataFrame
    gate: DataFrame
    decision: DataFrame
    train_rows: int
    dropped_label_rows: int
    materialized: list = field(default_factory=list)

    def release(self) -> None:
        """Unpersist the training matrix and the scored test split once the
        metric tables have been consumed."""
        for d in self.materialized:
            d.unpersist()


def run_training(raw: DataFrame, key: str = "listing_id", test_ratio: float = R.TEST_RATIO,
                 champion: ScoringBundle | None = None, min_r2: float = R.MIN_R2,
                 min_improvement: float = 0.0, materialize_mode: str = "auto") -> TrainingResult:
    """Split -> validate -> preprocess (fit on train) -> OLS -> test metrics -> gates.

    The champion (if any) is scored on the same test rows; with none, its
    R² counts as 0.
    """
    split = hash_split(raw, key, test_ratio, "_split")
    train = split.filter(F.col("_split") == "train").drop("_split")
    test = split.filter(F.col("_split") == "test").drop("_split")
    # V3 gate: schema checks of both parts (metadata only) before any transform
    validate({"train": train.drop(key), "test": test.drop(key)}).raise_if_failed()
    pp = Preprocessor(key=key, materialize=materialize_mode)
    matrix, pre = pp.fit_transform_with_model(train)
    matrix = materialize(matrix, materialize_mode)
    counts = matrix.agg(F.count(F.lit(1)).alias("n"), F.count(F.col(TARGET)).alias("labelled")).first()
    for d in pp.materialized:  # the matrix is materialized now; the feature frame is no longer needed
        d.unpersist()
    n_train, dropped = counts["n"], counts["n"] - counts["labelled"]
    usable = matrix.dropna(subset=[TARGET])
    reg = M.LinearTrainer(pre.feature_names, TARGET).fit(usable)
    bundle = ScoringBundle(pre, reg, key)
    scored = materialize(bundle.score(test, keep_label=True), materialize_mode)  # metrics + decision reuse it
    metrics = M.regression_metrics(scored, TARGET, "prediction", "linear_regression")
    gate = M.quality_gate(metrics, min_r2)
    if champion is not None:
        both = champion.beside(bundle.beside(test, "_new"), "_old")
        decision = M.champion_challenger(both, TARGET, "_new", "_old", min_improvement)
    else:
        decision = M.champion_challenger(scored, TARGET, "prediction", None, min_improvement)
    return TrainingResult(bundle, metrics, gate, decision, n_train, dropped, [matrix, scored])

