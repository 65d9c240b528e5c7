"""Least squares and the two-phase publish."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators.leastsq import LinearModel, fit_linear
from kiln.plans import publish as W
from kiln.plans.pipeline import TARGET
from kiln.sources.fixtures import listings
from kiln.sources.sinks import scratch_path
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("intercept", [True, False])
def test_least_norm_equals_pseudo_inverse(spark, intercept):
    r = np.random.default_rng(2)
    x = r.normal(size=(400, 3)) * [1, 1000, 1e-3] + [5, 0, 0]
    kind = r.integers(0, 3, 400)
    x = np.column_stack([x, *[(kind == k).astype(float) for k in range(3)], x[:, 0] * 2, np.zeros(400)])
    y = x @ r.normal(size=x.shape[1]) + r.normal(size=400)
    names = [f"f{i}" for i in range(x.shape[1])]
    df = spark.createDataFrame([(*map(float, row), float(t)) for row, t in zip(x, y)] + [(None,) * len(names) + (1.0,), (1.0,) * len(names) + (None,)],
                               ", ".join(f"{n} double" for n in [*names, "y"])).repartition(5)
    m = fit_linear(df, names, "y", intercept)
    mean = x.mean(0) if intercept else np.zeros(x.shape[1])
    want = np.linalg.pinv(x - mean) @ (y - (y.mean() if intercept else 0.0))
    assert np.allclose(m.coefficients, want, rtol=1e-6, atol=1e-8) and m.rank == (5 if intercept else 6)
    assert m.intercept == pytest.approx(y.mean() - mean @ want if intercept else 0.0)
    scored = m.transform(df).agg(F.count("prediction"), F.count(F.lit(1))).first()
    assert tuple(scored) == (401, 402)


def test_least_squares_without_rows(spark):
    m = fit_linear(spark.createDataFrame([], "a double, y double"), ["a"], "y")
    assert (m.coefficients, m.intercept, m.rank) == ([0.0], 0.0, 0)


@pytest.fixture()
def rows(spark):
    return spark.range(200).select((F.col("id") % 10).cast("double").alias("a"), (F.col("id") % 7).cast("double").alias("b"),
                                   (3 * (F.col("id") % 10) + (F.col("id") % 7)).cast("double").alias("y"))


def registry(spark):
    return W.Registry(spark, scratch_path(spark, "registry"), "m")


def test_a_taken_number_is_compared_again(spark, rows, monkeypatch):
    """Another run commits between this run's comparison and its commit: it meets the new champion."""
    reg = registry(spark)
    commit, others = W.Registry.commit, []

    def raced(self, record):
        if not others:
            others.append(1)
            self.stage("other", fit_linear(rows, ["a", "b"], "y"))
            assert commit(self, {**record, "run_id": "other", "outcome": "accepted", "path": self.model_path("other")})
        return commit(self, record)

    monkeypatch.setattr(W.Registry, "commit", raced)
    got = W.publish(reg, "mine", lambda: fit_linear(rows, ["a"], "y"), rows, "y", min_r2=0.1)
    assert (got["seq"], got["outcome"], got["champion_before"]) == (1, "rejected", "other") and got["r2_old"] == pytest.approx(1.0)
    assert reg.records().count() == 2 and reg.unfinished() == []
    assert not [n for n in reg.files.children("log") if n.startswith(".") and not n.endswith(".crc")]


def test_half_staged_models_are_staged_again(spark, rows):
    reg = registry(spark)
    spark.range(1).write.parquet(f"{reg.model_path('run')}/tables/1")  # no manifest: the writer was lost
    assert not reg.staged("run") and reg.unfinished() == ["run"]
    trained = []
    got = W.publish(reg, "run", lambda: trained.append(1) or fit_linear(rows, ["a"], "y"), rows, "y", min_r2=0.1)
    assert got["outcome"] == "accepted" and trained == [1]
    again = W.publish(reg, "run", None, rows, "y")
    assert again["seq"] == 0 and reg.records().count() == 1


def test_refused_models_are_never_champions(spark, rows):
    reg = registry(spark)
    assert W.publish(reg, "low", lambda: LinearModel(["a"], [0.0], 0.0, 1), rows, "y", min_r2=0.5)["outcome"] == "refused"
    got = W.publish(reg, "good", lambda: fit_linear(rows, ["a", "b"], "y"), rows, "y", min_r2=0.5)
    assert got["outcome"] == "accepted" and got["champion_before"] is None and got["r2_old"] == 0.0
    same = W.publish(reg, "same", lambda: fit_linear(rows, ["a", "b"], "y"), rows, "y", min_r2=0.5)
    assert same["outcome"] == "rejected"  # equal R² is no improvement


def test_training_flow_publishes(spark):
    reg = registry(spark)
    raw = listings(spark, SF_SMALL)
    assert W.run_publish(raw, reg, "r1", min_r2=0.99)["outcome"] == "refused"
    first = W.run_publish(raw, reg, "r2", min_r2=-10.0, min_improvement=-10.0)
    assert first["outcome"] == "accepted" and first["champion_before"] is None
    second = W.run_publish(raw, reg, "r3", min_r2=-10.0)
    assert second["outcome"] == "rejected" and second["r2_old"] == pytest.approx(first["r2_new"], abs=1e-9)
    assert second["r2_new"] == pytest.approx(second["r2_old"], abs=1e-9)  # the same model on the same rows
    bundle = W.load_model(first["path"], spark)
    beside = bundle.beside(raw, "_p")
    assert beside.columns == [*raw.columns, TARGET, "_p"]
    want = {r["listing_id"]: r["prediction"] for r in bundle.score(raw).collect()}
    got = {r["listing_id"]: r["_p"] for r in beside.collect()}
    assert got.keys() == want.keys() and all((a is None and want[k] is None) or a == pytest.approx(want[k]) for k, a in got.items())
