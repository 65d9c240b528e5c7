"""Training flow, persistence, registry and batch == stream scoring."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kiln.operators import split as P
from kiln.plans.pipeline import run_training
from kiln.sources import sinks as K
from kiln.sources.fixtures import listings
from kiln.sources.spec import raw_schema
from kiln.streaming.score import score_available_now
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def trained(spark):
    raw = listings(spark, SF_SMALL)
    test = P.hash_split(raw, "listing_id", 0.25, "_s").filter("_s = 'test'").drop("_s")
    return run_training(raw), test


def _scores(df):
    return {r["listing_id"]: r["prediction"] for r in df.select("listing_id", "prediction").collect()}


def test_training_outputs(trained):
    res, test = trained
    m = res.metrics.first()
    assert m["n"] > 0 and m["rmse"] == pytest.approx(m["mse"] ** 0.5)
    assert res.gate.first()["passed"] == (m["r2"] >= 0.6)
    assert res.decision.first()["r2_old"] == 0.0


def test_persistence_roundtrip(spark, trained):
    res, test = trained
    path = K.save_model(res.bundle, K.scratch_path(spark, "bundle"), spark)
    a, b = _scores(res.bundle.score(test)), _scores(K.load_model(path, spark).score(test))
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k], rel=1e-12)


def test_registry_latest(spark, trained):
    res, _ = trained
    root = K.scratch_path(spark, "registry")
    K.publish(spark, res.bundle, root, "m", 0.5, datetime(2026, 1, 1, 9, 0, 0))
    reg = K.publish(spark, res.bundle, root, "m", 0.7, datetime(2026, 1, 2, 9, 0, 0))
    assert reg.count() == 2
    latest = K.latest_per_key(reg, ["name"], [F.col("published_at")]).first()
    assert latest["version"] == "01_02_2026_09_00_00" and K.resolve_latest_model(spark, root, "m") is not None


def test_batch_equals_stream(spark, trained):
    res, test = trained
    src = K.write_table(test.repartition(3), K.scratch_path(spark, "in"))
    out = score_available_now(spark, res.bundle, src, raw_schema("listing_id"),
                              K.scratch_path(spark, "out"), K.scratch_path(spark, "ckpt"))
    a, b = _scores(res.bundle.score(test)), _scores(out)
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k], rel=1e-12)


def test_latest_parsed_version_skips_unparsable(spark):
    names = spark.createDataFrame([("12_01_2026_10_00_00",), ("latest_artifact",), ("01_05_2027_00_00_00",)],
                                  "folder string")
    assert K.latest_parsed_version(names).first()["folder"] == "01_05_2027_00_00_00"


def test_inference_metadata_json(spark, trained):
    from kiln.operators.encode import inference_metadata
    res, _ = trained
    enc = res.bundle.preprocess.encoder
    path = K.write_json_rows(inference_metadata(enc), K.scratch_path(spark, "meta"))
    row = spark.read.json(path).first()
    te = row["target_encodings"]["brand"].asDict()
    assert te["__global_fallback__"] == pytest.approx(enc.target.prior)
    assert list(row["one_hot_features"]) == enc.one_hot.feature_names


def test_training_refuses_invalid_schema(spark):
    from kiln.plans.pipeline import run_training
    bad = listings(spark, SF_SMALL).drop("engine")
    with pytest.raises(ValueError, match="validation failed"):
        run_training(bad)


def test_single_request_path(spark, trained):
    """S9 -> S8 -> M12 -> M14: form fields to raw text, one record, scored, formatted."""
    from kiln.operators.model import format_currency
    from kiln.sources.readers import compose_raw_text, records_frame
    res, _ = trained
    form = spark.createDataFrame([(1, 1, 1, 1, 0, 35000.0, 300.0, 3.5)],
                                 "accident int, clean_title int, is_sport int, is_premium int, is_4wd int, "
                                 "mileage double, hp double, disp double")
    cols = compose_raw_text(*[F.col(c) for c in form.columns])
    raw = form.select(*[e.alias(n) for n, e in cols.items()]).first().asDict()
    assert raw["model"] == "Sport Premium" and raw["engine"] == "300.0 HP 3.5L" and raw["clean_title"] == "Yes"
    rec = dict(raw, listing_id=1, brand="Brand#13", model_year=2019, fuel_type="Gasoline",
               transmission="8-Speed A/T", ext_col="Black", int_col="Beige")
    one = records_frame(spark, [rec], key="listing_id")
    assert one.first()["price"] == "0"
    out = res.bundle.score(one).select("price", format_currency(F.col("price")).alias("text")).first()
    assert out["price"] is not None and out["text"].startswith("$")
