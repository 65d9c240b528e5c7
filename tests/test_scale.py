"""Steps whose cost must not grow faster than their input."""

from pyspark.sql import functions as F

from kiln.functions import text as T
from kiln.operators.clean import Cleaner
from kiln.operators.features import FeatureEngineer
from kiln.operators.sparse import SparseOneHotEncoder
from kiln.plans import catalog_model
from kiln.sources.fixtures import listings
from tests.conftest import SF_SMALL


def plan(df, capsys):
    capsys.readouterr()
    df.explain(True)
    return capsys.readouterr().out


def test_part_is_not_sent_through_the_driver(spark, capsys):
    text = plan(Cleaner().transform(listings(spark, SF_SMALL)), capsys)
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_texts_are_normalised_once(spark, capsys):
    df = spark.createDataFrame([(" Titan-Gray. ",), ("nan",), (None,), ("Zebra",)], "v string")
    out = df.select(T.color_bucket(F.col("v"), "Unknown", "Other").alias("x"))
    assert [r[0] for r in out.collect()] == ["Beige", "Unknown", "Unknown", "Other"]
    assert plan(out, capsys).split("== Physical Plan ==")[1].count("regexp_replace") <= 2


def test_one_pass_features_equal_fit_and_transform(spark):
    df = spark.createDataFrame(
        [(1, "X M Sport", "Jet Black", "Navy", "None reported", "8-Speed A/T", "300HP 2.5L V6 Gasoline", None),
         (2, "awd", "\u2013", None, None, None, " nan ", "Diesel"), (3, None, "nan", "zebra", "x", "F", None, None),
         (4, "y", "other", "Beige", "x", "CVT", "100.0HP Electric Motor 3 Liter", None), (4, "y", "other", "Beige", "x", "CVT", "Plug-In electric 1.5 L", None)],
        "listing_id long, model string, ext_col string, int_col string, accident string, transmission string, engine string, fuel_type string")
    for mode_of in ("raw", "bucket"):
        one, _ = FeatureEngineer(mode_of=mode_of).fit_transform_with_model(df)
        two = FeatureEngineer(mode_of=mode_of).fit(df).transform(df)
        assert one.columns == two.columns and not [c for c in two.columns if c.startswith("_")]
        assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    hp = {(r["listing_id"], r["engine_hp"], r["engine_displacement"], r["fuel_type"]) for r in two.collect()}
    assert hp == {(1, 300.0, 2.5, "Gasoline"), (2, None, None, "Diesel"), (3, None, None, None), (4, 100.0, 0.0, "Electric"), (4, None, 1.5, "Hybrid")}


def test_custom_step_prepares_its_input_once(spark, monkeypatch):
    calls, prepared = [], catalog_model.featured
    monkeypatch.setattr(catalog_model, "featured", lambda *a: calls.append(1) or prepared(*a))
    assert catalog_model.custom_step(spark, SF_SMALL).count() > 0 and len(calls) == 1


def test_missing_values_do_not_meet_in_one_task(spark):
    n = 40_000
    df = spark.range(n).select("id", F.when(F.col("id") % 2 == 0, (F.col("id") - 1) * 0.0 + F.col("id")).alias("k"))
    model = SparseOneHotEncoder(["k"]).fit(df)
    assert model.size == n // 2
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(keep, ("-1", "false")):
            spark.conf.set(k, v)
        out = model.transform(df).withColumn("task", F.spark_partition_id())
        rows = out.select("id", F.col("features.positions").alias("at"), "task").collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    want = {i: [n // 2 - 1] if i % 2 else [i // 2 - 1] if i else [] for i in range(n)}
    assert len(rows) == n and {r["id"]: list(r["at"]) for r in rows} == want
    per_task = {}
    for r in rows:
        per_task[r["task"]] = per_task.get(r["task"], 0) + 1
    assert len(per_task) > 1 and max(per_task.values()) < n / 4
