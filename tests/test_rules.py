"""Rule tables: literal inputs with hand-derived outputs (FIXTURES.md §4)."""

import math

import pytest
from pyspark.sql import functions as F

from kiln.functions import text as T
from kiln.operators import encode as E
from kiln.operators import impute as I
from kiln.operators import model as M
from kiln.operators import outliers as O
from kiln.operators.features import FeatureEngineer
from kiln.operators.scale import Scaler
from tests.conftest import rows


def one_col(spark, values, name="v", typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id int, {name} {typ}").orderBy("id")


def test_c1_currency(spark):
    df = one_col(spark, ["$10,300", " $1 ", "call", None, "1d"])
    assert [r[0] for r in rows(df.select(T.clean_currency(F.col("v")).alias("x")), "x")] == [10300.0, 1.0, None, None, None]


def test_c2_distance(spark):
    df = one_col(spark, ["51,000 mi.", "7 mi", "mi."])
    assert [r[0] for r in rows(df.select(T.clean_distance(F.col("v")).alias("x")), "x")] == [51000.0, 7.0, None]


def test_c3_junk_tokens(spark):
    df = one_col(spark, ["–", " not supported ", "", " Diesel ", None])
    assert [r[0] for r in rows(df.select(T.clean_junk(F.col("v")).alias("x")), "x")] == [None, None, None, " Diesel ", None]


def test_c4_yes_flag(spark):
    df = one_col(spark, ["Yes", "yes", None])
    assert [r[0] for r in rows(df.select(T.yes_flag(F.col("v")).alias("x")), "x")] == [1, 0, 0]


def test_f4_color_rules(spark):
    df = one_col(spark, ["Titan Gray", "Infrared", "Green", "Other", None])
    assert [r[0] for r in rows(df.select(T.color_bucket(F.col("v")).alias("x")), "x")] == ["Beige", "Red", None, None, None]


def test_f7_transmission_with_fitted_default(spark):
    df = spark.createDataFrame(
        [(1, "Automatic CVT"), (2, "6-Speed M/T"), (3, "F"), (4, "Scheduled for or in production"),
         (5, "8-Speed A/T"), (6, "8-Speed A/T")], "listing_id int, transmission string")
    out = FeatureEngineer().fit(df).transform(df).orderBy("listing_id")
    assert [r[0] for r in rows(out, "transmission_type")] == ["CVT", "Manual", "8-speed a/t", None, "Automatic", "Automatic"]


def test_f10_f11_engine_numbers(spark):
    df = one_col(spark, ["355.0HP 5.3L V8", "3.0 Liter", None])
    out = df.select(T.engine_hp(F.col("v")).alias("hp"), T.engine_displacement(F.col("v")).alias("d"))
    assert rows(out, "hp", "d") == [(355.0, 5.3), (None, 3.0), (None, None)]


def test_f12_cylinders(spark):
    df = one_col(spark, ["V6", "8 Cylinder", "Flat 6", "Rotary"])
    assert [r[0] for r in rows(df.select(T.engine_cylinders(F.col("v")).alias("x")), "x")] == [6.0, 8.0, 6.0, None]


def test_f13_f14_engine_fuel(spark):
    df = one_col(spark, ["Plug-In Electric/Gas", "Electric Motor", "GDI"])
    out = df.select(T.engine_fuel(F.col("v")).alias("f"), T.engine_displacement(F.col("v")).alias("d"))
    assert rows(out, "f", "d") == [("Hybrid", None), ("Electric", 0.0), ("Gasoline", None)]


def test_f16_accident(spark):
    df = one_col(spark, ["None reported", None, "At least 1 accident or damage reported"])
    assert [r[0] for r in rows(df.select(T.accident_flag(F.col("v")).alias("x")), "x")] == [0.0, 0.0, 1.0]


def test_i1_group_median_tiers(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (2, "a", 3.0), (3, "a", None), (4, "b", None), (5, None, None), (6, "c", 10.0)],
        "id int, brand string, engine_hp double")
    out = I.GroupMedianImputer().fit(df).transform(df).orderBy("id")
    assert [r[0] for r in rows(out, "engine_hp")] == [1.0, 3.0, 2.0, 3.0, 3.0, 10.0]
    allnull = spark.createDataFrame([(1, "a", None)], "id int, brand string, engine_hp double")
    assert rows(I.GroupMedianImputer().fit(allnull).transform(allnull), "engine_hp") == [(None,)]


def test_i4_group_mode_ties_and_defaults(spark):
    df = spark.createDataFrame(
        [(1, "x", "b"), (2, "x", "a"), (3, "x", None), (4, "y", None), (5, "z", "b"), (6, "z", "b")],
        "id int, brand string, fuel_type string")
    out = I.GroupModeImputer().fit(df).transform(df).orderBy("id")
    assert [r[0] for r in rows(out, "fuel_type")] == ["b", "a", "a", "b", "b", "b"]
    none = spark.createDataFrame([(1, "x", None)], "id int, brand string, fuel_type string")
    assert rows(I.GroupModeImputer().fit(none).transform(none), "fuel_type") == [("Gasoline",)]


def test_i5_right_closed_bins(spark):
    m = I.QuantileBinModel("x", [1.0, 3.0, 7.0, 9.0])
    df = one_col(spark, [0.5, 1.0, 3.0, 3.1, 9.0, 9.5, None], "x", "double")
    assert [r[0] for r in rows(m.transform(df), "x_bin")] == [None, 0, 0, 1, 2, None, None]


def test_i2_ev_rule(spark):
    df = spark.createDataFrame([(1, " Tesla ", None, None), (2, "Ford", None, None), (3, "tesla", 2.0, "Gas")],
                               "id int, brand string, engine_displacement double, fuel_type string")
    out = I.EVRuleImputer().transform(df).orderBy("id")
    assert rows(out, "engine_displacement", "fuel_type") == [(0.0, "Electric"), (None, None), (2.0, "Gas")]


def test_o2_clip(spark):
    df = one_col(spark, [0.0, 5.0, 100.0, None], "x", "double")
    out = df.select(O.clip(F.col("x"), 1.0, 10.0).alias("c"))
    assert [r[0] for r in rows(out, "c")] == [1.0, 5.0, 10.0, None]


@pytest.mark.parametrize("kind", ["standard", "robust", "minmax"])
def test_a_constant_column_scales_to_zero(spark, kind):
    df = one_col(spark, [4.0, 4.0, 4.0], "x", "double")
    out = Scaler(["x"], kind).fit(df).transform(df)
    assert [r[0] for r in rows(out, "x")] == [0.0, 0.0, 0.0]


def test_a_scalers_values(spark):
    df = one_col(spark, [1.0, 2.0, 3.0, 4.0], "x", "double")
    std = [r[0] for r in rows(Scaler(["x"], "standard").fit(df).transform(df), "x")]
    assert std == pytest.approx([(v - 2.5) / math.sqrt(1.25) for v in [1, 2, 3, 4]])
    mm = [r[0] for r in rows(Scaler(["x"], "minmax").fit(df).transform(df), "x")]
    assert mm == pytest.approx([0, 1 / 3, 2 / 3, 1])
    rb = [r[0] for r in rows(Scaler(["x"], "robust").fit(df).transform(df), "x")]
    assert rb == pytest.approx([(v - 2.5) / 1.5 for v in [1, 2, 3, 4]])


def test_e1_one_hot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, c string")
    m = E.OneHotEncoder(["c"]).fit(df)
    assert m.feature_names == ["c_b", "c_null"]
    new = spark.createDataFrame([(9, "zzz")], "id int, c string")
    assert rows(m.transform(new), "c_b", "c_null") == [(0.0, 0.0)]
    assert rows(m.transform(df).orderBy("id"), "c_b", "c_null") == [(1.0, 0.0), (0.0, 0.0), (0.0, 1.0)]


def test_e1_case_insensitive_name_clash(spark):
    df = spark.createDataFrame([(1, "A"), (2, "Black"), (3, "black")], "id int, c string")
    assert E.OneHotEncoder(["c"]).fit(df).feature_names == ["c_Black", "c_black_2"]


def test_e2_unseen_and_null_get_prior(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 3.0), (3, "b", 10.0)], "id int, brand string, y double")
    te = E.TargetEncoder(["brand"], "y", key="id").fit(df)
    assert te.prior == pytest.approx(14 / 3)
    new = spark.createDataFrame([(7, "zzz"), (8, None)], "id int, brand string")
    assert [r[0] for r in rows(te.transform(new), "brand")] == pytest.approx([14 / 3, 14 / 3])
    lam = 1 / (1 + math.exp(-(2 - 20) / 10))
    got = dict(rows(te.tables["brand"].df, "brand", "_enc"))
    assert got["a"] == pytest.approx(14 / 3 * (1 - lam) + 2.0 * lam)


def test_e3_key_only_in_own_fold_gets_fold_prior(spark):
    from kiln.operators.split import hash_bucket
    df = spark.createDataFrame([(i, "common" if i > 0 else "solo", float(i)) for i in range(40)],
                               "id int, brand string, y double")
    out = E.TargetEncoder(["brand"], "y", key="id").oof_transform(df)
    folds = dict(rows(df.select("id", hash_bucket(F.col("id"), 5).alias("f")), "id", "f"))
    solo_fold = folds[0]
    others = [float(i) for i in range(40) if folds[i] != solo_fold]
    got = dict(rows(out, "id", "brand"))
    assert got[0] == pytest.approx(sum(others) / len(others))


def test_e6_align(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "k int, b double, extra double")
    out = E.align_features(df, ["a", "b"], keep=["k"])
    assert out.columns == ["k", "a", "b"] and rows(out, "a", "b") == [(0.0, 2.0)]


def test_m5_constant_target(spark):
    exact = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert M.regression_metrics(exact, "y", "p").first()["r2"] == 1.0
    off = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert M.regression_metrics(off, "y", "p").first()["r2"] == 0.0


def test_m3_m6_values(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, p double")
    r = M.regression_metrics(df, "y", "p").first()
    assert (r["mse"], r["mae"], r["n"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3), 3)
    assert r["r2"] == pytest.approx(1 - 2 / 8)


def test_m10_champion_rules(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0), (2.0, 2.0, 2.0), (3.0, 3.5, 3.5)], "y double, a double, b double")
    none = M.champion_challenger(df, "y", "a", None).first()
    assert none["r2_old"] == 0.0 and none["accepted"] is True
    tie = M.champion_challenger(df, "y", "a", "b").first()
    assert tie["difference"] == 0.0 and tie["accepted"] is False


def test_m8_gate_treats_missing_r2_as_fail(spark):
    m = spark.createDataFrame([("m", None)], "model string, r2 double")
    assert M.quality_gate(m).first()["passed"] is False


def test_x16_kruskal_undefined_cases(spark):
    from kiln.operators import profile as X
    tied = spark.createDataFrame([(1.0, "a"), (1.0, "b"), (1.0, "b")], "v double, g string")
    r = X.kruskal_wallis(tied, "v", "g").first()
    assert r["h"] is None and r["p_value"] is None
    one = spark.createDataFrame([(1.0, "a"), (2.0, "a")], "v double, g string")
    assert X.kruskal_wallis(one, "v", "g").first()["h"] is None
    two = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (3.0, "b"), (4.0, "b")], "v double, g string")
    r = X.kruskal_wallis(two, "v", "g").first()
    # ranks a: 1,2 (R=3), b: 3,4 (R=7); H = 12/(4*5) * (9/2 + 49/2) - 15 = 2.4
    assert r["h"] == pytest.approx(2.4) and r["p_value"] == pytest.approx(math.erfc(math.sqrt(1.2)))  # 1 dof
