"""Sparse one-hot rows."""

import pytest
from pyspark.sql import functions as F

from kiln.operators.encode import OneHotEncoder
from kiln.operators.sparse import SparseOneHotEncoder
from kiln.sources.sinks import load_model, save_model, scratch_path


def frame(spark):
    return spark.createDataFrame([(1, "b", 10, 0.5), (2, "a", 9, -0.0), (3, None, 10, 0.0), (4, "b", None, float("nan")), (5, "c", 100, None), (5, "c", 100, None)],
                                 "id long, s string, n int, d double")


@pytest.mark.parametrize("drop_first", [True, False])
def test_equals_the_dense_form(spark, drop_first):
    df = frame(spark)
    dense = OneHotEncoder(["s", "n"], drop_first).fit(df)
    model = SparseOneHotEncoder(["s", "n"], drop_first).fit(df)
    assert model.size == len(dense.feature_names)
    names = {r["position"]: f"{r['column_name']}_{r['category'] or 'null'}" for r in model.names().collect()}
    assert [names[i] for i in range(model.size)] == dense.feature_names
    want = sorted((r["id"], tuple(r[n] for n in dense.feature_names)) for r in dense.transform(df).collect())
    got = sorted((r["id"], tuple(1.0 if i in r["features"]["positions"] else 0.0 for i in range(model.size))) for r in model.transform(df).collect())
    assert got == want


def test_unseen_zeros_of_both_signs_and_saved(spark):
    model = SparseOneHotEncoder(["d", "s"], drop_first=False).fit(frame(spark))
    assert model.size == 4 + 4  # 0.0, 0.5, NaN, null; a, b, c, null
    back = load_model(save_model(model, scratch_path(spark, "sparse"), spark), spark)
    rows = spark.createDataFrame([("new", 7.0), ("a", -0.0), (None, float("nan"))], "s string, d double")
    out = [[*r["features"]["positions"]] for r in back.transform(rows).collect()]
    assert sorted(out) == [[], [0, 4], [2, 7]] and back.transform(rows).columns == ["features"]


def test_more_categories_than_any_driver_list(spark):
    n = 20_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    model = SparseOneHotEncoder(["k"]).fit(df)
    assert model.size == n - (n + 2) // 3  # -1 is the first and dropped
    out = model.transform(df).select("id", F.get("features.positions", F.lit(0)).alias("p"))
    assert out.filter(F.col("p").isNull()).count() == (n + 2) // 3
    assert out.filter(F.col("p").isNotNull() & (F.col("p") != F.col("id") - F.floor(F.col("id") / 3) - 1)).count() == 0


def test_empty_table_and_missing_column(spark):
    empty = frame(spark).filter("id < 0")
    model = SparseOneHotEncoder(["s", "n"]).fit(empty)
    assert model.size == 0 and model.transform(empty).count() == 0
    assert {tuple(r["features"]["positions"]) for r in model.transform(frame(spark)).collect()} == {()}
    with pytest.raises(ValueError):
        SparseOneHotEncoder(["nope"]).fit(empty)
