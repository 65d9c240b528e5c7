"""P1 with repeated and missing keys and repeated rows."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kiln.operators import split as P


def parts(df, ratio, key="k"):
    out = P.exact_split(df, key, ratio)
    rows = Counter(tuple(r) for r in out.drop("split").collect())
    assert rows == Counter(tuple(r) for r in df.collect())  # nothing lost, nothing made up
    return Counter(r["split"] for r in out.select("split").collect())


@pytest.mark.parametrize("ratio", [0.0, 0.1, 0.25, 0.5, 0.999, 1.0])
def test_exact_size_with_repeated_and_missing_keys(spark, ratio):
    """A key and no key hold a third of the rows each; every row differs in ``v``."""
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"),
                                  F.col("id").alias("v")).repartition(7)
    got = parts(df, ratio)
    assert got["test"] == math.ceil(1000 * ratio) and got["train"] == 1000 - math.ceil(1000 * ratio)


@pytest.mark.parametrize("key", ["x", None])
@pytest.mark.parametrize("ratio", [0.1, 0.5, 0.77])
def test_exact_size_where_all_rows_are_equal(spark, ratio, key, monkeypatch):
    monkeypatch.setattr(P, "COPIES_PER_ROW", 30)
    df = spark.range(500).select(F.lit(key).cast("string").alias("k"), F.lit(None).cast("double").alias("v"))
    assert parts(df, ratio)["test"] == math.ceil(500 * ratio)


def test_same_rows_chosen_whatever_the_partitions(spark):
    df = spark.range(600).select((F.col("id") % 2).alias("k"), (F.col("id") % 200).alias("v"), F.map_from_arrays(F.array(F.lit("a")), F.array("id")).alias("m"))
    a, b = (sorted((r["split"], r["k"], r["v"], r["m"]["a"]) for r in P.exact_split(x, "k", 0.3).collect()) for x in (df.repartition(2), df.repartition(9)))
    assert a == b and sum(r[0] == "test" for r in a) == 180


def test_a_column_of_nulls_is_no_empty_column(spark):
    """(null, 1) and (1, null) are different rows, although a plain hash skips nulls."""
    df = spark.createDataFrame([("k", None, 1)] * 5 + [("k", 1, None)] * 5, "k string, a long, b long")
    assert parts(df, 0.35)["test"] == 4


def test_empty_table(spark):
    assert P.exact_split(spark.createDataFrame([], "k string, v long"), "k", 0.3).count() == 0
