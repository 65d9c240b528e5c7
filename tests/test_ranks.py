"""Exact quantiles and modes against NumPy and plain counting."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kiln.operators import ranks as R

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def expected(values):
    """Linear quantiles of the sorted values (NaN last)."""
    x = sorted(values, key=lambda v: (math.isnan(v), v))
    out = []
    for p in PROBS:
        at = p * (len(x) - 1)
        low, high = x[math.floor(at)], x[math.ceil(at)]
        out.append(low if low == high or math.isnan(low) else low + (high - low) * (at - math.floor(at)))
    return out


def close(got, want):
    return all((math.isnan(a) and math.isnan(b)) or a == b or abs(a - b) <= 1e-12 * max(abs(a), abs(b)) for a, b in zip(got, want))


def wide(r, n):
    return [r.choice([-1, 1]) * r.random() * 10.0 ** r.randint(-300, 300) for _ in range(n)]


CASES = {
    "even": lambda r: [r.random() for _ in range(3000)],
    "ties": lambda r: [float(r.randint(0, 3)) for _ in range(500)] + [None] * 50,
    "wide": lambda r: wide(r, 3000),
    "tiny": lambda r: [k * 5e-324 for k in range(40)],
    "signs": lambda r: [-0.0, 0.0, 1.0, -1.0] * 3 + wide(r, 200),
    "infinite": lambda r: [math.inf, -math.inf, math.nan, math.nan] + wide(r, 300),
    "one": lambda r: [7.5],
    "two": lambda r: [1.0, 2.0],
    "none": lambda r: [None, None],
}


@pytest.mark.parametrize("local_rows", [10_000, 0])
def test_quantiles_equal_sorting(spark, monkeypatch, local_rows):
    """Small and large bucket counts, small selections and those that stay distributed."""
    r = random.Random(local_rows)
    groups = {name: make(r) for name, make in CASES.items()}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [(None, 3.0), (None, 5.0)], "g string, v double").repartition(5)
    groups[None] = [3.0, 5.0]
    monkeypatch.setattr(R, "LOCAL_ROWS", local_rows)
    for bits in (14, 4):
        monkeypatch.setattr(R, "BUCKET_BITS", bits)
        monkeypatch.setattr(R, "BUCKETS", 1 << bits)
        found = R.quantiles(df, {"x": F.col("v")}, PROBS, [["g"], []]).collect()
        assert len(found) == len(groups)  # all but the group without values, and all rows
        for row in found:
            values = [v for g, vs in groups.items() for v in vs if v is not None and (row["gs"] == 1 or g == row["g"])]
            assert row["n"] == len(values) and close(row["q"], expected(values)), (bits, row["g"], row["gs"])


def test_quantiles_of_several_columns_and_empty_tables(spark):
    df = spark.range(1001).select((F.col("id") * 3).alias("a"), (F.col("id") % 10).cast("int").alias("b"), F.lit(None).cast("double").alias("c"))
    assert R.column_quantiles(df, ["a", "b", "c"], [0.25, 0.5]) == {"a": [750.0, 1500.0], "b": [2.0, 4.0], "c": None}
    assert R.column_quantiles(df.limit(0), ["a"], [0.5]) == {"a": None}
    assert R.quantiles(df.limit(0), ["a"], [0.5], [["b"], []]).collect() == []


def test_no_plan_holds_a_percentile_buffer(spark):
    """The selection's passes are counts, least and largest values: nothing that keeps distinct values."""
    df = spark.range(100).select(F.col("id").cast("double").alias("a"))
    seen = []
    held = R._held
    try:
        R._held = lambda s: (seen.append(s._jdf.queryExecution().executedPlan().toString().lower()), held(s))[1]
        assert R.column_quantiles(df, ["a"], [0.5]) == {"a": [49.5]}
    finally:
        R._held = held
    assert seen and not any(word in plan for plan in seen for word in ("percentile", "median", "sortaggregate"))


def test_ordered_bits_order_like_doubles(spark):
    r = random.Random(1)
    values = wide(r, 500) + [2.0 ** k for k in range(-1074, 1024, 7)] + [0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", R.ordered_bits(F.col("v")).alias("b")).collect()
    want = np.abs(np.array([x["v"] for x in rows])).view(np.int64)
    for x, w in zip(rows, want):
        assert abs(x["b"]) == (0x7FF8 << 48 if math.isnan(x["v"]) else w) and (x["b"] < 0) == (x["v"] < 0)


def test_modes(spark):
    r = random.Random(4)
    rows = [(r.choice("ab"), r.choice(["x", "y", "é", None, ""])) for _ in range(300)] + [("c", None), (None, "q")] + [("d", f"only {k}") for k in range(200)]
    df = spark.createDataFrame(rows, "g string, v string").repartition(4)
    found = {(x["gs"], x["g"]): (x["value"], x["n"]) for x in R.modes(df, ["v"], [["g"], []]).collect()}

    def mode(values):
        return min(((-n, v.encode(), v) for v, n in Counter(values).items()))

    want = {(0, g): mode([v for h, v in rows if h == g and v is not None]) for g in ("a", "b", "d", None)}
    want[1, None] = mode([v for _, v in rows if v is not None])
    assert found == {k: (v, -n) for k, (n, _, v) in want.items()}
    assert found[0, "d"] == ("only 0", 1)  # ties: the smallest
    assert R.column_modes(df.withColumn("i", F.lit(3)), {"v": F.col("v"), "i": F.col("i")}) == {"v": found[1, None][0], "i": 3}
    assert R.column_modes(df.limit(0), {"v": F.col("v")}) == {"v": None}


def test_share_long_and_value_frequencies(spark):
    from kiln.operators import profile as X
    rows = [("a", "x", 0.0), ("a", "x", -0.0), ("a", None, 1.5), (None, "y", None), ("b", "é", 1.5)]
    df = spark.createDataFrame(rows, "g string, v string, d double")
    got = {(r["g"], r["v"]): (r["n"], r["share"]) for r in X.share_long(df, "g", "v").collect()}
    assert got == {("a", "x"): (2, pytest.approx(2 / 3)), ("a", None): (1, pytest.approx(1 / 3)), (None, "y"): (1, 1.0), ("b", "é"): (1, 1.0)}
    plan = X.distinct_counts(df)
    assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()
    assert {r["column_name"]: r["n_distinct"] for r in plan.collect()} == {"g": 2, "v": 3, "d": 2}
    assert {r["column_name"]: r["n_distinct"] for r in X.distinct_counts(df.limit(0)).collect()} == {"g": 0, "v": 0, "d": 0}


def test_quarantine_takes_every_row_once(spark):
    from kiln.operators import validate as V
    from kiln.sources.sinks import scratch_path
    rows = [("Ford", "$1,000", "5 mi.", 2020), (None, "ask", "5 mi.", 2020), ("Kia", None, "far", 2021), ("Kia", "$5", None, None)]
    df = spark.createDataFrame(rows, "brand string, price string, milage string, model_year long")
    path = scratch_path(spark, "quarantine")
    good = V.accept_rows(df, path)
    assert good.columns == df.columns and [tuple(r) for r in good.orderBy("price").collect()] == [rows[0], rows[3]]
    bad = {tuple(r)[:4]: r[V.REASONS] for r in spark.read.parquet(path).collect()}
    assert bad == {rows[1]: ["missing brand", "unparsable price"], rows[2]: ["missing price", "unparsable milage"]}
    assert V.accept_rows(df.limit(0), scratch_path(spark, "quarantine")).count() == 0
