"""Property tests for the coercing numeric parsers."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.functions import text as T

GRAMMAR = re.compile(T.NUMBER_GRAMMAR)


def _parse_all(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v string")
    return [r[0] for r in df.orderBy("id").select(fn(F.col("v"))).collect()]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=10**9), min_size=1, max_size=30))
def test_currency_and_distance_roundtrip(spark, amounts):
    money = [f"${a:,}" for a in amounts]
    miles = [f"{a:,} mi." for a in amounts]
    assert _parse_all(spark, T.clean_currency, money) == [float(a) for a in amounts]
    assert _parse_all(spark, T.clean_distance, miles) == [float(a) for a in amounts]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,$ -+eEdfinaxmi", max_size=12), min_size=1, max_size=30))
def test_parse_is_null_or_python_float(spark, texts):
    got = _parse_all(spark, T.parse_number, texts)
    for t, g in zip(texts, got):
        if GRAMMAR.match(t):
            assert g == float(t)
        else:
            assert g is None
