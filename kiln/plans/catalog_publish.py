"""Registered queries: least squares with several regressors (M1) and the publish flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators.leastsq import fit_linear
from kiln.plans import sqlparts as Q
from kiln.plans.publish import Registry, publish
from kiln.plans.registry import register
from kiln.session import table
from kiln.sources.sinks import scratch_path

GROSS_SQL = "g AS (SELECT l_extendedprice * l_quantity AS y, l_quantity AS x1, l_extendedprice AS x2, l_discount AS x3 FROM lineitem)"
#: Coefficients of y on x1 and x2 from covariances.
TWO_SQL = """c AS (SELECT var_pop(x1) AS s11, var_pop(x2) AS s22, covar_pop(x1, x2) AS s12, covar_pop(x1, y) AS s1, covar_pop(x2, y) AS s2,
  avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, var_pop(y) AS sy FROM g),
b AS (SELECT *, (s1 * s22 - s2 * s12) / (s11 * s22 - s12 * s12) AS b1, (s2 * s11 - s1 * s12) / (s11 * s22 - s12 * s12) AS b2 FROM c)"""


def _gross(spark, sf):
    return table(spark, sf, "lineitem").select((F.col("l_extendedprice") * F.col("l_quantity")).alias("y"), F.col("l_quantity").alias("x1"),
                                               F.col("l_extendedprice").alias("x2"), F.col("l_discount").alias("x3"))


def _coefficients(spark, m):
    return spark.createDataFrame([(f, float(w)) for f, w in zip([*m.features, "(intercept)"], [*m.coefficients, m.intercept])],
                                 "feature string, coefficient double")


@register("ols_two_regressors", Q.with_ctes(GROSS_SQL, TWO_SQL, body="""
SELECT 'x1' AS feature, b1 AS coefficient FROM b UNION ALL SELECT 'x2', b2 FROM b UNION ALL SELECT '(intercept)', my - b1 * m1 - b2 * m2 FROM b"""))
def ols_two_regressors(spark, sf):
    """M1: coefficients of the gross line value on quantity and price."""
    return _coefficients(spark, fit_linear(_gross(spark, sf), ["x1", "x2"], "y"))


@register("ols_collinear", """
WITH g AS (SELECT l_extendedprice AS y, CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END AS a, CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END AS n,
                  CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END AS r FROM lineitem),
m AS (SELECT avg(y) FILTER (a = 1) AS ma, avg(y) FILTER (n = 1) AS mn, avg(y) FILTER (r = 1) AS mr FROM g)
SELECT 'a' AS feature, ma - (ma + mn + mr) / 3 AS coefficient FROM m UNION ALL SELECT 'n', mn - (ma + mn + mr) / 3 FROM m
UNION ALL SELECT 'r', mr - (ma + mn + mr) / 3 FROM m UNION ALL SELECT '(intercept)', (ma + mn + mr) / 3 FROM m""")
def ols_collinear(spark, sf):
    """M1: a full one-hot block, whose columns add up to one: the least-norm solution is the groups' deviations."""
    li = table(spark, sf, "lineitem")
    flags = {k.lower(): (F.col("l_returnflag") == k).cast("double") for k in "ANR"}
    return _coefficients(spark, fit_linear(li.select(F.col("l_extendedprice").alias("y"), *[e.alias(k) for k, e in flags.items()]), list(flags), "y"))


@register("publish_flow", Q.with_ctes(GROSS_SQL, TWO_SQL, """r AS (SELECT regr_r2(y, x1) AS one, regr_r2(y, x2) AS other, regr_r2(y, x3) AS none,
  (SELECT (b1 * s1 + b2 * s2) / sy FROM b) AS two FROM g)""", body="""
SELECT CAST(0 AS BIGINT) AS seq, 'first' AS run_id, 'accepted' AS outcome, one AS r2_new, 0.0::DOUBLE AS r2_old, NULL::VARCHAR AS champion_before FROM r
UNION ALL SELECT 1, 'weaker', CASE WHEN other > one THEN 'accepted' ELSE 'rejected' END, other, one, 'first' FROM r
UNION ALL SELECT 2, 'useless', CASE WHEN none < 0.1 THEN 'refused' ELSE 'rejected' END, none, greatest(one, other), CASE WHEN other > one THEN 'weaker' ELSE 'first' END FROM r
UNION ALL SELECT 3, 'interrupted', 'accepted', two, greatest(one, other), CASE WHEN other > one THEN 'weaker' ELSE 'first' END FROM r"""))
def publish_flow(spark, sf):
    """A first publish, one that doesn't improve, one below the minimum R², and one that broke off after
    staging and is finished by a second call, all compared on the same rows."""
    rows = _gross(spark, sf)
    registry = Registry(spark, scratch_path(spark, "registry"), "gross_value")
    for run, features in (("first", ["x1"]), ("weaker", ["x2"]), ("useless", ["x3"])):
        publish(registry, run, lambda f=features: fit_linear(rows, f, "y"), rows, "y", min_r2=0.1)
    registry.stage("interrupted", fit_linear(rows, ["x1", "x2"], "y"))  # as if the driver were lost here

    def never():
        raise AssertionError("a staged run must not train again")

    assert registry.unfinished() == ["interrupted"]
    for _ in range(2):  # the second call finds the record
        publish(registry, "interrupted", never, rows, "y", min_r2=0.1)
    return registry.records().drop("path", "decided_at")
