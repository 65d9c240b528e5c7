"""Registered queries: exploratory profiling tables (X*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import profile as X
from kiln.operators.ranks import modes, quantiles
from kiln.plans import sqlparts as Q
from kiln.plans.catalog_fit import lineitem_gross
from kiln.plans.catalog_prep import cleaned, featured
from kiln.plans.registry import register
from kiln.session import table
from kiln.sources.fixtures import LISTINGS_SQL, listings

LC = [LISTINGS_SQL, Q.CLEANED_SQL]
FEATURE_COLS = ["listing_id", "brand", "model_year", "fuel_type", "ext_col", "int_col", "accident", "price_usd",
                "mileage_num", "has_clean_title", "is_sport", "is_premium", "is_4WD_AWD", "transmission_type",
                "engine_hp", "engine_displacement"]
CLEANED_COLS = ["listing_id", "brand", "model", "model_year", "fuel_type", "engine", "transmission", "ext_col",
                "int_col", "accident", "price_usd", "mileage_num", "has_clean_title"]
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LI_SQL = "li AS (SELECT *, l_extendedprice * l_quantity AS gross FROM lineitem)"


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------------ X1-X5

@register("profile_columns", Q.with_ctes(*Q.BASE, body=_union([
    f"SELECT (SELECT count(*) FROM features) AS n_rows, '{c}' AS column_name, {i} AS position, "
    f"(SELECT column_type FROM (DESCRIBE SELECT {c} FROM features)) AS data_type, count({c}) AS n_non_null FROM features"
    for i, c in enumerate(FEATURE_COLS)])))
def profile_columns(spark, sf):
    """Shape, SQL type and non-null count per column of the featured listings."""
    return X.profile_columns(featured(spark, sf))


@register("describe_numeric", _union([
    f"""SELECT '{c}' AS column_name, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std,
  CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
  quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lineitem""" for c in LI_NUM]))
def describe_numeric(spark, sf):
    """X2 + X23: count, mean, std, min, exact quartiles, max of the lineitem measures."""
    return X.describe_numeric(table(spark, sf, "lineitem"), LI_NUM)


@register("missing_report", Q.with_ctes(*LC, body="SELECT * FROM (" + _union([
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS pct_missing FROM cleaned" for c in CLEANED_COLS])
    + ") WHERE n_missing > 0"))
def missing_report(spark, sf):
    """Missing count and percent per cleaned-listing column (columns with any)."""
    return X.missing_report(cleaned(spark, sf))


@register("missing_patterns", Q.with_ctes(*LC, body="SELECT " + " || ".join(
    f"CASE WHEN {c} IS NULL THEN '1' ELSE '0' END" for c in CLEANED_COLS)
    + " AS pattern, count(*) AS n_rows FROM cleaned GROUP BY 1"))
def missing_patterns(spark, sf):
    """Row count per missingness pattern of the cleaned listings."""
    return X.missing_patterns(cleaned(spark, sf))


def _miss_corr_sql():
    parts = []
    for i, a in enumerate(CLEANED_COLS):
        for b in CLEANED_COLS[i + 1:]:
            fa, fb = f"CAST({a} IS NULL AS DOUBLE)", f"CAST({b} IS NULL AS DOUBLE)"
            parts.append(f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({fa}, {fb}) AS corr FROM cleaned "
                         f"HAVING var_pop({fa}) > 0 AND var_pop({fb}) > 0")
    return _union(parts)


@register("missing_correlation", Q.with_ctes(*LC, body=_miss_corr_sql()))
def missing_correlation(spark, sf):
    """Correlation of null indicators between cleaned-listing columns."""
    return X.missing_correlation(cleaned(spark, sf))


# ------------------------------------------------------------------ X6-X9

@register("histogram", Q.with_ctes(LI_SQL, body="""
SELECT bin, lo + bin * w AS lower, lo + (bin + 1) * w AS upper, n FROM (
  SELECT CAST(least(floor((gross - lo) / w), 49) AS INTEGER) AS bin, lo, w, count(*) AS n
  FROM li, (SELECT min(gross) AS lo, (max(gross) - min(gross)) / 50 AS w FROM li) b
  WHERE gross IS NOT NULL GROUP BY ALL)"""))
def histogram(spark, sf):
    """50 equal-width bins of the gross line value."""
    return X.histogram(lineitem_gross(spark, sf), "gross", 50)


@register("density_grid", Q.with_ctes(
    "lg AS (SELECT ln(l_extendedprice * l_quantity) AS x FROM lineitem)",
    "p AS (SELECT count(x) AS n, stddev_samp(x) * pow(count(x), -0.2) AS h, min(x) AS lo, max(x) AS hi FROM lg)",
    "g AS (SELECT CAST(i AS INTEGER) AS point, (lo - 3.0 * h) + i * (((hi + 3.0 * h) - (lo - 3.0 * h)) / 63) AS gx "
    "FROM p, range(64) t(i))",
    body="""SELECT g.point, g.gx AS x, sum(exp(-0.5 * pow((g.gx - lg.x) / p.h, 2))) / (p.n * p.h * sqrt(2 * pi())) AS density
FROM g, lg, p GROUP BY g.point, g.gx, p.n, p.h"""))
def density_grid(spark, sf):
    """Gaussian KDE (Scott bandwidth) of log gross line value on a 64-point grid."""
    li = table(spark, sf, "lineitem").select(F.log(F.col("l_extendedprice") * F.col("l_quantity")).alias("lg"))
    return X.density_grid(li, "lg", 64)


def _box_sql(src, c):
    return f"""SELECT '{c}' AS column_name, count({c}) AS n, q1, med AS median, q3,
  min({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_low,
  max({c}) FILTER (WHERE {c} >= q1 - 1.5 * (q3 - q1) AND {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
  count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM {src}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM {src}) q
GROUP BY q1, med, q3"""


@register("box_summary", Q.with_ctes(LI_SQL, body=_union([_box_sql("li", c) for c in ["gross", "l_extendedprice"]])))
def box_summary(spark, sf):
    """Box-plot summary of gross and extended price."""
    return X.box_summary(lineitem_gross(spark, sf), ["gross", "l_extendedprice"])


@register("box_by_group", Q.with_ctes(*Q.BASE, "z AS (SELECT fuel_type, price_usd FROM features WHERE price_usd < 150000)",
                                      body="""
SELECT z.fuel_type, q.n, q.q1, q.median, q.q3,
  min(price_usd) FILTER (WHERE price_usd >= q.q1 - 1.5 * (q.q3 - q.q1) AND price_usd <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_low,
  max(price_usd) FILTER (WHERE price_usd >= q.q1 - 1.5 * (q.q3 - q.q1) AND price_usd <= q.q3 + 1.5 * (q.q3 - q.q1)) AS whisker_high,
  count(*) FILTER (WHERE price_usd < q.q1 - 1.5 * (q.q3 - q.q1) OR price_usd > q.q3 + 1.5 * (q.q3 - q.q1)) AS n_outliers
FROM z JOIN (SELECT fuel_type, count(price_usd) AS n, quantile_cont(price_usd, 0.25) AS q1,
                    quantile_cont(price_usd, 0.5) AS median, quantile_cont(price_usd, 0.75) AS q3
             FROM z WHERE fuel_type IS NOT NULL GROUP BY fuel_type) q ON z.fuel_type = q.fuel_type
GROUP BY z.fuel_type, q.n, q.q1, q.median, q.q3"""))
def box_by_group(spark, sf):
    """X9 + X22: price box summary per fuel type over listings priced below 150 000."""
    f = featured(spark, sf).filter(F.col("price_usd") < 150000).select("fuel_type", "price_usd")
    return X.box_summary(f, value="price_usd", by="fuel_type")


# ------------------------------------------------------------------ X11-X20

@register("corr_matrix", _union([f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS corr FROM lineitem"
                                 for a in LI_NUM for b in LI_NUM]))
def corr_matrix(spark, sf):
    """X10 + X11: Pearson correlation matrix of the numeric lineitem measures."""
    li = table(spark, sf, "lineitem").select(*LI_NUM, "l_returnflag")
    return X.corr_matrix(li, X.numeric_columns(li))


@register("distinct_counts", Q.with_ctes(*Q.BASE, body=_union([
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM features" for c in FEATURE_COLS])))
def distinct_counts(spark, sf):
    """Distinct non-null values per featured-listing column."""
    return X.distinct_counts(featured(spark, sf))


@register("value_counts", """
SELECT p_brand AS value, count(*) AS n, count(*) / sum(count(*)) OVER () AS proportion
FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY n DESC, value""")
def value_counts(spark, sf):
    """Part brand counts and proportions, most frequent first."""
    return X.value_counts(table(spark, sf, "part"), "p_brand")


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]  # fixed values of the test table


@register("share_pivot", "SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, " + ", ".join(
    f"count(*) FILTER (o_orderpriority = '{p}') / count(*) AS \"{p}\"" for p in _PRIORITIES) + " FROM orders GROUP BY 1")
def share_pivot(spark, sf):
    """Order-priority shares per order year, pivoted wide (missing -> 0)."""
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("order_year"), "o_orderpriority")
    return X.share_pivot(o, "order_year", "o_orderpriority")


@register("kruskal_wallis", """
WITH t AS (SELECT CAST(year(o_orderdate) AS DOUBLE) AS v, o_orderpriority AS g FROM orders
           WHERE o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL),
dv AS (SELECT v, count(*) AS c FROM t GROUP BY v),
rk AS (SELECT v, c, sum(c) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM dv),
ar AS (SELECT v, coalesce(before, 0) + (c + 1) / 2.0 AS r FROM rk),
rg AS (SELECT g, sum(ar.r) AS rs, count(*) AS ng FROM t JOIN ar USING (v) GROUP BY g),
st AS (SELECT (SELECT count(*) FROM t) AS n, (SELECT sum(c * c * c - c) FROM dv) AS tt,
              (SELECT sum(rs * rs / ng) FROM rg) AS s, (SELECT count(*) FROM rg) AS k),
hh AS (SELECT n, k, (12.0 / (n * (n + 1.0)) * s - 3.0 * (n + 1)) / (1 - tt / (pow(n, 3) - n)) AS h FROM st)
SELECT 'order_year' AS value_column, 'o_orderpriority' AS group_column, CAST(k AS INTEGER) AS k, n, h,
  exp(-h / 2) * list_sum(list_transform(range(CAST((k - 1) / 2 AS BIGINT)), lambda i: pow(h / 2, i) / factorial(CAST(i AS INTEGER)))) AS p_value,
  exp(-h / 2) * list_sum(list_transform(range(CAST((k - 1) / 2 AS BIGINT)), lambda i: pow(h / 2, i) / factorial(CAST(i AS INTEGER)))) < 0.05 AS significant
FROM hh""")
def kruskal_wallis(spark, sf):
    """Kruskal-Wallis H of order year across order priorities (tie-corrected), p and verdict."""
    o = table(spark, sf, "orders").select(F.year("o_orderdate").cast("double").alias("order_year"), "o_orderpriority")
    return X.kruskal_wallis(o, "order_year", "o_orderpriority")


@register("kruskal_wallis_wide", """
WITH t AS (SELECT o_totalprice AS v, o_orderpriority AS g FROM orders
           WHERE o_totalprice IS NOT NULL AND o_orderpriority IS NOT NULL),
dv AS (SELECT v, count(*) AS c FROM t GROUP BY v),
rk AS (SELECT v, c, sum(c) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM dv),
ar AS (SELECT v, coalesce(before, 0) + (c + 1) / 2.0 AS r FROM rk),
rg AS (SELECT g, sum(ar.r) AS rs, count(*) AS ng FROM t JOIN ar USING (v) GROUP BY g),
st AS (SELECT (SELECT count(*) FROM t) AS n, (SELECT sum(c * c * c - c) FROM dv) AS tt,
              (SELECT sum(rs * rs / ng) FROM rg) AS s, (SELECT count(*) FROM rg) AS k),
hh AS (SELECT n, k, (12.0 / (n * (n + 1.0)) * s - 3.0 * (n + 1)) / (1 - tt / (pow(n, 3) - n)) AS h FROM st)
SELECT k, n, round(h, 4) AS h FROM hh""")
def kruskal_wallis_wide(spark, sf):
    """X16 on a column of nearly as many values as rows: total price across order priorities."""
    o = table(spark, sf, "orders").select(F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderpriority")
    return X.kruskal_wallis(o, "o_totalprice", "o_orderpriority").select(
        F.col("k").cast("bigint").alias("k"), "n", F.round("h", 4).alias("h"))


@register("top_n_categories", "SELECT p_brand AS value, count(*) AS n FROM part WHERE p_brand IS NOT NULL "
                              "GROUP BY p_brand ORDER BY n DESC, value LIMIT 20")
def top_n_categories(spark, sf):
    """The 20 most frequent part brands."""
    return X.top_n(table(spark, sf, "part"), "p_brand", 20)


@register("semi_filter_top_n", """
SELECT p_partkey, p_brand FROM part WHERE p_brand IN (
  SELECT p_brand FROM part WHERE p_brand IS NOT NULL GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 20)""")
def semi_filter_top_n(spark, sf):
    """Parts whose brand is among the 20 most frequent."""
    return X.semi_filter_top_n(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_brand", 20)


@register("group_median_ranked", Q.with_ctes(*LC, body="""
SELECT brand, median(price_usd) AS median_value, count(*) AS n FROM cleaned GROUP BY brand"""))
def group_median_ranked(spark, sf):
    """Median cleaned price per brand, ranked descending (ties by brand)."""
    return X.group_median_ranked(cleaned(spark, sf), "brand", "price_usd")


@register("pareto_coverage", """
WITH c AS (SELECT p_type AS value, count(*) AS n FROM part WHERE p_type IS NOT NULL GROUP BY p_type),
r AS (SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS position,
             sum(n) OVER (ORDER BY n DESC, value ROWS UNBOUNDED PRECEDING) AS cum FROM c)
SELECT position, value, n, n / (SELECT sum(n) FROM c) AS share, cum / (SELECT sum(n) FROM c) AS cum_share,
       cum / (SELECT sum(n) FROM c) >= 0.8 AS reached FROM r""")
def pareto_coverage(spark, sf):
    """Cumulative share of part types sorted by frequency, with the 80 % mark."""
    return X.pareto_coverage(table(spark, sf, "part"), "p_type", 0.8)


@register("pareto_wide", """
WITH c AS (SELECT l_orderkey AS value, count(*) AS n FROM lineitem WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey),
r AS (SELECT value, n, row_number() OVER (ORDER BY n DESC, value) AS position,
             sum(n) OVER (ORDER BY n DESC, value ROWS UNBOUNDED PRECEDING) AS cum FROM c)
SELECT position, value, n, n / (SELECT sum(n) FROM c) AS share, cum / (SELECT sum(n) FROM c) AS cum_share,
       cum / (SELECT sum(n) FROM c) >= 0.8 AS reached FROM r""")
def pareto_wide(spark, sf):
    """X20 on a column of very many values: line items per order."""
    return X.pareto_coverage(table(spark, sf, "lineitem"), "l_orderkey", 0.8)


# ------------------------------------------------------------------ X21, X24

K2_SQL = """
WITH t AS (SELECT o_totalprice AS x FROM orders WHERE o_totalprice IS NOT NULL),
m AS (SELECT count(*) * 1.0 AS n, avg(x) AS mu FROM t),
mo AS (SELECT n, avg(pow(x - mu, 2)) AS m2, avg(pow(x - mu, 3)) AS m3, avg(pow(x - mu, 4)) AS m4 FROM t, m GROUP BY n),
g AS (SELECT n, m3 / pow(m2, 1.5) AS g1, m4 / pow(m2, 2) AS b2 FROM mo),
a AS (SELECT *, g1 * sqrt((n + 1) * (n + 3) / (6.0 * (n - 2))) AS y,
        3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9)) AS beta,
        (b2 - 3.0 * (n - 1) / (n + 1)) / sqrt(24.0 * n * (n - 2) * (n - 3) / (pow(n + 1, 2) * (n + 3) * (n + 5))) AS xx,
        6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3))) AS s
      FROM g),
b AS (SELECT *, -1 + sqrt(2 * (beta - 1)) AS w2, 6 + 8 / s * (2 / s + sqrt(1 + 4 / (s * s))) AS aa FROM a),
c AS (SELECT *, (1 / sqrt(0.5 * ln(w2))) * asinh(y / sqrt(2 / (w2 - 1))) AS z1,
             1 + xx * sqrt(2 / (aa - 4)) AS d FROM b),
z AS (SELECT *, (1 - 2 / (9 * aa) - sign(d) * cbrt((1 - 2 / aa) / abs(d))) / sqrt(2 / (9 * aa)) AS z2 FROM c)
SELECT 'o_totalprice' AS column_name, CAST(n AS BIGINT) AS n, g1 AS skewness, b2 - 3 AS excess_kurtosis,
       z1 * z1 + z2 * z2 AS k2, exp(-(z1 * z1 + z2 * z2) / 2) AS p_value, exp(-(z1 * z1 + z2 * z2) / 2) > 0.05 AS looks_normal
FROM z"""


@register("normality_k2", K2_SQL)
def normality_k2(spark, sf):
    """D'Agostino K² normality test of order totals."""
    return X.normality_k2(table(spark, sf, "orders"), ["o_totalprice"])


@register("head_rows", Q.with_ctes(LISTINGS_SQL, body="SELECT * FROM listings ORDER BY listing_id LIMIT 5"))
def head_rows(spark, sf):
    """First five raw listings by key."""
    return X.head_rows(listings(spark, sf), "listing_id", 5)


@register("scatter_points", Q.with_ctes(*LC, body="SELECT listing_id, mileage_num, price_usd FROM cleaned"))
def scatter_points(spark, sf):
    """(mileage, price) point pairs behind the scatter plot, every listing."""
    return cleaned(spark, sf).select("listing_id", "mileage_num", "price_usd")


# ------------------------------------------- exact quantiles and modes of wide columns

_QS = [0.01, 0.25, 0.5, 0.75, 0.99]
_Q_SQL = ", ".join(f"quantile_cont(l_extendedprice, {q}) AS q{i}" for i, q in enumerate(_QS))


@register("quantiles_by_group", f"""
SELECT l_returnflag, count(l_extendedprice) AS n, {_Q_SQL} FROM lineitem GROUP BY l_returnflag
UNION ALL SELECT NULL, count(l_extendedprice), {_Q_SQL} FROM lineitem""")
def quantiles_by_group(spark, sf):
    """Exact quantiles of a column of nearly distinct values, per group and over all rows, in one selection."""
    found = quantiles(table(spark, sf, "lineitem"), ["l_extendedprice"], _QS, [["l_returnflag"], []])
    return found.select("l_returnflag", "n", *[F.col("q")[i].alias(f"q{i}") for i in range(len(_QS))])


@register("quantiles_many_groups", """
SELECT l_partkey, count(l_extendedprice) AS n, quantile_cont(l_extendedprice, 0.5) AS median FROM lineitem GROUP BY l_partkey""")
def quantiles_many_groups(spark, sf):
    """Exact medians of very many groups."""
    found = quantiles(table(spark, sf, "lineitem"), ["l_extendedprice"], [0.5], [["l_partkey"]])
    return found.select("l_partkey", "n", F.col("q")[0].alias("median"))


@register("modes_by_group", """
WITH c AS (SELECT lang, text, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1, 2),
a AS (SELECT text, count(*) AS n FROM documents WHERE text IS NOT NULL GROUP BY 1)
SELECT lang, text AS value, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, text) AS k FROM c) WHERE k = 1
UNION ALL SELECT NULL, text, n FROM (SELECT *, row_number() OVER (ORDER BY n DESC, text) AS k FROM a) WHERE k = 1""")
def modes_by_group(spark, sf):
    """The most frequent whole text, per language and over all documents (almost as many values as rows)."""
    return modes(table(spark, sf, "documents"), ["text"], [["lang"], []]).select("lang", "value", "n")


@register("share_long", """
SELECT l_returnflag, l_partkey, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY l_returnflag) AS share
FROM lineitem GROUP BY l_returnflag, l_partkey""")
def share_long(spark, sf):
    """Shares of very many values, in long form."""
    return X.share_long(table(spark, sf, "lineitem"), "l_returnflag", "l_partkey")


@register("value_frequencies", _union([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM orders GROUP BY {c}"
                                       for c in ("o_orderkey", "o_custkey", "o_orderpriority")]))
def value_frequencies(spark, sf):
    """(column, value) counts of several columns in one pass."""
    return X.value_frequencies(table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"])
