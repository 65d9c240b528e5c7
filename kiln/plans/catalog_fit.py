"""Registered queries: imputation (I*), outliers and scaling (O*, A*), encoding (E*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.operators import impute as I
from kiln.operators.base import Chain
from kiln.plans import sqlparts as Q
from kiln.plans.catalog_prep import featured
from kiln.plans.registry import register
from kiln.sources.fixtures import LISTINGS_SQL, listings

B = Q.BASE


def imputed(spark, sf):
    """Featured listings through the default sequential-fit imputation chain."""
    f = featured(spark, sf)  # already materialized
    return Chain(I.default_imputers(), materialize="none").fit(f).transform(f)


# ------------------------------------------------------------------ I1-I9

@register("impute_group_median", Q.with_ctes(*B, Q.IMPUTE_SQL[0], body="SELECT listing_id, engine_hp FROM imp1"))
def impute_group_median(spark, sf):
    """engine_hp filled by brand median, then global median."""
    f = featured(spark, sf)
    return I.GroupMedianImputer("engine_hp", ("brand",)).fit(f).transform(f).select("listing_id", "engine_hp")


@register("impute_rule_ev", Q.with_ctes(*B, f"ev AS ({Q.ev_rule('features')})", body="""
SELECT listing_id, engine_displacement, fuel_type FROM ev"""))
def impute_rule_ev(spark, sf):
    """EV brands get displacement 0.0 / fuel ``Electric`` where missing."""
    return I.EVRuleImputer().transform(featured(spark, sf)).select(
        "listing_id", "engine_displacement", "fuel_type")


@register("impute_two_key_median", Q.with_ctes(*B, *Q.IMPUTE_SQL[:3], body="""
SELECT listing_id, engine_displacement FROM imp3"""))
def impute_two_key_median(spark, sf):
    """I3 (after I1, I2): displacement by (brand, engine_hp) median, then global median."""
    f = featured(spark, sf)
    pre = Chain(I.default_imputers()[:2], materialize="none").fit(f).transform(f)
    m = I.GroupMedianImputer("engine_displacement", ("brand", "engine_hp")).fit(pre)
    return m.transform(pre).select("listing_id", "engine_displacement")


@register("impute_group_mode", Q.with_ctes(*B, f"m AS ({Q.group_mode_fill('features', 'fuel_type', 'brand', 'Gasoline')})",
                                           body="SELECT listing_id, fuel_type FROM m"))
def impute_group_mode(spark, sf):
    """I4: fuel_type by brand mode, then global mode, then ``Gasoline``."""
    f = featured(spark, sf)
    return I.GroupModeImputer("fuel_type", ("brand",)).fit(f).transform(f).select("listing_id", "fuel_type")


@register("quantile_bin", Q.with_ctes(*B, body=f"""
SELECT listing_id, CAST({Q.bin_expr('f.engine_hp', 'x.e')} AS INTEGER) AS engine_hp_bin
FROM features f, (SELECT list_sort(list_distinct(quantile_cont(engine_hp, {Q.QS15}))) AS e FROM features) x"""))
def quantile_bin(spark, sf):
    """15 quantile bins of engine_hp (right-closed, lowest included, outside -> null)."""
    f = featured(spark, sf)
    return I.QuantileBinner("engine_hp", 15).fit(f).transform(f).select("listing_id", "engine_hp_bin")


@register("impute_tiered_bins", Q.with_ctes(*B, *Q.tiered_ctes("features", "tb"), body="""
SELECT listing_id, engine_displacement FROM tb"""))
def impute_tiered_bins(spark, sf):
    """I6 on its own: EV rule, (brand, hp bin) median, hp bin median, global median."""
    f = featured(spark, sf)
    return I.TieredBinImputer().fit(f).transform(f).select("listing_id", "engine_displacement")


@register("impute_all", Q.with_ctes(*B, *Q.IMPUTE_SQL, body="SELECT * FROM imputed"))
def impute_all(spark, sf):
    """The default chain with sequential fit; returns every column."""
    return imputed(spark, sf)


@register("impute_constant", Q.with_ctes(LISTINGS_SQL, body=f"""
SELECT listing_id, coalesce(fuel_type, {Q.mode_of('listings', 'fuel_type')}) AS fuel_type,
  coalesce(accident, 'None reported') AS accident, coalesce(clean_title, 'No') AS clean_title
FROM listings"""))
def impute_constant(spark, sf):
    """I8: declared fills: fuel_type with its mode, accident/clean_title with constants."""
    raw = listings(spark, sf)
    return I.ConstantImputer().fit(raw).transform(raw).select("listing_id", "fuel_type", "accident", "clean_title")


@register("window_group_fill", Q.with_ctes(*B, f"w AS ({Q.group_median_fill('features', 'engine_displacement', ['brand', 'engine_hp'])})",
                                           body="SELECT listing_id, engine_displacement FROM w"))
def window_group_fill(spark, sf):
    """Same-table grouped fill of displacement by (brand, engine_hp), then global median."""
    return I.grouped_fill(featured(spark, sf), "engine_displacement", ["brand", "engine_hp"]).select(
        "listing_id", "engine_displacement")


# ------------------------------------------------------------------ O1-O7, A1-A4

from kiln.operators import outliers as O  # noqa: E402
from kiln.operators.scale import Scaler  # noqa: E402
from kiln.plans.catalog_prep import cleaned  # noqa: E402
from kiln.session import table  # noqa: E402

LI_COLS = ["gross", "l_extendedprice", "l_quantity", "l_discount"]


def lineitem_gross(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("gross"))


LI_SQL = ("li AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
          "l_extendedprice * l_quantity AS gross FROM lineitem)")


def _bounds_sql(src, cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name,
  quantile_cont({c}, 0.25) - 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS lower_bound,
  quantile_cont({c}, 0.75) + 1.5 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS upper_bound
FROM {src}""")
    return "\nUNION ALL\n".join(parts)


@register("iqr_bounds", Q.with_ctes(LI_SQL, body=_bounds_sql("li", LI_COLS)))
def iqr_bounds(spark, sf):
    """O1: IQR fences (q1 - 1.5 iqr, q3 + 1.5 iqr) for four lineitem measures, one selection."""
    bounds = O.iqr_bounds(lineitem_gross(spark, sf), LI_COLS)
    return spark.createDataFrame([(c, *b) for c, b in bounds.items()], "column_name string, lower_bound double, upper_bound double")


@register("iqr_clip", Q.with_ctes(LI_SQL, f"b AS ({_bounds_sql('li', ['gross'])})", body="""
SELECT l_orderkey, l_linenumber, CASE WHEN gross IS NULL THEN NULL
  ELSE greatest(least(gross, b.upper_bound), b.lower_bound) END AS gross
FROM li, b"""))
def iqr_clip(spark, sf):
    """O2: gross line value clipped to its IQR fences."""
    df = lineitem_gross(spark, sf)
    return O.IQRClipper(["gross"]).fit(df).transform(df).select("l_orderkey", "l_linenumber", "gross")


@register("log1p_transform", Q.with_ctes(LISTINGS_SQL, Q.CLEANED_SQL, body="""
SELECT listing_id, ln(1 + price_usd) AS price_usd, ln(1 + mileage_num) AS mileage_num FROM cleaned"""))
def log1p_transform(spark, sf):
    """O3: log1p of price and mileage."""
    return O.Log1p().transform(cleaned(spark, sf)).select("listing_id", "price_usd", "mileage_num")


@register("expm1_inverse", Q.with_ctes(LISTINGS_SQL, Q.CLEANED_SQL, body="""
SELECT listing_id, round(exp(ln(1 + price_usd)) - 1, 2) AS price FROM cleaned"""))
def expm1_inverse(spark, sf):
    """expm1 undoes log1p; the round trip of every price, in cents."""
    logged = O.Log1p(["price_usd"]).transform(cleaned(spark, sf))
    back = O.Expm1(["price_usd"]).transform(logged)
    return back.select("listing_id", F.round("price_usd", 2).alias("price"))


@register("outliers_all", Q.with_ctes(*B, *Q.IMPUTE_SQL, f"b AS ({_bounds_sql('imputed', ['engine_hp', 'engine_displacement'])})", body="""
SELECT listing_id, ln(1 + price_usd) AS price_usd, ln(1 + mileage_num) AS mileage_num,
  greatest(least(engine_hp, (SELECT upper_bound FROM b WHERE column_name = 'engine_hp')),
           (SELECT lower_bound FROM b WHERE column_name = 'engine_hp')) AS engine_hp,
  greatest(least(engine_displacement, (SELECT upper_bound FROM b WHERE column_name = 'engine_displacement')),
           (SELECT lower_bound FROM b WHERE column_name = 'engine_displacement')) AS engine_displacement
FROM imputed"""))
def outliers_all(spark, sf):
    """log1p(price, mileage) then IQR clip (hp, displacement) on the imputed listings."""
    df = imputed(spark, sf)
    return O.OutlierHandler().fit(df).transform(df).select(
        "listing_id", "price_usd", "mileage_num", "engine_hp", "engine_displacement")


def _report_sql(src, cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS BIGINT) AS n_outliers,
  count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100.0 / count(*) AS pct_outliers, lo AS lower_bound, hi AS upper_bound
FROM {src}, (SELECT lower_bound AS lo, upper_bound AS hi FROM bnds WHERE column_name = '{c}') GROUP BY lo, hi""")
    return "\nUNION ALL\n".join(parts)


@register("outlier_report", Q.with_ctes(LI_SQL, f"bnds AS ({_bounds_sql('li', LI_COLS)})", body=_report_sql("li", LI_COLS)))
def outlier_report(spark, sf):
    """Count and percent of rows outside the IQR fences per lineitem measure."""
    return O.outlier_report(lineitem_gross(spark, sf), LI_COLS)


@register("row_cap", Q.with_ctes(LISTINGS_SQL, Q.CLEANED_SQL, body="""
SELECT listing_id, price_usd, mileage_num FROM cleaned
WHERE coalesce(price_usd >= 1000, true) AND coalesce(price_usd <= 500000, true)
  AND coalesce(mileage_num <= 500000, true)"""))
def row_cap(spark, sf):
    """Declared price (1 000-500 000) and mileage (<= 500 000) range filter."""
    return O.RangeFilter().transform(cleaned(spark, sf)).select("listing_id", "price_usd", "mileage_num")


SC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scale_sql(kind):
    outs = []
    for c in SC_COLS:
        if kind == "standard":
            outs.append(f"({c} - (SELECT avg({c}) FROM lineitem)) / coalesce(nullif((SELECT stddev_pop({c}) FROM lineitem), 0), 1) AS {c}")
        elif kind == "robust":
            outs.append(f"({c} - (SELECT quantile_cont({c}, 0.5) FROM lineitem)) / coalesce(nullif((SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM lineitem), 0), 1) AS {c}")
        else:
            outs.append(f"({c} - (SELECT min({c}) FROM lineitem)) / coalesce(nullif((SELECT max({c}) - min({c}) FROM lineitem), 0), 1) AS {c}")
    return "SELECT l_orderkey, l_linenumber, " + ", ".join(outs) + " FROM lineitem"


def _scaled(spark, sf, kind):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *SC_COLS)
    return Scaler(SC_COLS, kind).fit(df).transform(df)


@register("scale_standard", _scale_sql("standard"))
def scale_standard(spark, sf):
    """A1: (x - mean) / population std (0 -> 1) on four lineitem measures."""
    return _scaled(spark, sf, "standard")


@register("scale_robust", _scale_sql("robust"))
def scale_robust(spark, sf):
    """A2: (x - median) / IQR (0 -> 1)."""
    return _scaled(spark, sf, "robust")


@register("scale_minmax", _scale_sql("minmax"))
def scale_minmax(spark, sf):
    """A3: (x - min) / (max - min) (0 -> 1)."""
    return _scaled(spark, sf, "minmax")


# ------------------------------------------------------------------ E1-E9

from kiln.operators import encode as E  # noqa: E402
from kiln.operators.sparse import SparseOneHotEncoder  # noqa: E402

NUMERIC_FEATURES = ["brand", "model_year", "accident", "price_usd", "mileage_num", "has_clean_title",
                    "is_sport", "is_premium", "is_4WD_AWD", "engine_hp", "engine_displacement"]
EXPECTED = ["brand", "model_year", "mileage_num", "engine_hp", "engine_displacement", "fuel_type_Diesel",
            "fuel_type_Electric", "transmission_type_Manual", "int_col_Navy", "ext_col_Red", "ext_col_Purple"]
P = Q.PREP


def prepared(spark, sf):
    """Imputed listings after the default outlier step (log1p price/mileage, IQR clip)."""
    df = imputed(spark, sf)
    return O.OutlierHandler().fit(df).transform(df)


def to_long(df, key, cols):
    """Unpivot ``cols`` to (key, feature, value double)."""
    return df.unpivot([key], [F.col(c).cast("double").alias(c) for c in cols], "feature", "value")


@register("one_hot", Q.with_ctes(*P, body=Q.onehot_long("prepared")))
def one_hot(spark, sf):
    """Drop-first one-hot of fuel/transmission/colours (null own category), as long rows."""
    df = prepared(spark, sf)
    m = E.OneHotEncoder().fit(df)
    return to_long(m.transform(df), "listing_id", m.feature_names)


@register("target_encode", Q.with_ctes(*P, Q.TE_SQL, body="""
SELECT s.listing_id, coalesce(t.enc, (SELECT p FROM te_prior)) AS brand
FROM prepared s LEFT JOIN te_map t ON s.brand = t.brand"""))
def target_encode(spark, sf):
    """Smoothed brand encoding of log-price fitted on all rows; unseen/null -> prior."""
    df = prepared(spark, sf)
    return E.TargetEncoder().fit(df).transform(df).select("listing_id", "brand")


@register("target_encode_wide", f"""
WITH prior AS (SELECT avg(l_extendedprice) AS p FROM lineitem),
st AS (SELECT l_orderkey, count(*) AS n, avg(l_extendedprice) AS m FROM lineitem GROUP BY l_orderkey)
SELECT s.l_orderkey AS orderkey, s.l_linenumber AS linenumber,
       round(p * (1 - {Q.lam('n')}) + m * {Q.lam('n')}, 3) AS encoded
FROM lineitem s JOIN st ON s.l_orderkey = st.l_orderkey, prior""")
def target_encode_wide(spark, sf):
    """E2 on a key of more categories than are ever collected: extended price by order."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_orderkey", F.col("l_linenumber").alias("linenumber"),
        F.col("l_extendedprice").cast("double").alias("l_extendedprice"))
    out = E.TargetEncoder(["l_orderkey"], target="l_extendedprice", key="orderkey").fit(rows).transform(rows)
    return out.select("orderkey", "linenumber", F.round("l_orderkey", 3).alias("encoded"))


@register("target_encode_oof", Q.with_ctes(*P, Q.OOF_SQL, body="SELECT listing_id, brand FROM oof"))
def target_encode_oof(spark, sf):
    """5-fold out-of-fold brand encoding in one aggregation pass."""
    return E.TargetEncoder().oof_transform(prepared(spark, sf)).select("listing_id", "brand")


def _numeric_long(src):
    return "\nUNION ALL\n".join(
        f"SELECT listing_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {src}" for c in NUMERIC_FEATURES)


@register("encode_all", Q.with_ctes(*P, Q.OOF_SQL, body=_numeric_long("oof") + "\nUNION ALL\n" + Q.onehot_long("oof")))
def encode_all(spark, sf):
    """E4 training path: one-hot then out-of-fold target encoding; the whole matrix as long rows."""
    out = E.CategoricalEncoder().fit_transform(prepared(spark, sf))
    return to_long(out, "listing_id", [c for c in out.columns if c != "listing_id"])


@register("frequency_encode", """
SELECT l_orderkey, l_linenumber, l_partkey,
  count(*) OVER (PARTITION BY l_partkey) / (SELECT count(*) FROM lineitem) AS l_partkey_freq
FROM lineitem""")
def frequency_encode(spark, sf):
    """E5: high-cardinality (> 50 distinct) columns -> share of rows (lineitem part key)."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return E.FrequencyEncoder(["l_partkey"], 50).fit(df).transform(df)


def _align_sql():
    outs = []
    for c in EXPECTED:
        if c == "brand":
            outs.append("coalesce(t.enc, (SELECT p FROM te_prior)) AS brand")
        elif c in NUMERIC_FEATURES:
            outs.append(f"s.{c}")
        else:
            col = next(o for o in Q.ONEHOT_COLS if c.startswith(o + "_"))
            v = c[len(col) + 1:]
            outs.append(f"CASE WHEN EXISTS (SELECT 1 FROM prepared WHERE {col} = '{v}') "
                        f"AND '{v}' <> (SELECT min({col}) FROM prepared) "
                        f"THEN CAST(coalesce(s.{col} = '{v}', false) AS DOUBLE) ELSE 0.0 END AS {c}")
    return "SELECT s.listing_id, " + ", ".join(outs) + " FROM prepared s LEFT JOIN te_map t ON s.brand = t.brand"


@register("align_features", Q.with_ctes(*P, Q.TE_SQL, body=_align_sql()))
def align_features(spark, sf):
    """Scoring-path encoding aligned to a fixed expected feature list (missing -> 0.0)."""
    df = prepared(spark, sf)
    enc = E.CategoricalEncoder().fit(df).transform(df)
    return E.align_features(enc, EXPECTED, keep=["listing_id"])


META_SQL = """SELECT 'brand' AS "column", brand AS category, enc AS value FROM te_map
UNION ALL SELECT 'brand', '__global_fallback__', p FROM te_prior"""


@register("encoding_metadata", Q.with_ctes(*P, Q.TE_SQL, body=META_SQL))
def encoding_metadata(spark, sf):
    """(column, category, value) rows of the fitted target encoding plus the fallback row."""
    return E.TargetEncoder().fit(prepared(spark, sf)).metadata()


@register("known_categories", Q.with_ctes(*P, Q.TE_SQL, f"meta AS ({META_SQL})", body="""
SELECT category FROM meta WHERE "column" = 'brand' AND category <> '__global_fallback__' ORDER BY category"""))
def known_categories(spark, sf):
    """Sorted known brands from the metadata, fallback row excluded."""
    return E.known_categories(E.TargetEncoder().fit(prepared(spark, sf)).metadata())


@register("onehot_sparse", """
WITH li AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE l_partkey END AS part, l_returnflag AS flag FROM lineitem),
v AS (SELECT DISTINCT 0 AS c, part IS NULL AS missing, part, NULL::VARCHAR AS flag FROM li UNION ALL SELECT DISTINCT 1, flag IS NULL, NULL, flag FROM li),
i AS (SELECT *, row_number() OVER (ORDER BY c, missing, part, flag) - 1 AS rank, row_number() OVER (PARTITION BY c ORDER BY missing, part, flag) AS nth FROM v),
p AS (SELECT *, rank - c - 1 AS position FROM i WHERE nth > 1),
s AS (SELECT count(*) AS size FROM p)
SELECT l_orderkey, l_linenumber, CAST(size AS BIGINT) AS size, CAST(a.position AS BIGINT) AS part_position, CAST(b.position AS BIGINT) AS flag_position
FROM li CROSS JOIN s LEFT JOIN p a ON a.c = 0 AND a.part IS NOT DISTINCT FROM li.part LEFT JOIN p b ON b.c = 1 AND b.flag IS NOT DISTINCT FROM li.flag""")
def onehot_sparse(spark, sf):
    """E1 without a bound on categories: line items by part and return flag; a fifth of the orders has no part."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_orderkey") % 5 != 0, F.col("l_partkey")).alias("part"),
                                             F.col("l_returnflag").alias("flag"))
    model = SparseOneHotEncoder(["part", "flag"]).fit(li)
    flags = model.names().filter("column_name = 'flag'").agg(F.min("position")).first()[0]
    at = F.col("features.positions")
    return model.transform(li).select("l_orderkey", "l_linenumber", F.col("features.size").alias("size"),
                                      F.array_min(F.filter(at, lambda x: x < flags)).alias("part_position"),
                                      F.array_min(F.filter(at, lambda x: x >= flags)).alias("flag_position"))
