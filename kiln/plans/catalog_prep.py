"""Registered queries: cleaning (C*) and feature extraction (F*) on ``listings``."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import rules as R
from kiln.functions import text as T
from kiln.operators.clean import Cleaner
from kiln.operators.features import FeatureEngineer
from kiln.plans import sqlparts as Q
from kiln.plans.registry import register
from kiln.sources.fixtures import LISTINGS_SQL, listings


def cleaned(spark, sf):
    return Cleaner().transform(listings(spark, sf))


def featured(spark, sf):
    """Cleaned listings through the feature chain (one-pass fit; result is materialized)."""
    return FeatureEngineer().fit_transform_with_model(cleaned(spark, sf))[0]


L = [LISTINGS_SQL]
LC = [LISTINGS_SQL, Q.CLEANED_SQL]
LCN = [LISTINGS_SQL, Q.CLEANED_SQL, Q.NORM_SQL]


# ------------------------------------------------------------------ C1-C5

@register("clean_price", Q.with_ctes(*L, body=f"""
SELECT listing_id, {Q.num("trim(regexp_replace(price, '[$,]', '', 'g'))")} AS price_usd FROM listings"""))
def clean_price(spark, sf):
    """Currency text -> double over every listing."""
    return listings(spark, sf).select("listing_id", T.clean_currency(F.col("price")).alias("price_usd"))


@register("clean_mileage", Q.with_ctes(*LC, body="SELECT listing_id, mileage_num FROM cleaned"))
def clean_mileage(spark, sf):
    """Distance text -> double."""
    return listings(spark, sf).select("listing_id", T.clean_distance(F.col("milage")).alias("mileage_num"))


@register("clean_fuel_type", Q.with_ctes(*LC, body="SELECT listing_id, fuel_type FROM cleaned"))
def clean_fuel_type(spark, sf):
    """Junk fuel-type tokens -> null."""
    return listings(spark, sf).select("listing_id", T.clean_junk(F.col("fuel_type")).alias("fuel_type"))


@register("clean_title_flag", Q.with_ctes(*LC, body="SELECT listing_id, has_clean_title FROM cleaned"))
def clean_title_flag(spark, sf):
    """C4: ``Yes`` -> 1 else 0."""
    return listings(spark, sf).select("listing_id", T.yes_flag(F.col("clean_title")).alias("has_clean_title"))


@register("clean_all", Q.with_ctes(*LC, body="SELECT * FROM cleaned"))
def clean_all(spark, sf):
    """The default cleaning chain as one projection."""
    return cleaned(spark, sf)


# ------------------------------------------------------------------ F1-F17

@register("model_flags", Q.with_ctes(*L, body=f"""
SELECT listing_id,
  CAST({Q.ci('model', 'Sport|S-Line|M Sport')} AS INTEGER) AS is_sport,
  CAST({Q.ci('model', 'Premium|Platinum|Limited')} AS INTEGER) AS is_premium,
  CAST({Q.ci('model', '4WD|xDrive|Quattro|AWD')} AS INTEGER) AS is_4WD_AWD
FROM listings"""))
def model_flags(spark, sf):
    """keyword flags from the model text."""
    m = F.col("model")
    return listings(spark, sf).select(
        "listing_id",
        T.keyword_flag(m, R.SPORT_PATTERN).alias("is_sport"),
        T.keyword_flag(m, R.PREMIUM_PATTERN).alias("is_premium"),
        T.keyword_flag(m, R.AWD_PATTERN).alias("is_4WD_AWD"))


@register("color_buckets", Q.with_ctes(*LCN, body=f"""
SELECT listing_id, {Q.color_case('n_int')} AS int_col, {Q.color_case('n_ext')} AS ext_col FROM normed"""))
def color_buckets(spark, sf):
    """Normalise, junk -> null, first-match colour family (no fill)."""
    return listings(spark, sf).select(
        "listing_id", T.color_bucket(F.col("int_col")).alias("int_col"),
        T.color_bucket(F.col("ext_col")).alias("ext_col"))


def _labeled_color_sql(n):
    return Q.color_case(f"coalesce({n}, 'unknown')", other="CASE WHEN coalesce(" + n +
                        ", 'unknown') = 'unknown' THEN 'Unknown' ELSE 'Other' END")


@register("color_buckets_labeled", Q.with_ctes(*LCN, body=f"""
SELECT listing_id, {_labeled_color_sql('n_int')} AS int_col, {_labeled_color_sql('n_ext')} AS ext_col
FROM normed"""))
def color_buckets_labeled(spark, sf):
    """notebook variant, junk -> ``Unknown``, no match -> ``Other``."""
    def lab(c):
        norm = F.coalesce(T.normalize_color(F.col(c)), F.lit("unknown"))
        return R.first_match(norm, list(R.COLOR_RULES) + [("^unknown$", "Unknown")], default="Other")
    return listings(spark, sf).select("listing_id", lab("int_col").alias("int_col"),
                                      lab("ext_col").alias("ext_col"))


@register("color_mode_fill", Q.with_ctes(*Q.BASE, body="SELECT listing_id, int_col, ext_col FROM features"))
def color_mode_fill(spark, sf):
    """colour buckets with nulls filled by the fitted mode of the normalised text."""
    return featured(spark, sf).select("listing_id", "int_col", "ext_col")


@register("transmission_bucket", Q.with_ctes(*Q.BASE, body="SELECT listing_id, transmission_type FROM features"))
def transmission_bucket(spark, sf):
    """CVT > Manual > Automatic > null; others -> fitted mode of normalised text."""
    return featured(spark, sf).select("listing_id", "transmission_type")


@register("transmission_bucket_labeled", Q.with_ctes(*LCN, body=f"""
SELECT listing_id, {Q.trans_case("coalesce(n_trans, 'unknown')", "CASE WHEN coalesce(n_trans, 'unknown') = 'unknown' THEN 'Unknown' ELSE 'Automatic' END")}
  AS transmission_type FROM normed"""))
def transmission_bucket_labeled(spark, sf):
    """F8: notebook variant: junk -> ``Unknown``, default always ``Automatic``."""
    raw = F.coalesce(T.normalize_transmission(F.col("transmission")), F.lit("unknown"))
    expr = R.first_match(raw, list(R.TRANSMISSION_RULES) + [("^unknown$", "Unknown")],
                         default=R.TRANSMISSION_DEFAULT)
    return listings(spark, sf).select("listing_id", expr.alias("transmission_type"))


@register("gear_count", Q.with_ctes(*LCN, body=r"""
SELECT listing_id,
  CASE WHEN coalesce(regexp_matches(n_trans, 'cvt|variable'), false) THEN 0.0
       ELSE TRY_CAST(coalesce(nullif(regexp_extract(n_trans, '(\d+)\s*(?:-speed|spd|speed|gear)', 1), ''),
                              nullif(regexp_extract(n_trans, '\b(\d+)\b', 1), '')) AS DOUBLE) END AS transmission_gears
FROM normed"""))
def gear_count(spark, sf):
    """gear count from transmission text; CVT -> 0."""
    return listings(spark, sf).select("listing_id", T.gear_count(F.col("transmission")).alias("transmission_gears"))


@register("engine_hp", Q.with_ctes(*LCN, body=f"SELECT listing_id, {Q.hp_expr('n_eng')} AS engine_hp FROM normed"))
def engine_hp(spark, sf):
    """horsepower number from engine text."""
    return listings(spark, sf).select("listing_id", T.engine_hp(F.col("engine")).alias("engine_hp"))


@register("engine_displacement", Q.with_ctes(*Q.BASE, body="SELECT listing_id, engine_displacement FROM features"))
def engine_displacement(spark, sf):
    """F11 + F14: litres from engine text; electric -> 0."""
    return listings(spark, sf).select("listing_id",
                                      T.engine_displacement(F.col("engine")).alias("engine_displacement"))


@register("engine_cylinders", Q.with_ctes(*LCN, body=f"""
SELECT listing_id,
  CASE WHEN {Q.fuel_case('n_eng')} = 'Electric' THEN 0.0
       ELSE TRY_CAST(coalesce(nullif(regexp_extract(n_eng, '(?i)(\\d+)\\s*Cylinder', 1), ''),
                              nullif(regexp_extract(n_eng, '(?i)\\b(?:V|I|H|V-)(\\d+)\\b', 1), ''),
                              CASE WHEN {Q.ci('n_eng', 'Straight 6|Flat 6')} THEN '6' END) AS DOUBLE) END
  AS engine_cylinders
FROM normed"""))
def engine_cylinders(spark, sf):
    """F12 (+F14): cylinder count from engine text; electric -> 0."""
    return listings(spark, sf).select("listing_id", T.engine_cylinders(F.col("engine")).alias("engine_cylinders"))


@register("engine_fuel", Q.with_ctes(*LCN, body=f"SELECT listing_id, {Q.fuel_case('n_eng')} AS fuel_type_engine FROM normed"))
def engine_fuel(spark, sf):
    """fuel type derived from engine text."""
    return listings(spark, sf).select("listing_id", T.engine_fuel(F.col("engine")).alias("fuel_type_engine"))


@register("fuel_type_merge", Q.with_ctes(*Q.BASE, body="SELECT listing_id, fuel_type FROM features"))
def fuel_type_merge(spark, sf):
    """cleaned fuel type back-filled from the engine-derived one."""
    c = cleaned(spark, sf)
    return c.select("listing_id", F.coalesce(F.col("fuel_type"), T.engine_fuel(F.col("engine"))).alias("fuel_type"))


@register("accident_flag", Q.with_ctes(*Q.BASE, body="SELECT listing_id, accident FROM features"))
def accident_flag(spark, sf):
    """F16: accident text -> 0/1 double."""
    return listings(spark, sf).select("listing_id", T.accident_flag(F.col("accident")).alias("accident"))


@register("features_all", Q.with_ctes(*Q.BASE, body="SELECT * FROM features"))
def features_all(spark, sf):
    """the whole default feature chain (fitted fallbacks) after cleaning."""
    return featured(spark, sf)
