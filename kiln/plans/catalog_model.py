"""Registered queries: sources/sinks (S*, K*), validation (V*), splits (P*),
models and gates (M*), flows (D*), streaming (ST1) and custom steps (U1)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from kiln.functions import rules as R
from kiln.operators import encode as E
from kiln.operators import model as M
from kiln.operators import split as P
from kiln.operators import validate as V
from kiln.plans import sqlparts as Q
from kiln.plans.catalog_fit import _numeric_long, to_long
from kiln.plans.catalog_prep import cleaned, featured
from kiln.plans.pipeline import CustomStep, Preprocessor, run_training
from kiln.plans.registry import register
from kiln.session import table
from kiln.sources import readers as RD
from kiln.sources.csvsplit import read_csv_split
from kiln.sources import sinks as K
from kiln.sources.fixtures import LISTINGS_SQL, listings
from kiln.sources.spec import raw_schema
from kiln.streaming.score import score_available_now

L = [LISTINGS_SQL]
RAW_COLS = "listing_id, brand, model, model_year, milage, fuel_type, engine, transmission, ext_col, int_col, accident, clean_title, price"

_TRAINED: dict = {}


def trained(spark, sf):
    """D2 training flow on the listings, run once per session and input folder."""
    k = (id(spark), sf)
    if k not in _TRAINED:
        raw = listings(spark, sf)
        _TRAINED[k] = (run_training(raw), raw)
    return _TRAINED[k]


def test_rows(spark, sf):
    res, raw = trained(spark, sf)
    return P.hash_split(raw, "listing_id", R.TEST_RATIO, "_s").filter(F.col("_s") == "test").drop("_s")


# ------------------------------------------------------------------ S1-S9

@register("scan_csv_roundtrip", Q.with_ctes(*L, body=f"SELECT {RAW_COLS} FROM listings"))
def scan_csv_roundtrip(spark, sf):
    """K1 + S1 + S6: write the raw listings as header CSV, read back with the declared schema."""
    path = K.write_table(listings(spark, sf), K.scratch_path(spark, "listings_csv"), fmt="csv")
    return RD.read_source(spark, {"path": path}, raw_schema("listing_id"))


@register("scan_csv_ranges", "SELECT doc_id, text, lang FROM documents")
def scan_csv_ranges(spark, sf):
    """Whole documents, line feeds and quotes included, written as CSV and read back in byte ranges of 1 MB."""
    path = K.scratch_path(spark, "documents_csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    (docs.write.option("header", True).option("escape", '"').option("quoteAll", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return read_csv_split(spark, path, docs.schema, range_bytes=1 << 20)


def _documents(spark, sf):
    docs = listings(spark, sf).withColumn("_id", F.col("listing_id").cast("string"))
    path = K.scratch_path(spark, "listings_docs")
    docs.write.mode("overwrite").json(path)
    return path


@register("scan_documents_json", Q.with_ctes(*L, body=f"SELECT CAST(listing_id AS VARCHAR) AS _id, {RAW_COLS} FROM listings"))
def scan_documents_json(spark, sf):
    """Every document of a JSON-lines collection as a table, ``_id`` kept."""
    return RD.read_documents(spark, {"path": _documents(spark, sf), "schema": raw_schema("listing_id")})


@register("drop_system_id", Q.with_ctes(*L, body=f"SELECT {RAW_COLS} FROM listings"))
def drop_system_id(spark, sf):
    """Source dispatch for a collection spec, then the ``_id`` column dropped."""
    spec = {"collection": "listings", "path": _documents(spark, sf), "format": "json"}
    return RD.read_source(spark, spec, raw_schema("listing_id"))


@register("null_tokens", Q.with_ctes(*L, body=f"SELECT {RAW_COLS} FROM listings"))
def null_tokens(spark, sf):
    """pandas' default missing-value tokens -> null over every string column."""
    return RD.normalize_null_tokens(listings(spark, sf))


@register("compose_raw_text", Q.with_ctes(*Q.BASE, body="""
SELECT listing_id,
  CASE WHEN accident = 1 THEN 'At least 1 accident or damage reported' ELSE 'None reported' END AS accident,
  CASE WHEN has_clean_title = 1 THEN 'Yes' ELSE 'No' END AS clean_title,
  coalesce(nullif(concat_ws(' ', CASE WHEN is_sport = 1 THEN 'Sport' END, CASE WHEN is_premium = 1 THEN 'Premium' END,
                            CASE WHEN is_4WD_AWD = 1 THEN '4WD' END), ''), 'Base Model') AS model,
  CAST(mileage_num AS VARCHAR) || ' mi.' AS milage,
  CAST(engine_hp AS VARCHAR) || ' HP ' || CAST(engine_displacement AS VARCHAR) || 'L' AS engine
FROM features"""))
def compose_raw_text(spark, sf):
    """Engineered fields of every listing turned back into raw form text."""
    f = featured(spark, sf)
    cols = RD.compose_raw_text(F.col("accident"), F.col("has_clean_title"), F.col("is_sport"),
                               F.col("is_premium"), F.col("is_4WD_AWD"), F.col("mileage_num"),
                               F.col("engine_hp"), F.col("engine_displacement"))
    return f.select("listing_id", *[e.alias(n) for n, e in cols.items()])


@register("score_raw_batch")
def score_raw_batch(spark, sf):
    """Raw test-split rows, price replaced by the dummy ``"0"`` of S8, scored by the trained bundle."""
    res, _ = trained(spark, sf)
    raw = test_rows(spark, sf).withColumn("price", F.lit("0"))
    return res.bundle.score(raw)


# ------------------------------------------------------------------ V1-V4

_SPLIT_SQL = f"""split AS (SELECT *, CASE WHEN {Q.hash32_sql('listing_id')} < {int(0.25 * (1 << 32))}
                           THEN 'test' ELSE 'train' END AS part FROM listings)"""


@register("validation_report", Q.with_ctes(*L, body="""
SELECT (SELECT count(*) FROM (DESCRIBE SELECT * EXCLUDE (listing_id) FROM listings)) = 12 AS validation_status,
       '' AS message"""))
def validation_report(spark, sf):
    """V1-V3 + K4: count/presence checks of the train and test parts -> report row."""
    parts = P.hash_split(listings(spark, sf), "listing_id", R.TEST_RATIO, "part")
    train = parts.filter(F.col("part") == "train").drop("part", "listing_id")
    test = parts.filter(F.col("part") == "test").drop("part", "listing_id")
    return V.validate({"train": train, "test": test}).frame(spark)


@register("validation_missing_columns", Q.with_ctes(*L, Q.CLEANED_SQL, body="""
SELECT d.class, d.column_name FROM (VALUES ('numerical', 'model_year', 1), ('categorical', 'brand', 2),
  ('categorical', 'model', 3), ('categorical', 'fuel_type', 4), ('categorical', 'engine', 5),
  ('categorical', 'transmission', 6), ('categorical', 'ext_col', 7), ('categorical', 'int_col', 8),
  ('categorical', 'accident', 9), ('categorical', 'clean_title', 10)) d(class, column_name, pos)
WHERE d.column_name NOT IN (SELECT column_name FROM (DESCRIBE SELECT * FROM cleaned))"""))
def validation_missing_columns(spark, sf):
    """V2: declared columns missing from the cleaned table, as (class, column_name) rows."""
    miss = V.missing_columns(cleaned(spark, sf))
    return spark.createDataFrame(miss, "class string, column_name string")


def _castability_sql():
    parsed = {"price": Q.num("trim(regexp_replace(price, '[$,]', '', 'g'))"),
              "milage": Q.num(r"trim(regexp_replace(regexp_replace(milage, ',', '', 'g'), '\s*mi\.?\s*$', ''))")}
    parts = []
    for c in ["brand", "model", "model_year", "milage", "fuel_type", "engine", "transmission", "ext_col",
              "int_col", "accident", "clean_title", "price"]:
        decl, typ = ("int64", "BIGINT") if c == "model_year" else ("str", "VARCHAR")
        bad = f"count(*) FILTER (WHERE {c} IS NOT NULL AND {parsed[c]} IS NULL)" if c in parsed else "0"
        parts.append(f"SELECT '{c}' AS column_name, '{decl}' AS declared_type, "
                     f"(SELECT column_type FROM (DESCRIBE SELECT {c} FROM listings)) = '{typ}' AS type_ok, "
                     f"count({c}) AS n_non_null, CAST({bad} AS BIGINT) AS n_unparsable FROM listings")
    return "\nUNION ALL\n".join(parts)


@register("validation_castability", Q.with_ctes(*L, body=_castability_sql()))
def validation_castability(spark, sf):
    """V4 + C7: declared-type check and unparsable-value counts per raw column."""
    return V.castability(listings(spark, sf))


# ------------------------------------------------------------------ P1-P3, K2, K3

_DIRTY_SQL = """dirty AS (SELECT * REPLACE (CASE WHEN listing_id % 11 = 0 THEN NULL ELSE brand END AS brand,
  CASE WHEN listing_id % 17 = 0 THEN 'ask' ELSE price END AS price) FROM listings)"""


@register("quarantine_reasons", Q.with_ctes(*L, _DIRTY_SQL, body="""
SELECT reason, count(*) AS n FROM (
  SELECT 'missing brand' AS reason FROM dirty WHERE brand IS NULL UNION ALL SELECT 'unparsable price' FROM dirty WHERE price = 'ask'
  UNION ALL SELECT 'unparsable milage' FROM dirty WHERE milage = 'unknown') GROUP BY 1
UNION ALL SELECT 'accepted', count(*) FROM dirty WHERE brand IS NOT NULL AND price <> 'ask' AND milage <> 'unknown'"""))
def quarantine_reasons(spark, sf):
    """V4, enforcing: listings with missing brands and prices and mileages that don't parse, routed; rows per reason and accepted."""
    k = F.col("listing_id")
    dirty = listings(spark, sf).withColumns({"brand": F.when(k % 11 != 0, F.col("brand")),
                                             "price": F.when(k % 17 == 0, F.lit("ask")).otherwise(F.col("price"))})
    path = K.scratch_path(spark, "quarantine")
    good = V.accept_rows(dirty, path)
    bad = spark.read.parquet(path).select(F.explode(V.REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return bad.unionByName(good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("accepted").alias("reason"), "n"))


@register("split_hash", Q.with_ctes(*L, _SPLIT_SQL, body="SELECT listing_id, part AS split FROM split"))
def split_hash(spark, sf):
    """P1 (scalable): md5-hash split with test ratio 0.25."""
    return P.hash_split(listings(spark, sf), "listing_id", R.TEST_RATIO).select("listing_id", "split")


@register("split_exact", Q.with_ctes(*L, body=f"""
SELECT listing_id, CASE WHEN row_number() OVER (ORDER BY {Q.hash32_sql('listing_id')}, listing_id)
                           <= ceil((SELECT count(*) FROM listings) * 0.25) THEN 'test' ELSE 'train' END AS split
FROM listings"""))
def split_exact(spark, sf):
    """P1 (exact size) + K2: ceil(n * 0.25) test rows by hash order, written
    partitioned by split and read back."""
    s = P.exact_split(listings(spark, sf), "listing_id", R.TEST_RATIO).select("listing_id", "split")
    path = K.write_table(s, K.scratch_path(spark, "splits"), partition_by=["split"])
    return spark.read.parquet(path).select("listing_id", "split")


@register("split_exact_repeated", """
WITH r AS (SELECT CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_returnflag END AS flag, l_extendedprice FROM lineitem),
k AS (SELECT count(*) AS n, CAST(ceil(count(*) * 0.25) AS BIGINT) AS n_test, CAST(sum(round(l_extendedprice * 100)) AS BIGINT) AS cents,
             count(flag) AS n_keys FROM r)
SELECT n_test, n - n_test AS n_train, cents, n_keys FROM k""")
def split_exact_repeated(spark, sf):
    """P1 (exact size) by a key of three values and nulls: the size is exact, and every row is in one part."""
    li = table(spark, sf, "lineitem").select(F.when(F.col("l_partkey") % 3 != 0, F.col("l_returnflag")).alias("flag"),
                                             "l_orderkey", "l_linenumber", "l_extendedprice")
    s = P.exact_split(li, "flag", R.TEST_RATIO)
    return s.agg(F.count_if(F.col("split") == "test").alias("n_test"), F.count_if(F.col("split") == "train").alias("n_train"),
                 F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("cents"), F.count("flag").alias("n_keys"))


@register("kfold_assign", Q.with_ctes(*L, body=f"SELECT listing_id, CAST({Q.hash32_sql('listing_id')} % 5 AS INTEGER) AS fold FROM listings"))
def kfold_assign(spark, sf):
    """5 hash folds."""
    return P.kfold(listings(spark, sf), "listing_id", 5).select("listing_id", "fold")


@register("feature_matrix", Q.with_ctes(*Q.PREP, Q.OOF_SQL, body=_numeric_long("oof") + "\nUNION ALL\n" + Q.onehot_long("oof")))
def feature_matrix(spark, sf):
    """D1 + P2 + K3: default chain's training matrix, written as named-column
    parquet and read back (long rows for comparison)."""
    matrix, _ = Preprocessor().fit_transform_with_model(listings(spark, sf))
    path = K.write_table(matrix, K.scratch_path(spark, "feature_matrix"))
    back = spark.read.parquet(path)
    features, _ = P.feature_target(back, "price_usd")
    x = to_long(features, "listing_id", [c for c in features.columns if c != "listing_id"])
    y = to_long(back.select("listing_id", "price_usd"), "listing_id", ["price_usd"])
    return x.unionByName(y)


# ------------------------------------------------------------------ K4-K9

@register("model_roundtrip")
def model_roundtrip(spark, sf):
    """K6: the trained bundle saved, loaded back and used to score the test rows."""
    res, _ = trained(spark, sf)
    path = K.save_model(res.bundle, K.scratch_path(spark, "bundle"), spark)
    return K.load_model(path, spark).score(test_rows(spark, sf))


@register("registry_publish")
def registry_publish(spark, sf):
    """K7 + K8: publish two versions to a registry, resolve the latest, list the registry."""
    res, _ = trained(spark, sf)
    root = K.scratch_path(spark, "registry")
    r2 = res.metrics.first()["r2"]
    K.publish(spark, res.bundle, root, "price_model", r2, datetime(2026, 1, 12, 10, 0, 0))
    reg = K.publish(spark, res.bundle, root, "price_model", r2, datetime(2026, 1, 12, 11, 30, 0))
    latest = K.resolve_latest_model(spark, root, "price_model")
    assert latest is not None
    return reg


@register("latest_per_key", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""")
def latest_per_key(spark, sf):
    """K8: the latest event per user (ties broken by the larger event id)."""
    ev = table(spark, sf, "events")
    out = K.latest_per_key(ev, ["user_id"], [F.col("ts"), F.col("event_id")])
    return out.select("event_id", "ts", "user_id", "event_type", "value", "props")


@register("latest_parsed_version", """
WITH folders AS (
  SELECT o_orderpriority,
    CASE WHEN o_orderkey % 50 = 0 THEN 'latest_artifact'
         ELSE strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%m_%d_%Y_%H_%M_%S') END AS folder
  FROM orders),
parsed AS (SELECT o_orderpriority, folder, try_strptime(folder, '%m_%d_%Y_%H_%M_%S') AS version_ts
           FROM folders WHERE try_strptime(folder, '%m_%d_%Y_%H_%M_%S') IS NOT NULL)
SELECT o_orderpriority, folder, version_ts FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY version_ts DESC, folder DESC) AS rn FROM parsed)
WHERE rn = 1""")
def latest_parsed_version(spark, sf):
    """K9: newest parsable timestamp-named folder per registry key (folder names
    built from order dates; ``latest_artifact`` entries are not parsable)."""
    o = table(spark, sf, "orders")
    stamp = F.expr("o_orderdate + make_interval(0, 0, 0, 0, 0, 0, o_orderkey % 86400)")
    folder = F.when(F.col("o_orderkey") % 50 == 0, F.lit("latest_artifact")).otherwise(
        F.date_format(stamp, R.VERSION_FOLDER_FORMAT))
    names = o.select("o_orderpriority", folder.alias("folder"))
    return K.latest_parsed_version(names, "folder", ["o_orderpriority"]).select(
        "o_orderpriority", "folder", "version_ts")


@register("validation_report_json", Q.with_ctes(*L, body="""
SELECT (SELECT count(*) FROM (DESCRIBE SELECT * EXCLUDE (listing_id) FROM listings)) = 12 AS validation_status,
       '' AS message"""))
def validation_report_json(spark, sf):
    """K4: the validation report written as JSON and read back."""
    rep = validation_report(spark, sf)
    path = K.write_json_rows(rep, K.scratch_path(spark, "report"))
    return spark.read.schema("validation_status boolean, message string").json(path)


# ------------------------------------------------------------------ M1-M15

LOG_SQL = "li AS (SELECT l_returnflag, ln(l_extendedprice) AS y, ln(l_quantity) AS x FROM lineitem)"
FIT_SQL = "fit AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM li)"
CHAMPION = {"intercept": 7.0, "weights": {"x": 1.0}}


def _log_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select("l_returnflag", F.log("l_extendedprice").alias("y"), F.log("l_quantity").alias("x"))


def _with_fit(spark, sf):
    df = _log_lineitem(spark, sf)
    fit = M.univariate_ols(df, "y", "x").first()
    return df.withColumn("p", M.linear_score({"x": fit["slope"]}, fit["intercept"]))


def _metrics_sql(by: str | None, name: str) -> str:
    g = f"{by}, " if by else ""
    grp = f" GROUP BY {by}" if by else ""
    return f"""SELECT {g}'{name}' AS model, avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse,
  CASE WHEN var_pop(y) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) END AS r2,
  avg(abs(y - p)) AS mae, count(*) AS n
FROM (SELECT li.*, fit.a + fit.b * li.x AS p FROM li, fit){grp}"""


@register("ols_univariate", Q.with_ctes(LOG_SQL, body="""
SELECT l_returnflag, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2,
       CAST(regr_count(y, x) AS BIGINT) AS n FROM li GROUP BY l_returnflag"""))
def ols_univariate(spark, sf):
    """M1 (one regressor): log extended price on log quantity, per return flag."""
    return M.univariate_ols(_log_lineitem(spark, sf), "y", "x", ["l_returnflag"])


@register("ols_multi")
def ols_multi(spark, sf):
    """M1/M9: multivariate OLS on the encoded listing matrix; test-split predictions."""
    res, _ = trained(spark, sf)
    return res.bundle.score(test_rows(spark, sf), keep_label=True)


@register("regression_metrics", Q.with_ctes(LOG_SQL, FIT_SQL, body=_metrics_sql(None, "univariate_ols")))
def regression_metrics(spark, sf):
    """M3-M6: mse, rmse, r2, mae of the fitted log-log line, one aggregation."""
    return M.regression_metrics(_with_fit(spark, sf), "y", "p", "univariate_ols")


@register("regression_metrics_by_group", Q.with_ctes(LOG_SQL, FIT_SQL, body=_metrics_sql("l_returnflag", "univariate_ols")))
def regression_metrics_by_group(spark, sf):
    """M7: the same metrics per return flag."""
    return M.regression_metrics(_with_fit(spark, sf), "y", "p", "univariate_ols", by=["l_returnflag"])


@register("quality_gate", Q.with_ctes(LOG_SQL, FIT_SQL, f"m AS ({_metrics_sql(None, 'univariate_ols')})", body="""
SELECT model, r2, CAST(0.6 AS DOUBLE) AS min_r2, coalesce(r2 >= 0.6, false) AS passed FROM m"""))
def quality_gate(spark, sf):
    """M8: minimum-quality gate (r2 >= 0.6)."""
    return M.quality_gate(M.regression_metrics(_with_fit(spark, sf), "y", "p", "univariate_ols"))


def _r2_sql(p: str) -> str:
    e2 = f"(y - {p}) * (y - {p})"
    return (f"CASE WHEN var_pop(y) = 0 THEN CASE WHEN sum({e2}) = 0 THEN 1.0 ELSE 0.0 END "
            f"ELSE 1 - sum({e2}) / (var_pop(y) * count(*)) END")


@register("champion_challenger", Q.with_ctes(LOG_SQL, FIT_SQL, body=f"""
SELECT r2_new, r2_old, r2_new - r2_old AS difference, r2_new - r2_old > 0.0 AS accepted FROM (
  SELECT {_r2_sql('p_new')} AS r2_new, {_r2_sql('p_old')} AS r2_old
  FROM (SELECT li.y, fit.a + fit.b * li.x AS p_new, 7.0 + 1.0 * li.x AS p_old FROM li, fit))"""))
def champion_challenger(spark, sf):
    """Fitted line (challenger) vs fixed-coefficient champion on the same rows."""
    df = _with_fit(spark, sf).withColumn("p_old", M.linear_score(CHAMPION["weights"], CHAMPION["intercept"]))
    return M.champion_challenger(df, "y", "p", "p_old", min_improvement=0.0)


@register("score_engineered_batch")
def score_engineered_batch(spark, sf):
    """M13 + E8: engineered test rows with a string brand: brand mapped through
    the metadata table (fallback constant), aligned, then predicted."""
    res, _ = trained(spark, sf)
    pre = res.bundle.preprocess
    cur = pre.cleaner.transform(test_rows(spark, sf))
    cur = pre.outliers.transform(pre.imputers.transform(pre.features.transform(cur)))
    cur = pre.encoder.one_hot.transform(cur).drop("price_usd")
    meta = pre.encoder.target.metadata()
    enc = E.encode_with_metadata(cur, meta, "brand")
    aligned = E.align_features(enc, pre.feature_names, keep=["listing_id"])
    return M.predict(res.bundle.regression, aligned).select(
        "listing_id", "prediction", F.expm1("prediction").alias("price"))


@register("format_currency", "SELECT o_orderkey, '$' || printf('%,.2f', o_totalprice) AS price_text FROM orders")
def format_currency(spark, sf):
    """Amounts as ``$1,234.50`` text."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", M.format_currency(F.col("o_totalprice")).alias("price_text"))


@register("linear_score", """
SELECT l_orderkey, l_linenumber, 0.5 + 1.5 * l_quantity + -20.0 * l_discount + 10.0 * l_tax AS score FROM lineitem""")
def linear_score(spark, sf):
    """Explicit-coefficient linear score over every line item."""
    li = table(spark, sf, "lineitem")
    s = M.linear_score({"l_quantity": 1.5, "l_discount": -20.0, "l_tax": 10.0}, 0.5)
    return li.select("l_orderkey", "l_linenumber", s.alias("score"))


# ------------------------------------------------------------------ ST1, U1, D2

@register("score_stream_available_now")
def score_stream_available_now(spark, sf):
    """ST1: raw test rows landed as parquet files, scored by a file stream (availableNow)."""
    res, _ = trained(spark, sf)
    src = K.write_table(test_rows(spark, sf).repartition(4), K.scratch_path(spark, "stream_in"))
    return score_available_now(spark, res.bundle, src, raw_schema("listing_id"),
                               K.scratch_path(spark, "stream_out"), K.scratch_path(spark, "stream_ckpt"))


@register("custom_step", Q.with_ctes(*Q.BASE, body="SELECT listing_id, 2024 - model_year AS vehicle_age FROM features"))
def custom_step(spark, sf):
    """A user-supplied step (vehicle age from the declared current year 2024)."""
    step = CustomStep(lambda df: df.withColumn("vehicle_age", F.lit(2024) - F.col("model_year")))
    df = featured(spark, sf)
    return step.fit(df).transform(df).select("listing_id", "vehicle_age")


@register("entry_flow")
def entry_flow(spark, sf):
    """Train on the hash-split listings; test metrics with quality gate and
    champion/challenger decision (no champion registered yet)."""
    res, _ = trained(spark, sf)
    d = res.decision.first()  # one-row aggregate
    m = res.metrics
    return m.select("*", F.lit(R.MIN_R2).alias("min_r2"),
                    F.coalesce(F.col("r2") >= F.lit(R.MIN_R2), F.lit(False)).alias("passed"),
                    F.lit(d["r2_old"]).alias("r2_old"), F.lit(d["accepted"]).alias("accepted"))
