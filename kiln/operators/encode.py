"""One-hot, smoothed and out-of-fold target encoding, frequency
encoding, feature alignment and the encoding metadata table.

Target encoding (Micci-Barreca): with n rows of category k, mean_k their
target mean, prior the overall mean,
    lambda(n) = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing))
    enc_k     = prior * (1 - lambda) + mean_k * lambda
Unseen and missing categories get the prior. Out-of-fold encoding aggregates
once by (category, fold) and subtracts each fold from the category totals, so
k folds cost one pass instead of k fits.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.functions import rules as R
from kiln.operators.base import Estimator, Model, ParamTable, present, replace_columns
from kiln.operators.split import hash_bucket

ONE_HOT_COLUMNS = ("fuel_type", "transmission_type", "int_col", "ext_col")
MAX_CATEGORIES = 1000


# ----------------------------------------------------------------- E1

@dataclass
class OneHotEncoder(Estimator):
    """Sorted categories, first dropped, null its own (last) category named
    ``{col}_null``; unseen -> all zeros; columns appended, sources dropped.

    The fit checks cardinality with a sketch before collecting category sets,
    so an unexpectedly wide column fails fast instead of flooding the driver.
    """

    columns: Sequence[str] = ONE_HOT_COLUMNS
    drop_first: bool = True
    max_categories: int = MAX_CATEGORIES

    def fit(self, df: DataFrame) -> "OneHotModel":
        cols = list(self.columns)
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise ValueError(f"one-hot columns missing: {missing}")
        approx = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
        wide = [c for c in cols if approx[c] > self.max_categories * 1.05]
        if wide:
            raise ValueError(f"too many categories for one-hot in {wide} (> {self.max_categories})")
        row = df.agg(*[F.array_sort(F.collect_set(F.col(c))).alias(c) for c in cols],
                     *[F.max(F.col(c).isNull().cast("int")).alias(f"{c}__null") for c in cols]).first()
        cats = {}
        for c in cols:
            values = list(row[c] or [])
            if row[f"{c}__null"]:
                values.append(None)
            if len(values) > self.max_categories:
                raise ValueError(f"too many categories for one-hot in {c}")
            cats[c] = values[1:] if self.drop_first and values else values
        return OneHotModel(cols, cats)


@dataclass
class OneHotModel(Model):
    columns: list
    categories: dict

    def features(self) -> list[tuple[str, object, str]]:
        """(source column, category, output name) in output order.

        Spark resolves names case-insensitively, so a name equal (ignoring
        case) to an earlier one of the same column gets ``_2``, ``_3``, ...
        """
        out = []
        for c in self.columns:
            seen: dict[str, int] = {}
            for v in self.categories[c]:
                name = f"{c}_{'null' if v is None else v}"
                k = seen.get(name.lower(), 0) + 1
                seen[name.lower()] = k
                out.append((c, v, name if k == 1 else f"{name}_{k}"))
        return out

    @property
    def feature_names(self) -> list[str]:
        return [n for _, _, n in self.features()]

    def indicator(self, c: str, v) -> Column:
        x = F.col(c)
        return (x.isNull() if v is None else F.coalesce(x == F.lit(v), F.lit(False))).cast("double")

    def transform(self, df: DataFrame) -> DataFrame:
        if not all(c in df.columns for c in self.columns):
            raise ValueError("one-hot source columns missing at transform")
        keep = [F.col(c) for c in df.columns if c not in self.columns]
        new = [self.indicator(c, v).alias(name) for c, v, name in self.features()]
        return df.select(*keep, *new)


# ----------------------------------------------------------------- E2 / E3

def _weight(n: Column, min_samples_leaf: float, smoothing: float) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(float(min_samples_leaf))) / F.lit(float(smoothing))))


def _blend(prior: Column, mean: Column, n: Column, m: float, s: float) -> Column:
    lam = _weight(n, m, s)
    return prior * (F.lit(1.0) - lam) + mean * lam


@dataclass
class TargetEncoder(Estimator):
    """E2 (``fit``/``transform``) and E3 (``fit_transform``: out-of-fold values).

    ``key`` is the row key hashed into ``n_folds`` folds for E3.
    """

    columns: Sequence[str] = ("brand",)
    target: str = "price_usd"
    smoothing: float = 10.0
    min_samples_leaf: float = 20.0
    n_folds: int = 5
    key: str = "listing_id"

    def _lam(self, n: float) -> float:
        return 1.0 / (1.0 + math.exp(-(n - self.min_samples_leaf) / self.smoothing))

    def fit(self, df: DataFrame) -> "TargetModel":
        """Master encoder: per column one grouping-sets job gives the prior and
        every category's (count, mean)."""
        y = F.col(self.target)
        prior, tables = None, {}
        for c in self.columns:
            stats = df.groupingSets([[c], []], c).agg(
                F.count(y).alias("_n"), F.avg(y).alias("_mean"), F.grouping_id(c).alias("_gid")).persist()
            head = stats.limit(ParamTable.COLLECT_MAX_ROWS + 2).collect()
            if prior is None:  # by its own filter: the head need not hold the total
                prior = stats.filter("_gid = 1").first()["_mean"]
            schema = T.StructType([df.schema[c], T.StructField("_enc", T.DoubleType())])
            if len(head) <= ParamTable.COLLECT_MAX_ROWS + 1:
                rows = []
                for r in head:
                    if r["_gid"] == 0 and r[c] is not None:
                        enc = prior if r["_mean"] is None or prior is None else (
                            prior * (1 - self._lam(r["_n"])) + r["_mean"] * self._lam(r["_n"]))
                        rows.append((r[c], enc))
                tables[c] = ParamTable.from_rows(df.sparkSession, rows, schema, [c])
            else:
                full = stats.filter((F.col("_gid") == 0) & F.col(c).isNotNull())
                enc = full.select(c, F.coalesce(_blend(F.lit(prior), F.col("_mean"), F.col("_n"),
                                                       self.min_samples_leaf, self.smoothing),
                                                F.lit(prior)).alias("_enc"))
                tables[c] = ParamTable(enc, [c])
            stats.unpersist()
        return TargetModel(list(self.columns), tables, prior)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        """Out-of-fold encoding of ``df`` itself (the master fit is separate)."""
        return self.oof_transform(df)

    def oof_transform(self, df: DataFrame) -> DataFrame:
        """Each row encoded from the other folds' rows only: one job per column
        aggregates (category, fold) and fold totals; out-of-fold sums are
        category totals minus the row's own fold."""
        y = F.col(self.target)
        cur = df.withColumn("_fold", hash_bucket(F.col(self.key), self.n_folds))
        new, fold_prior = {}, None
        for c in self.columns:
            stats = cur.groupingSets([[c, "_fold"], ["_fold"]], c, "_fold").agg(
                F.count(y).alias("_nf"), F.sum(y).alias("_sf"), F.grouping_id(c, "_fold").alias("_gid")).persist()
            head = stats.limit(ParamTable.COLLECT_MAX_ROWS + self.n_folds + 1).collect()
            if fold_prior is None:
                # n_folds rows, by their own filter: the head need not hold them
                ft = [(r["_fold"], r["_nf"], r["_sf"] or 0.0) for r in stats.filter("_gid = 2").collect()]
                n_all, s_all = sum(n for _, n, _ in ft), sum(v for _, _, v in ft)
                priors = {f: ((s_all - v) / (n_all - n) if n_all > n else None) for f, n, v in ft}
                fold_prior = F.map_from_arrays(F.array(*[F.lit(int(k)) for k in priors]),
                                               F.array(*[F.lit(v).cast("double") for v in priors.values()]))[F.col("_fold")]
            schema = T.StructType([cur.schema[c], T.StructField("_fold", T.IntegerType()),
                                   T.StructField(f"_n_{c}", T.LongType()), T.StructField(f"_s_{c}", T.DoubleType())])
            if len(head) <= ParamTable.COLLECT_MAX_ROWS + self.n_folds:
                cells = [(r[c], r["_fold"], r["_nf"], r["_sf"] or 0.0) for r in head
                         if r["_gid"] == 0 and r[c] is not None]
                tot: dict = {}
                for k, _, n, v in cells:
                    tn, ts = tot.get(k, (0, 0.0))
                    tot[k] = (tn + n, ts + v)
                rows = [(k, f, tot[k][0] - n, tot[k][1] - v) for k, f, n, v in cells]
                table = ParamTable.from_rows(cur.sparkSession, rows, schema, [c, "_fold"])
            else:
                w = Window.partitionBy(c)
                by_fold = stats.filter((F.col("_gid") == 0) & F.col(c).isNotNull())
                table = ParamTable(by_fold.select(
                    c, "_fold", (F.sum("_nf").over(w) - F.col("_nf")).alias(f"_n_{c}"),
                    (F.coalesce(F.sum("_sf").over(w), F.lit(0.0)) - F.coalesce(F.col("_sf"), F.lit(0.0)))
                    .alias(f"_s_{c}")), [c, "_fold"])
            stats.unpersist()
            cur = table.lookup(cur)
            n, sm = F.col(f"_n_{c}"), F.col(f"_s_{c}")
            enc = F.when(n > 0, _blend(fold_prior, sm / n, n, self.min_samples_leaf, self.smoothing))
            new[c] = F.coalesce(enc, fold_prior)
        out = replace_columns(cur, new)
        return out.select(*df.columns)


@dataclass
class TargetModel(Model):
    columns: list
    tables: dict
    prior: float

    def transform(self, df: DataFrame) -> DataFrame:
        cur = df
        new = {}
        for c in self.columns:
            if c not in df.columns:
                continue
            cur = self.tables[c].renamed({"_enc": f"_enc_{c}"}).lookup(cur)
            new[c] = F.coalesce(F.col(f"_enc_{c}"), F.lit(self.prior))
        return replace_columns(cur, new).select(*df.columns)

    def metadata(self) -> DataFrame:
        """Rows (column, category, value) plus one ``__global_fallback__`` row per column."""
        parts = []
        for c in self.columns:
            t = self.tables[c].df
            parts.append(t.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("category"),
                                  F.col("_enc").alias("value")))
            parts.append(t.sparkSession.range(1).select(
                F.lit(c).alias("column"), F.lit(R.GLOBAL_FALLBACK_KEY).alias("category"),
                F.lit(self.prior).cast("double").alias("value")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


# ----------------------------------------------------------------- E4

@dataclass
class CategoricalEncoder(Estimator):
    """One-hot then target encoding.

    ``fit_transform`` is the training path (target encoding out of fold);
    ``fit`` + ``transform`` is the scoring path (master target encoder).
    """

    one_hot: OneHotEncoder = field(default_factory=OneHotEncoder)
    target: TargetEncoder = field(default_factory=TargetEncoder)

    def fit(self, df: DataFrame) -> "EncoderModel":
        oh = self.one_hot.fit(df)
        te = self.target.fit(oh.transform(df))
        return EncoderModel(oh, te)

    def fit_transform_with_model(self, df: DataFrame):
        """(OOF-encoded training frame, fitted scoring model)."""
        oh = self.one_hot.fit(df)
        encoded = oh.transform(df)
        te = self.target.fit(encoded)
        return self.target.oof_transform(encoded), EncoderModel(oh, te)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit_transform_with_model(df)[0]


@dataclass
class EncoderModel(Model):
    one_hot: OneHotModel
    target: TargetModel

    def transform(self, df: DataFrame) -> DataFrame:
        return self.target.transform(self.one_hot.transform(df))


# ----------------------------------------------------------------- E5 / E6 / E9

@dataclass
class FrequencyEncoder(Estimator):
    """E5: columns with more than ``threshold`` distinct values -> share of rows."""

    columns: Sequence[str]
    threshold: int = 50
    suffix: str = "_freq"

    def fit(self, df: DataFrame) -> "FrequencyModel":
        cols = present(df, self.columns)
        total = df.count()
        tables = {}
        for c in cols:  # the frequency table itself says how many values there are
            freq = df.filter(F.col(c).isNotNull()).groupBy(c).count().select(c, (F.col("count") / F.lit(total)).alias("_freq"))
            table = ParamTable(freq, [c])
            if table.rows > self.threshold:
                tables[c] = table
            else:
                table.unpersist()
        return FrequencyModel(tables, self.suffix)


@dataclass
class FrequencyModel(Model):
    tables: dict
    suffix: str = "_freq"

    def transform(self, df: DataFrame) -> DataFrame:
        cur = df
        for c, t in self.tables.items():
            cur = t.renamed({"_freq": f"{c}{self.suffix}"}).lookup(cur)
            cur = cur.withColumn(f"{c}{self.suffix}", F.coalesce(F.col(f"{c}{self.suffix}"), F.lit(0.0)))
        return cur


def align_features(df: DataFrame, expected: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``expected`` columns in order (missing -> 0.0), extras dropped;
    ``keep`` columns (keys) are carried in front."""
    have = set(df.columns)
    return df.select(*[F.col(k) for k in keep],
                     *[F.col(c) if c in have else F.lit(0.0).alias(c) for c in expected])


def encode_with_metadata(df: DataFrame, metadata: DataFrame, column: str = "brand",
                         fallback: float = R.BRAND_FALLBACK_ENCODING) -> DataFrame:
    """Replace a string category by its encoding from the metadata rows
    (column, category, value); unknown -> the metadata's global fallback, else ``fallback``."""
    meta = metadata.filter(F.col("column") == column)
    glob = meta.filter(F.col("category") == R.GLOBAL_FALLBACK_KEY).select("value").first()
    fb = glob[0] if glob is not None else fallback
    table = ParamTable(meta.filter(F.col("category") != R.GLOBAL_FALLBACK_KEY)
                       .select(F.col("category").alias(column), F.col("value").alias("_enc")), [column])
    cur = table.lookup(df)
    return replace_columns(cur, {column: F.coalesce(F.col("_enc"), F.lit(fb))}).select(*df.columns)


def known_categories(metadata: DataFrame, column: str = "brand") -> DataFrame:
    """Sorted known categories of ``column`` without the fallback row."""
    return (metadata.filter((F.col("column") == column) & (F.col("category") != R.GLOBAL_FALLBACK_KEY))
            .select("category").orderBy("category"))


def inference_metadata(model: "EncoderModel") -> DataFrame:
    """K5/E7 nested form: one row ``(target_encodings map<column, map<category,
    value>>, one_hot_features array<string>)``, the fallback under
    ``__global_fallback__``; written as JSON by ``sinks.write_json_rows``."""
    meta = model.target.metadata()
    per_col = meta.groupBy("column").agg(F.map_from_entries(F.collect_list(F.struct("category", "value"))).alias("m"))
    names = F.array(*[F.lit(n) for n in model.one_hot.feature_names]) if model.one_hot.feature_names \
        else F.array().cast("array<string>")
    return per_col.agg(F.map_from_entries(F.collect_list(F.struct("column", "m"))).alias("target_encodings")) \
        .select("target_encodings", names.alias("one_hot_features"))

