"""Feature extraction from model, colour, accident, transmission and engine text.

The fit counts values in one job (modes of the normalised colour and transmission
text, used as fallbacks); the transform is one projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.functions import rules as R
from kiln.functions import text as T
from kiln.operators.base import Estimator, Model, replace_columns
from kiln.operators.ranks import column_modes

COLOR_COLUMNS = ("int_col", "ext_col")


def _mode_sources(df: DataFrame, color_columns, mode_of: str) -> dict:
    """The columns whose mode is the fallback, as expressions over ``df``."""
    out = {}
    have = set(df.columns)
    for c in color_columns:
        if c in have:
            out[c] = (T.normalize_color(F.col(c)) if mode_of == "raw"
                      else T.color_bucket(F.col(c)))
    if "transmission" in have:
        out["transmission"] = (T.normalize_transmission(F.col("transmission")) if mode_of == "raw"
                               else T.transmission_bucket(F.col("transmission"), default=None))
    return out


def _with_normalized(df: DataFrame, color_columns) -> DataFrame:
    """``df`` with its normalised texts and the engine's fuel as ``_n_`` columns.

    Each is a column of an earlier projection: inside one projection every rule of a first match
    and every use of a text would normalise it again.
    """
    have = set(df.columns)
    texts = {f"_n_{c}": T.color_text(F.col(c)) for c in color_columns if c in have}
    texts |= {"_n_transmission": R.normalize_lower(F.col("transmission"))} if "transmission" in have else {}
    texts |= {"_n_engine": F.trim(F.col("engine"))} if "engine" in have else {}
    if not texts:
        return df
    junk = {"_n_transmission": R.JUNK_TRANSMISSION_TOKENS, "_n_engine": R.JUNK_ENGINE_TOKENS}
    cur = df.withColumns(texts)
    cur = cur.withColumns({n: R.junk_to_null(F.col(n), junk.get(n, R.JUNK_COLOR_TOKENS)) for n in texts})
    return cur.withColumn("_n_fuel", T.fuel_family(F.col("_n_engine"))) if "engine" in have else cur


def fit_modes(df: DataFrame, color_columns=COLOR_COLUMNS, mode_of: str = "raw") -> dict:
    """Deterministic mode (ties -> smallest) per fallback column."""
    src = _mode_sources(df, color_columns, mode_of)
    return column_modes(df, src) if src else {}


@dataclass
class FeatureEngineer(Estimator):
    """Default feature chain (F1, F4+F6, F16, F7, F10-F14, F15) as one projection.

    ``fallback="fit"`` fixes the colour/transmission fallbacks on the fitted
    table; ``fallback="batch"`` recomputes them on every transformed batch
    (the reference's behaviour). ``mode_of="raw"`` takes the mode of the
    normalised raw text (reference); ``"bucket"`` the mode of the buckets.
    """

    color_columns: tuple = COLOR_COLUMNS
    fallback: str = "fit"
    mode_of: str = "raw"

    def fit(self, df: DataFrame) -> "FeatureModel":
        modes = fit_modes(df, self.color_columns, self.mode_of) if self.fallback == "fit" else None
        return FeatureModel(self.color_columns, modes, self.mode_of)

    def fit_transform_with_model(self, df: DataFrame, how: str = "auto"):
        """Training path in one heavy pass: extract every feature with the
        fallbacks left open (normalised text kept in hidden columns),
        materialize, take the modes from the materialized columns, then fill
        with a cheap projection. Same result as ``fit(df).transform(df)``."""
        from kiln.session import materialize

        if self.fallback != "fit":
            m = self.fit(df)
            return m.transform(df), m
        open_model = FeatureModel(self.color_columns, None, self.mode_of)
        have = set(df.columns)
        hidden = {}
        for c in [*self.color_columns, "transmission"]:
            if c in have:
                n = F.col(f"_n_{c}")
                bucket = T.transmission_family(n, default=None) if c == "transmission" else T.color_family(n)
                hidden[f"_mode_src_{c}"] = n if self.mode_of == "raw" else bucket
        hidden.update({"_n_transmission": F.col("_n_transmission")} if "transmission" in have else {})
        base = materialize(open_model.transform(df, fill=False, extra=hidden), how)
        srcs = [k for k in hidden if k.startswith("_mode_src_")]
        modes = {k[len("_mode_src_"):]: v for k, v in column_modes(base, {k: F.col(k) for k in srcs}).items()} if srcs else {}
        model = FeatureModel(self.color_columns, modes, self.mode_of)
        return model.fill(base, list(hidden)), model


@dataclass
class FeatureModel(Model):
    color_columns: tuple
    modes: dict | None
    mode_of: str = "raw"

    def transform(self, df: DataFrame, fill: bool = True, extra: dict | None = None) -> DataFrame:
        """One projection. ``fill=False`` leaves the colour/transmission
        fallbacks open (used by the one-pass training path)."""
        if fill:
            modes = self.modes if self.modes is not None else fit_modes(df, self.color_columns, self.mode_of)
        else:
            modes = None
        have = set(df.columns)
        df = _with_normalized(df, self.color_columns)
        new, drop = {}, [c for c in df.columns if c not in have and c not in (extra or {})]
        if "model" in have:
            m = F.col("model")
            new["is_sport"] = T.keyword_flag(m, R.SPORT_PATTERN)
            new["is_premium"] = T.keyword_flag(m, R.PREMIUM_PATTERN)
            new["is_4WD_AWD"] = T.keyword_flag(m, R.AWD_PATTERN)
            drop.append("model")
        for c in self.color_columns:
            if c in have:
                bucket = T.color_family(F.col(f"_n_{c}"))
                new[c] = F.coalesce(bucket, F.lit(modes.get(c))) if modes is not None else bucket
        if "accident" in have:
            new["accident"] = T.accident_flag(F.col("accident"))
        if "transmission" in have:
            if modes is not None:
                dflt = modes.get("transmission") or R.TRANSMISSION_DEFAULT
                new["transmission_type"] = T.transmission_family(F.col("_n_transmission"), default=dflt)
            else:
                new["transmission_type"] = T.transmission_family(F.col("_n_transmission"), default=None)
            drop.append("transmission")
        if "engine" in have:
            e, fuel = F.col("_n_engine"), F.col("_n_fuel")
            new["engine_hp"] = T.extract_number(e, R.HP_PATTERN)
            new["engine_displacement"] = T.displacement_of(e, fuel)
            if "fuel_type" in have:
                new["fuel_type"] = F.coalesce(F.col("fuel_type"), fuel)
            drop.append("engine")
        new.update(extra or {})
        return replace_columns(df, new, drop)

    def fill(self, base: DataFrame, hidden: list) -> DataFrame:
        """Close the fallbacks of an open transform and drop the hidden columns."""
        new = {}
        for c in self.color_columns:
            if c in base.columns:
                new[c] = F.coalesce(F.col(c), F.lit(self.modes.get(c)))
        if "transmission_type" in base.columns and "_n_transmission" in base.columns:
            dflt = self.modes.get("transmission") or R.TRANSMISSION_DEFAULT
            new["transmission_type"] = F.when(F.col("_n_transmission").isNotNull(),
                                              F.coalesce(F.col("transmission_type"), F.lit(dflt)))
        return replace_columns(base, new, hidden)
