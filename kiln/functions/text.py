"""Column expressions for dirty-text cleaning and feature extraction.

All functions take and return ``Column`` objects built only from built-in
Spark functions, so a whole cleaning or feature chain is projections only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kiln.functions import rules as R

# Numeric grammar accepted as a number: sign, digits with optional fraction
# (or a bare fraction), optional exponent. ``try_cast`` alone also accepts
# ``1d``, ``1.5f``, ``inf`` and surrounding spaces; this guard rejects them.
NUMBER_GRAMMAR = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_number(c: Column) -> Column:
    """Coercing numeric parse (C7): bad text -> null, never an error.

    Text outside the grammar is extracted as the empty string, which is no number; so ``c`` is evaluated once.
    """
    return F.regexp_extract(c, NUMBER_GRAMMAR, 0).try_cast("double")


def clean_currency(c: Column) -> Column:
    """Remove every ``$`` and ``,``, trim, parse; bad -> null."""
    return parse_number(F.trim(F.regexp_replace(c, r"[$,]", "")))


def clean_distance(c: Column) -> Column:
    """Remove commas and a trailing ``mi``/``mi.`` (with spaces), trim, parse."""
    no_commas = F.regexp_replace(c, ",", "")
    return parse_number(F.trim(F.regexp_replace(no_commas, r"\s*mi\.?\s*$", "")))


def clean_junk(c: Column, tokens=R.JUNK_FUEL_TOKENS) -> Column:
    """Null when the trimmed value is a junk token; other values unchanged."""
    return F.when(~F.trim(c).isin(list(tokens)), c)


def yes_flag(c: Column) -> Column:
    """C4: exact ``Yes`` -> 1, everything else (and missing) -> 0."""
    return F.coalesce((c == F.lit("Yes")).cast("int"), F.lit(0))


# ---------------------------------------------------------------- features

def keyword_flag(c: Column, pattern: str) -> Column:
    """case-insensitive keyword search as an int flag; missing -> 0."""
    return R.contains(c, pattern, ignore_case=True).cast("int")


def color_text(c: Column) -> Column:
    """lower, trim, drop ``.`` and ``-``."""
    return R.normalize_lower(c, r"[.\-]")


def normalize_color(c: Column) -> Column:
    """F2 + F3: lower, trim, drop ``.`` and ``-``; junk tokens -> null."""
    return R.junk_to_null(color_text(c), R.JUNK_COLOR_TOKENS)


def color_family(norm: Column, null_label: str | None = None,
                 else_label: str | None = None) -> Column:
    """F4/F5 from the normalised text."""
    return R.first_match(norm, R.COLOR_RULES, default=else_label, null_label=null_label)


def color_bucket(c: Column, null_label: str | None = None,
                 else_label: str | None = None) -> Column:
    """first-match colour family of the normalised text.

    ``null_label``/``else_label`` give the notebook variant (``Unknown``/``Other``);
    both default to null (to be filled by the fitted mode, F6).
    """
    return color_family(normalize_color(c), null_label, else_label)


def normalize_transmission(c: Column) -> Column:
    """lower(trim(c)) with the transmission junk tokens -> null."""
    return R.junk_to_null(R.normalize_lower(c), R.JUNK_TRANSMISSION_TOKENS)


def transmission_family(norm: Column, default: Column | str | None = R.TRANSMISSION_DEFAULT,
                        null_label: str | None = None) -> Column:
    """F7/F8 from the normalised text."""
    return R.first_match(norm, R.TRANSMISSION_RULES, default=default, null_label=null_label)


def transmission_bucket(c: Column, default: Column | str | None = R.TRANSMISSION_DEFAULT,
                        null_label: str | None = None) -> Column:
    """CVT > Manual > Automatic; junk/missing -> ``null_label``; else ``default``."""
    return transmission_family(normalize_transmission(c), default, null_label)


def gear_count(c: Column) -> Column:
    """gears before a speed word, else first standalone number; CVT -> 0.

    Junk transmission text counts as the token ``unknown`` (no number).
    """
    raw = normalize_transmission(c)
    first = F.regexp_extract(raw, R.GEAR_PATTERN, 1)
    fallback = F.regexp_extract(raw, R.GEAR_FALLBACK_PATTERN, 1)
    gears = F.coalesce(F.nullif(first, F.lit("")), F.nullif(fallback, F.lit("")))
    is_cvt = transmission_bucket(c, null_label="Unknown") == F.lit("CVT")
    return F.when(is_cvt, F.lit(0.0)).otherwise(parse_number(gears))


def normalize_engine(c: Column) -> Column:
    """trim(c) with the engine junk tokens -> null (case kept)."""
    return R.junk_to_null(F.trim(c), R.JUNK_ENGINE_TOKENS)


def extract_number(norm: Column, pattern: str) -> Column:
    """The number that ``pattern`` (case-insensitive) finds first; null without one."""
    return parse_number(F.regexp_extract(norm, f"(?i){pattern}", 1))


def engine_hp(c: Column) -> Column:
    """first number followed by ``HP`` (case-insensitive)."""
    return extract_number(normalize_engine(c), R.HP_PATTERN)


def engine_fuel(c: Column, null_label: str | None = None) -> Column:
    """Electric (not hybrid) > Hybrid > Diesel > Flex Fuel > Gasoline > null."""
    return fuel_family(normalize_engine(c), null_label)


def fuel_family(norm: Column, null_label: str | None = None) -> Column:
    """F13 from the normalised text."""
    def chain(raw: Column) -> Column:
        electric = R.contains(raw, R.ELECTRIC_PATTERN, True)
        hybrid = R.contains(raw, R.HYBRID_PATTERN, True)
        return (F.when(electric & ~hybrid, F.lit("Electric"))
                .when(hybrid, F.lit("Hybrid"))
                .when(R.contains(raw, R.DIESEL_PATTERN, True), F.lit("Diesel"))
                .when(R.contains(raw, R.FLEX_PATTERN, True), F.lit("Flex Fuel"))
                .when(R.contains(raw, R.GASOLINE_PATTERN, True), F.lit("Gasoline"))
                .when(raw.isNull(), F.lit(null_label)))

    return R.once(norm, chain)


def engine_displacement(c: Column) -> Column:
    """F11 + F14: number before ``L``/``Liter``; electric engines -> 0."""
    norm = normalize_engine(c)
    return displacement_of(norm, fuel_family(norm))


def displacement_of(norm: Column, fuel: Column) -> Column:
    """F11 + F14 from the normalised text and its fuel."""
    return F.when(fuel == F.lit("Electric"), F.lit(0.0)).otherwise(extract_number(norm, R.DISPLACEMENT_PATTERN))


def engine_cylinders(c: Column) -> Column:
    """F12 (+F14): ``N Cylinder`` > ``V6/I4/H6/V-10`` > ``Straight 6``/``Flat 6``; electric -> 0."""
    raw = normalize_engine(c)
    word = F.nullif(F.regexp_extract(raw, f"(?i){R.CYLINDER_WORD_PATTERN}", 1), F.lit(""))
    short = F.nullif(F.regexp_extract(raw, f"(?i){R.CYLINDER_SHORT_PATTERN}", 1), F.lit(""))
    text = F.when(R.contains(raw, R.CYLINDER_TEXT_PATTERN, True), F.lit("6"))
    cyl = parse_number(F.coalesce(word, short, text))
    return F.when(engine_fuel(c) == F.lit("Electric"), F.lit(0.0)).otherwise(cyl)


def accident_flag(c: Column) -> Column:
    """F16: exact-value map (``At least 1 ...`` -> 1), everything else -> 0."""
    return R.map_values(c, R.ACCIDENT_MAP, 0.0)


def is_ev_brand(brand: Column) -> Column:
    """Brand (lower, trim) in the EV set; missing -> False."""
    return F.coalesce(F.lower(F.trim(brand)).isin(list(R.EV_BRANDS)), F.lit(False))
