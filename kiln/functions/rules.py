"""Ordered first-match rule engine and the fixed values it is configured with.

A rule set is a list of ``(regex, label)`` pairs evaluated in order; the first
regex found anywhere in the value wins (unanchored ``rlike``, the same
semantics as a regex ``search``). Everything compiles to one chained
``CASE WHEN`` expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results.
# --------------------------------------------------------------------------

# Brands treated as electric vehicles (compared lower-cased and trimmed).
EV_BRANDS = ("tesla", "rivian", "lucid", "polestar")

# Junk tokens, compared after normalisation. The colour/transmission/engine
# sets hold mis-decoded dashes exactly as the reference has them; only the
# fuel-type set holds a real en dash.
JUNK_FUEL_TOKENS = ("–", "not supported", "")
JUNK_COLOR_TOKENS = ("γçô", "nan", "other", "")
JUNK_TRANSMISSION_TOKENS = ("γçô", "scheduled for or in production", "nan", "")
JUNK_ENGINE_TOKENS = ("ΓÇô", "nan", "")

# Model-name keyword flags (case-insensitive search).
SPORT_PATTERN = "Sport|S-Line|M Sport"
PREMIUM_PATTERN = "Premium|Platinum|Limited"
AWD_PATTERN = "4WD|xDrive|Quattro|AWD"

# Colour families, first match wins, searched in the normalised lower-case text.
COLOR_RULES = (
    ("black|blk|ebony|nero|charcoal|obsidian|beluga|amg|graphite|carbon", "Black"),
    ("beige|tan|parchment|sandstone|canberra|shara|macchiato|almond|shale|cashmere|linen|ivory|silk", "Beige"),
    ("gray|grey|slate|pewter|titan|boulder|ash|platinum|silver|galvanized|gideon", "Gray"),
    ("brown|walnut|espresso|caramel|cappuccino|nougat|sarder|mesa|tupelo|mocha|saddle|auburn|amber|brandy|mountain|aragon|chestnut|cocoa|dune|roast", "Brown"),
    ("red|hotspur|rioja|pimento|magma|garnet|chateau|adrenaline", "Red"),
    ("blue|navy|cobalt|rhapsody|charles|mistral|porpoise", "Blue"),
    ("orange|sakhir|kyalami|giallo|taurus|yellow", "Orange"),
    ("white|ice|pearl|grace|cloud|whisper|bianco|polar", "White"),
)

# Transmission families, first match wins, searched in lower-case text.
TRANSMISSION_RULES = (
    ("cvt|variable", "CVT"),
    ("m/t|manual|mt", "Manual"),
    ("a/t|automatic|auto|at|pdk|dct|steptronic|tronic|shift", "Automatic"),
)
TRANSMISSION_DEFAULT = "Automatic"

# Engine text patterns (case-insensitive).
HP_PATTERN = r"(\d+(?:\.\d+)?)\s*HP"
DISPLACEMENT_PATTERN = r"(\d+(?:\.\d+)?)\s*(?:L|Liter)"
CYLINDER_WORD_PATTERN = r"(\d+)\s*Cylinder"
CYLINDER_SHORT_PATTERN = r"\b(?:V|I|H|V-)(\d+)\b"
CYLINDER_TEXT_PATTERN = "Straight 6|Flat 6"
ELECTRIC_PATTERN = "Electric Motor|Electric Fuel|Electric"
HYBRID_PATTERN = "Hybrid|Plug-In"
DIESEL_PATTERN = "Diesel"
FLEX_PATTERN = "Flex Fuel|Flexible"
GASOLINE_PATTERN = "Gasoline|Gas|GDI|MPFI"

# Gear count: number before a speed word, else the first standalone number.
GEAR_PATTERN = r"(\d+)\s*(?:-speed|spd|speed|gear)"
GEAR_FALLBACK_PATTERN = r"\b(\d+)\b"

# Accident text -> flag; anything else (and missing) -> 0.
ACCIDENT_MAP = (("no accidents", 0), ("At least 1 accident or damage reported", 1))

# Fallbacks.
FUEL_DEFAULT = "Gasoline"
BRAND_FALLBACK_ENCODING = 10.310518988406342
GLOBAL_FALLBACK_KEY = "__global_fallback__"
VERSION_FOLDER_FORMAT = "MM_dd_yyyy_HH_mm_ss"
MIN_R2 = 0.6
TEST_RATIO = 0.25
SEED = 42

# --------------------------------------------------------------------------


def contains(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    """Null-safe unanchored regex search: null input -> False."""
    p = f"(?i){pattern}" if ignore_case else pattern
    return F.coalesce(c.rlike(p), F.lit(False))


def once(c: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(c)`` with ``c`` evaluated once a row.

    A chain of rules written out over ``c`` evaluates it again in every branch, and the chains of several
    columns make one generated method too large for the JVM to compile.
    """
    return F.transform(F.array(c), fn)[0]


def first_match(c: Column, rules: Sequence[tuple[str, str | None]],
                default: Column | str | None = None, ignore_case: bool = False,
                null_label: str | None = None) -> Column:
    """Chained CASE WHEN over ``rules``; null input yields ``null_label``.

    ``default`` is used when the value is present but no rule matches.
    """
    dflt = default if isinstance(default, Column) else F.lit(default)

    def chain(x: Column) -> Column:
        expr = F.when(x.isNull(), F.lit(null_label))
        for pattern, label in rules:
            expr = expr.when(contains(x, pattern, ignore_case), F.lit(label))
        return expr.otherwise(dflt)

    return once(c, chain)


def junk_to_null(c: Column, tokens: Iterable[str]) -> Column:
    """Return ``c`` unless it is one of ``tokens`` (null stays null)."""
    return F.when(~c.isin(list(tokens)), c)


def normalize_lower(c: Column, strip_chars: str | None = None) -> Column:
    """lower(trim(c)) and optionally remove every character in ``strip_chars``."""
    out = F.lower(F.trim(c))
    if strip_chars:
        out = F.regexp_replace(out, strip_chars, "")
    return out


def map_values(c: Column, mapping: Sequence[tuple[str, float]], default: float) -> Column:
    """Exact-value dictionary lookup with a default for misses and nulls."""
    m = F.create_map(*[x for k, v in mapping for x in (F.lit(k), F.lit(float(v)))])
    return F.coalesce(m[c], F.lit(float(default)))
