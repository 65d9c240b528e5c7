"""DuckDB SQL fragments for the oracle side of the correctness gate.

Each fragment is one CTE; ``with_ctes`` strings them in dependency order.
They restate the operator rules in plain SQL (independent of the Spark
code) over the pre-registered test-table views.
"""

from __future__ import annotations

from kiln.sources.fixtures import LISTINGS_SQL

GRAMMAR = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def num(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{GRAMMAR}') THEN TRY_CAST({x} AS DOUBLE) END)"


def ci(x: str, pattern: str) -> str:
    """Null-safe case-insensitive search."""
    return f"coalesce(regexp_matches({x}, '(?i){pattern}'), false)"


def cs(x: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({x}, '{pattern}'), false)"


CLEANED_SQL = f"""
cleaned AS (
  SELECT listing_id, brand, model, model_year,
    CASE WHEN trim(fuel_type) IN ('–', 'not supported', '') THEN NULL ELSE fuel_type END AS fuel_type,
    engine, transmission, ext_col, int_col, accident,
    {num("trim(regexp_replace(price, '[$,]', '', 'g'))")} AS price_usd,
    {num(r"trim(regexp_replace(regexp_replace(milage, ',', '', 'g'), '\s*mi\.?\s*$', ''))")} AS mileage_num,
    CASE WHEN clean_title = 'Yes' THEN 1 ELSE 0 END AS has_clean_title
  FROM listings
)"""

COLOR_CASE = """CASE WHEN {n} IS NULL THEN NULL
  WHEN regexp_matches({n}, 'black|blk|ebony|nero|charcoal|obsidian|beluga|amg|graphite|carbon') THEN 'Black'
  WHEN regexp_matches({n}, 'beige|tan|parchment|sandstone|canberra|shara|macchiato|almond|shale|cashmere|linen|ivory|silk') THEN 'Beige'
  WHEN regexp_matches({n}, 'gray|grey|slate|pewter|titan|boulder|ash|platinum|silver|galvanized|gideon') THEN 'Gray'
  WHEN regexp_matches({n}, 'brown|walnut|espresso|caramel|cappuccino|nougat|sarder|mesa|tupelo|mocha|saddle|auburn|amber|brandy|mountain|aragon|chestnut|cocoa|dune|roast') THEN 'Brown'
  WHEN regexp_matches({n}, 'red|hotspur|rioja|pimento|magma|garnet|chateau|adrenaline') THEN 'Red'
  WHEN regexp_matches({n}, 'blue|navy|cobalt|rhapsody|charles|mistral|porpoise') THEN 'Blue'
  WHEN regexp_matches({n}, 'orange|sakhir|kyalami|giallo|taurus|yellow') THEN 'Orange'
  WHEN regexp_matches({n}, 'white|ice|pearl|grace|cloud|whisper|bianco|polar') THEN 'White'
  ELSE {other} END"""

TRANS_CASE = """CASE WHEN {n} IS NULL THEN {null}
  WHEN regexp_matches({n}, 'cvt|variable') THEN 'CVT'
  WHEN regexp_matches({n}, 'm/t|manual|mt') THEN 'Manual'
  WHEN regexp_matches({n}, 'a/t|automatic|auto|at|pdk|dct|steptronic|tronic|shift') THEN 'Automatic'
  ELSE {other} END"""

FUEL_CASE = f"""CASE WHEN {ci('{n}', 'Electric Motor|Electric Fuel|Electric')} AND NOT {ci('{n}', 'Hybrid|Plug-In')} THEN 'Electric'
  WHEN {ci('{n}', 'Hybrid|Plug-In')} THEN 'Hybrid'
  WHEN {ci('{n}', 'Diesel')} THEN 'Diesel'
  WHEN {ci('{n}', 'Flex Fuel|Flexible')} THEN 'Flex Fuel'
  WHEN {ci('{n}', 'Gasoline|Gas|GDI|MPFI')} THEN 'Gasoline'
  WHEN {{n}} IS NULL THEN {{null}} END"""


def color_case(n: str, other: str = "NULL") -> str:
    return COLOR_CASE.format(n=n, other=other)


def trans_case(n: str, other: str, null: str = "NULL") -> str:
    return TRANS_CASE.format(n=n, other=other, null=null)


def fuel_case(n: str, null: str = "NULL") -> str:
    return FUEL_CASE.replace("{n}", n).replace("{null}", null)


def hp_expr(n: str) -> str:
    return num(f"nullif(regexp_extract({n}, '(?i)(\\d+(?:\\.\\d+)?)\\s*HP', 1), '')")


def disp_expr(n: str) -> str:
    return num(f"nullif(regexp_extract({n}, '(?i)(\\d+(?:\\.\\d+)?)\\s*(?:L|Liter)', 1), '')")


NORM_SQL = """
normed AS (
  SELECT *,
    CASE WHEN regexp_replace(lower(trim(int_col)), '[.\\-]', '', 'g') IN ('γçô', 'nan', 'other', '') THEN NULL
         ELSE regexp_replace(lower(trim(int_col)), '[.\\-]', '', 'g') END AS n_int,
    CASE WHEN regexp_replace(lower(trim(ext_col)), '[.\\-]', '', 'g') IN ('γçô', 'nan', 'other', '') THEN NULL
         ELSE regexp_replace(lower(trim(ext_col)), '[.\\-]', '', 'g') END AS n_ext,
    CASE WHEN lower(trim(transmission)) IN ('γçô', 'scheduled for or in production', 'nan', '') THEN NULL
         ELSE lower(trim(transmission)) END AS n_trans,
    CASE WHEN trim(engine) IN ('ΓÇô', 'nan', '') THEN NULL ELSE trim(engine) END AS n_eng
  FROM cleaned
)"""


def mode_of(table: str, col: str) -> str:
    """Scalar subquery: most frequent non-null value, ties -> smallest."""
    return (f"(SELECT v FROM (SELECT {col} AS v, count(*) AS c FROM {table} WHERE {col} IS NOT NULL "
            f"GROUP BY 1) ORDER BY c DESC, v LIMIT 1)")


FEATURES_SQL = f"""
features AS (
  SELECT listing_id, brand, model_year,
    coalesce(fuel_type, {fuel_case('n_eng')}) AS fuel_type,
    coalesce({color_case('n_ext')}, {mode_of('normed', 'n_ext')}) AS ext_col,
    coalesce({color_case('n_int')}, {mode_of('normed', 'n_int')}) AS int_col,
    CAST(CASE accident WHEN 'no accidents' THEN 0 WHEN 'At least 1 accident or damage reported' THEN 1
         ELSE 0 END AS DOUBLE) AS accident,
    price_usd, mileage_num, has_clean_title,
    CAST({ci('model', 'Sport|S-Line|M Sport')} AS INTEGER) AS is_sport,
    CAST({ci('model', 'Premium|Platinum|Limited')} AS INTEGER) AS is_premium,
    CAST({ci('model', '4WD|xDrive|Quattro|AWD')} AS INTEGER) AS is_4WD_AWD,
    {trans_case('n_trans', "coalesce(" + mode_of('normed', 'n_trans') + ", 'Automatic')")} AS transmission_type,
    {hp_expr('n_eng')} AS engine_hp,
    CASE WHEN {fuel_case('n_eng')} = 'Electric' THEN 0.0 ELSE {disp_expr('n_eng')} END AS engine_displacement
  FROM normed
)"""

BASE = [LISTINGS_SQL, CLEANED_SQL, NORM_SQL, FEATURES_SQL]


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + body


# ---------------------------------------------------------------- imputation

EV_SQL = "coalesce(lower(trim({b})) IN ('tesla', 'rivian', 'lucid', 'polestar'), false)"
QS15 = "[" + ", ".join(repr(i / 15) for i in range(16)) + "]"


def group_median_fill(src: str, target: str, keys: list[str]) -> str:
    """SELECT over ``src`` with ``target`` filled by group median then global median."""
    on = " AND ".join(f"s.{k} = g.{k}" for k in keys)
    notnull = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    ks = ", ".join(keys)
    return (f"SELECT s.* REPLACE (coalesce(s.{target}, g._m, (SELECT median({target}) FROM {src})) AS {target}) "
            f"FROM {src} s LEFT JOIN (SELECT {ks}, median({target}) AS _m FROM {src} WHERE {notnull} "
            f"GROUP BY {ks}) g ON {on}")


def group_mode_fill(src: str, target: str, key: str, default: str) -> str:
    ranked = (f"SELECT {key}, {target} AS v, row_number() OVER (PARTITION BY {key} ORDER BY count(*) DESC, "
              f"{target}) AS rn FROM {src} WHERE {key} IS NOT NULL AND {target} IS NOT NULL GROUP BY {key}, {target}")
    return (f"SELECT s.* REPLACE (coalesce(s.{target}, g.v, {mode_of(src, target)}, '{default}') AS {target}) "
            f"FROM {src} s LEFT JOIN (SELECT {key}, v FROM ({ranked}) WHERE rn = 1) g ON s.{key} = g.{key}")


def ev_rule(src: str, fuel: bool = True) -> str:
    ev = EV_SQL.format(b="brand")
    rep = [f"CASE WHEN {ev} AND engine_displacement IS NULL THEN 0.0 ELSE engine_displacement END AS engine_displacement"]
    if fuel:
        rep.append(f"CASE WHEN {ev} AND fuel_type IS NULL THEN 'Electric' ELSE fuel_type END AS fuel_type")
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM {src}"


def bin_expr(x: str, e: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR {x} < {e}[1] OR {x} > {e}[len({e})] THEN NULL "
            f"WHEN {x} = {e}[1] THEN 0 ELSE len(list_filter({e}, lambda v: v < {x})) - 1 END")


def tiered_bins(src: str, name: str) -> list[str]:
    """CTEs ending in ``name``: I6 on ``src`` (EV rule, brand+bin, bin, global)."""
    e = f"{name}_e"
    return [
        f"{e} AS (SELECT list_sort(list_distinct(quantile_cont(engine_hp, {QS15}))) AS e FROM {src})",
        f"{name}_ev AS ({ev_rule(src, fuel=False)})",
        f"{name}_b AS (SELECT s.*, {bin_expr('s.engine_hp', 'x.e')} AS _bin FROM {name}_ev s, {e} x)",
        f"""{name} AS (
  SELECT s.* EXCLUDE (_bin) REPLACE (coalesce(s.engine_displacement, kb._m, b._m,
      (SELECT median(engine_displacement) FROM {src})) AS engine_displacement)
  FROM {name}_b s
  LEFT JOIN (SELECT brand, _bin, median(engine_displacement) AS _m FROM {name}_b0
             WHERE brand IS NOT NULL AND _bin IS NOT NULL GROUP BY brand, _bin) kb
    ON s.brand = kb.brand AND s._bin = kb._bin
  LEFT JOIN (SELECT _bin, median(engine_displacement) AS _m FROM {name}_b0 WHERE _bin IS NOT NULL
             GROUP BY _bin) b ON s._bin = b._bin)""",
        f"{name}_b0 AS (SELECT s.*, {bin_expr('s.engine_hp', 'x.e')} AS _bin FROM {src} s, {e} x)",
    ]


def tiered_ctes(src: str, name: str) -> list[str]:
    c = tiered_bins(src, name)
    return [c[0], c[4], c[1], c[2], c[3]]


IMPUTE_SQL = [
    f"imp1 AS ({group_median_fill('features', 'engine_hp', ['brand'])})",
    f"imp2 AS ({ev_rule('imp1')})",
    f"imp3 AS ({group_median_fill('imp2', 'engine_displacement', ['brand', 'engine_hp'])})",
    f"imp4 AS ({group_mode_fill('imp3', 'fuel_type', 'brand', 'Gasoline')})",
    *tiered_ctes("imp4", "imputed"),
]


# ---------------------------------------------------------------- outliers + encoding

def _fence(c: str, side: str) -> str:
    q1, q3 = f"quantile_cont({c}, 0.25)", f"quantile_cont({c}, 0.75)"
    expr = f"{q1} - 1.5 * ({q3} - {q1})" if side == "lo" else f"{q3} + 1.5 * ({q3} - {q1})"
    return f"(SELECT {expr} FROM imputed)"


PREPARED_SQL = f"""
prepared AS (
  SELECT * REPLACE (ln(1 + price_usd) AS price_usd, ln(1 + mileage_num) AS mileage_num,
    greatest(least(engine_hp, {_fence('engine_hp', 'hi')}), {_fence('engine_hp', 'lo')}) AS engine_hp,
    greatest(least(engine_displacement, {_fence('engine_displacement', 'hi')}), {_fence('engine_displacement', 'lo')})
      AS engine_displacement)
  FROM imputed
)"""

PREP = [*BASE, *IMPUTE_SQL, PREPARED_SQL]


def hash32_sql(k: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8)) AS BIGINT)"


def lam(n: str) -> str:
    return f"(1.0 / (1.0 + exp(-({n} - 20.0) / 10.0)))"


ONEHOT_COLS = ["fuel_type", "transmission_type", "int_col", "ext_col"]


def onehot_long(src: str, keep_first: bool = False) -> str:
    """(listing_id, feature, value) rows of the drop-first one-hot matrix of ``src``."""
    parts = []
    for c in ONEHOT_COLS:
        cats = (f"SELECT v, name || CASE WHEN dup > 1 THEN '_' || dup ELSE '' END AS name FROM ("
                f"SELECT v, name, row_number() OVER (PARTITION BY lower(name) ORDER BY rn) AS dup FROM ("
                f"SELECT v, rn, '{c}_' || coalesce(v, 'null') AS name FROM ("
                f"SELECT v, row_number() OVER (ORDER BY v NULLS LAST) AS rn FROM (SELECT DISTINCT {c} AS v FROM {src})) "
                f"WHERE rn > {0 if keep_first else 1}))")
        parts.append(f"""SELECT s.listing_id, k.name AS feature,
    CASE WHEN k.v IS NULL THEN CAST(s.{c} IS NULL AS DOUBLE) ELSE CAST(coalesce(s.{c} = k.v, false) AS DOUBLE) END AS value
  FROM {src} s, ({cats}) k""")
    return "\nUNION ALL\n".join(parts)


TE_SQL = f"""
te_prior AS (SELECT avg(price_usd) AS p FROM prepared),
te_stats AS (SELECT brand, count(price_usd) AS n, avg(price_usd) AS m FROM prepared WHERE brand IS NOT NULL GROUP BY brand),
te_map AS (SELECT brand, coalesce(te_prior.p * (1 - {lam('n')}) + m * {lam('n')}, te_prior.p) AS enc FROM te_stats, te_prior)"""

OOF_SQL = f"""
pf AS (SELECT *, CAST({hash32_sql('listing_id')} % 5 AS INTEGER) AS _fold FROM prepared),
ft AS (SELECT _fold, count(price_usd) AS n, sum(price_usd) AS s FROM pf GROUP BY _fold),
fp AS (SELECT ft._fold, (t.s - ft.s) / (t.n - ft.n) AS prior FROM ft, (SELECT sum(n) AS n, sum(s) AS s FROM ft) t),
bf AS (SELECT brand, _fold, count(price_usd) AS nf, sum(price_usd) AS sf FROM pf WHERE brand IS NOT NULL GROUP BY brand, _fold),
bo AS (SELECT brand, _fold, sum(nf) OVER (PARTITION BY brand) - nf AS n,
              coalesce(sum(sf) OVER (PARTITION BY brand), 0) - coalesce(sf, 0) AS s FROM bf),
oof AS (SELECT pf.* REPLACE (coalesce(CASE WHEN bo.n > 0 THEN fp.prior * (1 - {lam('bo.n')}) + (bo.s / bo.n) * {lam('bo.n')} END,
                                      fp.prior) AS brand)
        FROM pf JOIN fp ON pf._fold = fp._fold LEFT JOIN bo ON pf.brand = bo.brand AND pf._fold = bo._fold)"""
