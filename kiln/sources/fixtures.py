"""Stand-in input: the dirty 12-column ``listings`` view derived from test tables.

The test tables carry no nulls and no dirty text, so this view only lays
dirty strings of the documented raw schema over ``orders`` joined to
``part``. It does none of the pipeline's work: every cleaning, extraction,
imputation and encoding step runs on it through the library's own code, and
nothing downstream relies on how these strings were produced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.session import spread, table


def _s(c: Column) -> Column:
    return c.cast("string")


def _by(key: Column, mod: int, cases: dict[int, str | None], other: str | None) -> Column:
    r = key % mod
    expr = None
    for k, v in cases.items():
        expr = (F.when if expr is None else expr.when)(r == k, F.lit(v))
    return expr.otherwise(F.lit(other))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty raw listings keyed by ``listing_id`` (see FIXTURES.md §3)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    # part grows with the data, so it never goes through the driver; several even partitions a core, since rows are costly from here on
    j = o.join(p.hint("merge"), o.o_custkey == p.p_partkey).repartition(spread(o))
    k, c, s = F.col("o_orderkey"), F.col("o_custkey"), F.col("p_size")
    t = F.floor(F.col("o_totalprice")).cast("bigint")
    ev = (c % 40) == 0
    hp = _s(100 + s * 7)
    disp = F.concat(_s(1 + s % 6), F.lit("."), _s(s % 10))
    engine = (
        F.when(ev, F.concat(_s(300 + s), F.lit(".0HP Electric Motor Electric Fuel System")))
        .when(k % 13 == 0, F.lit("–"))
        .when(k % 17 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 0, F.concat(disp, F.lit(" Liter GDI")))
        .when(k % 6 == 0, F.concat(hp, F.lit(".0HP Gas/Hybrid")))
        .otherwise(F.concat(hp, F.lit(".0HP "), disp, F.lit("L V6 Cylinder Engine Gasoline Fuel")))
    )
    milage = F.when(k % 101 == 0, F.lit("unknown")).otherwise(F.concat(
        _s(1 + (k * 37) % 199), F.lit(","), F.lpad(_s((k * 13) % 1000), 3, "0"), F.lit(" mi.")))
    return j.select(
        k.alias("listing_id"),
        F.when(ev, F.lit("Tesla")).otherwise(F.col("p_brand")).alias("brand"),
        F.concat(F.col("p_name"), _by(k, 5, {0: " M Sport", 1: " xDrive", 2: " LIMITED"}, "")).alias("model"),
        F.year("o_orderdate").cast("bigint").alias("model_year"),
        milage.alias("milage"),
        _by(k, 9, {0: None, 1: "–", 2: "not supported", 3: "Diesel", 4: "Hybrid",
                   5: "E85 Flex Fuel"}, "Gasoline").alias("fuel_type"),
        engine.alias("engine"),
        _by(k, 8, {0: "6-Speed M/T", 1: "CVT Transmission", 2: "Automatic CVT", 3: "–",
                   4: None, 5: "F"}, "8-Speed A/T").alias("transmission"),
        _by(k, 10, {0: "Jet Black", 1: "Titan Gray", 2: "Rosso Red", 3: "Green", 4: "–",
                    5: None, 6: "Glacier White", 7: "Other"}, "Black.").alias("ext_col"),
        _by(c, 4, {0: "Beige", 1: "Saddle Brown", 2: "Navy"}, "Black").alias("int_col"),
        _by(k, 4, {0: "At least 1 accident or damage reported", 1: None}, "None reported").alias("accident"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).otherwise(F.lit("Yes")).alias("clean_title"),
        F.concat(F.lit("$"), _s(F.floor(t / 1000).cast("bigint")), F.lit(","),
                 F.lpad(_s(t % 1000), 3, "0")).alias("price"),
    )


LISTINGS_SQL = """
listings AS (
  SELECT
    o_orderkey AS listing_id,
    CASE WHEN o_custkey % 40 = 0 THEN 'Tesla' ELSE p_brand END AS brand,
    p_name || CASE o_orderkey % 5 WHEN 0 THEN ' M Sport' WHEN 1 THEN ' xDrive'
                                  WHEN 2 THEN ' LIMITED' ELSE '' END AS model,
    CAST(year(o_orderdate) AS BIGINT) AS model_year,
    CASE WHEN o_orderkey % 101 = 0 THEN 'unknown'
         ELSE CAST(1 + (o_orderkey * 37) % 199 AS VARCHAR) || ','
              || lpad(CAST((o_orderkey * 13) % 1000 AS VARCHAR), 3, '0') || ' mi.' END AS milage,
    CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '–' WHEN 2 THEN 'not supported'
         WHEN 3 THEN 'Diesel' WHEN 4 THEN 'Hybrid' WHEN 5 THEN 'E85 Flex Fuel'
         ELSE 'Gasoline' END AS fuel_type,
    CASE WHEN o_custkey % 40 = 0 THEN CAST(300 + p_size AS VARCHAR) || '.0HP Electric Motor Electric Fuel System'
         WHEN o_orderkey % 13 = 0 THEN '–'
         WHEN o_orderkey % 17 = 0 THEN NULL
         WHEN o_orderkey % 7 = 0 THEN CAST(1 + p_size % 6 AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR) || ' Liter GDI'
         WHEN o_orderkey % 6 = 0 THEN CAST(100 + p_size * 7 AS VARCHAR) || '.0HP Gas/Hybrid'
         ELSE CAST(100 + p_size * 7 AS VARCHAR) || '.0HP ' || CAST(1 + p_size % 6 AS VARCHAR) || '.'
              || CAST(p_size % 10 AS VARCHAR) || 'L V6 Cylinder Engine Gasoline Fuel' END AS engine,
    CASE o_orderkey % 8 WHEN 0 THEN '6-Speed M/T' WHEN 1 THEN 'CVT Transmission'
         WHEN 2 THEN 'Automatic CVT' WHEN 3 THEN '–' WHEN 4 THEN NULL WHEN 5 THEN 'F'
         ELSE '8-Speed A/T' END AS transmission,
    CASE o_orderkey % 10 WHEN 0 THEN 'Jet Black' WHEN 1 THEN 'Titan Gray' WHEN 2 THEN 'Rosso Red'
         WHEN 3 THEN 'Green' WHEN 4 THEN '–' WHEN 5 THEN NULL WHEN 6 THEN 'Glacier White'
         WHEN 7 THEN 'Other' ELSE 'Black.' END AS ext_col,
    CASE o_custkey % 4 WHEN 0 THEN 'Beige' WHEN 1 THEN 'Saddle Brown' WHEN 2 THEN 'Navy'
         ELSE 'Black' END AS int_col,
    CASE o_orderkey % 4 WHEN 0 THEN 'At least 1 accident or damage reported' WHEN 1 THEN NULL
         ELSE 'None reported' END AS accident,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Yes' END AS clean_title,
    '$' || CAST(CAST(floor(o_totalprice) AS BIGINT) // 1000 AS VARCHAR) || ','
        || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS price
  FROM orders JOIN part ON o_custkey = p_partkey
)"""
