"""Registered queries: ingest with source fallback and snapshots (S5), newest entries of a storage folder (K8, K9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import rules as R
from kiln.plans import sqlparts as Q
from kiln.plans.registry import register
from kiln.session import table
from kiln.sources import store as S
from kiln.sources.fixtures import LISTINGS_SQL, listings
from kiln.sources.sinks import scratch_path, write_table
from kiln.sources.spec import raw_schema

_SUMS = """count(*) AS n, count(fuel_type) AS n_fuel, CAST(sum(listing_id) AS BIGINT) AS ids, max(price) AS max_price"""


@register("ingest_snapshots", Q.with_ctes(LISTINGS_SQL, body=f"""
SELECT CAST(0 AS BIGINT) AS version, 'first' AS run_id, 'fallback' AS source, count(*) AS n_rows, {_SUMS} FROM listings
UNION ALL SELECT 1, 'second', 'listings', count(*), {_SUMS} FROM listings WHERE brand <> 'Tesla'"""))
def ingest_snapshots(spark, sf):
    """First the collection is missing and the fallback CSV gives the rows, then the collection exists (without
    one brand); a repeated run adds nothing, and the older snapshot reads as before."""
    root, store = scratch_path(spark, "ingest"), S.FeatureStore(spark, scratch_path(spark, "features"))
    raw = listings(spark, sf)
    write_table(raw, f"{root}/listings_csv", fmt="csv")
    specs = [{"collection": "listings", "path": f"{root}/collection"}, {"path": f"{root}/listings_csv", "name": "fallback"}]
    schema = raw_schema("listing_id")
    S.ingest(spark, specs, store, "first", schema)
    raw.filter("brand <> 'Tesla'").withColumn("_id", F.col("listing_id").cast("string")).write.json(f"{root}/collection")
    for _ in range(2):
        S.ingest(spark, specs, store, "second", schema)
    rows = store.versions().select("version", "run_id", "source", "n_rows")
    sums = [store.read(v).agg(F.count(F.lit(1)).alias("n"), F.count("fuel_type").alias("n_fuel"), F.sum("listing_id").alias("ids"),
                              F.max("price").alias("max_price")).withColumn("version", F.lit(v).cast("long")) for v in (0, 1)]
    return rows.join(sums[0].unionByName(sums[1]), "version")


@register("newest_version_folders", """
WITH f AS (SELECT o_orderpriority AS priority, o_totalprice, CASE WHEN quarter(o_orderdate) = 4 THEN NULL ELSE
             make_timestamp(year(o_orderdate), quarter(o_orderdate), 1, 12, 30, 0) END AS version_ts FROM orders),
m AS (SELECT priority, max(version_ts) AS version_ts FROM f GROUP BY 1)
SELECT f.priority, f.version_ts, count(*) AS n, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS cents
FROM f JOIN m ON f.priority = m.priority AND f.version_ts = m.version_ts GROUP BY 1, 2""")
def newest_version_folders(spark, sf):
    """K9: orders written into one folder for each priority and quarter, named by time (or ``latest_artifact``, which
    doesn't parse); storage is listed, and only the newest folder of each priority is read back."""
    quarter, year = F.quarter("o_orderdate"), F.year("o_orderdate")
    stamp = F.make_timestamp(year, quarter, F.lit(1), F.lit(12), F.lit(30), F.lit(0))
    name = F.when(quarter == 4, F.lit("latest_artifact")).otherwise(F.date_format(stamp, R.VERSION_FOLDER_FORMAT))
    orders = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("priority"), name.alias("version"), "o_totalprice")
    root = write_table(orders.repartition("priority", "version"), scratch_path(spark, "versions"), partition_by=["priority", "version"])
    files = S.list_files(spark, root).filter(F.col("folder").startswith("priority="))
    files = files.withColumn("priority", F.regexp_extract("folder", "^priority=([^/]*)/", 1))
    newest = S.newest_version(files, ["priority"]).collect()  # a folder for each priority
    parts = [spark.read.parquet(f"{root}/{r['folder']}").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))
             .select(F.lit(r["priority"]).alias("priority"), F.lit(r["version_ts"]).alias("version_ts"), "n", "cents") for r in newest]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("newest_file", """
SELECT c_mktsegment AS segment, count(*) AS n, CAST(sum(round(c_acctbal * 100)) AS BIGINT) AS cents FROM customer
WHERE c_mktsegment = (SELECT max(c_mktsegment) FROM customer) GROUP BY 1""")
def newest_file(spark, sf):
    """K8: one folder of customers for each segment, written one after the other, and files of another kind after
    them; the newest file of the wanted kind is found by its modification time and read."""
    root, customers = scratch_path(spark, "entries"), table(spark, sf, "customer")
    segments = [r[0] for r in customers.select("c_mktsegment").distinct().orderBy("c_mktsegment").collect()]
    for i, segment in enumerate(segments):
        customers.filter(F.col("c_mktsegment") == segment).coalesce(1).write.parquet(f"{root}/{len(segments) - i}")
    customers.select("c_mktsegment").distinct().write.csv(f"{root}/notes")
    path = S.newest_file(S.list_files(spark, root), ".parquet").first()["path"]
    return (spark.read.parquet(path).groupBy(F.col("c_mktsegment").alias("segment"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("c_acctbal") * 100).cast("bigint")).alias("cents")))
