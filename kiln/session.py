"""Session construction, table loading and lineage cutting."""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "kiln") -> SparkSession:
    """Build (or reuse) a session configured for this library.

    On a cluster the master, memory and checkpoint folder come from the
    submitter; locally (tests, bench) we fill in only what is unset.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("KILN_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; set our own only when unset.

    A private scratch folder is only created for local sessions (tests and
    bench), never chosen on a cluster that names a shared folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="kiln-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, how: str = "auto") -> DataFrame:
    """Cut lineage before several dependent jobs reuse ``df``.

    ``checkpoint`` writes to the shared checkpoint folder (survives executor
    loss without recomputation); ``persist`` keeps MEMORY_AND_DISK blocks
    (recomputed from lineage on loss); ``none`` returns ``df`` unchanged;
    ``auto`` checkpoints on a cluster and persists in local mode.
    """
    if how == "auto":
        how = "persist" if df.sparkSession.sparkContext.master.startswith("local") else "checkpoint"
    if how == "checkpoint":
        ensure_checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "persist":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "none":
        return df
    raise ValueError(f"unknown materialize mode {how!r}")


def spread(scan: DataFrame) -> int:
    """Partitions for costly row work on a scanned table: some for every core, more where the scan itself has more."""
    return max(4 * scan.sparkSession.sparkContext.defaultParallelism, 4 * scan.rdd.getNumPartitions())


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread an under-partitioned batch input over every core before CPU-heavy
    row work (an unsplittable file arrives as one partition). A no-op for
    inputs that already have enough partitions and for streams. Only for scans
    and projections of them: adaptive execution runs a plan's shuffles and
    broadcasts before it can tell the number of partitions."""
    if df.isStreaming:
        return df
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - sessions without RDD access: leave the layout alone
        return df
    return df.repartition(target) if current < target else df


def load_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """Lazily bind the parquet test tables (no job runs here)."""
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
