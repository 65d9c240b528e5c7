"""Small frame helpers shared by the operators."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from kiln.session import ensure_checkpoint_dir


def col(name: str) -> Column:
    """Column by its exact name (names may hold dots or back-ticks)."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, text_col: str) -> DataFrame:
    """One struct column ``doc`` with every column of ``df`` (so no name can clash), ``text_col`` as string."""
    return df.select(F.struct(*[(col(c).cast("string") if c == text_col else col(c)).alias(c)
                                for c in df.columns]).alias("doc"))


def unpacked(df: DataFrame, columns: list[str]) -> list[Column]:
    return [F.col("doc").getField(c).alias(c) for c in columns]


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor
    costs no recomputation of what came before. Parquet keeps later reads to
    the columns they need.
    """
    spark = df.sparkSession
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, "false")
    spark.conf.set(cleanup, "true")  # the shuffles behind a stored frame are not needed again
    path = f"{ensure_checkpoint_dir(spark)}/kiln-{uuid4().hex}"
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, id_col: str) -> DataFrame | None:
    """(id, number): distinct ids numbered in their order over a range-partitioned sort; None if ids are integers."""
    if isinstance(docs.schema[id_col].dataType, IntegralType):
        return None
    ids = docs.select(col(id_col).alias("id")).filter("id is not null").distinct().orderBy("id")
    return stored(ids.select("id", F.monotonically_increasing_id().alias("number")))


def with_numbers(docs: DataFrame, numbers: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) with numbers for ids; null ids stay null."""
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    return texts.join(numbers, "id", "left").select(F.col("number").alias("id"), "text")


def with_ids(found: DataFrame, numbers: DataFrame, *columns: str) -> DataFrame:
    """``found`` with the ids that the numbers in ``columns`` stand for."""
    order = found.columns
    for c in columns:
        ids = numbers.select(F.col("number").alias(c), F.col("id").alias("given_id"))
        found = found.join(ids, c, "left").drop(c).withColumnRenamed("given_id", c)
    return found.select(*order)
