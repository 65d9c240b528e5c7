"""Reading sources into the raw listing shape.

``read_source`` dispatches on a spec: a path string reads CSV; a mapping
with ``collection`` reads a document collection (the MongoDB Spark connector
when ``format`` is ``mongodb``, JSON-lines documents otherwise). Every read
takes the declared schema, so nothing is inferred per file.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

from kiln.session import ensure_parallelism
from kiln.sources.csvsplit import read_csv_split
from kiln.sources.spec import SYSTEM_ID_COLUMN, raw_schema

# The tokens pandas' CSV reader treats as missing by default.
PANDAS_NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None, quoted_lines: bool = True) -> DataFrame:
    """Header CSV with an explicit schema. Fields may hold line feeds (``csvsplit.py``: two passes over byte
    ranges, records written once to the checkpoint folder) unless ``quoted_lines`` is off (one lazy, splittable scan)."""
    if quoted_lines:
        return read_csv_split(spark, path, schema or raw_schema())
    return ensure_parallelism(spark.read.schema(schema or raw_schema())
                              .option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
                              .csv(path))


def read_documents(spark: SparkSession, spec: Mapping) -> DataFrame:
    """Every document of a collection as a table (``_id`` kept)."""
    schema = spec.get("schema") or raw_schema()
    if SYSTEM_ID_COLUMN not in schema.fieldNames():
        schema = StructType([*schema.fields]).add(SYSTEM_ID_COLUMN, StringType(), True)
    if spec.get("format", "json") == "mongodb":
        reader = spark.read.format("mongodb").schema(schema)
        for k, v in spec.get("options", {}).items():
            reader = reader.option(k, v)
        return reader.option("collection", spec["collection"]).load()
    return ensure_parallelism(spark.read.schema(schema).json(spec["path"]))


def drop_system_id(df: DataFrame) -> DataFrame:
    """Drop the document-store id column when present."""
    return df.drop(SYSTEM_ID_COLUMN) if SYSTEM_ID_COLUMN in df.columns else df


def normalize_null_tokens(df: DataFrame, tokens: Sequence[str] = PANDAS_NA_TOKENS,
                          columns: Sequence[str] | None = None) -> DataFrame:
    """Missing-value tokens in string columns -> null; NaN in float columns -> null."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if columns is not None and f.name not in columns:
            out.append(c)
        elif isinstance(f.dataType, StringType):
            out.append(F.when(~c.isin(list(tokens)), c).alias(f.name))
        elif isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.when(~F.isnan(c), c).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def read_source(spark: SparkSession, spec, schema: StructType | None = None) -> DataFrame:
    """Path string -> CSV; mapping with ``collection`` -> documents;
    mapping with ``path`` -> CSV. Then S4 and S6 post-processing."""
    if isinstance(spec, str):
        df = read_csv(spark, spec, schema)
    elif isinstance(spec, Mapping) and spec.get("collection"):
        df = read_documents(spark, {**spec, "schema": schema or spec.get("schema")})
    elif isinstance(spec, Mapping) and spec.get("path"):
        df = read_csv(spark, spec["path"], schema or spec.get("schema"))
    else:
        raise ValueError("source spec must be a path or a mapping with 'collection' or 'path'")
    return normalize_null_tokens(drop_system_id(df))


def records_frame(spark: SparkSession, rows: Sequence[Mapping], key: str | None = None) -> DataFrame:
    """Request records -> rows of the raw schema (dummy price ``"0"``)."""
    schema = raw_schema(key)
    data = [tuple((r.get(f.name) if f.name != "price" else r.get("price", "0")) for f in schema.fields)
            for r in rows]
    return spark.createDataFrame(data, schema)


def compose_raw_text(accident: Column, clean_title: Column, is_sport: Column, is_premium: Column,
                     is_4wd: Column, mileage: Column, hp: Column, displacement: Column) -> dict:
    """Structured form fields -> the raw text the cleaning chain expects."""
    words = F.concat_ws(" ", F.when(is_sport == 1, F.lit("Sport")), F.when(is_premium == 1, F.lit("Premium")),
                        F.when(is_4wd == 1, F.lit("4WD")))
    return {
        "accident": F.when(accident == 1, F.lit("At least 1 accident or damage reported"))
                     .otherwise(F.lit("None reported")),
        "clean_title": F.when(clean_title == 1, F.lit("Yes")).otherwise(F.lit("No")),
        "model": F.when(words == "", F.lit("Base Model")).otherwise(words),
        "milage": F.concat(mileage.cast("string"), F.lit(" mi.")),
        "engine": F.concat(hp.cast("string"), F.lit(" HP "), displacement.cast("string"), F.lit("L")),
    }
