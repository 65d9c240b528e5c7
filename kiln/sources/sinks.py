"""K1-K9: table and report writers, fitted-model persistence, a versioned
model registry and latest-entry resolution.

Everything is written through Spark to any Hadoop-compatible path (local,
HDFS, object stores); nothing goes through driver-local files.
"""

from __future__ import annotations

import dataclasses
import importlib
import json
import uuid
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions import rules as R
from kiln.operators.base import ParamTable
from kiln.session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/kiln-scratch/{uuid.uuid4().hex}/{name}"


# ------------------------------------------------------------ K1-K5 writers

def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (),
                mode: str = "overwrite") -> str:
    """K1/K2/K3: write a table (parquet default, csv with header) by column name."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).option("escape", '"').csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_json_rows(df: DataFrame, path: str) -> str:
    """K4/K5: small report/metadata tables as JSON lines (one file)."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


# ------------------------------------------------------------ K6 persistence

def _encode(obj, path: str, spark: SparkSession, counter: list):
    if obj is None or isinstance(obj, (bool, int, float, str)):
        return {"t": "lit", "v": obj}
    if isinstance(obj, (list, tuple)):
        return {"t": "list", "v": [_encode(x, path, spark, counter) for x in obj]}
    if isinstance(obj, dict):
        return {"t": "dict", "v": [[_encode(k, path, spark, counter), _encode(v, path, spark, counter)]
                                   for k, v in obj.items()]}
    if isinstance(obj, ParamTable):
        counter[0] += 1
        p = f"{path}/tables/{counter[0]}"
        obj.df.write.mode("overwrite").parquet(p)
        return {"t": "table", "path": p, "keys": obj.keys}
    if isinstance(obj, PipelineModel):
        counter[0] += 1
        p = f"{path}/ml/{counter[0]}"
        obj.write().overwrite().save(p)
        return {"t": "ml", "path": p}
    if dataclasses.is_dataclass(obj):
        cls = type(obj)
        return {"t": "obj", "cls": f"{cls.__module__}:{cls.__qualname__}",
                "fields": {f.name: _encode(getattr(obj, f.name), path, spark, counter)
                           for f in dataclasses.fields(obj)}}
    if callable(obj) and getattr(obj, "__module__", "").startswith("kiln.") and "<" not in obj.__qualname__:
        return {"t": "fn", "ref": f"{obj.__module__}:{obj.__qualname__}"}
    raise TypeError(f"cannot persist {type(obj).__name__}; use module-level functions and kiln models")


def _resolve(ref: str):
    mod, name = ref.split(":")
    if not mod.startswith("kiln."):
        raise ValueError(f"refusing to load {ref}")
    obj = importlib.import_module(mod)
    for part in name.split("."):
        obj = getattr(obj, part)
    return obj


def _decode(node, spark: SparkSession):
    t = node["t"]
    if t == "lit":
        return node["v"]
    if t == "list":
        return [_decode(x, spark) for x in node["v"]]
    if t == "dict":
        return {_decode(k, spark): _decode(v, spark) for k, v in node["v"]}
    if t == "table":
        return ParamTable(spark.read.parquet(node["path"]), node["keys"])
    if t == "ml":
        return PipelineModel.load(node["path"])
    if t == "fn":
        return _resolve(node["ref"])
    if t == "obj":
        cls = _resolve(node["cls"])
        return cls(**{k: _decode(v, spark) for k, v in node["fields"].items()})
    raise ValueError(f"bad manifest node {t}")


def save_model(obj, path: str, spark: SparkSession) -> str:
    """K6: persist a fitted kiln model/bundle: parameter tables as parquet,
    Spark ML models with their own writer, literals in a JSON manifest."""
    manifest = _encode(obj, path, spark, [0])
    (spark.createDataFrame([(json.dumps(manifest),)], "manifest string")
     .coalesce(1).write.mode("overwrite").text(f"{path}/manifest"))
    return path


def load_model(path: str, spark: SparkSession):
    """K6: inverse of ``save_model``."""
    text = "".join(r[0] for r in spark.read.text(f"{path}/manifest").collect())
    return _decode(json.loads(text), spark)


# ------------------------------------------------------------ K7-K9 registry

REGISTRY_SCHEMA = "name string, version string, path string, r2 double, published_at timestamp"


def version_name(ts: datetime | None = None) -> str:
    """Folder name in the reference's ``%m_%d_%Y_%H_%M_%S`` form."""
    return (ts or datetime.now(timezone.utc)).strftime("%m_%d_%Y_%H_%M_%S")


def publish(spark: SparkSession, bundle, registry_root: str, name: str, r2: float | None,
            ts: datetime | None = None) -> DataFrame:
    """K7: write the bundle under ``registry_root/name/<version>`` and append a
    registry row; earlier versions are never overwritten."""
    ts = ts or datetime.now(timezone.utc)
    version = version_name(ts)
    path = f"{registry_root.rstrip('/')}/{name}/{version}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        raise FileExistsError(f"{path} is published already")  # versions have a precision of one second
    save_model(bundle, path, spark)
    row = spark.createDataFrame([(name, version, path, r2, ts.replace(tzinfo=None))], REGISTRY_SCHEMA)
    row.write.mode("append").parquet(f"{registry_root.rstrip('/')}/_registry")
    return spark.read.parquet(f"{registry_root.rstrip('/')}/_registry")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """K8: the newest row per key by ``order`` (descending, left to right).

    ``max_by`` over a struct of the ordering columns keeps the aggregation
    partial (map-side), so a hot key never collects its rows in one task.
    """
    cols = [c for c in df.columns if c not in set(keys)]
    ordkey = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)])
    packed = F.struct(*[F.col(c) for c in cols])
    agg = df.groupBy(*keys).agg(F.max_by(packed, ordkey).alias("_row"))
    return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in cols])


def latest_parsed_version(names: DataFrame, name_col: str = "folder", by: Sequence[str] = ()) -> DataFrame:
    """K9: newest folder whose name parses as ``MM_dd_yyyy_HH_mm_ss``; others skipped."""
    ts = F.try_to_timestamp(F.col(name_col), F.lit(R.VERSION_FOLDER_FORMAT))
    parsed = names.select(*by, F.col(name_col), ts.alias("version_ts")).filter(F.col("version_ts").isNotNull())
    return latest_per_key(parsed, list(by), [F.col("version_ts"), F.col(name_col)]) if by else (
        parsed.agg(F.max_by(F.struct(name_col, "version_ts"), F.struct("version_ts", name_col)).alias("r"))
        .select(F.col("r")[name_col].alias(name_col), F.col("r")["version_ts"].alias("version_ts")))


def resolve_latest_model(spark: SparkSession, registry_root: str, name: str):
    """Load the newest registered bundle for ``name`` (None when nothing is registered)."""
    reg = spark.read.parquet(f"{registry_root.rstrip('/')}/_registry").filter(F.col("name") == name)
    latest = latest_per_key(reg, ["name"], [F.col("published_at"), F.col("version")]).first()
    return None if latest is None else load_model(latest["path"], spark)
