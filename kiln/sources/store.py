"""Ingest into a feature store of versioned snapshots; K8, K9: newest entries of a storage folder.

A store is a folder with the snapshots' rows (``data/<run>-<attempt>``, Parquet) and a
log of one small record per snapshot (``log/<version>.json``: the run, the source
that gave the rows, their number, schema and folder). A snapshot exists if and
only if the log holds its record, which is written once its rows are complete,
so a reader resolves a version to a folder that nobody changes any more; a run
that breaks off leaves a folder without a record, which no reader sees and
``vacuum`` removes. Two ingests at once get two versions, in the order of their
commits; a run that is called again returns its record.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from kiln.functions import rules as R
from kiln.sources.hadoop import Folder
from kiln.sources.readers import read_source
from kiln.sources.sinks import latest_per_key

SNAPSHOT = "version long, run_id string, source string, n_rows long, schema string, path string, taken_at timestamp"


class NoSource(LookupError):
    """None of the sources exists."""


class FeatureStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, Folder(spark, root)

    def _numbers(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.folder.children("log") if n.endswith(".json") and not n.startswith(".")]

    def versions(self) -> DataFrame:
        """All snapshots, one row each."""
        if not self._numbers():
            return self.spark.createDataFrame([], SNAPSHOT)
        return self.spark.read.schema(SNAPSHOT).json(f"{self.folder.path}/log/*.json")

    def _record(self, version: int) -> dict:
        return self.spark.read.schema(SNAPSHOT).json(f"{self.folder.path}/log/{version:020d}.json").first().asDict()

    def read(self, version: int | None = None, as_of: datetime | None = None) -> DataFrame:
        """The rows of a version, of the newest one taken by ``as_of`` (UTC if it has no zone), or of the newest."""
        if version is None:
            if as_of is not None:
                at = as_of.replace(tzinfo=as_of.tzinfo or timezone.utc)
                # the log's order counts, not the clocks of the machines that wrote it
                version = self.versions().filter(F.col("taken_at") <= F.lit(at)).agg(F.max("version")).first()[0]
            else:
                version = max(self._numbers(), default=None)
            if version is None:
                raise NoSource(f"no snapshot in {self.folder.path}")
        record = self._record(version)
        return self.spark.read.schema(StructType.fromJson(json.loads(record["schema"]))).parquet(record["path"])

    def write(self, df: DataFrame, run_id: str, source: str) -> dict:
        """Write the rows, then commit their record under the next free version."""
        known = self.versions().filter(F.col("run_id") == run_id).first()
        if known is not None:
            return known.asDict()
        # each attempt has its own folder, so one that was thought lost can't change what another commits
        path = f"{self.folder.path}/data/{run_id}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        n_rows = self.spark.read.schema(df.schema).parquet(path).count()  # from the footers
        while True:
            version = max(self._numbers(), default=-1) + 1
            record = {"version": version, "run_id": run_id, "source": source, "n_rows": n_rows, "schema": df.schema.json(),
                      "path": path, "taken_at": datetime.now(timezone.utc).isoformat()}
            if self.folder.create_once(f"log/{version:020d}.json", json.dumps(record).encode() + b"\n"):
                return self._record(version)
            known = self.versions().filter(F.col("run_id") == run_id).first()
            if known is not None:  # another attempt of this run was first
                return known.asDict()

    def vacuum(self, older_than_seconds: float = 86_400.0) -> list[str]:
        """Remove folders of rows that no record names and that nobody has changed for so long; their names."""
        named = {r["path"].rpartition("/")[2] for r in self.versions().select("path").collect()}
        limit = (time.time() - older_than_seconds) * 1000
        stale = [n for n in self.folder.children("data") if n not in named and self.folder.modified(f"data/{n}") <= limit]
        for n in stale:
            self.folder.delete(f"data/{n}")
        return stale


def source_exists(spark: SparkSession, spec) -> bool:
    """Whether a source spec names anything: a path with files, or a collection of a connector (which is asked on reading)."""
    if not spec:
        return False
    path = spec if isinstance(spec, str) else spec.get("path")
    if path:
        return Folder(spark, path).matches()
    return isinstance(spec, Mapping) and bool(spec.get("collection"))


def first_source(spark: SparkSession, specs: Sequence, schema: StructType | None = None) -> tuple[DataFrame, str]:
    """Rows and name of the first source that exists.

    Only a missing source is passed over. One that exists and can't be read fails: old rows must not replace it silently.
    """
    for spec in specs:
        if source_exists(spark, spec):
            name = spec if isinstance(spec, str) else spec.get("name") or spec.get("collection") or spec["path"]
            return read_source(spark, spec, schema), name
    raise NoSource(f"none of {len(specs)} sources exists")


def ingest(spark: SparkSession, specs: Sequence, store: FeatureStore, run_id: str, schema: StructType | None = None) -> dict:
    """The first source that exists, processed (S4, S6) and kept as a snapshot; its record."""
    df, name = first_source(spark, specs, schema)
    return store.write(df, run_id, name)


# ------------------------------------------------------------ K8, K9: entries of a folder

def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, entry, folder, modified, length) of every file below a folder; contents are not read.

    ``entry`` is the path below ``root``, ``folder`` its part before the file name. Spark lists many folders on executors.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    below = F.col("path").substr(F.lit(len(Folder(spark, root).qualified()) + 2), F.length("path"))
    return (files.select("path", below.alias("entry"), F.col("modificationTime").alias("modified"), "length")
            .withColumn("folder", F.when(F.instr("entry", "/") > 0, F.regexp_extract("entry", r"^(.*)/[^/]*$", 1)).otherwise("")))


def _newest(entries: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    if by:
        return latest_per_key(entries, list(by), [F.col(c) for c in order])
    return entries.agg(F.max_by(F.struct(*entries.columns), F.struct(*order)).alias("r")).filter("r IS NOT NULL").select("r.*")


def newest_file(files: DataFrame, suffix: str, by: Sequence[str] = ()) -> DataFrame:
    """K8: the file with the newest modification time among those whose names end so (ties: the largest path), of each ``by``."""
    return _newest(files.filter(F.col("entry").endswith(suffix)), by, ["modified", "path"])


def newest_version(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """K9: the folder whose last name parses as a version time and is the newest, of each ``by``; other names are passed over.

    Names may carry a partition column (``version=...``). Of folders of one time, the one with the largest path counts."""
    name = F.regexp_extract("folder", r"(?:^|/)(?:[^/=]*=)?([^/]*)$", 1)
    named = files.select(*by, "folder", name.alias("version")).distinct()
    ts = F.try_to_timestamp(F.col("version"), F.lit(R.VERSION_FOLDER_FORMAT))
    return _newest(named.withColumn("version_ts", ts).filter("version_ts IS NOT NULL"), by, ["version_ts", "folder"])
