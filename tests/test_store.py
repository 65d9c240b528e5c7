"""S5 ingest and snapshots; K8, K9 from storage."""

from datetime import datetime, timedelta, timezone

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from kiln.sources import store as S
from kiln.sources.hadoop import Folder
from kiln.sources.sinks import scratch_path

SCHEMA = StructType([StructField("a", LongType()), StructField("b", StringType())])


def new_store(spark):
    return S.FeatureStore(spark, scratch_path(spark, "store"))


def values(df):
    return sorted(tuple(r) for r in df.collect())


def csv(spark, rows):
    path = scratch_path(spark, "in")
    spark.createDataFrame(rows, SCHEMA).write.option("header", True).csv(path)
    return path


def test_first_source_that_exists_and_snapshots(spark):
    store, path = new_store(spark), csv(spark, [(1, "x"), (2, "NA")])
    missing = scratch_path(spark, "none")
    got = S.ingest(spark, [None, "", {"collection": "c", "path": missing}, missing, path], store, "one", SCHEMA)
    assert (got["version"], got["source"], got["n_rows"]) == (0, path, 2)
    assert values(store.read().na.fill("?")) == [(1, "x"), (2, "?")]  # null tokens as in every read
    later = csv(spark, [(3, "y")])
    assert S.ingest(spark, [later], store, "two", SCHEMA)["version"] == 1
    assert S.ingest(spark, [path], store, "two", SCHEMA)["source"] == later  # a run that is called again
    assert values(store.read()) == [(3, "y")] and store.read(0).count() == 2
    assert store.versions().count() == 2


def test_no_source_and_an_unreadable_one(spark):
    store = new_store(spark)
    with pytest.raises(S.NoSource):
        S.ingest(spark, [None, scratch_path(spark, "none")], store, "one", SCHEMA)
    with pytest.raises(S.NoSource):
        store.read()
    with pytest.raises(Py4JJavaError, match="DATA_SOURCE_NOT_FOUND"):  # a broken connector isn't passed over for older rows
        S.ingest(spark, [{"collection": "c", "format": "mongodb"}, csv(spark, [(1, "x")])], store, "one", SCHEMA)
    assert store.versions().count() == 0


def test_as_of(spark):
    store = new_store(spark)
    before = datetime.now(timezone.utc)
    store.write(spark.createDataFrame([(1, "x")], SCHEMA), "one", "s")
    between = datetime.now(timezone.utc)
    store.write(spark.createDataFrame([(2, "y")], SCHEMA), "two", "s")
    assert values(store.read(as_of=between)) == [(1, "x")]
    assert values(store.read(as_of=between + timedelta(hours=1))) == [(2, "y")]
    with pytest.raises(S.NoSource):
        store.read(as_of=before)


def test_an_interrupted_run_is_unseen_and_removed(spark, monkeypatch):
    store, df = new_store(spark), spark.createDataFrame([(1, "x")], SCHEMA)
    with monkeypatch.context() as m:
        m.setattr(Folder, "create_once", lambda *a: (_ for _ in ()).throw(ConnectionError()))
        with pytest.raises(ConnectionError):
            store.write(df, "one", "s")
    assert store.versions().count() == 0 and len(store.folder.children("data")) == 1
    kept = store.write(df, "one", "s")
    assert store.vacuum() == []  # it might still be written
    assert len(store.vacuum(older_than_seconds=-60)) == 1
    assert store.folder.children("data") == [kept["path"].rpartition("/")[2]] and values(store.read()) == [(1, "x")]


def test_a_taken_number(spark):
    store = new_store(spark)
    create, raced = Folder.create_once, []
    df = spark.createDataFrame([(1, "x")], SCHEMA)

    class Raced(Folder):
        def create_once(self, name, content):
            if not raced:
                raced.append(name)
                S.FeatureStore(spark, self.path).write(df, "other", "s")
            return create(self, name, content)

    store.folder.__class__ = Raced
    assert store.write(df, "one", "s")["version"] == 1 and store.versions().count() == 2


def test_listing_of_files_and_versions(spark):
    root = scratch_path(spark, "list")
    for name in ("a/01_02_2024_00_00_00", "a/12_31_2023_23_59_59", "a/latest_artifact", "list/list", "b"):
        spark.range(2).coalesce(1).write.parquet(f"{root}/{name}")
    files = S.list_files(spark, root)
    assert {r["folder"] for r in files.collect()} == {"a/01_02_2024_00_00_00", "a/12_31_2023_23_59_59", "a/latest_artifact", "list/list", "b"}
    newest = S.newest_version(files).collect()
    assert [(r["version"], r["folder"]) for r in newest] == [("01_02_2024_00_00_00", "a/01_02_2024_00_00_00")]
    assert S.newest_file(files, ".parquet").first()["folder"] == "b"
    assert S.newest_file(files, ".nothing").count() == 0 and S.newest_version(files.filter("folder = 'b'")).count() == 0
    by = S.newest_file(files.withColumn("top", F.substring_index("folder", "/", 1)), ".parquet", ["top"])
    assert sorted(r["folder"] for r in by.collect()) == ["a/latest_artifact", "b", "list/list"]
