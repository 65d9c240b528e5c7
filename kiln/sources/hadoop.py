"""Small files and folders of any Hadoop file system, from the driver: listings of one folder, records that are
written once, and whether a path exists. Tables are read and written by Spark, not here."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _hadoop(self, name: str):
        p = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return p, p.getFileSystem(self._conf)

    def qualified(self) -> str:
        """The folder's path as listings show it, with its file system."""
        p, fs = self._hadoop("")
        return fs.makeQualified(p).toString()

    def exists(self, name: str = "") -> bool:
        p, fs = self._hadoop(name)
        return fs.exists(p)

    def matches(self) -> bool:
        """Whether the folder's path, which may be a glob, names anything."""
        p, fs = self._hadoop("")
        return bool(fs.globStatus(p))

    def children(self, name: str = "") -> list[str]:
        """Sorted names in a folder (none if it doesn't exist)."""
        p, fs = self._hadoop(name)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def modified(self, name: str = "") -> int:
        """Modification time in milliseconds."""
        p, fs = self._hadoop(name)
        return fs.getFileStatus(p).getModificationTime()

    def delete(self, name: str) -> bool:
        p, fs = self._hadoop(name)
        return fs.delete(p, True)

    def create_once(self, name: str, content: bytes) -> bool:
        """Write a small file whole or not at all; False if the name is taken.

        It is written aside and renamed, which needs a file system whose rename refuses an existing target in one
        step (HDFS; locally it is a check and a rename).
        """
        folder = name.rpartition("/")[0]
        aside, fs = self._hadoop(f"{folder}/.{uuid.uuid4().hex}")
        target, _ = self._hadoop(name)
        out = fs.create(aside, False)
        out.write(bytearray(content))
        out.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf).rename(aside, target, options)
        except Py4JJavaError as e:
            fs.delete(aside, False)
            if "FileAlreadyExists" in e.java_exception.getClass().getName():
                return False
            raise
        return True
