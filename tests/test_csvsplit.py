"""Multi-line CSV in byte ranges against Spark's whole-file reader."""

import csv
import io
import os
import random

import pytest
from pyspark.sql.types import LongType, StringType, StructType

from kiln.sources import csvsplit as C
from kiln.sources.sinks import scratch_path

SCHEMA = StructType().add("id", LongType()).add("text", StringType()).add("more", StringType())


def write(spark, files, end="\n", last=True):
    """CSV files of (id, text, more) rows, quoted where needed."""
    folder = scratch_path(spark, "csv").removeprefix("file:")
    os.makedirs(folder)
    for name, rows in files.items():
        out = io.StringIO()
        w = csv.writer(out, lineterminator=end)
        w.writerow(["id", "text", "more"])
        w.writerows(rows)
        with open(f"{folder}/{name}.csv", "w", newline="") as f:
            f.write(out.getvalue() if last else out.getvalue().removesuffix(end))
    return f"file:{folder}"


def texts(seed, n=300):
    r = random.Random(seed)
    signs = ["a", "é", '"', "\n", "\n\n", ",", " ", "x" * 40, '""', "\r\n", "end\n"]
    return [(i, "".join(r.choices(signs, k=r.randint(1, 9))) or None, r.choice(["plain", "q\nq", 'say "hi"', ""])) for i in range(n)]


def same(spark, path, range_bytes):
    whole = spark.read.schema(SCHEMA).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    got = C.read_csv_split(spark, path, SCHEMA, range_bytes=range_bytes)
    assert got.schema == whole.schema
    a, b = ([tuple(r) for r in d.collect()] for d in (got, whole))
    key = str
    assert sorted(a, key=key) == sorted(b, key=key) and a
    return a


@pytest.mark.parametrize("range_bytes", [37, 256, 4096, None])
def test_ranges_equal_whole_files(spark, range_bytes):
    path = write(spark, {"a": texts(1), "b": texts(2, 40), "empty": []})
    assert len(same(spark, path, range_bytes)) == 340


def test_many_tasks_read_one_file(spark):
    path = write(spark, {"a": texts(3, 400)})
    with C.fixed_ranges(spark, 500):
        lines = C.lines_of(spark, path)
        assert lines.rdd.getNumPartitions() > 8
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    same(spark, path, 500)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_a_record_over_many_ranges(spark):
    long = "\n".join(f"line {i} of a long, quoted field" for i in range(200))
    same(spark, write(spark, {"a": [(1, "x", "y"), (2, long, long), (3, "\n", "z")]}), 64)


def test_line_ends_and_a_last_line_without_one(spark):
    path = write(spark, {"a": [(1, "one\r\ntwo", "x"), (2, "three", "y")]}, end="\r\n", last=False)
    got = sorted(tuple(r) for r in C.read_csv_split(spark, path, SCHEMA, range_bytes=9).collect())
    assert got == [(1, "one\r\ntwo", "x"), (2, "three", "y")]


def test_shuffled_ranges(spark, monkeypatch):
    monkeypatch.setattr(C, "LOCAL_RANGES", 2)
    same(spark, write(spark, {"a": texts(5, 120), "b": texts(6, 20)}), 200)


def test_corrupt_rows_are_kept(spark):
    folder = scratch_path(spark, "csv").removeprefix("file:")
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as f:
        f.write('id,text,more\n1,a,b\nnot a number,"c\nd",e\n3,too,few,no many\n4,"open, never closed\n')
    got = C.read_csv_split(spark, f"file:{folder}", SCHEMA, range_bytes=12, corrupt="bad").collect()
    bad = {r["bad"] for r in got if r["bad"] is not None}
    assert 'not a number,"c\nd",e' in bad and "3,too,few,no many" in bad
    assert [tuple(r)[:3] for r in got if r["bad"] is None][:1] == [(1, "a", "b")]

