"""CSV files whose quoted fields hold line feeds, read by many tasks a file.

Spark's ``multiLine`` reads a whole file in one task. Here the file's lines are
read in byte ranges. A line begins inside a quoted field exactly if the number
of quotes before it is odd (a quote inside a field is doubled, so it counts
twice). One pass counts the quotes of each range; their prefix sums over a
file's ranges, one row each, say how every range begins. A second pass joins
the lines of each record. What a range cannot finish itself, the lines of a
record that began before it or go on after it, leaves the task as a fragment;
fragments (two a range at most) are put together per file in order. Records are
then parsed one by one with the declared schema; those that don't fit it keep
their text in the corrupt-record column.

The ranges of both passes must be the same, so the range size doesn't depend on
the number of cores while they run, and the joined records are written once to
the checkpoint folder. A quote that is never closed swallows the rest of its
file into one record, as it does with ``multiLine``.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from kiln.session import materialize

CORRUPT = "_corrupt_record"
#: So many byte ranges at most go to every task as a local table; beyond, lines and ranges meet by a shuffle.
LOCAL_RANGES = 10_000


@contextmanager
def fixed_ranges(spark: SparkSession, range_bytes: int | None):
    """Byte ranges of ``range_bytes`` (else the session's maxPartitionBytes), whatever the number of cores."""
    wanted = {"spark.sql.files.minPartitionNum": "1"}
    if range_bytes:
        wanted |= {"spark.sql.files.maxPartitionBytes": str(range_bytes), "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, place, line): every line with its file, its byte range and its place in the task's order."""
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("place"), F.col("value").alias("line")))


def range_starts(lines: DataFrame, quote: str) -> DataFrame:
    """(file, block, inside): whether a byte range begins inside a quoted field."""
    quotes = F.length("line") - F.length(F.replace(F.col("line"), F.lit(quote), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))
    before = F.sum("quotes").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return counts.select("file", "block", (F.coalesce(before, F.lit(0)) % 2 == 1).alias("inside"))


def joined(lines: DataFrame, quote: str) -> DataFrame:
    """(file, block, place, part, text) from lines in order with ``inside``: whole records (part 0), the end of a
    record that began earlier (1), the beginning of one that goes on (2), or a stretch of one that does both (3)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, first, begun = None, [], 0, True  # the range, the open record's lines, its place, whether it began here
        inside, out = False, []

        def leave() -> None:
            if held:  # the range ends inside a record, or is nothing but a stretch of one
                out.append((*at, first, 2 if begun else 3, "\n".join(held)))

        for batch in batches:
            for file, block, place, line, start in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, block) != at:
                    leave()
                    at, held, inside, begun = (file, block), [], start, not start
                if not held:
                    first = place
                held.append(line)
                if line.count(quote) % 2:
                    inside = not inside
                if not inside:
                    out.append((*at, first, 0 if begun else 1, "\n".join(held)))
                    held, begun = [], True
            yield rows(out)
            out = []
        leave()
        yield rows(out)

    def rows(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "block", "place", "part", "text"])

    return lines.select("file", "block", "place", "line", "inside").mapInArrow(run, "file string, block long, place long, part int, text string")


def records(spark: SparkSession, path: str, quote: str = '"', range_bytes: int | None = None) -> DataFrame:
    """(file, block, place, text): every record of every file under ``path``."""
    with fixed_ranges(spark, range_bytes):
        lines = lines_of(spark, path)
        starts = range_starts(lines, quote)
        head = starts.limit(LOCAL_RANGES + 1).collect()
        if len(head) <= LOCAL_RANGES:
            side = F.broadcast(spark.createDataFrame(head, starts.schema))
            lines = lines.join(side, ["file", "block"])  # a broadcast join keeps the lines' order
        else:
            lines = lines.join(starts.hint("merge"), ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "place")
        parts = materialize(joined(lines, quote), "checkpoint")
    pieces = parts.filter("part > 0")
    # a record's pieces: a beginning (2), stretches (3), an end (1), in the order of their ranges
    order = Window.partitionBy("file").orderBy("block", "part_order")
    numbered = (pieces.withColumn("part_order", F.when(F.col("part") == 1, 0).otherwise(1))
                .withColumn("record", F.sum((F.col("part") == 2).cast("int")).over(order)))
    whole = (numbered.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "part_order", "place", "text"))).alias("p"))
             .select("file", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["place"].alias("place"),
                     F.array_join(F.col("p.text"), "\n").alias("text")))
    return parts.filter("part = 0").select("file", "block", "place", "text").unionByName(whole)


def read_csv_split(spark: SparkSession, path: str, schema: StructType, header: bool = True, quote: str = '"',
                   range_bytes: int | None = None, corrupt: str | None = None) -> DataFrame:
    """Header CSV with the declared schema; ``corrupt`` names a column for the text of records that don't fit it."""
    found = records(spark, path, quote, range_bytes)
    if header:  # the first record of each file
        firsts = found.filter("block = 0").groupBy("file").agg(F.min("place").alias("place")).withColumn("block", F.lit(0).cast("long"))
        found = found.join(firsts, ["file", "block", "place"], "left_anti")
    text = F.when(F.col("text").endswith("\r"), F.expr("substring(text, 1, length(text) - 1)")).otherwise(F.col("text"))
    found = found.select(text.alias("text")).filter(F.trim("text") != "")
    name = corrupt or CORRUPT
    parsed = F.from_csv("text", _ddl(StructType([*schema.fields]).add(name, StringType(), True)),
                        {"quote": quote, "escape": quote, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": name})
    rows = found.select(parsed.alias("r"))
    return rows.select(*[F.col("r")[f.name].alias(f.name) for f in schema.fields], *([F.col("r")[name].alias(name)] if corrupt else []))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
