"""Exact quantiles and modes of distributed columns, without buffers of distinct values.

Quantiles are found by selection. A first pass gives every group's count, least
and largest value; a histogram between those bounds then says in which bucket
each wanted rank lies, and each further pass counts only the values in those
buckets, in finer ones between the bucket's own least and largest value, until
a bucket holds one value. Buckets are even steps of the value, which never
misorder two values; where that does not close in (after ``EVEN_PASSES``, or
with infinite bounds) they are steps of the doubles' bits, which do within a few
passes whatever the values. A bucket of few rows is counted value by value at
once. All columns, ranks and groupings share the passes; a pass shuffles one
row for each group, open bucket and non-empty finer bucket, at most about
``BUCKETS`` an open bucket, pre-aggregated before the shuffle, so neither a hot
group nor a column of distinct values meets in one task.

Modes count (group, value) pairs and keep the pair with the largest count by a
minimum over (-count, value): ties go to the smallest value.

Nulls are left out; NaN counts as the largest value. A column without values
gives no row. Null group keys form a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from kiln.session import ensure_parallelism, materialize

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
#: Passes with even steps before steps of bits.
EVEN_PASSES = 3
#: Selections with at most so many (group, column, rank) rows go on as local rows that each task can have.
LOCAL_ROWS = 10_000


def ordered_bits(x: Column) -> Column:
    """The double's bits as a number that orders like the double (exact arithmetic on powers of two)."""
    a = F.abs(x)
    guess = F.floor(F.log2(a)).cast("int")
    ratio = a / F.pow(F.lit(2.0), guess.cast("double"))
    exponent = guess + (ratio >= 2).cast("int") - (ratio < 1).cast("int")
    fraction = a / F.pow(F.lit(2.0), exponent.cast("double")) - 1
    normal = (exponent.cast("long") + 1023) * (1 << 52) + (fraction * float(1 << 52)).cast("long")
    bits = (F.when(F.isnan(x), F.lit(0x7FF8 << 48))
            .when(a == float("inf"), F.lit(0x7FF0 << 48))
            .when(a < 2.0 ** -1022, (a * 2.0 ** 537 * 2.0 ** 537).cast("long"))
            .otherwise(normal))
    return F.when((x < 0) & ~F.isnan(x), -bits).otherwise(bits)


def _base(df: DataFrame, columns: Mapping[str, Column], sets: Sequence[Sequence[str]]) -> DataFrame:
    """Only what is counted: keys g0.. and values v0.."""
    keys = list(dict.fromkeys(k for s in sets for k in s))
    return df.select(*[F.col(k).alias(f"g{i}") for i, k in enumerate(keys)], *[x.alias(f"v{j}") for j, x in enumerate(columns.values())])


def _entries(base: DataFrame, columns: Mapping[str, Column], sets: Sequence[Sequence[str]]) -> DataFrame:
    """One row for each row, grouping and column with a value: gs, g0.., c, v."""
    keys = list(dict.fromkeys(k for s in sets for k in s))
    kinds = {f.name: f.dataType for f in base.schema.fields}
    rows = [F.struct(F.lit(s).alias("gs"),
                     *[(F.col(f"g{i}") if k in own else F.lit(None).cast(kinds[f"g{i}"])).alias(f"g{i}") for i, k in enumerate(keys)],
                     F.lit(j).alias("c"), F.col(f"v{j}").alias("v"))
            for s, own in enumerate(sets) for j in range(len(columns))]
    return base.select(F.inline(F.array(*rows))).filter("v IS NOT NULL")


def _named(df: DataFrame, columns: Mapping[str, Column], sets: Sequence[Sequence[str]], values: Sequence[str]) -> DataFrame:
    keys = list(dict.fromkeys(k for s in sets for k in s))
    names = F.array(*[F.lit(c) for c in columns])
    return df.select("gs", *[F.col(f"g{i}").alias(k) for i, k in enumerate(keys)], names[F.col("c")].alias("column_name"), *values)


def _group(sets: Sequence[Sequence[str]]) -> list[str]:
    return ["gs", *[f"g{i}" for i in range(len({k for s in sets for k in s}))], "c"]


def _finer(buckets: DataFrame, even: bool) -> tuple[DataFrame, Column]:
    """The open buckets with their ``step``, and the number of a value's finer bucket in its open one.

    Buckets whose bounds have no finite positive step wait for the passes over bits; bounds of two signs part at 0 there.
    """
    at, to, v = F.col("at"), F.col("to"), F.col("v")
    if even:
        step = (to - at) / float(BUCKETS)
        steady = (step > 0) & (step < float("inf"))
        return (buckets.withColumn("step", F.when(steady, step)),
                F.coalesce(F.floor((v - at) / F.col("step")).cast("long"), F.lit(0).cast("long")))
    low, high = ordered_bits(at), ordered_bits(to)
    wide = F.log2((high - low + 1).cast("double"))
    buckets = (buckets.withColumn("parted", (at < 0) & (to > 0)).withColumn("low", F.when(~F.col("parted"), low))
               .withColumn("step", F.when(~F.col("parted"), F.pow(F.lit(2.0), F.greatest(F.ceil(wide) - BUCKET_BITS, F.lit(0)).cast("double")))))
    return buckets, F.coalesce(F.floor((ordered_bits(v) - F.col("low")) / F.col("step")).cast("long"), (v >= 0).cast("long"))


def _chosen(histogram: DataFrame, group: list[str]) -> DataFrame:
    """Rows of a histogram in which wanted ranks lie: the group, total, rank, and the bucket's least and largest
    value, size and how many values are smaller (before)."""
    w = Window.partitionBy(*group, "at").orderBy("bucket", "value")
    running = histogram.withColumn("before", F.col("base") + F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    hits = F.filter("ranks", lambda k: (k >= F.col("before")) & (k < F.col("before") + F.col("size")))
    return running.withColumn("rank", F.explode(hits)).select(*group, "total", "rank", "least", "most", "size", "before")


def _held(selection: DataFrame) -> tuple[DataFrame, bool, bool]:
    """The selection cut off from its lineage, whether it is small enough for every task, and whether any bucket is open."""
    selection = selection.withColumn("open", F.col("least") != F.col("most"))
    head = selection.limit(LOCAL_ROWS + 1).collect()
    if len(head) <= LOCAL_ROWS:
        schema = StructType([StructField(f.name, f.dataType, True) for f in selection.schema.fields])
        return selection.sparkSession.createDataFrame(head, schema), True, any(r["open"] for r in head)
    selection = materialize(selection, "checkpoint")
    return selection, False, not selection.filter("open").isEmpty()


def quantiles(df: DataFrame, columns: Sequence[str] | Mapping[str, Column], probs: Sequence[float],
              sets: Sequence[Sequence[str]] = ((),), computed: bool = False) -> DataFrame:
    """Exact linear quantiles of every column in every group of every grouping set.

    Rows: gs (which set), the sets' key columns (null where a set lacks one), column_name, n, q (array, as ``probs``).
    ``computed``: the input is more than a scan, so its keys and values are materialized for the passes.
    """
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}
    columns = {c: x.cast("double") for c, x in columns.items()}
    group = _group(sets)
    base = _base(df, columns, sets)
    wide = base if computed else ensure_parallelism(base)
    kept = computed or wide is not base  # a spread input of few partitions is kept too, so it is spread once
    base = materialize(wide) if kept else base
    rows = _entries(base, columns, sets)
    stats = [F.count(F.lit(1)).alias("size"), F.min("v").alias("least"), F.max("v").alias("most")]
    places = [F.lit(float(p)) * (F.col("total") - 1) for p in probs]
    wanted = F.array_distinct(F.array(*[f(x).cast("long") for x in places for f in (F.floor, F.ceil)]))

    bounds = rows.groupBy(*group).agg(*stats).withColumn("total", F.col("size"))
    selection, small, more = _held(bounds.select(*group, "total", F.explode(wanted).alias("rank"), "least", "most", "size",
                                                 F.lit(0).cast("long").alias("before")))
    found, passes = selection.filter("NOT open"), 0
    while more:
        open_ = selection.filter("open")
        buckets = (open_.groupBy(*[F.col(g).alias(f"_{g}") for g in group], F.col("least").alias("at"), F.col("most").alias("to"),
                                 "total", F.col("before").alias("base"), F.col("size").alias("within"))
                   .agg(F.collect_set("rank").alias("ranks")))
        same = F.lit(True)
        for g in group:
            same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
        buckets, bucket = _finer(buckets, passes < EVEN_PASSES)
        side = F.broadcast(buckets) if small else buckets
        inside = rows.join(side.drop("ranks"), same & (F.col("v") >= F.col("at")) & (F.col("v") <= F.col("to")))
        few = F.col("within") <= BUCKETS
        counts = inside.groupBy(*group, F.col("at").alias("_at"), F.when(~few, bucket).alias("bucket"), F.when(few, F.col("v")).alias("value")).agg(*stats)
        finer = counts.join(side, same & (F.col("_at") == F.col("at")))  # arrays stay out of the hash aggregation
        selection, small, more = _held(_chosen(finer, group))
        found, passes = found.unionByName(selection.filter("NOT open")), passes + 1
    if kept:
        base.unpersist()
    value = found.groupBy(*group, "total").agg(F.map_from_entries(F.collect_list(F.struct("rank", "least"))).alias("at"))

    def between(x: Column) -> Column:
        low, high = (F.col("at")[f(x).cast("long")] for f in (F.floor, F.ceil))
        return F.when(low == high, low).otherwise(low + (high - low) * (x - F.floor(x)))

    out = value.select(*group, F.col("total").alias("n"), F.array(*[between(x) for x in places]).alias("q"))
    return _named(out, columns, sets, ["n", "q"])


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], computed: bool = False) -> dict[str, list[float] | None]:
    """{column: quantiles} over all rows (None without values)."""
    found = {r["column_name"]: list(r["q"]) for r in quantiles(df, columns, probs, computed=computed).collect()} if columns else {}
    return {c: found.get(c) for c in columns}


def modes(df: DataFrame, columns: Sequence[str] | Mapping[str, Column], sets: Sequence[Sequence[str]] = ((),)) -> DataFrame:
    """The most frequent value of every column (all of one type) in every group of every grouping set.

    Rows: gs, the sets' key columns, column_name, value, n.
    """
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}
    group = _group(sets)
    counts = _entries(_base(df, columns, sets), columns, sets).groupBy(*group, "v").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*group).agg(F.min(F.struct((-F.col("n")).alias("less"), "v")).alias("best"))
    return _named(best.select(*group, F.col("best.v").alias("value"), (-F.col("best.less")).alias("n")), columns, sets, ["value", "n"])


def column_modes(df: DataFrame, columns: Mapping[str, Column]) -> dict:
    """{name: mode} over all rows (None without values); columns may differ in type."""
    kinds: dict = {}
    for f in df.select(*[x.alias(c) for c, x in columns.items()]).schema.fields:
        kinds.setdefault(f.dataType, []).append(f.name)
    found: dict = {}
    for own in kinds.values():
        found |= {r["column_name"]: r["value"] for r in modes(df, {c: columns[c] for c in own}).collect()}
    return {c: found.get(c) for c in columns}
