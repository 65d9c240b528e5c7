"""The tables behind an exploratory analysis, as distributed jobs.

Wide per-column statistics run as one aggregation and are unpivoted to long
form. Order-dependent statistics (ranks, cumulative shares) first reduce to
distinct values, then use a distributed prefix sum (range partitioning +
per-partition totals) so no global window lands on a single task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, DoubleType, FloatType, IntegerType, LongType, NumericType,
                               StringType, TimestampNTZType, TimestampType)

from kiln.functions.stats import chi2_sf, dagostino_k2
from kiln.operators.ranks import column_quantiles, quantiles
from kiln.session import materialize

SQL_TYPE_NAMES = {StringType: "VARCHAR", LongType: "BIGINT", IntegerType: "INTEGER", DoubleType: "DOUBLE",
                  FloatType: "FLOAT", BooleanType: "BOOLEAN", DateType: "DATE", TimestampType: "TIMESTAMP",
                  TimestampNTZType: "TIMESTAMP"}


def _stack(wide: DataFrame, names: Sequence[str], fields: Sequence[str], out: Sequence[str]) -> DataFrame:
    """Unpivot ``{name}__{field}`` columns of a one-row frame to one row per name."""
    items = ", ".join(f"'{n}', " + ", ".join(f"`{n}__{f}`" for f in fields) for n in names)
    return wide.selectExpr(f"stack({len(names)}, {items}) AS (column_name, {', '.join(out)})")


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns by schema (no job)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in set(exclude)]


def profile_columns(df: DataFrame) -> DataFrame:
    """Per column: position, SQL type name, row count and non-null count."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(F.col(c)).alias(f"{c}__nn") for c in cols])
    types = {f.name: SQL_TYPE_NAMES.get(type(f.dataType), f.dataType.simpleString().upper())
             for f in df.schema.fields}
    items = ", ".join(f"'{c}', {i}, '{types[c]}', `{c}__nn`" for i, c in enumerate(cols))
    return wide.selectExpr("_n AS n_rows", f"stack({len(cols)}, {items}) AS (column_name, position, data_type, n_non_null)")


QUARTERS = [0.25, 0.5, 0.75]


def quartile_table(df: DataFrame, column: str, by: str, approx: bool = False) -> DataFrame:
    """(by, n, q): non-null values and their quartiles in each group with any."""
    if approx:
        return (df.groupBy(by).agg(F.count(column).alias("n"), F.percentile_approx(F.col(column), QUARTERS, 10000).cast("array<double>").alias("q"))
                .filter("n > 0"))
    return quantiles(df, [column], QUARTERS, [[by]], computed=True).select(by, "n", "q")


def quartiles(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict:
    """{column: [q25, q50, q75]}: exact linear percentiles by selection, or a fixed-size sketch with ``approx``."""
    if not approx:
        return column_quantiles(df, cols, QUARTERS)
    return df.agg(*[F.percentile_approx(F.col(c), QUARTERS, 10000).cast("array<double>").alias(c) for c in cols]).first().asDict()


def describe_numeric(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Count, mean, sample std, min, quartiles (exact, linear), max."""
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).cast("double").alias(f"{c}__min"),
                 F.max(x).cast("double").alias(f"{c}__max")]
    wide = df.agg(*aggs)
    found = quartiles(df, cols, approx)
    q = F.coalesce(*[F.when(F.col("column_name") == c, F.array(*[F.lit(v) for v in found[c]])) for c in cols if found[c]],
                   F.lit(None).cast("array<double>"))
    long = _stack(wide, cols, ["count", "mean", "std", "min", "max"], ["n", "mean", "std", "min", "max"]).withColumn("q", q)
    return long.select("column_name", "n", "mean", "std", "min", F.col("q")[0].alias("q25"),
                       F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percent per column, only columns with any missing."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"{c}__m") for c in cols])
    items = ", ".join(f"'{c}', `{c}__m`" for c in cols)
    long = wide.selectExpr("_n", f"stack({len(cols)}, {items}) AS (column_name, n_missing)")
    return (long.filter(F.col("n_missing") > 0)
            .select("column_name", F.col("n_missing").cast("bigint").alias("n_missing"),
                    (F.col("n_missing") * 100.0 / F.col("_n")).alias("pct_missing")))


def missing_patterns(df: DataFrame) -> DataFrame:
    """Rows per missingness pattern (one 0/1 character per column, in order)."""
    pattern = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in df.columns])
    return df.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n_rows"))


def missing_correlation(df: DataFrame) -> DataFrame:
    """Correlation of null indicators for column pairs (a before b), columns
    whose indicator is constant left out."""
    cols = df.columns
    flags = df.select(*[F.col(c).isNull().cast("double").alias(c) for c in cols])
    var = flags.agg(*[F.var_pop(c).alias(c) for c in cols]).first()
    keep = [c for c in cols if var[c] and var[c] > 0]
    pairs = [(a, b) for i, a in enumerate(keep) for b in keep[i + 1:]]
    if not pairs:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, corr double")
    wide = flags.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    items = ", ".join(f"'{a}', '{b}', p{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {items}) AS (column_a, column_b, corr)")


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; (bin, lower, upper, n)."""
    r = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n bigint")
    width = (hi - lo) / bins if hi > lo else 1.0
    x = F.col(col)
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    return (df.filter(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
            .select("bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"),
                    (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("upper"), "n"))


def density_grid(df: DataFrame, col: str, gridsize: int = 64, cut: float = 3.0) -> DataFrame:
    """Gaussian KDE on a grid, Scott bandwidth h = std * n^(-1/5), grid from
    min - cut*h to max + cut*h. Exact: one pass with one partial sum per grid point."""
    x = F.col(col)
    r = df.agg(F.count(x).alias("n"), F.stddev_samp(x).alias("sd"), F.min(x).alias("lo"),
               F.max(x).alias("hi")).first()
    n, sd = r["n"], r["sd"]
    if not n or not sd:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = sd * n ** (-0.2)
    lo, hi = r["lo"] - cut * h, r["hi"] + cut * h
    step = (hi - lo) / (gridsize - 1)
    grid = [lo + i * step for i in range(gridsize)]
    wide = df.filter(x.isNotNull()).agg(
        *[F.sum(F.exp(F.lit(-0.5) * F.pow((F.lit(g) - x) / F.lit(h), 2))).alias(f"g{i}") for i, g in enumerate(grid)])
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    items = ", ".join(f"{i}, CAST({g!r} AS DOUBLE), g{i}" for i, g in enumerate(grid))
    return wide.selectExpr(f"stack({gridsize}, {items}) AS (point, x, s)").select(
        "point", "x", (F.col("s") * F.lit(norm)).alias("density"))


def box_summary(df: DataFrame, cols: Sequence[str] = (), value: str | None = None,
                by: str | None = None, k: float = 1.5, approx: bool = False) -> DataFrame:
    """Quartiles, whisker ends (extreme values inside the fences) and
    outlier count, per column or per group of ``by``. Two aggregations."""
    if by is not None:
        x = F.col(value)
        q = quartile_table(df.filter(F.col(by).isNotNull()), value, by, approx)
        fences = q.select(by, "n", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"),
                          F.col("q")[2].alias("q3"))
        fences = fences.withColumn("_lo", F.col("q1") - k * (F.col("q3") - F.col("q1"))) \
                       .withColumn("_hi", F.col("q3") + k * (F.col("q3") - F.col("q1")))
        # fences table is one row per group: broadcast only when the group count is bounded
        n_groups = fences.count()
        side = F.broadcast(fences) if n_groups <= 100_000 else fences
        j = df.select(by, value).join(side, by)
        inside = (x >= F.col("_lo")) & (x <= F.col("_hi"))
        return j.groupBy(by, "n", "q1", "median", "q3").agg(
            F.min(F.when(inside, x)).alias("whisker_low"), F.max(F.when(inside, x)).alias("whisker_high"),
            F.count_if(x.isNotNull() & ~inside).alias("n_outliers"))
    wide = {c: q for c, q in quartiles(df, cols, approx).items() if q}
    cols = [c for c in cols if c in wide]  # a column without values has no box
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, n bigint, q1 double, median double, q3 double, "
                                                   "whisker_low double, whisker_high double, n_outliers bigint")
    aggs = []
    for c in cols:
        q1, med, q3 = wide[c]
        lo, hi = q1 - k * (q3 - q1), q3 + k * (q3 - q1)
        x = F.col(c)
        inside = (x >= F.lit(lo)) & (x <= F.lit(hi))
        aggs += [F.min(F.when(inside, x)).alias(f"{c}__wl"), F.max(F.when(inside, x)).alias(f"{c}__wh"),
                 F.count_if(x.isNotNull() & ~inside).alias(f"{c}__no"), F.count(x).alias(f"{c}__n")]
    second = df.agg(*aggs)
    items = ", ".join(f"'{c}', `{c}__n`, CAST({wide[c][0]!r} AS DOUBLE), CAST({wide[c][1]!r} AS DOUBLE), "
                      f"CAST({wide[c][2]!r} AS DOUBLE), `{c}__wl`, `{c}__wh`, `{c}__no`" for c in cols)
    return second.selectExpr(f"stack({len(cols)}, {items}) AS (column_name, n, q1, median, q3, whisker_low, "
                             f"whisker_high, n_outliers)")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """X11: Pearson correlation for every ordered column pair (pairwise-complete rows)."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(*[F.corr(a, b).alias(f"p{i}") for i, (a, b) in enumerate(pairs)])
    items = ", ".join(f"'{a}', '{b}', p{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {items}) AS (column_a, column_b, corr)")


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per column (``approx`` uses HyperLogLog++)."""
    cols = list(cols or df.columns)
    if approx:
        wide = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        items = ", ".join(f"'{c}', `{c}`" for c in cols)
        return wide.selectExpr(f"stack({len(cols)}, {items}) AS (column_name, n_distinct)")
    counted = value_frequencies(df, cols).groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")  # a column without values has 0
    return names.join(counted, "column_name", "left").select("column_name", F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct"))


def value_frequencies(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n): how often each non-null value occurs in each column, as text.

    All columns share one pass and one shuffle of (column, value) pairs that are
    counted before it, so a hot value travels as one row a task and no row is
    copied for every column of a distinct count (-0.0 counts as 0.0)."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def text(c: str) -> Column:
        x = F.col(c)
        return (x + 0.0 if isinstance(kinds[c], (DoubleType, FloatType)) else x).cast("string")

    pairs = F.array(*[F.struct(F.lit(i).alias("c"), text(c).alias("value")) for i, c in enumerate(cols)])
    counts = df.select(F.inline(pairs)).filter("value IS NOT NULL").groupBy("c", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.array(*[F.lit(c) for c in cols])[F.col("c")].alias("column_name"), "value", "n")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """(value, n, proportion) ordered by n desc then value; nulls dropped."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return counts.select("value", "n", (F.col("n") / F.lit(total)).alias("proportion")).orderBy(F.desc("n"), "value")


def share_long(df: DataFrame, row: str, col: str) -> DataFrame:
    """X15 in long form: (row, col, n, share) of every pair that occurs, for any number of values on either side.

    Shares come from the rows' totals joined back, so no row's values meet in one task."""
    counts = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(F.col(row).alias("_row")).agg(F.sum("n").alias("_total"))
    return counts.join(totals, F.col(row).eqNullSafe(F.col("_row"))).select(row, col, "n", (F.col("n") / F.col("_total")).alias("share"))


def share_pivot(df: DataFrame, row: str, col: str, max_values: int = 1000) -> DataFrame:
    """Share of each ``col`` value within each ``row`` value, pivoted wide,
    missing -> 0. Counts are aggregated before the pivot."""
    counts = df.groupBy(row, col).agg(F.count(F.lit(1)).alias("n"))
    values = [r[0] for r in counts.select(col).distinct().orderBy(col).limit(max_values + 1).collect()]
    if len(values) > max_values:
        raise ValueError(f"too many pivot values in {col}")
    shares = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(row)))
    return shares.groupBy(row).pivot(col, values).agg(F.first("share")).fillna(0.0)


def prefix_before(df: DataFrame, order: Sequence[Column], weights: dict[str, str],
                  partitions: int | None = None) -> DataFrame:
    """Distributed exclusive prefix sums in ``order``: for each ``out: weight``.

    The (already reduced) rows are range-partitioned and checkpointed together
    with their range, since another evaluation of the partitioning would sample
    other bounds. Each range is totalled, the small totals table gives offsets,
    and a running sum is added per range. Only one row per range reaches the
    driver.
    """
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    ranged = materialize(df.repartitionByRange(n_parts, *order).withColumn("_pid", F.spark_partition_id()), "checkpoint")
    totals = sorted(ranged.groupBy("_pid").agg(*[F.sum(w).alias(out) for out, w in weights.items()]).collect())
    w = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = {}
    for out, weight in weights.items():
        offsets, run = {}, 0
        for t in totals:
            offsets[t["_pid"]] = run
            run += t[out]
        off = F.map_from_arrays(F.array(*[F.lit(p) for p in offsets]), F.array(*[F.lit(v) for v in offsets.values()]))[F.col("_pid")] \
            if offsets else F.lit(0)
        before[out] = (off + F.coalesce(F.sum(weight).over(w), F.lit(0))).cast("double")
    return ranged.withColumns(before).drop("_pid")


def kruskal_wallis(df: DataFrame, value: str, group: str, alpha: float = 0.05) -> DataFrame:
    """H with tie correction across groups of ``group``; p from chi-square."""
    base = df.filter(F.col(value).isNotNull() & F.col(group).isNotNull())
    vg = base.groupBy(value, group).agg(F.count(F.lit(1)).alias("c"))
    dv = vg.groupBy(value).agg(F.sum("c").alias("t"))
    ranked = prefix_before(dv, [F.col(value)], {"before": "t"}).withColumn("avg_rank", F.col("before") + (F.col("t") + 1) / 2.0)
    ties = ranked.agg(F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("tt"), F.sum("t").alias("n")).first()
    rg = vg.join(ranked.select(value, "avg_rank"), value).groupBy(group).agg(
        F.sum(F.col("c") * F.col("avg_rank")).alias("r"), F.sum("c").alias("ng"))
    s = rg.agg(F.sum(F.col("r") * F.col("r") / F.col("ng")).alias("s"), F.count(F.lit(1)).alias("k")).first()
    n, k = ties["n"] or 0, s["k"] or 0
    denom = 1.0 - ties["tt"] / (float(n) ** 3 - n) if n > 1 else 0.0
    if k < 2 or denom <= 0.0:  # one group, or every value tied: the statistic is undefined
        h = p = None
    else:
        h = (12.0 / (n * (n + 1)) * s["s"] - 3.0 * (n + 1)) / denom
        p = chi2_sf(h, k - 1)
    return df.sparkSession.createDataFrame(
        [(value, group, int(k), int(n), h, p, None if p is None else bool(p < alpha))],
        "value_column string, group_column string, k int, n bigint, h double, p_value double, significant boolean")


def top_n(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values (ties by value)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "value").limit(n))


def semi_filter_top_n(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """Rows whose ``col`` is among the top ``n`` values (a broadcast semi
    join: the right side holds at most ``n`` rows)."""
    top = top_n(df, col, n).select(F.col("value").alias(col))
    return df.join(F.broadcast(top), col, "left_semi")


def group_median_ranked(df: DataFrame, key: str, value: str, approx: bool = False) -> DataFrame:
    """Median of ``value`` per ``key`` ranked descending (ties by key)."""
    if approx:
        found = df.groupBy(key).agg(F.percentile_approx(F.col(value), 0.5, 10000).cast("double").alias("median_value"), F.count(F.lit(1)).alias("n"))
    else:
        middle = quantiles(df, [value], [0.5], [[key]], computed=True).select(F.col(key).alias("_key"), F.col("q")[0].alias("median_value"))
        rows = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        found = rows.join(middle, F.col(key).eqNullSafe(F.col("_key")), "left").select(key, "median_value", "n")
    return found.orderBy(F.desc("median_value"), key)


def pareto_coverage(df: DataFrame, col: str, threshold: float = 0.8) -> DataFrame:
    """Values sorted by share (desc, then value) with cumulative share and
    whether the threshold has been reached at that position."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    order = [F.desc("n"), F.col("value")]
    cum = prefix_before(counts.withColumn("one", F.lit(1)), order, {"rank_before": "one", "before": "n"})
    return cum.select((F.col("rank_before").cast("bigint") + 1).alias("position"), "value", "n",
                      (F.col("n") / F.lit(total)).alias("share"),
                      ((F.col("before") + F.col("n")) / F.lit(total)).alias("cum_share"),
                      ((F.col("before") + F.col("n")) / F.lit(total) >= F.lit(threshold)).alias("reached"))


def normality_k2(df: DataFrame, cols: Sequence[str], alpha: float = 0.05) -> DataFrame:
    """D'Agostino-Pearson K² per column; p = exp(-K²/2) (chi-square, 2 dof)."""
    r = df.agg(*[a for c in cols for a in (F.count(c).alias(f"{c}__n"), F.skewness(c).alias(f"{c}__s"),
                                           F.kurtosis(c).alias(f"{c}__k"))]).first()
    rows = []
    for c in cols:
        n, g1, ek = r[f"{c}__n"], r[f"{c}__s"], r[f"{c}__k"]
        k2, p = dagostino_k2(n, g1, ek) if n and n >= 8 and g1 is not None else (None, None)
        rows.append((c, n, g1, ek, k2, p, None if p is None else bool(p > alpha)))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, n bigint, skewness double, excess_kurtosis double, k2 double, "
              "p_value double, looks_normal boolean")


def head_rows(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows by ``key``."""
    return df.orderBy(key).limit(n)
