"""E1 without a bound on categories: one-hot rows as positions and values.

The category index is a table, not a list on the driver: the distinct (column,
value) pairs, ordered by column and value (nulls last), are numbered by a
distributed prefix sum. A column's first category has no position
(``drop_first``), as in the dense form, and unseen categories have none either.
Transforming joins each column to its part of the index; small parts are
broadcast, large ones shuffle, where adaptive execution splits hot values. The
position of the missing category is known to every task: missing values are
spread over the tasks of the join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.base import Estimator, Model, ParamTable
from kiln.operators.profile import prefix_before


@dataclass
class SparseOneHotEncoder(Estimator):
    """Positions count from 0 through all columns in their given order."""

    columns: Sequence[str]
    drop_first: bool = True

    def fit(self, df: DataFrame) -> "SparseOneHotModel":
        cols = list(self.columns)
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise ValueError(f"one-hot columns missing: {missing}")
        kinds = {f.name: f.dataType for f in df.schema.fields}
        entry = [F.struct(F.lit(i).alias("c"), F.col(c).isNull().alias("missing"),
                          *[(F.col(c) if i == j else F.lit(None).cast(kinds[d])).alias(f"v{j}") for j, d in enumerate(cols)])
                 for i, c in enumerate(cols)]
        order = ["c", "missing", *[f"v{j}" for j in range(len(cols))]]
        found = df.select(F.inline(F.array(*entry))).distinct().withColumn("one", F.lit(1))
        ranked = prefix_before(found, [F.col(x) for x in order], {"rank": "one"}).drop("one").withColumn("rank", F.col("rank").cast("long"))
        sizes = {r["c"]: r["n"] for r in ranked.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a column
        starts, dropped, start = [], [], 0
        for i in range(len(cols)):
            starts.append(start)
            dropped.append(int(self.drop_first and sizes.get(i, 0) > 0))
            start += sizes.get(i, 0)
        # of every column up to a row's own, one position less if its first category is dropped
        less = F.array(*[F.lit(sum(dropped[:i + 1])) for i in range(len(cols))])[F.col("c")]
        first = F.col("rank") == F.array(*[F.lit(s).cast("long") for s in starts])[F.col("c")]
        index = ranked.withColumn("position", F.col("rank") - less)
        if self.drop_first:
            index = index.filter(~first)
        table = ParamTable(index.drop("rank"), ["c"])
        nulls = {r["c"]: r["position"] for r in table.df.filter("missing").select("c", "position").collect()}  # at most a row a column
        return SparseOneHotModel(cols, start - sum(dropped), table, [sizes.get(i, 0) for i in range(len(cols))],
                                 [nulls.get(i) for i in range(len(cols))])


@dataclass
class SparseOneHotModel(Model):
    columns: list
    size: int
    index: ParamTable
    counts: list  # categories of each column
    nulls: list  # position of each column's missing category, if it has one

    def transform(self, df: DataFrame, into: str = "features") -> DataFrame:
        """Sources dropped; ``into``: struct of size, positions (ascending) and values, as a sparse vector holds them."""
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise ValueError(f"one-hot columns missing: {missing}")
        kept = [F.col(c) for c in df.columns if c not in self.columns]
        row = df.select(F.struct(*kept).alias("_kept"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(self.columns)]) \
            if kept else df.select(*[F.col(c).alias(f"_v{i}") for i, c in enumerate(self.columns)])
        for i in range(len(self.columns)):
            v, k = F.col(f"_v{i}"), F.col(f"_k{i}")
            part = self.index.df.filter((F.col("c") == i) & ~F.col("missing")).select(F.col(f"v{i}").alias(f"_k{i}"), F.col("position").alias(f"_f{i}"))
            if self.counts[i] <= ParamTable.COLLECT_MAX_ROWS:
                row = row.join(F.broadcast(part), v == k, "left")
            else:  # rows without a value find nothing; a number of their own keeps them from meeting in one task
                row = row.withColumn("_s", F.when(v.isNull(), F.monotonically_increasing_id()).otherwise(F.xxhash64(v)))
                row = row.join(part.withColumn("_t", F.xxhash64(k)), (v == k) & (F.col("_s") == F.col("_t")), "left").drop("_s", "_t")
            own = F.when(v.isNull(), F.lit(self.nulls[i]).cast("long")).otherwise(F.col(f"_f{i}"))
            row = row.withColumn(f"_p{i}", own).drop(f"_k{i}", f"_f{i}")
        positions = F.array_compact(F.array(*[F.col(f"_p{i}") for i in range(len(self.columns))]))
        features = F.struct(F.lit(self.size).cast("long").alias("size"), positions.alias("positions"),
                            F.transform(positions, lambda _: F.lit(1.0)).alias("values")).alias(into)
        return row.select(*([F.col("_kept.*")] if kept else []), features)

    def names(self) -> DataFrame:
        """(position, column_name, category as text; null for the missing category)."""
        value = F.coalesce(*[F.col(f"v{i}").cast("string") for i in range(len(self.columns))])
        return self.index.df.select("position", F.array(*[F.lit(c) for c in self.columns])[F.col("c")].alias("column_name"), value.alias("category"))
