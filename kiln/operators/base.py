"""Fit/transform protocol shared by every operator, plus size-checked lookups.

``Estimator.fit(df)`` runs aggregation jobs and returns a ``Model``;
``Model.transform(df)`` is lazy (projections and lookup joins only).
Fitted state is literals or small parameter DataFrames whose row count is
checked before they are broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

# Parameter tables at or below this many rows are broadcast to every task;
# larger ones use a shuffle join (AQE may still re-plan and split skew).
MAX_BROADCAST_ROWS = 1_000_000


class Model:
    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError


class Estimator:
    def fit(self, df: DataFrame) -> Model:  # pragma: no cover - interface
        raise NotImplementedError

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


class Transformer(Estimator, Model):
    """Stateless step: ``fit`` returns itself."""

    def fit(self, df: DataFrame) -> "Transformer":
        return self


class ParamTable:
    """A fitted lookup table with a known row count.

    Fitting collects at most ``COLLECT_MAX_ROWS + 1`` rows in one job: a table
    that fits is kept as driver-side rows (a local relation, broadcast without
    recomputation), and at most ``INLINE_MAX_ROWS`` rows are folded into the
    projection as literal maps (no join stage at all). A larger table stays
    distributed (persisted, counted) and is broadcast up to
    ``max_broadcast_rows`` or shuffle-joined beyond (AQE may split skew).
    """

    INLINE_MAX_ROWS = 64
    COLLECT_MAX_ROWS = 10_000

    def __init__(self, df: DataFrame, keys: Sequence[str], rows: list | None = None):
        self.keys = list(keys)
        if rows is None:
            df = df.persist(StorageLevel.MEMORY_AND_DISK)
            head = df.limit(self.COLLECT_MAX_ROWS + 1).collect()
            if len(head) <= self.COLLECT_MAX_ROWS:
                df.unpersist()
                rows = head
        if rows is not None:
            names = df.columns
            self.local = [r if isinstance(r, Row) else Row(**dict(zip(names, r))) for r in rows]
            self.rows = len(self.local)
            self.df = df.sparkSession.createDataFrame(self.local, df.schema)
        else:
            self.local = None
            self.df = df
            self.rows = df.count()
        self.inline = self.local if self.rows <= self.INLINE_MAX_ROWS else None

    @classmethod
    def from_rows(cls, spark, rows: list, schema, keys: Sequence[str]) -> "ParamTable":
        """A table whose (size-checked) rows are already on the driver."""
        return cls(spark.createDataFrame(rows, schema), keys, rows=rows)

    @property
    def value_columns(self) -> list[str]:
        return [c for c in self.df.columns if c not in self.keys]

    def _inline_lookup(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in self.df.schema.fields}
        if len(self.keys) == 1:
            k = self.keys[0]
            key_arr = F.array(*[F.lit(r[k]).cast(types[k]) for r in self.inline])
            probe = F.col(k)
        else:
            key_arr = F.array(*[F.struct(*[F.lit(r[k]).cast(types[k]).alias(k) for k in self.keys])
                                for r in self.inline])
            probe = F.struct(*[F.col(k).alias(k) for k in self.keys])
        new = []
        for v in self.value_columns:
            vals = F.array(*[F.lit(r[v]).cast(types[v]) for r in self.inline])
            if not self.inline:
                new.append(F.lit(None).cast(types[v]).alias(v))
            else:
                new.append(F.map_from_arrays(key_arr, vals)[probe].alias(v))
        return df.select("*", *new)

    def lookup(self, df: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
        """Left-lookup the parameters onto ``df`` by key (null keys find nothing)."""
        if self.inline is not None:
            return self._inline_lookup(df)
        side = F.broadcast(self.df) if self.rows <= max_broadcast_rows else self.df
        return df.join(side, on=self.keys, how="left")

    def renamed(self, mapping: dict) -> "ParamTable":
        """The same table with value columns renamed (no job, no recount)."""
        t = ParamTable.__new__(ParamTable)
        df = self.df
        for a, b in mapping.items():
            df = df.withColumnRenamed(a, b)
        t.df, t.keys, t.rows = df, self.keys, self.rows
        t.local = None if self.local is None else [_rename_row(r, mapping) for r in self.local]
        t.inline = None if self.inline is None else [_rename_row(r, mapping) for r in self.inline]
        return t

    def unpersist(self) -> None:
        self.df.unpersist()


def _rename_row(r, mapping):
    from pyspark.sql import Row
    d = r.asDict()
    return Row(**{mapping.get(k, k): v for k, v in d.items()})


def present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The subset of ``cols`` that exist in ``df`` (in the given order)."""
    have = set(df.columns)
    return [c for c in cols if c in have]


def replace_columns(df: DataFrame, new: dict, drop: Sequence[str] = ()) -> DataFrame:
    """One projection: keep column order, replace in place, append new, drop listed."""
    drop_set = set(drop)
    out = []
    for c in df.columns:
        if c in drop_set:
            continue
        out.append(new[c].alias(c) if c in new else F.col(c))
    have = set(df.columns)
    out += [e.alias(n) for n, e in new.items() if n not in have and n not in drop_set]
    return df.select(*out)


class Chain(Estimator):
    """Ordered steps with sequential fit: each step is fitted on the output of
    the previous fitted steps (I7 semantics). ``materialize`` cuts lineage of
    the intermediate frame once per fit when steps need several passes."""

    def __init__(self, steps: Sequence[Estimator], materialize: str = "auto"):
        self.steps = list(steps)
        self.materialize = materialize

    def fit(self, df: DataFrame) -> "ChainModel":
        from kiln.session import materialize

        cur = materialize(df, self.materialize)
        models = []
        for step in self.steps:
            m = step.fit(cur)
            models.append(m)
            cur = m.transform(cur)
        return ChainModel(list(models))


@dataclass
class ChainModel(Model):
    models: list

    def transform(self, df: DataFrame) -> DataFrame:
        for m in self.models:
            df = m.transform(df)
        return df
