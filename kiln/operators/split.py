"""Deterministic hash splits and fold assignment.

A row's position is ``h = first 8 hex digits of md5(key)`` as an unsigned
32-bit integer. It depends only on the key, so splits are stable across
partitionings, re-runs and engines (``randomSplit`` is not).

The exact-size split orders rows by (h, key, digest of the whole row, copy
number) and finds the row at which the test part reaches ``ceil(n * ratio)``
rows with radix selects (12-bit digits, each pass collecting at most 4 096
counts to the driver) instead of a global sort. The digest is only computed
when the cut falls among rows of one key. Rows that agree in everything are
interchangeable: if the cut falls among them, only their number matters. A null
key gives no position, so the row's digest stands in for it; null keys of equal
``h`` come after the others.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

HASH_BITS = 32
DIGIT_BITS = 12
DIGEST_BITS = 63
#: Copies of one row that a task writes when the cut falls among them.
COPIES_PER_ROW = 10_000


def hash32(key: Column) -> Column:
    """Unsigned 32-bit position from md5 of the key's string form."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")


def hash_bucket(key: Column, k: int) -> Column:
    """Fold / bucket id in [0, k)."""
    return (hash32(key) % F.lit(k)).cast("int")


def hash_split(df: DataFrame, key: str, ratio: float, col: str = "split") -> DataFrame:
    """P1 (scalable): ``test`` where h < ratio * 2^32; size is ratio * n in expectation."""
    cut = int(ratio * (1 << HASH_BITS))
    return df.withColumn(col, F.when(hash32(F.col(key)) < F.lit(cut), F.lit("test")).otherwise(F.lit("train")))


def _unhashable(t: DataType) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return True
    if isinstance(t, ArrayType):
        return _unhashable(t.elementType)
    return isinstance(t, StructType) and any(_unhashable(f.dataType) for f in t.fields)


def row_digests(df: DataFrame, columns: Sequence[str]) -> tuple[Column, Column]:
    """Two hashes of 63 bits over all values of a row, by column position; which values are null counts too."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    values = [F.to_json(F.struct(F.col(c))) if _unhashable(kinds[c]) else F.col(c) for c in columns]
    nulls = F.concat(F.lit(""), *[F.col(c).isNull().cast("int").cast("string") for c in columns])
    keep = F.lit((1 << DIGEST_BITS) - 1)
    return F.xxhash64(nulls, *values).bitwiseAND(keep), F.xxhash64(F.lit(1), *values, nulls).bitwiseAND(keep)


@dataclass
class ExactSplitPoint:
    """The test part is every row up to the cut in the order (h, key, digest, copy).

    ``copies`` is set if the cut falls among rows that agree in everything: (their number, how many are test rows).
    """

    n: int
    n_test: int
    h_star: int | None
    key_star: object = None
    digest_star: tuple[int, int] | None = None
    copies: tuple[int, int] | None = None
    null_keys: bool = False


def _select(values: DataFrame, name: str, bits: int, need: int) -> tuple[int, int, int]:
    """The value (below 2^bits) of the ``need``-th smallest row, how many rows up to it are needed and how many have it."""
    prefix, within, count, low = 0, F.lit(True), 0, bits
    while low > 0:
        width = min(DIGIT_BITS, low)
        low -= width
        digit = F.shiftright(F.col(name), low).bitwiseAND(F.lit((1 << width) - 1))
        for d, count in sorted(tuple(r) for r in values.filter(within).groupBy(digit.alias("d")).count().collect()):
            if need <= count:
                prefix |= d << low
                break
            need -= count
        within = F.shiftright(F.col(name), low) == F.lit(prefix >> low)
    return prefix, need, count


def _nth(counts: Sequence[tuple], need: int) -> tuple[object, int, int]:
    """The value at which running counts reach ``need``, what is needed of it, and its count."""
    for value, count in counts:
        if need <= count:
            return value, need, count
        need -= count
    raise ValueError("fewer rows than needed")


def _position(df: DataFrame, key: str, null_keys: bool) -> Column:
    """h; a row without a key takes it from its digest."""
    k = F.col(key).cast("string")
    return hash32(F.coalesce(k, row_digests(df, df.columns)[0].cast("string")) if null_keys else k)


def exact_split_point(df: DataFrame, key: str, ratio: float) -> ExactSplitPoint:
    n, n_keys = df.agg(F.count(F.lit(1)), F.count(key)).first()
    n_test, null_keys = math.ceil(n * ratio), n_keys < n
    if n_test == 0:
        return ExactSplitPoint(n, 0, None)
    # (hash, key) only: the passes below re-read 16 bytes per row, not the input
    hashed = df.select(_position(df, key, null_keys).alias("_h"), F.col(key).alias("_k")).persist(StorageLevel.MEMORY_AND_DISK)
    h_star, need, _ = _select(hashed, "_h", HASH_BITS, n_test)
    # one row for each of the keys that share 32 bits of md5: some hundreds for 10^12 keys
    tied = hashed.filter(F.col("_h") == h_star).groupBy("_k").count().orderBy(F.asc_nulls_last("_k")).collect()
    hashed.unpersist()
    key_star, need, count = _nth(tied, need)
    point = ExactSplitPoint(n, n_test, h_star, key_star, null_keys=null_keys)
    if need == count:
        return point
    first, second = row_digests(df, df.columns)
    mine = (df.filter((_position(df, key, null_keys) == h_star) & F.col(key).eqNullSafe(F.lit(key_star)))
            .select(first.alias("_d"), second.alias("_e")).persist(StorageLevel.MEMORY_AND_DISK))
    d_star, need, _ = _select(mine, "_d", DIGEST_BITS, need)
    same = mine.filter(F.col("_d") == d_star).groupBy("_e").count().orderBy("_e").collect()  # a row, but for collisions of 63 bits
    mine.unpersist()
    e_star, need, count = _nth(same, need)
    point.digest_star = (d_star, e_star)
    point.copies = (count, need) if need < count else None
    return point


def exact_split(df: DataFrame, key: str, ratio: float, col: str = "split") -> DataFrame:
    """P1 (exact size): test has exactly ceil(n * ratio) rows, chosen by hash order, whatever the keys."""
    p = exact_split_point(df, key, ratio)
    if p.h_star is None:
        return df.withColumn(col, F.lit("train"))
    h, k = _position(df, key, p.null_keys), F.col(key)
    at_key = k.eqNullSafe(F.lit(p.key_star))
    before_key = k.isNotNull() if p.key_star is None else k < F.lit(p.key_star)
    part = lambda test: F.when(test, F.lit("test")).otherwise(F.lit("train"))
    if p.digest_star is None:
        up_to, cut_rows = at_key, None
    else:
        d, e = row_digests(df, df.columns)
        d_star, e_star = p.digest_star
        up_to = at_key & ((d < d_star) | ((d == d_star) & (e <= e_star)))
        cut_rows = (h == p.h_star) & at_key & (d == d_star) & (e == e_star)
    is_test = F.coalesce((h < F.lit(p.h_star)) | ((h == F.lit(p.h_star)) & (before_key | up_to)), F.lit(False))
    if p.copies is None:
        return df.withColumn(col, part(is_test))
    # the cut falls among equal rows: one of them is written as often as they occur, so nothing has to number them
    count, need = p.copies
    pieces = df.filter(cut_rows).limit(1).withColumn("_piece", F.explode(F.sequence(F.lit(0), F.lit((count - 1) // COPIES_PER_ROW))))
    start = F.col("_piece") * COPIES_PER_ROW
    copies = (pieces.repartition(F.col("_piece"))
              .withColumn("_copy", F.explode(F.sequence(start, F.least(start + COPIES_PER_ROW, F.lit(count)) - 1)))
              .withColumn(col, part(F.col("_copy") < need)).drop("_piece", "_copy"))
    return df.filter(~F.coalesce(cut_rows, F.lit(False))).withColumn(col, part(is_test)).unionByName(copies)


def kfold(df: DataFrame, key: str, k: int = 5, col: str = "fold") -> DataFrame:
    """fold = h mod k."""
    return df.withColumn(col, hash_bucket(F.col(key), k))


def feature_target(df: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(features without the target, the target alone), by name."""
    return df.drop(target), df.select(target)
