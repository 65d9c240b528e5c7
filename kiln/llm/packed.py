"""Compact exchange of (key, document) pairs: one shuffled row holds many pairs.

A 64-bit key goes to the bucket its top bits name; within a row the pairs are
in document order, the document ids are stored once as differences with a
count each, and only the key bytes that are needed travel. The rows are
ordinary shuffle rows: Spark deals them out with ``groupBy("bucket")`` and each
bucket is sized by the caller to a fixed number of pairs on average.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.textbytes import mix

SCHEMA = "bucket int, ids binary, counts binary, keys binary, flags binary"
#: Pairs that a task collects before it emits rows.
FLUSH = 2_000_000


def bucket_bits(texts: DataFrame, text_col: str, bytes_per_bucket: int = 16_000_000) -> int:
    """So many bits of buckets that one holds the pairs of about ``bytes_per_bucket`` bytes of text."""
    total = texts.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return min(20, max(3, int(total // bytes_per_bucket).bit_length()))


class Packer:
    """Collects pairs and turns them into rows, one for each bucket touched."""

    def __init__(self, bits: int, key_bytes: int):
        self.bits, self.key_bytes = bits, key_bytes
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, keys: np.ndarray, ids: np.ndarray, flags: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        self.parts.append((keys, ids, np.zeros(len(keys), bool) if flags is None else flags))
        self.n += len(keys)
        if self.n >= FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        keys, ids, flags = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.n = [], 0
        bucket = (keys >> np.uint64(64 - self.bits)).astype(np.uint16 if self.bits <= 16 else np.uint32)
        order = np.argsort(bucket, kind="stable")
        bucket, ids, flags = bucket[order], ids[order], flags[order]
        low = ((keys[order] << np.uint64(self.bits)) >> np.uint64(64 - 8 * self.key_bytes))
        low = low.view(np.uint8).reshape(-1, 8)[:, :self.key_bytes]
        edges = np.append(np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))), len(bucket))
        out: dict[str, list] = {"bucket": [], "ids": [], "counts": [], "keys": [], "flags": []}
        for a, b in zip(edges[:-1], edges[1:]):
            new = np.flatnonzero(np.concatenate(([True], ids[a + 1:b] != ids[a:b - 1])))
            out["bucket"].append(int(bucket[a]))
            out["ids"].append(np.diff(ids[a:b][new], prepend=0).astype(np.int64).tobytes())
            out["counts"].append(np.diff(np.append(new, b - a)).astype(np.uint32).tobytes())
            out["keys"].append(np.ascontiguousarray(low[a:b]).tobytes())
            out["flags"].append(np.packbits(flags[a:b]).tobytes() if flags[a:b].any() else b"")
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["bucket"], pa.int32())] + [pa.array(out[c], pa.binary()) for c in ("ids", "counts", "keys", "flags")],
            ["bucket", "ids", "counts", "keys", "flags"])


def unpack(group: pa.Table, key_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys (below the bucket bits), ids and flags of a bucket's rows."""
    keys, ids, flags = [], [], []
    for row in zip(*(group.column(c).to_pylist() for c in ("ids", "counts", "keys", "flags"))):
        raw = np.frombuffer(row[2], np.uint8).reshape(-1, key_bytes)
        wide = np.zeros((len(raw), 8), np.uint8)
        wide[:, :key_bytes] = raw
        keys.append(wide.view(np.uint64).ravel())
        ids.append(np.repeat(np.cumsum(np.frombuffer(row[0], np.int64)), np.frombuffer(row[1], np.uint32)))
        flags.append(np.unpackbits(np.frombuffer(row[3], np.uint8), count=len(raw)).astype(bool) if row[3]
                     else np.zeros(len(raw), bool))
    return np.concatenate(keys), np.concatenate(ids), np.concatenate(flags)


def key_of(h: np.ndarray, bits: int, key_bytes: int) -> np.ndarray:
    """Bucket and kept key bytes of a hash as one number: what ``answers`` lists."""
    return h >> np.uint64(max(0, 64 - bits - 8 * key_bytes))


def whole_key(bucket: int, keys: np.ndarray, bits: int, key_bytes: int) -> np.ndarray:
    """The same number from a bucket and its keys."""
    width = min(64 - bits, 8 * key_bytes)
    return (np.uint64(bucket) << np.uint64(width)) | (keys >> np.uint64(8 * key_bytes - width))


def answers(ids: np.ndarray, keys: np.ndarray, bits: int) -> pa.Table:
    """Packed rows of (id, key) answers, dealt out by a hash of the id: a row for each
    id bucket touched, not for each id."""
    route = (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
    order = np.lexsort((keys, ids, route))
    ids, keys, route = ids[order], keys[order], route[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    ids, keys, route = ids[new], keys[new], route[new]
    edges = np.append(np.flatnonzero(np.concatenate(([True], route[1:] != route[:-1]))), len(route)) if len(ids) else [0]
    out: dict[str, list] = {"bucket": [], "ids": [], "counts": [], "keys": [], "flags": []}
    for a, b in zip(edges[:-1], edges[1:]):
        first = np.flatnonzero(np.concatenate(([True], ids[a + 1:b] != ids[a:b - 1])))
        out["bucket"].append(int(route[a]))
        out["ids"].append(np.diff(ids[a:b][first], prepend=0).astype(np.int64).tobytes())
        out["counts"].append(np.diff(np.append(first, b - a)).astype(np.uint32).tobytes())
        out["keys"].append(keys[a:b].tobytes())
        out["flags"].append(b"")
    return pa.table({"bucket": pa.array(out["bucket"], pa.int32())} | {
        c: pa.array(out[c], pa.binary()) for c in ("ids", "counts", "keys", "flags")})


def by_id(answered: DataFrame, name: str) -> DataFrame:
    """(id, ``name``): all keys of each id from packed answers."""

    def gather(group: pa.Table) -> pa.Table:
        keys, ids, _ = unpack(group, 8)
        order = np.argsort(ids, kind="stable")
        keys, ids = keys[order], ids[order]
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        return pa.table({"id": pa.array(ids[first], pa.int64()), name: pa.ListArray.from_arrays(
            pa.array(np.append(first, len(ids)).astype(np.int32)), pa.array(keys.view(np.int64)))})

    return answered.groupBy("bucket").applyInArrow(gather, f"id long, {name} array<long>")
