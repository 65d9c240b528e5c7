"""Vectorised work on the UTF-8 bytes of a text column inside Python workers.

Whole texts are processed in slices of at most ``SLICE_BYTES`` bytes (a single
longer text makes a slice of its own), so a worker's memory is bounded by the
longest text, not by the batch Spark hands over.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1_000_000
BATCH_BYTES = "8m"

# Odd multipliers of the polynomial and finalising hashes.
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)

#: Words ``[^\x20\x09-\x0D]+``: every byte but the ASCII white space.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z became a-z: digits, letters, all non-ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x41:0x5B] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

#: ASCII lower-casing as a byte table.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
SAME = np.arange(256, dtype=np.uint8)


def bound_batches(spark) -> None:
    """Limit the Arrow batches of this session's Python stages by bytes, so long texts don't add up."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mix (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_POW: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i mod 2^64 for i < n (cached, grown by doubling)."""
    have = _POW.get(int(base))
    if have is None or len(have[0]) < n:
        m = 1 << max(12, int(n - 1).bit_length())
        out = []
        for b in (int(base), _inverse(int(base))):
            a = np.full(m, b, dtype=np.uint64)
            a[0] = 1
            out.append(np.multiply.accumulate(a))
        _POW[int(base)] = have = (out[0], out[1])
    return have


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows (nulls are empty)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n, at = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1, offset=8 * at) if n else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Row ranges of the batch with at most SLICE_BYTES bytes of text (one row at least)."""
    if not batch.num_rows:
        return
    _, offsets = flat(batch.column(batch.schema.names.index(column)))
    i = 0
    while i < batch.num_rows:
        j = int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, side="right")) - 1
        j = min(max(j, i + 1), batch.num_rows)
        yield batch.slice(i, j - i)
        i = j


@dataclass
class Words:
    """Words of consecutive texts: byte ranges, 64-bit hashes, and the first word of each text."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # words [first[i], first[i + 1]) belong to text i

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words_of(column: pa.Array, alphabet: np.ndarray = NON_SPACE, fold: np.ndarray = SAME) -> Words:
    data, offsets = flat(column)
    data = fold[data]
    inside = alphabet[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.zeros(len(data), dtype=bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), dtype=bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Words(data, offsets, start, end, Spans(data).hash(start, end), np.searchsorted(start, offsets))


class Spans:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(_P, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _Q)


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive values (the caller drops runs that cross texts)."""
    if len(h) < size:
        return np.zeros(0, dtype=np.uint64)
    up, down = powers(_Q, len(h) + 1)
    sums = np.zeros(len(h) + 1, dtype=np.uint64)
    np.cumsum(h * up[:len(h)], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[:len(h) - size + 1])


def inside_one_text(first: np.ndarray, size: int) -> np.ndarray:
    """Start indices of the runs of ``size`` words that lie in one text, in order."""
    n = int(first[-1])
    if n < size:
        return np.zeros(0, dtype=np.int64)
    last = np.repeat(first[1:], np.diff(first))  # end of the word's own text
    at = np.arange(n)
    return at[at + size <= last]


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Boolean mask over n places: covered by a run [s, s + size) of some start s."""
    step = np.zeros(n + 1, dtype=np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + size, n), -1)
    return np.cumsum(step[:n]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal true runs."""
    padded = np.concatenate(([False], mask, [False]))
    change = np.flatnonzero(padded[1:] != padded[:-1])
    return change[::2], change[1::2]
