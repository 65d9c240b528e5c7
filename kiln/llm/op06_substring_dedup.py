"""Exact repeated word passages by fixed-block anchors.

1. Every text is cut into non-overlapping reference blocks of ``window // 2``
   words, and every rolling window of that size probes the block index. A
   passage of ``window`` words shared by two documents contains a whole block
   of either, so a block whose hash occurs in another document is an anchor of
   every such passage, and passages without an anchor cannot repeat.
2. Around its anchors a document's hits are extended: all windows of
   ``window`` words that contain an anchor are compared, by hash, with those
   of all other documents; a window that also starts in a document with a
   smaller id is removed. Runs of removed words are the maximal exact repeats.

Blocks and probes, and later the extended windows, are exchanged as packed
rows (see ``packed``), bucketed by hash: groups of copies are handled per
distinct window with its smallest document, never as pairs of documents.

Windows are judged on the input, not on what is left. Defined results: null or
wordless texts have no words; rows with a null id neither remove nor lose
words; rows with equal ids don't remove each other's words; extra columns are
not touched; ids that are not integers are compared in their own order and given
back as they are. Hashes are 64-bit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import col, numbered, stored, with_ids, with_numbers
from kiln.llm.packed import SCHEMA, Packer, answers, bucket_bits, by_id, key_of, unpack, whole_key
from kiln.llm.textbytes import Words, bound_batches, covered, inside_one_text, runs, slices, window_hashes, words_of

#: Bytes of a probe's hash that travel beside its bucket: enough to find anchors, as false ones are dropped later.
PROBE_BYTES = 4


def _windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    at = inside_one_text(w.first, size)
    return at, (window_hashes(w.hash, size)[at] if len(at) else np.zeros(0, np.uint64))


def anchors(texts: DataFrame, block: int, bits: int) -> DataFrame:
    """(id, keys): hashes of rolling windows that equal a reference block and occur in several documents."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(bits, PROBE_BYTES)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            done = 0
            for part in slices(batch):
                w = words_of(part.column(1))
                at, h = _windows(w, block)
                text = w.text[at]
                is_block = (at - w.first[text]) % block == 0
                yield from packer.add(h, ids[done:done + part.num_rows][text], is_block)
                done += part.num_rows
        yield from packer.flush()

    def match(group: pa.Table) -> pa.Table:
        keys, ids, is_block = unpack(group, PROBE_BYTES)
        index, where = np.unique(keys[is_block], return_inverse=True)
        smallest = np.full(len(index), np.iinfo(np.int64).max)
        np.minimum.at(smallest, where, ids[is_block])
        at = np.searchsorted(index, keys).clip(0, max(0, len(index) - 1))
        hit = index[at] == keys if len(index) else np.zeros(len(keys), bool)
        at, ids = at[hit], ids[hit]
        largest = np.full(len(index), np.iinfo(np.int64).min)
        np.maximum.at(largest, at, ids)
        live = (largest > smallest)[at] if len(index) else hit[:0]
        bucket = group.column("bucket")[0].as_py()
        return answers(ids[live], whole_key(bucket, index[at[live]], bits, PROBE_BYTES), bits)

    packed = texts.filter("id is not null").mapInArrow(probe, SCHEMA)
    return by_id(packed.groupBy("bucket").applyInArrow(match, SCHEMA), "keys")


def repeated_windows(texts: DataFrame, found: DataFrame, window: int, bits: int) -> DataFrame:
    """(id, windows): hashes of the document's windows that also start in a document with a smaller id."""
    block = window // 2

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(bits, 8)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            done = 0
            for part in slices(batch):
                w = words_of(part.column(1))
                at, h = _windows(w, block)
                text = w.text[at]
                keys = key_of(h, bits, PROBE_BYTES)
                anchored = np.zeros(len(w.start), bool)
                low = np.searchsorted(at, w.first)
                for i, live in enumerate(part.column(2)):
                    a, b = low[i], low[i + 1]
                    anchored[at[a:b][np.isin(keys[a:b], live.values.to_numpy().view(np.uint64))]] = True
                starts, h = _windows(w, window)
                # windows that start at most window - block words before an anchor hold it
                reach = np.concatenate(([0], np.cumsum(anchored)))
                holds = reach[starts + window - block + 1] > reach[starts]
                starts, h = starts[holds], h[holds]
                yield from packer.add(h, ids[done:done + part.num_rows][w.text[starts]])
                done += part.num_rows
        yield from packer.flush()

    def judge(group: pa.Table) -> pa.Table:
        keys, ids, _ = unpack(group, 8)
        index, where = np.unique(keys, return_inverse=True)
        smallest = np.full(len(index), np.iinfo(np.int64).max)
        np.minimum.at(smallest, where, ids)
        again = ids > smallest[where]
        return answers(ids[again], whole_key(group.column("bucket")[0].as_py(), keys[again], bits, 8), bits)

    packed = texts.join(found, "id").select("id", "text", "keys").mapInArrow(extend, SCHEMA)
    return by_id(packed.groupBy("bucket").applyInArrow(judge, SCHEMA), "windows")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50,
            keep_text: bool = True) -> DataFrame:
    """Per row: id, n_words, n_removed, spans (flat word ranges of the maximal
    repeats), kept_sha256 and, if asked for, kept_text (words joined by one space)."""
    numbers = numbered(docs, id_col)
    if numbers is not None:
        return with_ids(repeats(with_numbers(docs, numbers, id_col, text_col), "id", "text", window, keep_text), numbers, "id")
    bound_batches(docs.sparkSession)
    texts = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    bits = bucket_bits(texts, "text")
    found = stored(anchors(texts, window // 2, bits))
    removed = stored(repeated_windows(texts, found, window, bits))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                w = words_of(part.column(1))
                starts, h = _windows(w, window)
                low = np.searchsorted(starts, w.first)
                n = np.diff(w.first)
                gone, spans, digest, texts = np.zeros(len(n), np.int64), [], [], []
                raw = w.data.tobytes()
                for i, windows in enumerate(part.column(2)):
                    words = slice(w.first[i], w.first[i + 1])
                    mask = np.zeros(n[i], bool)
                    if windows.is_valid:
                        a, b = low[i], low[i + 1]
                        own = np.isin(h[a:b], windows.values.to_numpy().view(np.uint64))
                        mask = covered(starts[a:b][own] - w.first[i], window, int(n[i]))
                    gone[i] = mask.sum()
                    spans.append(np.stack(runs(mask), axis=1).ravel() if gone[i] else [])
                    left = [raw[s:e] for s, e in zip(w.start[words][~mask].tolist(), w.end[words][~mask].tolist())]
                    left = b" ".join(left)
                    digest.append(hashlib.sha256(left).hexdigest())
                    if keep_text:
                        texts.append(left)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n.astype(np.int64)), pa.array(gone),
                     pa.array(spans, pa.list_(pa.int64())), pa.array(digest, pa.string()),
                     pa.array(texts if keep_text else [None] * len(n), pa.binary()).cast(pa.string())],
                    ["id", "n_words", "n_removed", "spans", "kept_sha256", "kept_text"])

    return texts.join(removed, "id", "left").select("id", "text", "windows").mapInArrow(
        cut, "id long, n_words long, n_removed long, spans array<long>, kept_sha256 string, kept_text string")


def report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Digest per document: doc_id, n_words, n_removed, kept_sha256."""
    return repeats(docs, id_col, keep_text=False, **options).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")
