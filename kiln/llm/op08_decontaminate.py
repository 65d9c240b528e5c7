"""Benchmark decontamination by a prefix-filtered join and exact verification.

Every window of ``window`` consecutive item words (a shorter item is one
window) is searched for in every document. The words of a window are ordered
by rarity in the corpus; full containment needs a prefix of one word, the
rarest. Document words are joined with those prefix words only, each match
fixes where the window would have to start (positional bound) and whether it
fits into the text (length bound), and the rest of the window is compared
word by word.

The item side is a stated query set: it is read in blocks of at most about
``block_bytes`` bytes of item text, each block's index goes to every task, and
all documents pass through one block after the other without a shuffle. Word
counts for the rarity order cover all documents.

Defined results: a null or wordless text has no words and no hits; items
without words have no window; an item with a null id marks words but is not
listed; repeated rows are judged one by one; columns beside the text are
carried inside a struct, so their names may clash with anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.frames import col, packed, stored, unpacked
from kiln.llm.textbytes import ALNUM, LOWER, bound_batches, covered, runs, slices, words_of

#: Candidate windows compared at once in a task.
CHUNK = 500_000


class ItemIndex:
    """Windows of one block of items: word hashes in rows, item and length of each."""

    def __init__(self, ids: list, texts: list, window: int):
        w = words_of(pa.array(texts, pa.string()), ALNUM, LOWER)
        rows, lengths, owner = [], [], []
        for i in range(len(texts)):
            a, b = int(w.first[i]), int(w.first[i + 1])
            if a == b:
                continue
            n = min(window, b - a)
            at = np.arange(a, b - n + 1)[:, None] + np.arange(n)
            tokens = np.zeros((len(at), window), dtype=np.uint64)
            tokens[:, :n] = w.hash[at]
            rows.append(tokens)
            lengths.append(np.full(len(at), n))
            owner.append(np.full(len(at), i))
        self.ids = ids
        self.tokens = np.concatenate(rows) if rows else np.zeros((0, window), np.uint64)
        self.lengths = np.concatenate(lengths) if rows else np.zeros(0, np.int64)
        self.owner = np.concatenate(owner) if rows else np.zeros(0, np.int64)
        used = np.arange(window)[None, :] < self.lengths[:, None]
        self.vocabulary = np.unique(self.tokens[used])

    def order_by_rarity(self, counts: np.ndarray) -> None:
        """Choose each window's prefix word: the rarest in the corpus, ties by hash. Windows with an absent word go."""
        at = np.searchsorted(self.vocabulary, self.tokens).clip(0, max(0, len(self.vocabulary) - 1))
        seen = counts[at] if len(counts) else np.zeros(self.tokens.shape, np.int64)
        unused = np.arange(self.tokens.shape[1])[None, :] >= self.lengths[:, None]
        seen = np.where(unused, np.iinfo(np.int64).max, seen)
        live = seen.min(axis=1) > 0 if len(seen) else np.zeros(0, bool)
        self.tokens, self.lengths, self.owner, seen, at = (
            x[live] for x in (self.tokens, self.lengths, self.owner, seen, at))
        rank = np.lexsort((np.arange(len(self.vocabulary)), counts))
        place = np.empty(len(rank), np.int64)
        place[rank] = np.arange(len(rank))
        by_rarity = np.where(seen == np.iinfo(np.int64).max, np.iinfo(np.int64).max, place[at] if len(rank) else seen)
        self.offset = by_rarity.argmin(axis=1) if len(by_rarity) else np.zeros(0, np.int64)
        prefix = self.tokens[np.arange(len(self.tokens)), self.offset]
        order = np.argsort(prefix, kind="stable")
        self.by_prefix = order
        self.prefixes, self.prefix_first = np.unique(prefix[order], return_index=True)
        self.prefix_first = np.append(self.prefix_first, len(order))

    def occurrences(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start word, window) of every occurrence of a window in the texts' words."""
        none = np.zeros(0, np.int64)
        if not len(self.prefixes) or not len(h):
            return none, none
        at = np.searchsorted(self.prefixes, h).clip(0, len(self.prefixes) - 1)
        hit = np.flatnonzero(self.prefixes[at] == h)
        low, high = self.prefix_first[at[hit]], self.prefix_first[at[hit] + 1]
        text_of = np.searchsorted(first, hit, side="right") - 1
        begin, limit = first[text_of], first[text_of + 1]
        starts, windows = [], []
        total = np.cumsum(high - low)
        i = 0
        while i < len(hit):  # as many matches at once as CHUNK candidates allow
            j = max(i + 1, int(np.searchsorted(total, (total[i - 1] if i else 0) + CHUNK, side="right")))
            n = high[i:j] - low[i:j]
            which = np.repeat(np.arange(i, j), n)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            w = self.by_prefix[low[which] + inner]
            s = hit[which] - self.offset[w]
            ok = (s >= begin[which]) & (s + self.lengths[w] <= limit[which])
            s, w = s[ok], w[ok]
            for k in range(self.tokens.shape[1]):
                need = self.lengths[w] > k
                same = ~need | (h[np.minimum(s + k, len(h) - 1)] == self.tokens[w, k])
                s, w = s[same], w[same]
                if not len(s):
                    break
            starts.append(s)
            windows.append(w)
            i = j
        return (np.concatenate(starts), np.concatenate(windows)) if starts else (none, none)


def _texts(batch: pa.RecordBatch, text_col: str) -> pa.Array:
    return batch.column(0).field(batch.schema.field(0).type.get_field_index(text_col))


def _word_counts(docs: DataFrame, index: ItemIndex, text_col: str) -> np.ndarray:
    """How often each word of the index occurs in all documents."""
    vocabulary = index.vocabulary

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                h = words_of(part.column(0), ALNUM, LOWER).hash
                at = np.searchsorted(vocabulary, h).clip(0, len(vocabulary) - 1)
                at = at[vocabulary[at] == h]
                total += np.bincount(at, minlength=len(vocabulary))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"word": seen.astype(np.int64), "n": total[seen]})

    out = np.zeros(len(vocabulary), np.int64)
    if len(vocabulary):
        found = (docs.select(col(text_col).cast("string").alias("text")).mapInArrow(count, "word long, n long")
                 .groupBy("word").agg(F.sum("n").alias("n")))
        for r in found.collect():  # one row for each word of a bounded block of items at most
            out[r["word"]] = r["n"]
    return out


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int
                ) -> Iterator[tuple[ItemIndex, bool]]:
    """Indexes over blocks of about ``block_bytes`` bytes of item text, and whether each is the last."""
    items = benchmark.select(col(id_col).cast("string").alias("id"), col(text_col).cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(total // block_bytes) + 1
    for b in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        rows = part.distinct().collect()
        yield ItemIndex([r["id"] for r in rows], [r["text"] for r in rows], window), b + 1 == blocks


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, block_bytes: int = 8_000_000,
                  keep_text: bool = True) -> DataFrame:
    """``doc`` (all columns of docs as a struct), ``n_words``, ``spans`` (flat
    word ranges [start, end) that are hit) and ``items`` (ids, as strings) per row."""
    bound_batches(docs.sparkSession)
    frame = packed(docs, text_col).select(
        "doc", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<long>").alias("spans"),
        F.array().cast("array<string>").alias("items"))
    for index, last in item_blocks(benchmark, item_col, item_text_col, window, block_bytes):
        index.order_by_rarity(_word_counts(docs, index, text_col))
        frame = _probed(frame, index, text_col, keep_text or not last)
        if not last:  # so that one block's index at a time is in memory
            frame = stored(frame)
    return frame


def _probed(frame: DataFrame, index: ItemIndex, text_col: str, keep_text: bool) -> DataFrame:
    fields = [f for f in frame.schema["doc"].dataType.fields if keep_text or f.name != text_col]
    schema = T.StructType([T.StructField("doc", T.StructType(fields))] + frame.schema.fields[1:])
    names = [f.name for f in fields]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            texts = _texts(whole, text_col)
            flat_batch = pa.RecordBatch.from_arrays([texts, pa.array(np.arange(whole.num_rows))], ["text", "row"])
            for part in slices(flat_batch):
                batch = whole.slice(part.column(1)[0].as_py(), part.num_rows)
                w = words_of(part.column(0), ALNUM, LOWER)
                starts, windows = index.occurrences(w.hash, w.first)
                spans, items = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                order = np.argsort(starts, kind="stable")
                starts, windows = starts[order], windows[order]
                low = np.searchsorted(starts, w.first)
                for i in np.flatnonzero(low[1:] > low[:-1]):
                    a, b = low[i], low[i + 1]
                    n = int(w.first[i + 1] - w.first[i])
                    hit = np.zeros(n, bool)
                    for s, e in zip(spans[i][::2], spans[i][1::2]):
                        hit[s:e] = True
                    for size in np.unique(index.lengths[windows[a:b]]):
                        chosen = index.lengths[windows[a:b]] == size
                        hit |= covered(starts[a:b][chosen] - w.first[i], int(size), n)
                    spans[i] = np.stack(runs(hit), axis=1).ravel().tolist()
                    found = {index.ids[o] for o in np.unique(index.owner[windows[a:b]])} | set(items[i])
                    items[i] = sorted(x for x in found if x is not None)
                doc = batch.column(0)
                kept = pa.StructArray.from_arrays(
                    [doc.field(doc.type.get_field_index(n)) for n in names], fields=[doc.type.field(n) for n in names])
                yield pa.RecordBatch.from_arrays(
                    [kept, pa.array(np.diff(w.first).astype(np.int64)), pa.array(spans, pa.list_(pa.int64())),
                     pa.array(items, pa.list_(pa.string()))], ["doc", "n_words", "spans", "items"])

    return frame.mapInArrow(probe, schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents (all columns) in which no window of an item occurs."""
    found = contamination(docs, benchmark, **options)
    return found.filter(F.size("spans") == 0).select(*unpacked(found, docs.columns))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Digest per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    text_col = options.get("text_col", "text")
    found = contamination(docs.select(col(id_col), col(text_col)), benchmark, keep_text=False, **options)
    n_hit = F.aggregate(
        F.transform("spans", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        F.col("doc").getField(id_col).alias("doc_id"), "n_words", n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))
