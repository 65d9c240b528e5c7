"""Exact repeats of byte strings by suffix arrays built with Lyndon grouping.

A byte is removed if a string of ``length`` bytes around it also starts
anywhere else, in the same document or another.

1. Anchors. Every string of ``length`` bytes has one minimal gram of up to ``GRAM`` bytes
   (by hash; the first of equal ones), so equal strings have equal anchors at
   the same place. Neighbouring strings mostly share theirs: about two anchors
   for each ``length`` bytes less the gram's. Anchors are counted over the whole corpus
   in packed rows (see ``packed``); strings whose anchor is unique cannot repeat.
2. Suffix order. For an anchor that occurs again, the hash of its context (all
   strings it is minimal in; 128 bits) is counted by Spark before and after a
   shuffle without the bytes. Equal contexts are one class, which settles groups
   of copies without comparing their members: a class that occurs again repeats
   as a whole. Where a gram has several classes, one copy of each class's bytes
   goes to the bucket of the gram. These distinct contexts are cut into ``SYMBOL``-byte symbols on a
   grid through the anchor, and their suffixes are sorted (see ``lyndon``).
   Every string of ``length`` bytes holds ``WHOLE`` whole symbols, so strings
   that repeat lie where neighbours in that order share so many.
3. Exact ends. Among suffixes that share ``WHOLE`` symbols, the remaining bytes
   of the string, before and behind them, are compared, for each offset. The
   spans are joined back to the occurrences by class, where adaptive execution
   splits a hot one; no task needs all occurrences of a passage.

Documents never meet in pairs, and strings never cross documents. Strings are
judged on the input, not on what is left. Defined results: null and empty texts
have no bytes; rows are told apart by id and text, so null ids and repeated ids
are fine (a repeated row repeats all its strings); extra columns are kept by
``suffix_dedup`` unchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.llm.frames import col, packed, stored
from kiln.llm.lyndon import suffix_array
from kiln.llm.packed import SCHEMA, Packer, answers, bucket_bits, by_id, unpack, whole_key
from kiln.llm.textbytes import bound_batches, flat, mix, powers, runs, slices

#: Bytes of an anchor's gram for strings of 400 bytes and more (``gram_bytes``).
GRAM = 128
SYMBOL = 32
#: Symbols sorted in one suffix array at most, unless one anchor alone has more.
BUNDLE = 30_000
_BASE = np.uint64(0xD6E8FEB86659FD93)


def gram_bytes(length: int) -> int:
    """Shorter strings have shorter grams in proportion, so their anchors lie no closer than that."""
    return max(1, min(GRAM, length * GRAM // 400))


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(col(id_col).cast("string"), col(text_col).cast("string"))


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Anchors of the strings of ``length`` bytes in the texts: gram hash, text,
    place, first and last string start (places count from the text's start)."""
    none = np.zeros(0, np.int64)
    gram = gram_bytes(length)
    width = length - gram + 1
    grams = len(data) - gram + 1
    if grams < width:
        return none.astype(np.uint64), none, none, none, none
    up, down = powers(_BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    h = mix((sums[gram:] - sums[:-gram]) * down[:grams])
    # the smallest of every `width` consecutive hashes, with its place in the low bits
    place = np.uint64(max(1, int(grams).bit_length()))
    ranked = ((h >> place) << place) | np.arange(grams, dtype=np.uint64)
    padded = np.full(-(-grams // width) * width, np.iinfo(np.uint64).max)
    padded[:grams] = ranked
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    strings = grams - width + 1
    least = np.minimum(behind[:strings], ahead[width - 1:width - 1 + strings])
    least = (least & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)
    # strings that lie in one text
    size = np.diff(offsets)
    many = np.maximum(0, size - length + 1)
    text = np.repeat(np.arange(len(size)), many)
    start = np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many) + offsets[text]
    least = least[start]
    if not len(start):
        return none.astype(np.uint64), none, none, none, none
    new = np.flatnonzero(np.concatenate(([True], (least[1:] != least[:-1]) | (text[1:] != text[:-1]))))
    last = np.append(new[1:], len(start)) - 1
    text, base = text[new], offsets[text[new]]
    # minimal hashes are small ones: mixed again, they spread over the buckets
    return mix(h[least[new]] + _BASE), text, least[new] - base, start[new] - base, start[last] - base


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(row_key(id_col, text_col).alias("id"), col(text_col).cast("string").alias("text"))


def repeated_anchors(texts: DataFrame, length: int, bits: int) -> DataFrame:
    """(id, keys): the row's anchors that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(bits, 8)
        for batch in batches:
            for part in slices(batch):
                ids = part.column(0).to_numpy(zero_copy_only=False)
                h, text, *_ = anchors_of(*flat(part.column(1)), length)
                yield from packer.add(h, ids[text])
        yield from packer.flush()

    def again(group: pa.Table) -> pa.Table:
        keys, ids, _ = unpack(group, 8)
        _, where, n = np.unique(keys, return_inverse=True, return_counts=True)
        live = n[where] > 1
        return answers(ids[live], whole_key(group.column("bucket")[0].as_py(), keys[live], bits, 8), bits)

    return by_id(texts.mapInArrow(run, SCHEMA).groupBy("bucket").applyInArrow(again, SCHEMA), "keys")


_MEMBER = "gram long, high long, low long, id long, first int, strings int, anchor int"


def members(texts: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """One row for each repeated anchor's occurrence, without its bytes: the gram, the class of its context (128 bits
    of a hash over the bytes, their anchor and their strings), the row, the first string's start in the text, how many
    strings start in the context, and the anchor's offset in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                ids = part.column(0).to_numpy(zero_copy_only=False)
                data, offsets = flat(part.column(1))
                h, text, place, first, last = anchors_of(data, offsets, length)
                low = np.searchsorted(text, np.arange(part.num_rows + 1))
                live = np.zeros(len(h), bool)
                for i, keys in enumerate(part.column(2)):
                    a, b = low[i], low[i + 1]
                    live[a:b] = np.isin(h[a:b], keys.values.to_numpy().view(np.uint64))
                h, text, place, first, last = (x[live] for x in (h, text, place, first, last))
                raw, base = data.tobytes(), offsets[text]
                strings, anchor = (last - first + 1).astype(np.int32), (place - first).astype(np.int32)
                marks = np.stack([anchor, strings], axis=1).tobytes()
                digest = b"".join([hashlib.blake2b(raw[s:e], digest_size=16, key=marks[8 * i:8 * i + 8]).digest()
                                   for i, (s, e) in enumerate(zip((base + first).tolist(), (base + last + length).tolist()))])
                halves = np.frombuffer(digest, np.int64).reshape(-1, 2)
                for i in range(0, len(h), 100_000):
                    k = slice(i, i + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[k]) for x in (h.view(np.int64), halves[:, 0], halves[:, 1], ids[text], first.astype(np.int32), strings, anchor)],
                        ["gram", "high", "low", "id", "first", "strings", "anchor"])

    return texts.join(found, "id").select("id", "text", "keys").mapInArrow(run, _MEMBER)


def classes_of(occurrences: DataFrame) -> DataFrame:
    """One row for each class: its gram, strings, anchor, how often it occurs, one occurrence (the row and first
    string), and whether its gram has other classes. Counted before the shuffles, so copies travel as one row a task."""
    counted = occurrences.groupBy("gram", "high", "low").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "first")).alias("one"), F.min("strings").alias("strings"), F.min("anchor").alias("anchor"))
    alone = counted.groupBy(F.col("gram").alias("_gram")).agg((F.count(F.lit(1)) > 1).alias("others"))
    return counted.join(alone, F.col("gram") == F.col("_gram")).drop("_gram")


_CONTEXT = "bucket int, gram long, high long, low long, strings int, anchor int, bytes binary"


def contexts(texts: DataFrame, classes: DataFrame, length: int, bits: int) -> DataFrame:
    """The bytes of every class whose gram has other classes, from one of its occurrences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part.column(0))
                wanted = part.column(1)
                begin = wanted.offsets.to_numpy()
                own = wanted.values.slice(begin[0], begin[-1] - begin[0])
                first, strings = own.field("first").to_numpy(), own.field("strings").to_numpy()
                start = offsets[np.repeat(np.arange(part.num_rows), np.diff(begin))] + first
                raw, gram = data.tobytes(), own.field("gram").to_numpy()
                bucket = (gram.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int32)
                for i in range(0, len(own), 4000):
                    k = slice(i, i + 4000)
                    pieces = [raw[s:e] for s, e in zip(start[k].tolist(), (start[k] + strings[k] - 1 + length).tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket[k]), pa.array(gram[k]), *[own.field(c)[i:i + 4000] for c in ("high", "low", "strings", "anchor")],
                         pa.array(pieces, pa.binary())], ["bucket", "gram", "high", "low", "strings", "anchor", "bytes"])

    wanted = classes.filter("others").groupBy(F.col("one.id").alias("id")).agg(
        F.collect_list(F.struct("gram", "high", "low", "strings", "anchor", F.col("one.first").alias("first"))).alias("wanted"))
    # rows with equal id are equal texts: one of them is enough
    return texts.join(wanted, "id").select("id", "text", "wanted").dropDuplicates(["id"]).select("text", "wanted").mapInArrow(run, _CONTEXT)


def repeated_starts(pieces: list[bytes], anchor: np.ndarray, strings: np.ndarray, length: int) -> list[np.ndarray]:
    """For distinct contexts, the offsets of their strings of ``length`` bytes that occur
    more than once among all strings of these contexts. ``anchor``: the anchor's offset in
    each context; ``strings``: how many strings start in it (at offsets 0, 1, ...)."""
    whole = (length - SYMBOL + 1) // SYMBOL
    # symbols on a grid through each anchor, contexts parted by a symbol of their own rank 0
    symbols, home, offset = [], [], []
    for k, piece in enumerate(pieces):
        begin = int(anchor[k]) % SYMBOL
        n = (len(piece) - begin) // SYMBOL
        symbols.append(np.frombuffer(piece, np.uint8, n * SYMBOL, begin).reshape(n, SYMBOL))
        home.append(np.full(n + 1, k))
        offset.append(begin + SYMBOL * np.arange(n + 1))
    sizes = np.array([len(s) for s in symbols])
    stacked = np.concatenate(symbols) if symbols else np.zeros((0, SYMBOL), np.uint8)
    rank = np.unique(np.ascontiguousarray(stacked).view(f"V{SYMBOL}").ravel(), return_inverse=True)[1] + 1
    home, offset = np.concatenate(home), np.concatenate(offset)
    sequence = np.zeros(len(home), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    inner = np.ones(len(home), bool)
    inner[ends] = False
    sequence[inner] = rank
    order = np.array(suffix_array(sequence), np.int64)
    left = ends[home] - np.arange(len(home))  # whole symbols from here to the end of the context
    order = order[left[order] >= whole]
    if not len(order):
        return [np.zeros(0, np.int64)] * len(pieces)
    shared = sequence[order[:, None] + np.arange(whole)]
    joined = np.concatenate(([False], (shared[1:] == shared[:-1]).all(axis=1)))
    interval = np.cumsum(~joined)  # suffixes that share `whole` symbols
    large = np.bincount(interval)[interval] > 1
    order, interval = order[large], interval[large]
    found: list[list[int]] = [[] for _ in pieces]
    seen: dict[tuple, tuple[int, int] | None] = {}
    for i, group in zip(order.tolist(), interval.tolist()):
        k, at = int(home[i]), int(offset[i])
        piece, behind = pieces[k], at + whole * SYMBOL
        for before in range(min(SYMBOL, at + 1)):
            start, stop = at - before, at - before + length
            if start >= strings[k]:
                continue
            if stop > len(piece):
                break
            key = (group, piece[start:at], piece[behind:stop])
            first = seen.get(key, 0)
            if first == 0:
                seen[key] = (k, start)
                continue
            if first is not None:
                found[first[0]].append(first[1])
                seen[key] = None
            found[k].append(start)
    return [np.unique(np.array(x, np.int64)) for x in found]


def repeated_parts(found: DataFrame, length: int) -> DataFrame:
    """(high, low, parts): flat byte ranges of the strings that repeat in a class's context among its gram's classes."""

    def run(group: pa.Table) -> pa.Table:
        gram, strings, anchor = (group.column(c).to_numpy() for c in ("gram", "strings", "anchor"))
        pieces = group.column("bytes").to_pylist()
        parts: list[np.ndarray] = [np.zeros(0, np.int64)] * len(pieces)
        order = np.argsort(gram, kind="stable")
        cuts = np.flatnonzero(np.diff(gram[order])) + 1
        bundle: list[int] = []

        def settle() -> None:
            got = repeated_starts([pieces[c] for c in bundle], anchor[bundle], strings[bundle], length)
            for c, starts in zip(bundle, got):
                mask = np.zeros(strings[c], bool)
                mask[starts] = True
                a, b = runs(mask)
                parts[c] = np.stack([a, b - 1 + length], axis=1).ravel()
            bundle.clear()

        size = 0
        for own in np.split(order, cuts):
            bundle += own.tolist()
            size += sum(len(pieces[c]) // SYMBOL + 1 for c in own)
            if size >= BUNDLE:
                settle()
                size = 0
        if bundle:
            settle()
        some = np.array([i for i, p in enumerate(parts) if len(p)], np.int64)
        return pa.table({"high": group.column("high").to_numpy()[some], "low": group.column("low").to_numpy()[some],
                         "parts": pa.array([parts[i] for i in some], pa.list_(pa.int64()))})

    return found.groupBy("bucket").applyInArrow(run, "high long, low long, parts array<long>")


def repeated_spans(occurrences: DataFrame, classes: DataFrame, parts: DataFrame, length: int) -> DataFrame:
    """(id, spans): flat byte ranges of the strings that repeat. A class that occurs again repeats as a whole, the
    others where their gram's classes share strings."""
    whole = F.array(F.lit(0).cast("long"), (F.col("strings") - 1 + length).cast("long"))
    found = (classes.filter("n > 1").select("high", "low", whole.alias("parts"))
             .unionByName(parts.join(classes.filter("n = 1 AND others").select("high", "low"), ["high", "low"])))
    spans = occurrences.select("high", "low", "id", "first").join(found, ["high", "low"]).select(
        "id", F.transform("parts", lambda x: x + F.col("first")).alias("spans"))
    return spans.groupBy("id").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def repeats(docs: DataFrame, id_col: str, text_col: str, length: int) -> DataFrame:
    """(id, spans): rows of docs (by ``row_key``) with bytes to remove, unmerged flat ranges."""
    bound_batches(docs.sparkSession)
    texts = _keyed(docs, id_col, text_col)
    bits = bucket_bits(texts, "text", 12_000_000)
    found = stored(repeated_anchors(texts, length, bits))
    occurrences = stored(members(texts, found, length))
    classes = stored(classes_of(occurrences))
    parts = repeated_parts(contexts(texts, classes, length, bits + 3), length)  # contexts take more room than keys
    return stored(repeated_spans(occurrences, classes, parts, length))


def merged(spans: np.ndarray, n: int) -> np.ndarray:
    """Mask of n bytes from flat ranges."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, spans[::2], 1)
    np.add.at(step, spans[1::2], -1)
    return np.cumsum(step[:n]) > 0


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """Digest per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    spans = repeats(docs, id_col, text_col, length).withColumnRenamed("id", "row")
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"),
                       row_key(id_col, text_col).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, spans in zip(batch.column(1).cast(pa.binary()), batch.column(2)):
                data = text.as_py() or b""
                if not spans.is_valid:
                    out.append((len(data), 0, 0, hashlib.sha256(data).hexdigest()))
                    continue
                mask = merged(spans.values.to_numpy(), len(data))
                kept = np.frombuffer(data, np.uint8)[~mask].tobytes()
                out.append((len(data), int(mask.sum()), len(runs(mask)[0]), hashlib.sha256(kept).hexdigest()))
            n, removed, many, digest = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(many, pa.int64()),
                 pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.join(spans, "row", "left").select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                 count_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns of docs; the text is what is left of it.

    A character of several bytes goes only if all its bytes are removed.
    ``count_col``, if there is such a column, becomes the new text's code points.
    """
    spans = repeats(docs, id_col, text_col, length)
    rows = packed(docs, text_col).withColumn("row", F.xxhash64(
        F.col("doc").getField(id_col).cast("string"), F.col("doc").getField(text_col)))
    joined = rows.join(spans.withColumnRenamed("id", "row"), "row", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch.column(0)
            at = doc.type.get_field_index(text_col)
            out = []
            for text, spans in zip(doc.field(at), batch.column(1)):
                data = text.as_py()
                if data is not None and spans.is_valid:
                    raw = np.frombuffer(data.encode(), np.uint8)
                    keep = ~merged(spans.values.to_numpy(), len(raw))
                    begin = np.flatnonzero((raw & 0xC0) != 0x80)
                    keep = np.repeat(np.logical_or.reduceat(keep, begin), np.diff(np.append(begin, len(raw))))
                    data = raw[keep].tobytes().decode()
                out.append(data)
            arrays = [doc.field(i) for i in range(doc.type.num_fields)]
            arrays[at] = pa.array(out, doc.type.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in doc.type])

    schema = T.StructType(list(rows.schema["doc"].dataType.fields))
    left = joined.select("doc", "spans").mapInArrow(run, schema)
    if count_col and count_col in docs.columns:
        left = left.withColumn(count_col, F.length(col(text_col)).cast(docs.schema[count_col].dataType))
    return left
