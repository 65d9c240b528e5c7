"""Alignment of two tokenizers over the same texts, on Arrow arrays.

Tokenizer A is a byte-level BPE vocabulary, tokenizer B a SentencePiece model;
both read a space and the text. Inside a task everything is Arrow compute on
flat arrays: the documents' token lists are flattened with parent indices,
token byte lengths become token ends by cumulative sums that start again at
every document, and a full outer hash join of both sides on the (document,
end) key finds the ends they share. Ends of both sides cut the groups. Sorted
by key, each row of the join is the end of one stretch of bytes that lies in
exactly one token of A and one of B; filling ids backwards over the other
side's rows therefore lists every overlapping pair of token occurrences once.
``Table.group_by`` counts the pairs of each document, then of each slice of
documents, and Spark adds the slices' counts up. Each slice gets the totals of
its own pairs back by a join on the pair and a cogroup on the slice, so no
table of all pairs ever sits in one task; what is broadcast (the largest count
of each id of B) has at most as many rows as B has ids.

Neither tokenizer ever joins a non-space character with a space behind it, so
texts are cut before every single space between non-spaces, the distinct units
of a task are encoded once, and a text's tokens are its units' tokens taken in
order. Tests hold this against encoding whole texts.

Defined results: null and empty texts, and texts whose joined token bytes of A
or B differ from space and text, have no tokens: all numbers 0, empty groups.
Documents count each for itself, equal ids included; other columns are not
read. A slice holds ``slice_bytes`` of text, or one longer text.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import col, stored
from kiln.llm.textbytes import bound_batches, slices

#: Fixed value: the pattern by which byte-level BPE cuts texts before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A single space between two characters that are no white space.
UNIT = re.compile(r" (?=\S)(?<=\S )")
#: Units a task remembers before it starts anew.
REMEMBER = 300_000
#: Bits of a document's byte offsets in a (document, end) key, of B's ids in a pair.
END, ID = 40, 16


def byte_level_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level BPE files: printable Latin-1 stands for itself, the other
    bytes for the characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


class ByteLevel:
    """Tokenizer A: ids of texts and the bytes of every id."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        alphabet = byte_level_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items()}
        self.encoding = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, units: list[str]) -> list[list[int]]:
        one = self.encoding.encode_ordinary
        return [one(" " + u) for u in units]


class SentencePieces:
    """Tokenizer B (which puts the space before a text itself)."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[1:-1], 16)]) if self.model.is_byte(i)
                              else b"" if self.model.is_control(i) else piece.replace("▁", " ").encode())

    def encode(self, units: list[str]) -> list[list[int]]:
        return self.model.encode(units, num_threads=1)


class Units:
    """Token lists of the distinct units a task has met, as flat arrays."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.bytes = tokenizer.bytes
        self.sizes = pa.array([len(b) for b in self.bytes], pa.int64())
        self.names = pa.array([str(i) for i in range(len(self.bytes))], pa.string())
        self.clear()

    def clear(self) -> None:
        self.ids, self.offsets, self.ok = np.zeros(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool)

    def add(self, units: list[str]) -> None:
        lists = self.tokenizer.encode(units)
        names = self.bytes
        same = [b"".join([names[i] for i in x]) == b" " + u.encode() for x, u in zip(lists, units)]
        ends = self.offsets[-1] + np.cumsum([len(x) for x in lists])
        self.ids = np.concatenate((self.ids, np.fromiter((i for x in lists for i in x), np.int32)))
        self.offsets = np.concatenate((self.offsets, ends))
        self.ok = np.concatenate((self.ok, np.array(same, bool)))

    def tokens(self, rows: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(self.offsets.astype(np.int32)), pa.array(self.ids)).take(rows)


@dataclass
class Aligned:
    """One chunk of documents: their groups, and how often each document links each pair."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups_a: pa.ListArray  # of all groups, one after the other
    groups_b: pa.ListArray
    pairs: pa.Table  # doc, pair, n: distinct pairs of each document


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = Units(ByteLevel(a_path)), Units(SentencePieces(b_path))
        self.known: dict[str, int] = {}

    def rows_of(self, units: list[str]) -> np.ndarray:
        """Row of every unit in both stores, after the new ones have been encoded."""
        if len(self.known) > REMEMBER:
            self.known.clear()
            self.a.clear()
            self.b.clear()
        known = self.known
        new = [u for u in units if u not in known]
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self.a.add(new)
            self.b.add(new)
        return np.fromiter((known[u] for u in units), np.int32, len(units))

    def side(self, units: Units, rows: pa.Array, doc_of_unit: pa.Array, n: int, name: str) -> tuple[pa.Table, pa.Array, np.ndarray]:
        """(key, id) of every token, the ids, and tokens per document."""
        lists = units.tokens(rows)
        ids = pc.list_flatten(lists)
        doc = pc.take(doc_of_unit, pc.list_parent_indices(lists))
        total = pc.cumulative_sum(pc.take(units.sizes, ids))
        count = np.bincount(doc.to_numpy(), minlength=n)
        # cumulative sums begin again at every document
        before = np.concatenate(([0], total.to_numpy()))[np.cumsum(count) - count]
        end = pc.subtract(total, pc.take(pa.array(before), doc))
        key = pc.bit_wise_or(pc.shift_left(doc, END), end)
        return pa.table({"key": key, name: ids}), ids, count

    def aligned(self, texts: list[str | None]) -> Aligned:
        n = len(texts)
        cuts = [UNIT.split(t) if t else [] for t in texts]
        listed = pa.array([u for x in cuts for u in x], pa.string()).dictionary_encode()
        rows = pc.take(pa.array(self.rows_of(listed.dictionary.to_pylist())), listed.indices)
        doc = np.repeat(np.arange(n), [len(x) for x in cuts])
        ok = (self.a.ok & self.b.ok)[rows.to_numpy()]
        if not ok.all():  # documents that one of the tokenizers does not give back
            keep = ~np.isin(doc, doc[~ok])
            doc, rows = doc[keep], rows.filter(pa.array(keep))
        doc = pa.array(doc, pa.int64())
        left, ids_a, n_a = self.side(self.a, rows, doc, n, "a")
        right, ids_b, n_b = self.side(self.b, rows, doc, n, "b")
        both = left.join(right, "key", join_type="full outer", use_threads=False).combine_chunks().sort_by("key").combine_chunks()
        key, a, b = (both.column(c).combine_chunks() if both.num_rows else pa.array([], t)
                     for c, t in (("key", pa.int64()), ("a", pa.int32()), ("b", pa.int32())))
        has_a, has_b = pc.is_valid(a), pc.is_valid(b)
        shared = pc.and_(has_a, has_b)
        doc_of = pc.shift_right(key, END)

        def grouped(has: pa.Array, ids: pa.Array) -> pa.ListArray:
            last = np.flatnonzero(shared.filter(has).to_numpy(zero_copy_only=False))
            return pa.ListArray.from_arrays(pa.array(np.append(0, last + 1).astype(np.int32)), ids)

        pair = pc.bit_wise_or(pc.shift_left(pc.fill_null_backward(a).cast(pa.int64()), ID), pc.fill_null_backward(b).cast(pa.int64()))
        counted = (pa.table({"own": pc.bit_wise_or(pc.shift_left(doc_of, 2 * ID), pair)}).group_by("own", use_threads=False)
                   .aggregate([([], "count_all")]).sort_by("own"))  # groups come in no set order
        own = counted.column("own")
        counted = pa.table({"doc": pc.shift_right(own, 2 * ID), "pair": pc.bit_wise_and(own, (1 << 2 * ID) - 1),
                            "n": counted.column("count_all")})
        docs = doc_of.to_numpy()
        return Aligned(n_a, n_b, np.bincount(docs[shared.to_numpy(zero_copy_only=False)], minlength=n),
                       np.bincount(docs, minlength=n), grouped(has_a, ids_a), grouped(has_b, ids_b), counted)


def written(x: Aligned, a: Units, b: Units) -> list[str]:
    """Every document's groups as ``a1,a2|b1;a3|b2,b3`` in decimal ids."""
    def side(groups: pa.ListArray, names: pa.Array) -> pa.Array:
        return pc.binary_join(pa.ListArray.from_arrays(groups.offsets, names.take(groups.values)), ",")

    both = pc.binary_join_element_wise(side(x.groups_a, a.names), side(x.groups_b, b.names), "|")
    offsets = pa.array(np.concatenate(([0], np.cumsum(x.n_groups))).astype(np.int32))
    return pc.binary_join(pa.ListArray.from_arrays(offsets, both), ";").to_pylist()


def default_paths(a_path: str | None, b_path: str | None) -> tuple[str, str]:
    if a_path is None or b_path is None:
        import public_tokenizers

        a_path = a_path or str(public_tokenizers.path("byte_bpe_50k.json"))
        b_path = b_path or str(public_tokenizers.path("piece_bpe_32k.model"))
    return a_path, b_path


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
           b_path: str | None = None) -> DataFrame:
    """(id, groups) of every row: the smallest runs of A's and B's ids over the same bytes, in order."""
    bound_batches(docs.sparkSession)
    a_path, b_path = default_paths(a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_path, b_path)
        for batch in batches:
            for part in slices(batch):
                x = aligner.aligned(part.column(1).to_pylist())
                offsets = pa.array(np.concatenate(([0], np.cumsum(x.n_groups))).astype(np.int32))
                pairs = pa.StructArray.from_arrays([x.groups_a, x.groups_b], ["a", "b"])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, pairs)], ["id", "groups"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, groups array<struct<a:array<int>,b:array<int>>>").withColumnRenamed("id", id_col)


class Slice:
    """Documents of one slice: their numbers, and the slice's own list of pairs."""

    def __init__(self):
        self.ids: list[pa.Array] = []
        self.numbers: list[tuple[np.ndarray, ...]] = []
        self.digests: list[str] = []
        self.pairs: list[pa.Table] = []
        self.n = 0

    def add(self, ids: pa.Array, x: Aligned, digests: list[str]) -> None:
        self.ids.append(ids)
        self.numbers.append((x.n_a, x.n_b, x.n_groups, x.n_links))
        self.digests += digests
        self.pairs.append(x.pairs.set_column(0, "doc", pc.add(x.pairs.column("doc"), self.n)))
        self.n += len(ids)

    def row(self, number: int) -> pa.RecordBatch:
        pairs = pa.concat_tables(self.pairs).combine_chunks()
        coded = pairs.column("pair").combine_chunks().dictionary_encode() if pairs.num_rows else pa.array([], pa.int64()).dictionary_encode()
        counts = (pa.table({"code": coded.indices, "n": pairs.column("n")}).group_by("code", use_threads=False)
                  .aggregate([("n", "sum")]).sort_by("code").column("n_sum"))
        doc = pairs.column("doc").to_numpy()
        offsets = pa.array(np.searchsorted(doc, np.arange(self.n + 1)).astype(np.int32))
        columns = [np.concatenate(x).astype(np.int64) for x in zip(*self.numbers)]
        docs = pa.table({
            "id": pa.chunked_array(self.ids), "n_a": columns[0], "n_b": columns[1], "n_groups": columns[2], "n_links": columns[3],
            "groups_sha256": pa.array(self.digests, pa.string()),
            "codes": pa.ListArray.from_arrays(offsets, coded.indices),
            "ns": pa.ListArray.from_arrays(offsets, pairs.column("n").combine_chunks().cast(pa.int32()) if pairs.num_rows else pa.array([], pa.int32()))})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(docs)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([coded.dictionary.to_pylist()], pa.list_(pa.int64())),
             pa.array([counts.to_pylist()], pa.list_(pa.int64())), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
            ["slice", "pairs", "counts", "docs"])


def sliced(docs: DataFrame, id_col: str, text_col: str, a_path: str, b_path: str, slice_bytes: int) -> DataFrame:
    """One row per slice: its pairs with their counts, and its documents packed as an Arrow stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, now, size = Aligner(a_path, b_path), Slice(), 0
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch):
                x = aligner.aligned(part.column(1).to_pylist())
                now.add(part.column(0), x, [hashlib.sha256(t.encode()).hexdigest() if t else ""
                                            for t in written(x, aligner.a, aligner.b)])
                size += part.column(1).nbytes
                if size >= slice_bytes:
                    yield now.row(number)
                    now, size, number = Slice(), 0, number + 1
        if now.n:
            yield now.row(number)

    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "slice long, pairs array<long>, counts array<long>, docs binary")


def pair_counts(parts: DataFrame) -> DataFrame:
    """(pair, n, best): links of every pair in all documents, and whether no pair of its B id has more."""
    total = stored(parts.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p"))
                   .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.counts").alias("n")))
    b = F.col("pair").bitwiseAND((1 << ID) - 1)
    most = total.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # at most as many rows as B has ids
    return total.join(F.broadcast(most), b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
          b_path: str | None = None, slice_bytes: int = 8_000_000) -> DataFrame:
    """(a, b, n, best): how often each token of A overlaps each token of B, over all documents."""
    bound_batches(docs.sparkSession)
    parts = stored(sliced(docs, id_col, text_col, *default_paths(a_path, b_path), slice_bytes))
    pair = F.col("pair")
    return pair_counts(parts).select(F.shiftright(pair, ID).cast("int").alias("a"),
                                     pair.bitwiseAND((1 << ID) - 1).cast("int").alias("b"), "n", "best")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
           b_path: str | None = None, slice_bytes: int = 8_000_000) -> DataFrame:
    """Digest per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    bound_batches(docs.sparkSession)
    parts = stored(sliced(docs, id_col, text_col, *default_paths(a_path, b_path), slice_bytes))
    own = parts.select(F.col("slice").alias("of"), F.posexplode("pairs").alias("code", "pair"))
    answers = own.join(pair_counts(parts), "pair").select("of", "code", "n", "best")

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        with pa.ipc.open_stream(left.column("docs")[0].as_py()) as stream:
            docs = stream.read_all().combine_chunks()
        order = right.sort_by("code")  # every code of the slice, once
        code = pc.list_flatten(docs.column("codes"))
        times = pc.list_flatten(docs.column("ns")).cast(pa.int64())
        counted = pc.multiply(pc.take(order.column("n"), code), times).to_numpy()
        best = pc.if_else(pc.take(order.column("best"), code), times, 0).to_numpy()
        offsets = np.concatenate(([0], np.cumsum(pc.list_value_length(docs.column("codes")).to_numpy())))
        sums = [np.concatenate(([0], np.cumsum(x)))[offsets] for x in (best, counted)]
        return pa.table({"doc_id": docs.column("id"), "n_a": docs.column("n_a"), "n_b": docs.column("n_b"),
                         "n_groups": docs.column("n_groups"), "n_links": docs.column("n_links"),
                         "n_best": np.diff(sums[0]), "count_sum": np.diff(sums[1]), "groups_sha256": docs.column("groups_sha256")})

    kind = docs.schema[id_col].dataType.simpleString()
    return (parts.select("slice", "docs").groupBy("slice").cogroup(answers.groupBy("of")).applyInArrow(
        finish, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"))
