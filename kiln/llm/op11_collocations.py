"""Collocations: phrases of several words that occur together more often than apart.

Texts (A-Z lowered) are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at
spaces and tabs into words; everything is counted per language. Exact counts of
all phrases that occur at least ``least`` times come from weighted acyclic
automata (``transducer.py``), length by length, since a phrase can only be
frequent if both phrases without its first and without its last word are:

1. Tasks turn their texts into shards of one language: word numbers, and the
   distinct words with counts, dealt out by a hash. Each hash bucket adds the
   shards' counts up, numbers the frequent words (in hash order) and answers
   the shards.
2. For each length every shard builds a transducer of its sorted n-grams with
   their counts and cuts it into prefix ranges: the first word's hash names the
   range, and a word that holds more than its share of all words is spread over
   several ranges by its second word. A range unites its transducers, adds up
   the weights, keeps the frequent n-grams and tells each shard which of its
   n-grams they are, so a shard goes on with the stretches of text in which all
   n-grams are frequent. A range gets an n-gram once a shard at most.
3. For the parts of every frequent phrase, requests go to the part's range and
   are composed with its transducer; there each part also learns the count of
   the most frequent longer phrase around it.
4. Scores are exact (whole numbers of any size); the first ``top`` phrases of a
   language come from a ranking by (language, salt) and then by language.

All exchanges are Spark shuffles of packed rows, written to the shared folder
between the steps. The driver only learns the number of words.

Defined results: null texts are empty, a null language is ``und`` (and equal to
one so named); texts without words, and languages without a phrase, give no
rows; repeated documents count each; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.frames import col, stored
from kiln.llm.textbytes import bound_batches, mix
from kiln.llm.transducer import Transducer, distinct, spread, squeeze, union

SHARD_BYTES = 16_000_000
RANGE_BYTES = 32_000_000
BLOCK_BYTES = 4_000_000
#: A-Z lowered, piece ends as line feeds, tabs as spaces.
FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x0A if c in b".,;:!?" or 0x0A <= c <= 0x0D else 0x20 if c == 0x09 else c
             for c in range(256))
#: Bits of a word's number that tell words with one hash apart.
SAME_HASH = 24


class Numbers(dict):
    """Word -> number in order of appearance; 0 is the end of a piece, 1 nothing."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": 1})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def numbered(data: bytes, numbers: Numbers) -> np.ndarray:
    """Numbers of the words of folded text, one 0 between pieces."""
    out, start = [np.zeros(1, np.int32)], 0
    while start < len(data):
        stop = data.find(b"\n", start + BLOCK_BYTES) + 1 or len(data)
        words = data[start:stop].replace(b"\n", b" \n ").split(b" ")
        out.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
        start = stop
    x = np.concatenate(out)
    x = x[x != 1]
    return x[np.append(True, (x[1:] != 0) | (x[:-1] != 0))]


def shards(docs: DataFrame, text_col: str, lang_col: str, bits: int) -> DataFrame:
    """Rows of two kinds: a shard's text (bucket -1), and its words in each hash bucket."""

    def made(number: int, lang: str, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        x = numbered(b"\n".join(texts).translate(FOLD), numbers)
        words = list(numbers)[2:]
        seed = zlib.crc32(lang.encode())
        hashes = np.fromiter((zlib.crc32(w, seed) for w in words), np.int64, len(words))
        counts = np.bincount(x, minlength=len(words) + 2)[2:]
        bucket = hashes >> (32 - bits)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange((1 << bits) + 1))
        rows = [(-1, int(counts.sum()), squeeze([x]), b"")]
        for b in np.flatnonzero(np.diff(edges)).tolist():
            own = order[edges[b]:edges[b + 1]]
            rows.append((b, 0, squeeze([own + 2, counts[own], hashes[own]]), b" ".join([words[k] for k in own.tolist()])))
        for k in range(0, len(rows), 64):
            bucket_, n, body, text = zip(*rows[k:k + 64])
            m = len(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * m, pa.int64()), pa.array([lang] * m, pa.string()), pa.array(bucket_, pa.int32()), pa.array(n, pa.int64()),
                 pa.array([body[i] if b < 0 else None for i, b in enumerate(bucket_)], pa.binary()),
                 pa.array([body[i] if b >= 0 else None for i, b in enumerate(bucket_)], pa.binary()), pa.array(text, pa.binary())],
                ["shard", "lang", "bucket", "n", "tokens", "counts", "words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 1
                if size[lang] >= SHARD_BYTES:
                    yield from made(number, lang, held.pop(lang))
                    del size[lang]
                    number += 1
            while sum(size.values()) >= 2 * SHARD_BYTES:  # many languages at once: the largest goes first
                lang = max(size, key=size.get)
                yield from made(number, lang, held.pop(lang))
                del size[lang]
                number += 1
        for lang in sorted(held):
            yield from made(number, lang, held[lang])
            number += 1

    rows = docs.select(F.coalesce(col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       col(text_col).cast("string").alias("text")).filter("text <> ''")
    return rows.mapInArrow(run, "shard long, lang string, bucket int, n long, tokens binary, counts binary, words binary")


def table_of(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})


def word_counts(parts: DataFrame, least: int) -> DataFrame:
    """Of each hash bucket: frequent words with their ids and counts (shard -1), and answers to the shards."""

    def merge(group: pa.Table) -> pa.Table:
        rows = []
        for shard, lang, counts, words in zip(*(group.column(c).to_pylist() for c in ("shard", "lang", "counts", "words"))):
            local, n, hashes = spread(counts)
            rows.append((shard, lang, local, n.tolist(), hashes.tolist(), words.split(b" ")))
        total: dict[tuple[str, bytes], int] = {}
        hash_of: dict[tuple[str, bytes], int] = {}
        for _, lang, _, n, hashes, words in rows:
            for w, c, h in zip(words, n, hashes):
                key = (lang, w)
                total[key] = total.get(key, 0) + c
                hash_of[key] = h
        often = sorted((hash_of[key], key) for key, c in total.items() if c >= least)
        ids: dict[tuple[str, bytes], int] = {}
        for k, (h, key) in enumerate(often):
            ids[key] = h << SAME_HASH if k == 0 or often[k - 1][0] != h else ids[often[k - 1][1]] + 1
        out = []
        for lang in sorted({key[0] for key in ids}):
            own = [key for _, key in often if key[0] == lang]
            out.append((-1, lang, squeeze([np.array([ids[k] for k in own]), np.array([total[k] for k in own])]), b" ".join(k[1] for k in own)))
        for shard, lang, local, _, _, words in rows:
            hit = [(k, ids[lang, w], total[lang, w]) for k, w in enumerate(words) if (lang, w) in ids]
            if hit:
                place, own, n = (np.array(x) for x in zip(*hit))
                out.append((shard, lang, squeeze([local[place], own, n]), b""))
        return table_of(out, ["to", "lang", "body", "words"], [pa.int64(), pa.string(), pa.binary(), pa.binary()])

    return (parts.filter("bucket >= 0").select("bucket", "shard", "lang", "counts", "words").groupBy("bucket")
            .applyInArrow(merge, "to long, lang string, body binary, words binary"))


@dataclass
class Ranges:
    """Which range counts an n-gram: a function of its first two words and the first one's count."""

    bits: int
    total: int

    def of(self, first: np.ndarray, n: np.ndarray, second: np.ndarray) -> np.ndarray:
        count = 1 << self.bits
        spread_over = np.minimum(np.maximum(1, -(-n * count // max(1, self.total))), count)
        second_place = (second >> SAME_HASH) * spread_over >> 32
        return ((mix(first.astype(np.uint64)) >> np.uint64(40)).astype(np.int64) + second_place) % count


def windows(text: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct n-grams of ``text`` (-1: a gap) in order; where each occurrence begins and which it is."""
    gap = np.append(np.cumsum(text < 0), 0)
    at = np.flatnonzero(text[:max(0, len(text) - n + 1)] >= 0)
    at = at[gap[at + n - 1] == gap[at]]
    if not len(at):
        return np.zeros((0, n), np.int64), at, at
    table, place = distinct(np.stack([text[at + k] for k in range(n)], axis=1), width)
    return table, at, place


STATE = ["range", "shard", "lang", "text", "body"]
STATE_TYPES = [pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary()]
STATE_SCHEMA = "range int, shard long, lang string, text binary, body binary"


def emitted(shard: int, lang: str, n: int, text: np.ndarray, ids: np.ndarray, counts: np.ndarray, ranges: Ranges) -> list[tuple]:
    """The shard's text for later lengths, and its transducer of n-grams in pieces."""
    grams, _, place = windows(text, n, len(ids))
    if not len(grams):
        return []
    route = ranges.of(ids[grams[:, 0]], counts[grams[:, 0]], ids[grams[:, 1]])
    order = np.argsort(route, kind="stable")
    rows = [(-1, shard, lang, squeeze([text, ids, counts]), None)]
    for r, piece in Transducer.pieces(ids[grams[order]], np.bincount(place)[order], route[order]):
        rows.append((r, shard, lang, None, piece.dump()))
    return rows


def begun(parts: DataFrame, words: DataFrame, ranges: Ranges) -> DataFrame:
    """Shards with the frequent words' numbers (in id order), rare words as gaps, and their pairs of words."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        for shard, lang, tokens in zip(*(left.column(c).to_pylist() for c in ("shard", "lang", "tokens"))):
            answers = [spread(b) for b in right.column("body").to_pylist()]
            if answers:
                local, ids, counts = (np.concatenate(x) for x in zip(*answers))
                order = np.argsort(ids)
                x = spread(tokens)[0]
                number = np.full(int(x.max()) + 1, -1, np.int64)
                number[local[order]] = np.arange(len(order))
                rows += emitted(shard, lang, 2, number[x], ids[order], counts[order], ranges)
        return table_of(rows, STATE, STATE_TYPES)

    texts = parts.filter("bucket < 0").select("shard", "lang", "tokens")
    return texts.groupBy("shard").cogroup(words.filter("to >= 0").select("to", "body").groupBy("to")).applyInArrow(run, STATE_SCHEMA)


def united(state: DataFrame, least: int) -> DataFrame:
    """Of each range: the transducer of the frequent n-grams of a language (shard -1), and a bit for each n-gram of a shard."""

    def run(group: pa.Table) -> pa.Table:
        by_lang: dict[str, list[tuple[int, bytes]]] = {}
        for shard, lang, body in zip(*(group.column(c).to_pylist() for c in ("shard", "lang", "body"))):
            by_lang.setdefault(lang, []).append((shard, body))
        r, rows = group.column("range")[0].as_py(), []
        for lang, own in sorted(by_lang.items()):
            parts = [Transducer.load(body) for _, body in own]
            grams, weights, place = union(parts)
            often = weights >= least
            if not often.any():
                continue
            rows.append((r, -1, lang, None, Transducer.of(grams[often], weights[often]).dump()))
            ends = np.cumsum([len(p.weights) for p in parts])
            for (shard, _), bits in zip(own, np.split(often[place], ends[:-1])):
                if bits.any():
                    rows.append((r, shard, lang, np.packbits(bits).tobytes(), None))
        return table_of(rows, STATE, STATE_TYPES)

    return state.filter("range >= 0").select("range", "shard", "lang", "body").groupBy("range").applyInArrow(run, STATE_SCHEMA)


def continued(state: DataFrame, answers: DataFrame, n: int, ranges: Ranges) -> DataFrame:
    """Shards reduced to stretches in which all (n - 1)-grams are frequent, and their n-grams."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        bits = {r: np.frombuffer(b, np.uint8) for r, b in zip(right.column("of").to_pylist(), right.column("bits").to_pylist())}
        for shard, lang, packed in zip(*(left.column(c).to_pylist() for c in ("shard", "lang", "text"))):
            if not bits:
                break
            text, ids, counts = spread(packed)
            grams, at, place = windows(text, n - 1, len(ids))
            route = ranges.of(ids[grams[:, 0]], counts[grams[:, 0]], ids[grams[:, 1]])
            order = np.argsort(route, kind="stable")
            edges = np.searchsorted(route[order], np.arange((1 << ranges.bits) + 1))
            often = np.zeros(len(grams), bool)
            for r, b in bits.items():
                own = order[edges[r]:edges[r + 1]]
                often[own] = np.unpackbits(b, count=len(own)).astype(bool)
            at = at[often[place]]
            # runs of neighbouring frequent (n - 1)-grams; one alone can't lie in a frequent n-gram
            begin = np.flatnonzero(np.append(True, np.diff(at) != 1)) if len(at) else np.zeros(0, np.int64)
            end = np.append(begin[1:], len(at))
            begin, end = begin[end - begin > 1], end[end - begin > 1]
            size = end - begin + n - 1  # words, and a gap behind them
            if not len(size):
                continue
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            new = text[np.minimum(np.repeat(at[begin], size) + step, len(text) - 1)]
            new[np.cumsum(size) - 1] = -1
            used, dense = np.unique(new[new >= 0], return_inverse=True)
            new[new >= 0] = dense
            rows += emitted(shard, lang, n, new, ids[used], counts[used], ranges)
        return table_of(rows, STATE, STATE_TYPES)

    told = answers.filter("shard >= 0").select(F.col("shard").alias("to"), F.col("range").alias("of"), F.col("text").alias("bits"))
    return (state.filter("range < 0").select("shard", "lang", "text").groupBy("shard")
            .cogroup(told.groupBy("to")).applyInArrow(run, STATE_SCHEMA))


@dataclass
class Counted:
    """``words``: (id, word, n) of frequent words; ``transducers``: (range, lang, body) of frequent n-grams;
    ``totals``: (lang, n) of all words."""

    words: DataFrame
    transducers: DataFrame
    totals: DataFrame
    ranges: Ranges


def counted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5, least: int = 100) -> Counted:
    bound_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(col(text_col).cast("string")))).first()[0] or 0
    bits = min(16, max(3, int(size // RANGE_BYTES).bit_length()))
    parts = stored(shards(docs, text_col, lang_col, bits))
    totals = parts.filter("bucket < 0").groupBy("lang").agg(F.sum("n").alias("n"))
    ranges = Ranges(bits, totals.agg(F.sum("n")).first()[0] or 0)
    words = stored(word_counts(parts, least))
    state = stored(begun(parts, words, ranges))
    found = []
    for n in range(2, longest + 1):
        answers = stored(united(state, least))
        found.append(answers.filter("shard < 0").select("range", "lang", "body"))
        if n < longest:
            state = stored(continued(state, answers, n + 1, ranges))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids, n = spread(body)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array([w.decode() for w in text.split(b" ")], pa.string()), pa.array(n)],
                                                 ["id", "word", "f"])

    vocabulary = words.filter("to < 0").select("body", "words").mapInArrow(listed, "id long, word string, f long")
    frame = found[0]
    for more in found[1:]:
        frame = frame.unionByName(more)
    return Counted(vocabulary, frame, totals, ranges)


def phrases(c: Counted) -> DataFrame:
    """(lang, ids, a) of all frequent phrases of two words and more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = Transducer.load(body)
                grams = t.paths()
                offsets = np.arange(len(grams) + 1, dtype=np.int32) * grams.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(grams.ravel())),
                     pa.array(t.weights)], ["lang", "ids", "a"])

    return c.transducers.select("lang", "body").mapInArrow(run, "lang string, ids array<long>, a long")


def part_counts(named: DataFrame, c: Counted) -> DataFrame:
    """From phrases with ids and word counts: answers (ids, k, side, n) on parts of two words and more, and
    (ids, longer) for phrases inside a phrase with one more word."""
    ranges = c.ranges

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, fs, a = (batch.column(k).to_pylist() for k in range(3))
            rows = []
            for own, f, n in zip(ids, fs, a):
                for k in range(1, len(own)):
                    if k >= 2:
                        rows.append((own, k, 0, own[:k], n, f[0]))
                    if len(own) - k >= 2:
                        rows.append((own, k, 1, own[k:], n, f[k]))
            if not rows:
                continue
            own, k, side, part, n, f = zip(*rows)
            first, second = (np.array([p[i] for p in part]) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges.of(first, np.array(f), second).astype(np.int32)), pa.array(own, pa.list_(pa.int64())), pa.array(k, pa.int32()),
                 pa.array(side, pa.int32()), pa.array(part, pa.list_(pa.int64())), pa.array(n, pa.int64())],
                ["at", "ids", "k", "side", "part", "a"])

    def composed(left: pa.Table, right: pa.Table) -> pa.Table:
        by_size: dict[int, list[Transducer]] = {}
        for body in right.column("body").to_pylist():
            t = Transducer.load(body)
            by_size.setdefault(len(t.arcs), []).append(t)
        ids, k, side, part, a = (left.column(c).to_pylist() for c in ("ids", "k", "side", "part", "a"))
        size = np.array([len(p) for p in part], np.int64)
        n = np.zeros(len(part), np.int64)
        for s in np.unique(size).tolist():
            own = np.flatnonzero(size == s)
            grams = np.array([part[i] for i in own.tolist()], np.int64)
            for t in by_size.get(s, []):  # one for each language; ids of languages differ
                n[own] += t.weights_of(grams)
        longer: dict[tuple[int, ...], int] = {}
        for i, p in enumerate(part):
            if len(p) + 1 == len(ids[i]):
                longer[tuple(p)] = max(longer.get(tuple(p), 0), a[i])
        m = len(longer)
        return pa.table({
            "ids": pa.array(ids + [list(p) for p in longer], pa.list_(pa.int64())), "k": pa.array(k + [None] * m, pa.int32()),
            "side": pa.array(side + [None] * m, pa.int32()), "n": pa.array(n.tolist() + [None] * m, pa.int64()),
            "longer": pa.array([None] * len(ids) + list(longer.values()), pa.int64())})

    requests = named.select("ids", "fs", "a").mapInArrow(asked, "at int, ids array<long>, k int, side int, part array<long>, a long")
    return requests.groupBy("at").cogroup(c.transducers.select("range", "body").groupBy("range")).applyInArrow(
        composed, "ids array<long>, k int, side int, n long, longer long")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = 5, least: int = 100,
                 percent: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every frequent phrase that no longer one makes needless."""
    c = counted(docs, text_col, lang_col, longest, least)
    at = F.posexplode("ids").alias("at", "id")
    named = stored(phrases(c).select("lang", "ids", "a", at).join(c.words, "id").groupBy("lang", "ids", "a").agg(
        F.array_sort(F.collect_list(F.struct("at", "f", "word"))).alias("w"))
        .select("lang", "ids", "a", F.col("w.f").alias("fs"), F.array_join("w.word", " ").alias("phrase")))
    answers = part_counts(named, c)
    rows = (named.select("ids", "lang", "a", "fs", "phrase", *[F.lit(None).cast(t).alias(x) for x, t in (("part", "struct<k:int,side:int,n:long>"), ("longer", "long"))])
            .unionByName(answers.select("ids", F.when(F.col("k").isNotNull(), F.struct("k", "side", "n")).alias("part"), "longer"), True))
    whole = (rows.groupBy("ids").agg(F.first("lang", True).alias("lang"), F.first("a", True).alias("a"), F.first("fs", True).alias("fs"),
                                     F.first("phrase", True).alias("phrase"), F.collect_list("part").alias("parts"), F.max("longer").alias("longer"))
             .filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(percent) * F.col("a")))
             .join(c.totals, "lang"))  # a row for each language

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, phrase, a, n, fs, parts = (batch.column(k).to_pylist() for k in range(6))
            best = []
            for own_a, own_n, f, given in zip(a, n, fs, parts):
                size = len(f)
                cut = {(1, 0): f[0], (size - 1, 1): f[-1]} | {(p["k"], p["side"]): p["n"] for p in given}
                best.append(min((1000 * own_a * own_n // (cut[k, 0] * cut[k, 1]), k, cut[k, 0], cut[k, 1]) for k in range(1, size)))
            score, _, left, right = zip(*best) if best else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(phrase, pa.string())] + [pa.array(x, pa.int64()) for x in (a, left, right, n, score)],
                ["lang", "phrase", "a", "l", "r", "n", "score"])

    return whole.select("lang", "phrase", "a", "n", "fs", "parts").mapInArrow(
        scored, "lang string, phrase string, a long, l long, r long, n long, score long")


def report(docs: DataFrame, top: int = 2_000, **options) -> DataFrame:
    """The first ``top`` collocations of every language: lang, rank, phrase, a, l, r, n, score."""
    rows = collocations(docs, **options)
    salts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    some = rows.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
