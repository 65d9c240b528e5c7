"""SentencePiece encoding as a lattice, and decoding.

A word (leading spaces and what follows up to the next space; line feeds stand
alone; of any length) has an edge for every piece of the
vocabulary that is one of its substrings, and one of byte pieces for every code
point that is no piece. Its tokens are the path with the largest sum of the
model's piece scores; equal sums prefer the longer last piece.

Relational form: words are exploded into their substrings of bounded length,
joined with the piece table on equality, the edges are grouped by word, and the
search is a fold over the sorted edges with Spark's ``aggregate``. It encodes
the ``frequent`` most frequent words of the whole corpus, a table of bounded
size that every task gets. The other words are as many as the corpus has rare
words: the same search runs on their distinct forms inside the task that reads
them (vectorised over words), because giving them back to their documents
would shuffle every occurrence. Words of more than ``LONG_BYTES`` bytes are
searched alone, in blocks that carry the search's state on. All forms give the
same tokens for any word.

Decoding joins the pieces' bytes; byte pieces are their byte. Encoding is
lossless: ``decode(encode(text)) == text`` for every text.

Defined results: null texts have a null list of tokens, empty texts an empty
one; repeated rows are encoded one by one; extra columns are not touched. The
piece model's file is a parameter; the model is never trained here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.frames import col
from kiln.llm.textbytes import Spans, bound_batches, flat, slices

#: Code points of a word in the table of frequent words at most.
LONGEST = 32
#: Bytes of a word that is searched together with others at most.
LONG_BYTES = 1024
#: Bytes whose edges are held at once.
BLOCK = 16_384
SEARCH_BYTES = 500_000
#: Score of a code point that has to be written in byte pieces: below every ordinary piece.
BYTES_SCORE = -40_000
WORD_BOUNDARY = "(?<! )(?= )|(?<=\\n)|(?=\\n)"


class Pieces:
    """Vocabulary of a SentencePiece model: ordinary pieces with scores, and the byte pieces."""

    def __init__(self, model_file: str | None = None):
        import sentencepiece

        if model_file is None:
            import public_tokenizers

            model_file = str(public_tokenizers.path("piece_bpe_32k.model"))
        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = model.get_piece_size()
        self.text: list[str] = []
        self.id: list[int] = []
        self.score: list[int] = []
        self.byte_id = [0] * 256
        self.bytes = [b""] * self.size  # what an id decodes to; control pieces decode to nothing
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_id[value] = i
                self.bytes[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = piece.replace("▁", " ")
                self.text.append(piece)
                self.id.append(i)
                self.score.append(round(model.get_score(i)))
                self.bytes[i] = piece.encode()

    @property
    def longest(self) -> int:
        return max(map(len, self.text))

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(zip(self.text, self.id, self.score)), "piece string, id int, score long")


def relational_encode(words: DataFrame, pieces: Pieces) -> DataFrame:
    """(word, ids) of distinct words by explode, join, grouping and a fold."""
    spark = words.sparkSession
    cut = (words.select("word", F.explode(F.sequence(F.lit(1), F.length("word"))).alias("at"))
           .select("word", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(pieces.longest), F.length("word") - F.col("at") + 1))).alias("size"))
           .select("word", (F.col("at") - 1).alias("start"), (F.col("at") - 1 + F.col("size")).alias("end"),
                   F.substring("word", F.col("at"), F.col("size")).alias("piece"), "size"))
    code = F.hex(F.encode("piece", "UTF-8"))
    byte_ids = F.array(*[F.lit(i) for i in pieces.byte_id])
    as_bytes = F.transform(F.sequence(F.lit(0), F.octet_length("piece") - 1), lambda k: F.get(
        byte_ids, F.conv(F.substring(code, 2 * k + 1, F.lit(2)), 16, 10).cast("int")))
    # the piece table is as large as the model's vocabulary, so every task can have it
    edges = (cut.join(F.broadcast(pieces.frame(spark)), "piece", "left").filter("id is not null or size = 1")
             .select("word", F.struct(
                 "end", "start", F.coalesce("score", F.lit(BYTES_SCORE)).cast("long").alias("score"),
                 F.when(F.col("id").isNotNull(), F.array("id")).otherwise(as_bytes).alias("ids")).alias("edge")))
    grouped = edges.groupBy("word").agg(F.array_sort(F.collect_list("edge")).alias("edges"))
    origin = F.array(F.struct(F.lit(0).cast("long").alias("score"), F.lit(-1).alias("start"), F.array().cast("array<int>").alias("ids")))

    def step(best, edge):
        total = F.get(best, edge["start"])["score"] + edge["score"]
        node = F.array(F.struct(total.alias("score"), edge["start"].alias("start"), edge["ids"].alias("ids")))
        return (F.when(F.size(best) <= edge["end"], F.concat(best, node))
                .when(total > F.get(best, edge["end"])["score"], F.concat(F.slice(best, F.lit(1), edge["end"]), node))
                .otherwise(best))

    folded = F.aggregate("edges", origin, step, lambda best: F.reverse(F.transform(best, lambda x, k: F.struct(
        k.alias("at"), x["start"].alias("start"), x["ids"].alias("ids")))))
    last = F.struct(F.lit(-2).alias("at"), F.array().cast("array<int>").alias("ids"))
    path = F.aggregate(folded, last, lambda a, x: F.when((a["at"] == -2) | (a["at"] == x["at"]), F.struct(
        x["start"].alias("at"), F.concat(x["ids"], a["ids"]).alias("ids"))).otherwise(a), lambda a: a["ids"])
    return grouped.select("word", path.alias("ids"))


def frequent_words(docs: DataFrame, text_col: str, most: int) -> DataFrame:
    """The ``most`` words that occur most often in all documents (ties by word)."""
    words = docs.select(F.explode(F.split(F.coalesce(col(text_col).cast("string"), F.lit("")), WORD_BOUNDARY)).alias("word"))
    return (words.filter(F.length("word").between(1, LONGEST)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "word").limit(most).select("word"))


class Lattice:
    """The search for many words at once, and the frequent words' known answers."""

    def __init__(self, pieces: Pieces, known: list[tuple[str, list[int]]]):
        raw = [t.encode() for t in pieces.text]
        size = np.array([len(r) for r in raw])
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        h = Spans(np.frombuffer(b"".join(raw), np.uint8)).hash(first, first + size)
        self.by_size = {}
        for n in np.unique(size):
            own = np.flatnonzero(size == n)
            own = own[np.argsort(h[own])]
            self.by_size[int(n)] = (h[own], np.array(pieces.id)[own], np.array(pieces.score)[own])
        self.byte_id = np.array(pieces.byte_id, np.int32)
        words = [w.encode() for w, _ in known]
        size = np.array([len(w) for w in words], np.int64)
        first = np.cumsum(size) - size
        h = Spans(np.frombuffer(b"".join(words), np.uint8)).hash(first, first + size)
        order = np.argsort(h)
        self.known = h[order]
        lists = [known[i][1] for i in order]
        self.known_first = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
        self.known_ids = np.array([i for x in lists for i in x], np.int32)

    def search(self, data: np.ndarray, spans: Spans, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of tokens of each word, tokens) of the words' byte ranges."""
        size = end - start
        node0 = np.concatenate(([0], np.cumsum(size + 1)))  # a word of n bytes has nodes 0..n
        word = np.repeat(np.arange(len(start)), size)
        inner = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
        at = start[word] + inner
        left = end[word] - at
        node = node0[word] + inner
        lead = (data[at] & 0xC0) != 0x80
        width = np.where(data[at] < 0x80, 1, np.where(data[at] < 0xE0, 2, np.where(data[at] < 0xF0, 3, 4)))
        single = np.zeros(len(at), bool)
        froms, tos, ids, scores = [], [], [], []
        for n, (hashes, piece, score) in self.by_size.items():
            fit = np.flatnonzero((left >= n) & lead)
            if not len(fit):
                continue
            h = spans.hash(at[fit], at[fit] + n)
            k = np.searchsorted(hashes, h).clip(0, len(hashes) - 1)
            same = hashes[k] == h
            fit, k = fit[same], k[same]
            single[fit[width[fit] == n]] = True
            froms.append(node[fit])
            tos.append(node[fit] + n)
            ids.append(piece[k])
            scores.append(score[k])
        alone = np.flatnonzero(lead & ~single)
        froms.append(node[alone])
        tos.append(node[alone] + width[alone])
        ids.append(np.full(len(alone), -1))
        scores.append(np.full(len(alone), BYTES_SCORE))
        source, target, ids, scores = (np.concatenate(x) for x in (froms, tos, ids, scores))
        owner = np.searchsorted(node0, target, side="right") - 1
        depth = target - node0[owner]
        order = np.lexsort((source, target, depth))
        source, target, ids, scores, depth = (x[order] for x in (source, target, ids, scores, depth))
        best = np.full(node0[-1], np.iinfo(np.int64).min // 4)
        best[node0[:-1]] = 0
        back = np.full(node0[-1], -1)
        edges = np.concatenate(([0], np.flatnonzero(depth[1:] != depth[:-1]) + 1, [len(depth)]))
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            total = best[source[a:b]] + scores[a:b]
            new = np.concatenate(([True], target[a + 1:b] != target[a:b - 1]))
            begin = np.flatnonzero(new)
            top = np.maximum.reduceat(total, begin)
            group = np.cumsum(new) - 1
            hit = np.flatnonzero(total == top[group])
            keep = hit[np.concatenate(([True], group[hit][1:] != group[hit][:-1]))]  # the first: the longest piece
            best[target[a:b][begin]] = top
            back[target[a:b][begin]] = a + keep
        # walk back from all words' ends at once, one token of each word at a time
        here = node0[1:] - 1
        live = np.arange(len(start))
        parts = []
        while len(live):
            e = back[here[live]]
            live, e = live[e >= 0], e[e >= 0]
            if not len(live):
                break
            parts.append((live, e))
            here[live] = source[e]
        if not parts:
            return np.zeros(len(start), np.int64), np.zeros(0, np.int32)
        live = np.concatenate([p[0] for p in parts])
        e = np.concatenate([p[1] for p in parts])
        turn = np.concatenate([np.full(len(p[0]), k) for k, p in enumerate(parts)])
        order = np.lexsort((-turn, live))
        live, e = live[order], e[order]
        # a path step of byte pieces is as many tokens as its code point has bytes
        wide = np.where(ids[e] >= 0, 1, target[e] - source[e])
        out = np.repeat(ids[e], wide).astype(np.int32)
        step = np.repeat(np.arange(len(e)), wide)
        some = np.flatnonzero(out < 0)
        if len(some):
            within = some - (np.cumsum(wide) - wide)[step[some]]
            s = source[e[step[some]]]
            w = live[step[some]]
            out[some] = self.byte_id[data[start[w] + (s - node0[w]) + within]]
        return np.bincount(live, weights=wide, minlength=len(start)).astype(np.int64), out

    def search_long(self, data: np.ndarray, spans: Spans, start: int, end: int) -> np.ndarray:
        """Tokens of one word of any length; only the edges that end in one block are held."""
        size = end - start
        best = [0] + [None] * size
        back = np.zeros(size + 1, np.int32)  # bytes of the last piece of the best path to each place
        last = np.full(size + 1, -1, np.int32)  # its id, or -1 for byte pieces
        sizes = sorted(self.by_size)
        for low in range(0, size, BLOCK):
            high = min(size, low + BLOCK)  # edges that end in (low, high]
            a = max(0, low - max(4, sizes[-1]))
            own = data[start + a:start + high]
            lead = (own & 0xC0) != 0x80
            width = np.where(own < 0x80, 1, np.where(own < 0xE0, 2, np.where(own < 0xF0, 3, 4)))
            single = np.zeros(len(own), bool)
            froms, wide, ids, scores = [], [], [], []
            for n in sizes:
                hashes, piece, score = self.by_size[n]
                fit = np.flatnonzero(lead[:max(0, len(own) - n + 1)])
                if not len(fit):
                    continue
                h = spans.hash(start + a + fit, start + a + fit + n)
                k = np.searchsorted(hashes, h).clip(0, len(hashes) - 1)
                same = hashes[k] == h
                fit, k = fit[same], k[same]
                single[fit[width[fit] == n]] = True
                froms.append(a + fit)
                wide.append(np.full(len(fit), n))
                ids.append(piece[k])
                scores.append(score[k])
            alone = np.flatnonzero(lead & ~single)
            froms.append(a + alone)
            wide.append(width[alone])
            ids.append(np.full(len(alone), -1))
            scores.append(np.full(len(alone), BYTES_SCORE))
            source, wide, ids, scores = (np.concatenate(x) for x in (froms, wide, ids, scores))
            target = source + wide
            inside = np.flatnonzero((target > low) & (target <= high))
            inside = inside[np.lexsort((source[inside], target[inside]))]  # the longest piece first
            for s, t, i, score in zip(*(x[inside].tolist() for x in (source, target, ids, scores))):
                total = best[s] + score
                if best[t] is None or total > best[t]:
                    best[t] = total
                    back[t] = t - s
                    last[t] = i
        parts, at = [], size
        while at:
            n = int(back[at])
            i = int(last[at])
            parts.append(self.byte_id[data[start + at - n:start + at]] if i < 0 else [i])
            at -= n
        return np.concatenate(parts[::-1]).astype(np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of all texts and each text's first, and the texts' bytes and offsets."""
        data, offsets = flat(texts)
        space, feed = data == 0x20, data == 0x0A
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        edge[1:-1] |= (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
        start = np.flatnonzero(edge[:-1])
        end = np.append(start[1:], len(data))[:len(start)]
        spans = Spans(data)
        h = spans.hash(start, end)
        distinct, sample, which = np.unique(h, return_index=True, return_inverse=True)
        count = np.zeros(len(distinct), np.int64)
        begin = np.zeros(len(distinct), np.int64)
        pool = [self.known_ids]
        filled = len(self.known_ids)
        if len(self.known):
            k = np.searchsorted(self.known, distinct).clip(0, len(self.known) - 1)
            have = self.known[k] == distinct
            count[have] = (self.known_first[k + 1] - self.known_first[k])[have]
            begin[have] = self.known_first[k][have]
        else:
            have = np.zeros(len(distinct), bool)
        size = end[sample] - start[sample]
        for i in np.flatnonzero(~have & (size > LONG_BYTES)):
            ids = self.search_long(data, spans, int(start[sample[i]]), int(end[sample[i]]))
            count[i], begin[i] = len(ids), filled
            filled += len(ids)
            pool.append(ids)
        rare = np.flatnonzero(~have & (size <= LONG_BYTES))
        chunk = np.cumsum(size[rare]) // SEARCH_BYTES
        for own in np.split(rare, np.flatnonzero(np.diff(chunk)) + 1) if len(rare) else ():
            n, ids = self.search(data, spans, start[sample[own]], end[sample[own]])
            count[own] = n
            begin[own] = filled + np.cumsum(n) - n
            filled += len(ids)
            pool.append(ids)
        pool = np.concatenate(pool)
        n = count[which]
        total = np.cumsum(n)
        at = np.repeat(begin[which] - (total - n), n) + np.arange(total[-1] if len(total) else 0)
        tokens = pool[at]
        first_word = np.searchsorted(start, offsets)
        return tokens, np.concatenate(([0], total))[first_word], data, offsets


class Decoder:
    """Bytes of token lists."""

    def __init__(self, pieces: Pieces):
        size = np.array([len(b) for b in pieces.bytes], np.int64)
        self.first = np.concatenate(([0], np.cumsum(size)))
        self.data = np.frombuffer(b"".join(pieces.bytes), np.uint8)

    def decode(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens one after the other, and where each token's begin."""
        n = self.first[tokens + 1] - self.first[tokens]
        total = np.cumsum(n)
        at = np.repeat(self.first[tokens] - (total - n), n) + np.arange(total[-1] if len(total) else 0)
        return self.data[at], np.concatenate(([0], total))


def lattice_for(docs: DataFrame, pieces: Pieces, text_col: str, frequent: int) -> Lattice:
    known = relational_encode(frequent_words(docs, text_col, frequent), pieces).toArrow()  # `frequent` rows at most
    return Lattice(pieces, list(zip(known.column("word").to_pylist(), known.column("ids").to_pylist())))


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None,
            frequent: int = 65_536) -> DataFrame:
    """(id, tokens) of every row; tokens is an array of piece ids."""
    bound_batches(docs.sparkSession)
    lattice = lattice_for(docs, Pieces(model_file), text_col, frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                tokens, first, _, _ = lattice.encode(part.column(1))
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(tokens),
                                                 mask=part.column(1).is_null())
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, tokens array<int>").withColumnRenamed("id", id_col)


def decoded(rows: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens", model_file: str | None = None) -> DataFrame:
    """(id, text) of every row of token lists; bytes that are no UTF-8 (never made by ``encoded``) become U+FFFD."""
    bound_batches(rows.sparkSession)
    decoder = Decoder(Pieces(model_file))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for tokens in batch.column(1):
                if not tokens.is_valid:
                    texts.append(None)
                    continue
                raw, _ = decoder.decode(np.array(tokens.values.to_numpy(zero_copy_only=False), np.int64))
                texts.append(raw.tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["id", "text"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(col(id_col).alias("id"), col(tokens_col).alias("tokens")).mapInArrow(
        run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model_file: str | None = None,
           frequent: int = 65_536) -> DataFrame:
    """Digest per document: doc_id, n_tokens, tokens_sha256 (little-endian 32-bit ids), round_trip."""
    bound_batches(docs.sparkSession)
    pieces = Pieces(model_file)
    lattice, decoder = lattice_for(docs, pieces, text_col, frequent), Decoder(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                tokens, first, data, offsets = lattice.encode(part.column(1))
                raw, begin = decoder.decode(tokens)
                back = begin[first]
                raw, data, ids = raw.tobytes(), data.tobytes(), tokens.astype("<i4").tobytes()
                same = [raw[a:b] == data[c:d] for a, b, c, d in zip(back[:-1], back[1:], offsets[:-1], offsets[1:])]
                digest = [hashlib.sha256(ids[4 * a:4 * b]).hexdigest() for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(first).astype(np.int64)), pa.array(digest, pa.string()), pa.array(same, pa.bool_())],
                    ["doc_id", "n_tokens", "tokens_sha256", "round_trip"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, tokens_sha256 string, round_trip boolean")
