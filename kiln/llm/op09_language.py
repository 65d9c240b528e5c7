"""Language identification by nearest centroids of TF-IDF n-gram vectors.

Texts become counts of their byte bigrams and trigrams (letters in lower case,
everything else in ASCII a space) hashed into ``DIMENSIONS`` places, damped by a
logarithm, weighted by inverse document frequency and scaled to length one.
Document frequencies cover all documents. From at most about ``per_lang``
labelled rows of each language (chosen by a hash of the id) spherical k-means
makes several centroids per language. A text gets the language of the centroid
with the largest cosine; ``rejected`` tells that it is farther from it than
nearly all of that language's sample (a text in none of the languages).

Only the document frequencies (``DIMENSIONS`` numbers) and the sample come to
the driver; the centroids go to the tasks.

Defined results: ``und`` with score 0 for null texts and texts without a
letter, and if nothing was learned; equal cosines go to the language first in
order; labelled rows with a null id are not learned from; extra columns are
not touched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import col
from kiln.llm.textbytes import LOWER, bound_batches, flat, slices

DIMENSIONS = 4096
_FOLD = LOWER.copy()
_FOLD[:0x41] = 0x20
_FOLD[0x5B:0x61] = 0x20
_FOLD[0x7B:0x80] = 0x20


def counts(texts: pa.Array) -> np.ndarray:
    """Row for each text: how often each place's n-grams occur."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    owner = np.repeat(np.arange(n), np.diff(offsets))
    # a space before and behind every text, so n-grams never cross texts unseen
    padded = np.full(len(data) + 2 * n, 0x20, np.uint32)
    text = np.repeat(np.arange(n), np.diff(offsets) + 2)
    padded[np.arange(len(data)) + 2 * owner + 1] = _FOLD[data]
    out = np.zeros(n * DIMENSIONS, np.int64)
    for size in (2, 3):
        if len(padded) < size:
            continue
        code = padded[:len(padded) - size + 1].copy()
        any_letter = code != 0x20
        for k in range(1, size):
            more = padded[k:len(padded) - size + 1 + k]
            any_letter |= more != 0x20
            code = (code << np.uint32(8)) | more
        keep = any_letter & (text[:len(code)] == text[size - 1:])
        place = ((code[keep] + np.uint32(size << 24)) * np.uint32(2654435761)) >> np.uint32(20)
        out += np.bincount(text[:len(code)][keep] * DIMENSIONS + place, minlength=n * DIMENSIONS)
    return out.reshape(n, DIMENSIONS)


def vectors(texts: pa.Array, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts(texts).astype(np.float32)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _few(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of at most 500 rows, for the dense vectors' sake."""
    for part in slices(batch):
        for i in range(0, part.num_rows, 500):
            yield part.slice(i, 500)


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts with a letter and, for each place, of texts that use it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(DIMENSIONS, np.int64)
        for batch in batches:
            for part in _few(batch):
                used = counts(part.column(0)) > 0
                total += used.sum(axis=0)
                n += int(used.any(axis=1).sum())
        yield pa.RecordBatch.from_pydict({"place": np.arange(-1, DIMENSIONS), "n": np.append(n, total)})

    rows = texts.select("text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    found = {r["place"]: r["n"] for r in rows}
    return found.get(-1, 0), np.array([found.get(i, 0) for i in range(DIMENSIONS)], np.float64)


def spherical_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """k centroids of unit rows (fewer if rows are few), started far apart from each other."""
    centres = [x.mean(axis=0)]
    while len(centres) < min(k, len(x)):
        nearest = np.max(x @ np.array(centres).T, axis=1)
        centres.append(x[int(nearest.argmin())])
    c = np.array(centres)
    for _ in range(rounds):
        c = c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
        own = (x @ c.T).argmax(axis=1)
        c = np.array([x[own == j].mean(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
    return c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)


class Model:
    def __init__(self, idf: np.ndarray, languages: list[str], centroids: np.ndarray, owner: np.ndarray, least: np.ndarray):
        self.idf, self.languages, self.centroids, self.owner, self.least = idf, languages, centroids, owner, least

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        n = len(texts)
        lettered = np.array(pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_pylist(), bool)
        if not self.languages:
            return ["und"] * n, np.zeros(n), np.zeros(n, bool)
        similar = vectors(texts, self.idf) @ self.centroids.T
        best = similar.argmax(axis=1)
        score = np.clip(similar[np.arange(n), best], 0, 1).astype(np.float64)
        lang = self.owner[best]
        names = [self.languages[j] if ok else "und" for j, ok in zip(lang, lettered)]
        return names, np.where(lettered, score, 0.0), lettered & (score < self.least[lang])


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_lang: int = 400, centroids: int = 4) -> Model:
    """``learn`` marks the rows whose language may be used."""
    bound_batches(docs.sparkSession)
    texts = docs.select(col(text_col).cast("string").alias("text"))
    n, used = document_frequencies(texts)
    idf = (np.log((n + 1) / (used + 1)) + 1).astype(np.float32)
    labelled = docs.filter(learn & col(lang_col).isNotNull() & col(id_col).isNotNull()).select(
        F.pmod(F.xxhash64(col(id_col)), F.lit(1_000_000)).alias("draw"), col(lang_col).alias("lang"),
        col(text_col).cast("string").alias("text"))
    # about per_lang rows of each language: those whose draw lies below its share
    share = F.coalesce(F.lit(per_lang) * 1_000_000 / F.col("rows"), F.lit(0))
    sizes = labelled.filter("text is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    sample = labelled.join(F.broadcast(sizes), "lang").filter(F.col("draw") < share).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _few(pa.RecordBatch.from_arrays([batch.column(1), batch.column(0)], ["text", "lang"])):
                x = vectors(part.column(0), idf).astype(np.float16)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"])

    rows = sample.mapInArrow(run, "lang string, x binary").toArrow()
    langs = np.array(rows.column("lang").to_pylist(), object)
    names = sorted(set(langs.tolist()))
    centres, owner, least = [], [], []
    for j, name in enumerate(names):
        picked = [v.as_py() for v, lang in zip(rows.column("x"), langs) if lang == name]
        x = np.array(sorted(picked), dtype=object)
        x = np.stack([np.frombuffer(v, np.float16).astype(np.float32) for v in x])
        c = spherical_means(x[x.any(axis=1)] if x.any() else x, centroids)
        centres.append(c)
        owner += [j] * len(c)
        least.append(float(np.quantile((x @ c.T).max(axis=1), 0.005)) * 0.5)
    return Model(idf, names, np.concatenate(centres) if centres else np.zeros((0, DIMENSIONS), np.float32),
                 np.array(owner, np.int64), np.array(least))


def predicted(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (doc_id, held_out, text) with the prediction in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _few(batch):
                names, score, rejected = model.predict(part.column(2))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                    ["doc_id", "held_out", "lang_pred", "score", "rejected"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, lang_pred string, score double, rejected boolean")


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts`` (null for a null id)."""
    return F.pmod(F.crc32(col(id_col).cast("string").cast("binary")), F.lit(parts))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
           fitted: Callable[..., Model] = fit, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected; learned from rows outside fold 0 of 5."""
    model = fitted(docs, F.coalesce(fold(id_col, 5) != 0, F.lit(False)), id_col, text_col, lang_col, **options)
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(fold(id_col, 5) == 0, F.lit(False)).alias("held_out"),
                       col(text_col).cast("string").alias("text"))
    return predicted(rows, model)
