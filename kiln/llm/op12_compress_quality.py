"""Quality classification by compression.

Two zstandard dictionaries are trained, one on text labelled good and one on
text labelled bad. Every whole text is cut into blocks of ``block`` bytes and
each block is compressed with either dictionary; the difference of the summed
sizes divided by the text's bytes (``gain``: bytes that the good dictionary
saves per byte) tells which dictionary knows the text better. Blocks are
compressed one by one so that a dictionary counts as much at a long text's end
as at its beginning. A rising curve (isotonic regression) fitted on labelled rows
that no dictionary has seen turns the gain into the share of good texts at it.

What comes to the driver is bounded by parameters: at most ``per_class``
labelled ids of each label are drawn (those with the smallest hash of their
id); half of them give at most ``blocks`` blocks each class for the
dictionaries, the other half one number each for the curve. The drawn ids and
the two dictionaries (``dictionary_bytes`` each) are what tasks receive.

Defined results: null texts count as empty; an empty text has gain 0 and the
curve's value there. Without labelled rows of both classes the score is the
share of good labels among those there are (0.5 without any). Labels other
than 0 and 1 and null ids are not learned from; an id labelled both ways
counts as bad; labelled ids without a document count for nothing. Repeated
documents are scored each for itself. Columns other than the named ones are
not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import col
from kiln.llm.op09_language import fold
from kiln.llm.textbytes import bound_batches

LEVEL = 3


def cut(data: bytes, block: int) -> list[bytes]:
    return [data[i:i + block] for i in range(0, len(data), block)]


def dictionary(blocks: list[bytes], size: int) -> bytes:
    """A trained dictionary, or the blocks themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(blocks)[-size:]


class Sizes:
    """Compressed size of texts under a dictionary."""

    def __init__(self, data: bytes, block: int):
        self.block = block
        self.compress = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data), write_content_size=False,
            write_checksum=False, write_dict_id=False).compress

    def of(self, data: bytes) -> int:
        return sum(len(self.compress(x)) for x in cut(data, self.block))


def gains(texts: pa.Array, good: Sizes, bad: Sizes) -> list[float]:
    out = []
    for text in texts.cast(pa.binary()).to_pylist():
        out.append((bad.of(text) - good.of(text)) / len(text) if text else 0.0)
    return out


@dataclass
class Model:
    """``good`` and ``bad`` are dictionaries; without them the score is constant. The curve
    runs through the points (``at``, ``share``) and is flat beyond the outer ones."""

    good: bytes | None
    bad: bytes | None
    at: np.ndarray
    share: np.ndarray
    block: int

    def score(self, gain: np.ndarray) -> np.ndarray:
        return np.interp(gain, self.at, self.share)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corners of the rising curve nearest to y: neighbours that would make it fall are pooled,
    a pool is level from its first to its last x, and lines run between pools."""
    order = np.lexsort((-y, x))  # equal gains are pooled
    pools: list[list[float]] = []  # weight, weighted sum of y, first x, last x
    for a, b, w in zip(x[order].tolist(), y[order].tolist(), weight[order].tolist()):
        pools.append([w, w * b, a, a])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            w2, y2, _, last = pools.pop()
            w1, y1, first, _ = pools[-1]
            pools[-1] = [w1 + w2, y1 + y2, first, last]
    w, sy, first, last = np.array(pools).T
    share = np.clip(sy / w, 0.001, 0.999)
    corners = np.stack([first, last], axis=1).ravel()
    keep = np.append(True, np.diff(corners) > 0)
    return corners[keep], np.repeat(share, 2)[keep]


def drawn(labels: DataFrame, learn: Column, id_col: str, label_col: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(id, label, draw) of at most ``per_class`` ids of each label, and how many ids carry each label."""
    one = (labels.filter(learn & col(id_col).isNotNull() & col(label_col).isin(0, 1))
           .groupBy(col(id_col).alias("id")).agg(F.min(col(label_col)).cast("int").alias("label"))
           .withColumn("draw", F.xxhash64("id")))
    sizes = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [one.filter(F.col("label") == k).orderBy("draw", "id").limit(per_class) for k in (0, 1)]
    return parts[0].unionByName(parts[1]), sizes


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = 4_000, blocks: int = 4_000, block: int = 1_024,
        dictionary_bytes: int = 112_640) -> Model:
    """``learn`` marks the rows of ``labels`` that may be learned from."""
    bound_batches(docs.sparkSession)
    ids, sizes = drawn(labels, learn, id_col, label_col, per_class)
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / total if total else 0.5
    constant = Model(None, None, np.zeros(1), np.array([prior]), block)
    if len(sizes) < 2:
        return constant
    texts = (docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")).filter("text <> ''")
             .join(F.broadcast(ids), "id"))  # 2 * per_class ids at most

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, piece = [], []
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                found = [x for x in cut(text, block) if len(x) >= 8]
                label += [k] * len(found)
                piece += found
            yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(piece, pa.binary())], ["label", "piece"])

    halves = F.pmod(F.shiftright("draw", 7), F.lit(2))
    cuts = (texts.filter(halves == 0).select("label", "text").mapInArrow(pieces, "label int, piece binary")
            .withColumn("order", F.xxhash64("piece")))
    made = []
    for k in (1, 0):
        rows = cuts.filter(F.col("label") == k).orderBy("order", "piece").limit(blocks).select("piece").toArrow()
        made.append(rows.column("piece").to_pylist())
    if not made[0] or not made[1]:
        return constant
    good, bad = (dictionary(x, dictionary_bytes) for x in made)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, b = Sizes(good, block), Sizes(bad, block)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(gains(batch.column(1), g, b), pa.float64())],
                                             ["label", "gain"])

    rows = texts.filter(halves == 1).select("label", "text").mapInArrow(measure, "label int, gain double").toArrow()
    y = rows.column("label").to_numpy().astype(float)
    if len(set(y.tolist())) < 2:
        return constant
    # each class weighs as much as it does among all labelled ids
    weight = np.where(y == 1, prior / (y == 1).sum(), (1 - prior) / (y == 0).sum()) * len(y)
    return Model(good, bad, *isotonic(rows.column("gain").to_numpy(), y, weight), block)


def scored(rows: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """``rows`` (doc_id, held_out, text) with gain, score and predicted in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = None if model.good is None else (Sizes(model.good, model.block), Sizes(model.bad, model.block))
        for batch in batches:
            gain = np.array(gains(batch.column(2), *sizes) if sizes else [0.0] * batch.num_rows, np.float64)
            score = model.score(gain)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(gain), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "gain", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, gain double, score double, predicted int")


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", **options) -> DataFrame:
    """doc_id, held_out, gain, score, predicted; learned from labelled rows outside fold 0 of 5."""
    model = fit(docs, labels, F.coalesce(fold(id_col, 5) != 0, F.lit(False)), id_col, text_col, label_col, **options)
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(fold(id_col, 5) == 0, F.lit(False)).alias("held_out"),
                       F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    return scored(rows, model)
