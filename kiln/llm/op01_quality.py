"""Quality rules: hashed n-gram likelihood ratio of trusted against raw text.

Unigrams and bigrams of words are hashed into ``BUCKETS`` buckets. Two
multinomials are counted over them: the raw one over all documents, the target
one over trusted documents (labelled good, a sample of at most
``max_trusted`` rows chosen by a hash of the id). A document's score is the
mean over its n-grams of log p_target - log p_raw, in whole millionths so that
the sum does not depend on order, and documents below ``min_score`` are
rejected: n-grams that trusted text never uses lower it.

Before that, base rules look at the document itself: fewer than 20 words, or
more than 30 percent of the words inside 8-word windows that repeat within the
text, fail. Everything is built-in functions on one row; the only shuffle is
the sum of the bucket counts, and only those ``BUCKETS`` counts come to the
driver.

Defined results: null or wordless texts have zero in every count and fail the
base rules; without trusted rows every weight is zero and the method rejects
nothing; repeated rows are judged one by one; extra columns are carried by
``quality_filter`` in a struct, so no name can clash.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import col, packed, unpacked

BUCKETS = 1 << 14
WINDOW = 8
SPACE = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _pair_bucket(h: Column, x: Column, i: Column) -> Column:
    return F.pmod(F.xxhash64(x, F.get(h, i + 1)), F.lit(BUCKETS)).cast("int")


def buckets(text: Column) -> Column:
    """Bucket of every unigram and bigram of words."""
    return let(word_hashes(text), lambda h: F.concat(
        F.transform(h, lambda x: F.pmod(x, F.lit(BUCKETS)).cast("int")),
        F.slice(F.transform(h, lambda x, i: _pair_bucket(h, x, i)), F.lit(1), F.greatest(F.size(h) - 1, F.lit(0)))))


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        trusted_col: str = "doc_id", max_trusted: int = 20_000, smoothing: float = 1.0) -> list[int]:
    """Weight of every bucket in millionths of a nat."""
    chosen = (trusted.select(col(trusted_col).alias("trusted")).filter("trusted is not null").distinct()
              .orderBy(F.xxhash64("trusted"), "trusted").limit(max_trusted))
    counts = (docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
              .join(F.broadcast(chosen), F.col("id") == F.col("trusted"), "left")
              .select(F.col("trusted").isNotNull().cast("long").alias("good"), F.explode(buckets(F.col("text"))).alias("bucket"))
              .groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"), F.sum("good").alias("target")))
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for r in counts.collect():  # BUCKETS rows at most
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not sum(target):
        return [0] * BUCKETS
    all_raw, all_target = sum(raw) + smoothing * BUCKETS, sum(target) + smoothing * BUCKETS
    return [round(1e6 * (math.log((t + smoothing) / all_target) - math.log((r + smoothing) / all_raw)))
            for t, r in zip(target, raw)]


def _repeat_words(g: Column) -> Column:
    """Words inside windows (hashes in order) that occur more than once."""
    ordered = F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    starts = let(ordered, lambda s: F.array_sort(F.transform(
        F.filter(s, lambda x, k: (F.get(s, k + 1)["h"] == x["h"]) | ((k > 0) & (F.get(s, k - 1)["h"] == x["h"]))),
        lambda x: x["i"])))
    none = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(starts, none, lambda a, i: F.struct(
        i.alias("last"), (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n")), lambda a: a["n"])


def features(text: Column, weights: list[int]) -> Column:
    """Struct n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, millionths (of the n-grams' sum)."""
    text = F.coalesce(text, F.lit(""))
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def of_words(w: Column) -> Column:
        return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.struct(
            F.size(w).alias("n_words"),
            F.length(F.concat_ws("", w)).alias("word_chars"),
            F.when(F.size(w) < WINDOW, 0).otherwise(let(F.slice(
                F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)])),
                F.lit(1), F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
                lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(_repeat_words(g)))
            ).alias("n_repeat_words"),
            (F.aggregate(h, F.lit(0).cast("long"), lambda a, x: a + F.get(table, F.pmod(x, F.lit(BUCKETS)).cast("int")))
             + F.aggregate(F.transform(h, lambda x, i: F.when(i < F.size(h) - 1, F.get(table, _pair_bucket(h, x, i))).otherwise(0)),
                           F.lit(0).cast("long"), lambda a, x: a + x)).alias("millionths")))

    return let(words(text), lambda w: F.struct(
        of_words(w).alias("of_words"),
        F.length(F.regexp_replace(text, "[^#*$%&|<>]+", "")).alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))


def judged(docs: DataFrame, weights: list[int], text_col: str = "text", min_score: float = -0.05) -> DataFrame:
    """``doc`` (all columns as a struct) and the counts, base_failed, score and kept of every row."""
    made = packed(docs, text_col).withColumn("f", features(F.col("doc").getField(text_col), weights))
    w = F.col("f.of_words")
    grams = F.greatest(2 * w["n_words"] - 1, F.lit(1))
    counted = made.select(
        "doc", w["n_words"].cast("long").alias("n_words"), w["word_chars"].cast("long").alias("word_chars"),
        F.col("f.n_symbols").cast("long").alias("n_symbols"), F.col("f.n_dup_lines").cast("long").alias("n_dup_lines"),
        w["n_repeat_words"].cast("long").alias("n_repeat_words"), (w["millionths"] / grams / 1e6).alias("score"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= min_score))


def quality_filter(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_score: float = -0.05, **options) -> DataFrame:
    """The documents (all columns) that pass the base rules and the likelihood ratio."""
    found = judged(docs, fit(docs, trusted, id_col, text_col, **options), text_col, min_score)
    return found.filter("kept").select(*unpacked(found, docs.columns))


def report(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           min_score: float = -0.05, **options) -> DataFrame:
    """Counts and verdict per document."""
    found = judged(docs.select(col(id_col), col(text_col)), fit(docs, trusted, id_col, text_col, **options), text_col, min_score)
    return found.select(F.col("doc").getField(id_col).alias("doc_id"), "n_words", "word_chars", "n_symbols",
                        "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")
