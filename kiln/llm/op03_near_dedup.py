"""Near-duplicate documents: MinHash bands, odd sketches, exact check, components.

1. Every text becomes its set of word shingles (hashed to 64 bits), a MinHash
   signature of ``BANDS * ROWS`` samples, one key per band, and an odd sketch:
   each (sample number, sample value) flips one of ``SKETCH_BITS`` bits, so the
   XOR of two sketches holds the parity of the samples that differ and its
   population count estimates their number, precisely when it is small.
2. Texts with the same shingle set form a class; its smallest id stands for it.
3. In every band bucket the members are paired with the bucket's smallest
   member (a star, not all pairs). Pairs whose sketches and set sizes allow the
   similarity are checked on the full sets.
4. Links give components. Members of a bucket that are still in another
   component than the bucket's smallest member may yet be linked with other
   members. In buckets of at most ``SMALL`` members they are paired with those
   (so many pairs for each member at most). In larger ones, groups of near
   copies that are no star, a prefix-filtered join finds the pairs. There the
   members of all buckets whose smallest members are in one component form one
   group (a member meets a group once, in however many of its buckets): with L
   the set of the component's smallest member, two sets a and x are similar
   only if their differences from L overlap in (|a+L| + |x+L| - t) / 2 elements
   (+ is the symmetric difference, t the largest |a+x| that the sizes and the
   threshold allow), so they share one of the rarest elements of the
   differences. Copies with edits of their own share none, and make no pairs.

No candidate is dropped in step 4. At similarity 0.8 a pair shares no band with
probability (1 - 0.8^4)^24 < 3e-6; the sketch bound dismisses a true pair with
about 1e-8 (``ALLOWED_DIFFERENT`` is six standard deviations above the mean).

Defined results: texts that are null or have no words have the empty set and
link with nothing; with fewer words than a shingle the whole sequence is one
shingle; rows with equal ids are one document; rows with a null id get
themselves (a null component) and are kept; extra columns are never touched.
Ids that are not integers (strings, for instance) are given back as they are, in
their own order; inside they are numbered in that order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import col, numbered, stored, with_ids, with_numbers
from kiln.llm.graph import components
from kiln.llm.textbytes import LOWER, NON_SPACE, bound_batches, inside_one_text, mix, slices, window_hashes, words_of

BANDS, ROWS = 24, 4
SKETCH_BITS = 512
#: Of BANDS * ROWS samples, so many may differ by the sketch's estimate (mean at 0.8: 19, deviation 3.9).
ALLOWED_DIFFERENT = 43
#: Members of a bucket up to which pairs are made directly.
SMALL = 32
#: Members of a large group that share one copy of its smallest member's set.
PER_PART = 256
#: A group's element counts travel in so many shares, and so many of them are added up at once.
SHARES, FAN = 8, 256
#: Same threshold as a bound of the XOR's population count.
XOR_BOUND = int(SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** (2 * ALLOWED_DIFFERENT)))

_SAMPLES = np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)
_FACTOR = (mix(_SAMPLES) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_SHIFT = (mix(_SAMPLES + np.uint64(1000)) >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within the text, and each text's first place."""
    w = words_of(texts, NON_SPACE, LOWER)
    n = np.diff(w.first)
    at = inside_one_text(w.first, size)
    h = window_hashes(w.hash, size)[at] if len(at) else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(n)), n)[at]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):  # the whole sequence is one shingle
        whole = np.array([window_hashes(w.hash[w.first[i]:w.first[i + 1]], int(n[i]))[0] for i in short], np.uint64)
        h, owner = np.concatenate([h, whole]), np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    h, owner = h[new], owner[new]
    return h, np.searchsorted(owner, np.arange(len(n) + 1))


def signatures(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text with a non-empty set: MinHash samples, band keys, odd sketch words."""
    begin = first[:-1][np.diff(first) > 0]
    x = (sets >> np.uint64(32)).astype(np.uint32)
    sample = np.empty((len(begin), BANDS * ROWS), np.uint32)
    for k in range(BANDS * ROWS):
        v = x * _FACTOR[k] + _SHIFT[k]
        v ^= v >> np.uint32(15)
        sample[:, k] = np.minimum.reduceat(v, begin) if len(begin) else 0
    keyed = mix(sample.astype(np.uint64) + (_SAMPLES << np.uint64(32)))
    bands = mix(keyed.reshape(len(begin), BANDS, ROWS).cumsum(axis=2)[:, :, -1])
    bit = (keyed >> np.uint64(40)) % np.uint64(SKETCH_BITS)
    flips = np.zeros((len(begin), SKETCH_BITS), np.uint8)
    np.add.at(flips, (np.arange(len(begin))[:, None], bit.astype(np.int64)), 1)
    sketch = np.packbits(flips & 1, axis=1).view(np.int64)
    return sample, bands, sketch


def sketched(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """One row per document: id, n (set size), same (two hashes of the set), bands, sketch."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, first = shingle_sets(part.column(1), shingle)
                n = np.diff(first)
                full = np.flatnonzero(n)
                _, bands, sketch = signatures(sets, first)
                same = np.zeros((len(n), 2), np.uint64)
                if len(full):
                    same[full, 0] = np.add.reduceat(mix(sets), first[full])
                    same[full, 1] = np.add.reduceat(mix(sets * np.uint64(0x9E3779B97F4A7C15) + np.uint64(7)), first[full])
                per_row = np.zeros(len(n) + 1, np.int64)

                def lists(values: np.ndarray, width: int) -> pa.Array:
                    per_row[1:] = np.cumsum((n > 0) * width)
                    return pa.ListArray.from_arrays(pa.array(per_row.astype(np.int32)),
                                                    pa.array(values.astype(np.int64).ravel()))

                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n.astype(np.int64)), pa.array(same[:, 0].view(np.int64)),
                     pa.array(same[:, 1].view(np.int64)), lists(bands.view(np.int64), BANDS),
                     lists(sketch, SKETCH_BITS // 64)],
                    ["id", "n", "same1", "same2", "bands", "sketch"])

    return docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text")).mapInArrow(
        run, "id long, n long, same1 long, same2 long, bands array<long>, sketch array<long>")


def _sets_of(texts: DataFrame, shingle: int) -> DataFrame:
    """(id, shingles) of the given (id, text) rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, first = shingle_sets(part.column(1), shingle)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(sets.view(np.int64)))],
                    ["id", "shingles"])

    return texts.mapInArrow(run, "id long, shingles array<long>")


def _may_be_similar(percent: int) -> Column:
    """Sizes and odd sketches of (n1, sketch1) and (n2, sketch2) allow the similarity."""
    differ = F.lit(0)
    for k in range(SKETCH_BITS // 64):
        differ = differ + F.bit_count(F.col("sketch1")[k].bitwiseXOR(F.col("sketch2")[k]))
    return ((100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2")) & (differ <= XOR_BOUND))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Those pairs (a, b) of class ids that pass the sketches and then the check on the full sets."""
    side = classes.select("id", "n", "sketch")
    hopeful = stored(
        pairs.join(side.toDF("a", "n1", "sketch1"), "a").join(side.toDF("b", "n2", "sketch2"), "b")
        .filter(_may_be_similar(percent)).select("a", "b"))
    wanted = hopeful.select(F.col("a").alias("id")).union(hopeful.select("b")).distinct()
    # by a shuffle at every size, so that what small inputs need tells what large ones do
    sets = stored(_sets_of(docs.join(wanted.hint("merge"), "id").select("id", "text"), shingle))
    common = F.size(F.array_intersect("s1", "s2"))
    return (hopeful.join(sets.toDF("a", "s1"), "a").join(sets.toDF("b", "s2"), "b")
            .filter(100 * common >= percent * (F.size("s1") + F.size("s2") - common)).select("a", "b"))


def _small_rest(placed: DataFrame) -> DataFrame:
    """Pairs of small buckets' members in different components, one of them not in the leader's."""
    apart = placed.filter("component <> main").select("bucket", F.col("id").alias("a"), F.col("component").alias("ca"))
    other = placed.select("bucket", F.col("id").alias("b"), F.col("component").alias("cb"), "main")
    return apart.join(other, "bucket").filter("ca <> cb and (cb = main or a < b)").select("a", "b")


def _cells(elements: np.ndarray) -> np.ndarray:
    return (mix(elements.view(np.uint64)) >> np.uint64(48)).astype(np.int64)


def _packed_cells(cells: np.ndarray, counts: np.ndarray) -> bytes:
    return cells.astype(np.uint16).tobytes() + counts.astype(np.int64).tobytes()


def _unpacked_cells(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(packed) // 10
    return np.frombuffer(packed, np.uint16, n), np.frombuffer(packed, np.int64, n, 2 * n)


def _cell_counts(differ: DataFrame) -> DataFrame:
    """(main, share, packed): how many elements of a group fall into each of 65 536 hashed cells, in ``SHARES`` shares
    of the cells; parts count their own members, then ``FAN`` counts at a time are added up, so no task meets a
    large group's members or all of its parts."""

    def count(group: pa.Table) -> pa.Table:
        total = np.bincount(_cells(group.column("elements").combine_chunks().flatten().to_numpy()), minlength=1 << 16)
        used = np.flatnonzero(total)
        edges = np.searchsorted(used, np.arange(SHARES + 1) * ((1 << 16) // SHARES))
        rows = [(s, _packed_cells(used[a:b], total[used[a:b]])) for s, (a, b) in enumerate(zip(edges[:-1], edges[1:]))]
        main, part = (group.column(c)[0].as_py() for c in ("main", "part"))
        return pa.table({"main": [main] * SHARES, "part": [part] * SHARES, "share": pa.array([r[0] for r in rows], pa.int32()),
                         "packed": pa.array([r[1] for r in rows], pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(1 << 16, np.int64)
        for packed in group.column("packed").to_pylist():
            cells, counts = _unpacked_cells(packed)
            total[cells] += counts
        used = np.flatnonzero(total)
        return pa.table({"main": [group.column("main")[0].as_py()], "part": [group.column("part")[0].as_py()],
                         "share": pa.array([group.column("share")[0].as_py()], pa.int32()),
                         "packed": pa.array([_packed_cells(used, total[used])], pa.binary())})

    schema = "main long, part long, share int, packed binary"
    counts = differ.select("main", "part", "elements").groupBy("main", "part").applyInArrow(count, schema)
    most = differ.agg(F.max("parts")).first()[0] or 0
    while most > 1:
        counts = (counts.withColumn("part", F.floor(F.col("part") / FAN).cast("long")).groupBy("main", "share", "part")
                  .applyInArrow(add, schema))
        most = -(-most // FAN)
    return counts.select("main", "share", "packed")


def _prefixes(differ: DataFrame, percent: int) -> DataFrame:
    """(main, id, component, apart, n, d, element, place): the elements that a member of a group must share one of
    with whoever is similar to it, in the order of their cells' counts (any order common to a group will do; rare
    elements come first). An element alone in its cell finds nobody and is left out, but keeps its place."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        total = np.zeros(1 << 16, np.int64)
        for packed in right.column("packed").to_pylist():
            cells, counts = _unpacked_cells(packed)
            total[cells] = counts
        lists = left.column("elements").combine_chunks()
        n = left.column("n").to_numpy()
        size = lists.value_lengths().to_numpy()
        owner = np.repeat(np.arange(len(size)), size)
        elements = lists.flatten().to_numpy()
        often = total[_cells(elements)]
        order = np.lexsort((elements, often, owner))  # owners' elements stay together
        place = np.arange(len(order)) - np.repeat(np.cumsum(size) - size, size) + 1
        keep = (often[order] > 1) & (percent * (place - 1) <= (100 - percent) * n[owner])
        at = pa.array(owner[keep])
        return pa.table({c: left.column(c).combine_chunks().take(at) for c in ("main", "id", "component", "apart", "n")} | {
            "d": pa.array(size[owner[keep]].astype(np.int32)), "element": pa.array(elements[order][keep]),
            "place": pa.array(place[keep].astype(np.int32))})

    copies = _cell_counts(differ).join(differ.select("main", "part").distinct().toDF("main", "of"), "main").toDF("to", "share", "packed", "of")
    return differ.groupBy("main", "part").cogroup(copies.groupBy("to", "of")).applyInArrow(
        run, "main long, id long, component long, apart boolean, n int, d int, element long, place int")


def _large_rest(placed: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The same for large buckets, by a prefix join on the sets' differences from their component's smallest member."""
    group = placed.groupBy("main", "id").agg(F.first("component").alias("component"))
    sizes = group.groupBy("main").agg(F.count(F.lit(1)).alias("rows"), F.max(F.col("component") != F.col("main")).alias("open"))
    parts = sizes.filter("open").select("main", F.ceil(F.col("rows") / PER_PART).alias("parts"))
    group = stored(group.join(parts, "main").withColumn("apart", F.col("component") != F.col("main"))
                   .withColumn("part", F.pmod(F.xxhash64("id"), "parts")))
    wanted = group.select("id").union(group.select("main")).distinct()
    sets = stored(_sets_of(texts.join(wanted.hint("merge"), "id").select("id", "text"), shingle))
    # a copy of the smallest member's set for every part of its group, so that no task gathers a large group
    smallest = (group.select("main", "parts").distinct()
                .join(sets.groupBy(F.col("id").alias("main")).agg(F.min("shingles").alias("l")), "main")
                .select("main", "l", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")))
    differ = stored(group.join(sets.toDF("id", "s"), "id").join(smallest, ["main", "part"])
                    .select("main", "part", "parts", "id", "component", "apart", F.size("s").alias("n"),
                            F.concat(F.array_except("s", "l"), F.array_except("l", "s")).alias("elements")))
    ranked = stored(_prefixes(differ, percent))
    a = ranked.filter("apart").select("main", "element", *[F.col(c).alias(f"{c}1") for c in ("id", "component", "n", "d", "place")])
    b = ranked.select("main", "element", "apart", *[F.col(c).alias(f"{c}2") for c in ("id", "component", "n", "d", "place")])
    most = (F.col("n1") + F.col("n2")) * (100 - percent) / (100 + percent)
    fits = ((F.col("component1") != F.col("component2")) & (~F.col("apart") | (F.col("id1") < F.col("id2")))
            & (100 * F.least("n1", "n2") >= percent * F.greatest("n1", "n2"))
            & (2 * (F.col("place1") - 1) <= F.col("d1") - F.col("d2") + most)
            & (2 * (F.col("place2") - 1) <= F.col("d2") - F.col("d1") + most))
    return a.join(b, ["main", "element"]).filter(fits).select(F.col("id1").alias("a"), F.col("id2").alias("b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, n_shingles, component) for every row of ``docs``; component is the smallest linked id."""
    numbers = numbered(docs, id_col)
    if numbers is not None:
        found = near_duplicates(with_numbers(docs, numbers, id_col, text_col), "id", "text", shingle, percent)
        return with_ids(found, numbers, "id", "component")
    rows = stored(sketched(docs, id_col, text_col, shingle))
    texts = docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text"))
    known = rows.filter("n > 0 and id is not null")
    # one row per class; repeated ids (different texts under one id) may stand for several classes
    classes = stored(known.groupBy("same1", "same2").agg(
        F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", "bands", "sketch")]))
    smallest = classes.select("same1", "same2", "id")
    buckets = classes.select("id", F.explode("bands").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("id").alias("leader"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(buckets.join(leaders, "bucket"))
    star = members.filter("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    links = stored(_verified(star, classes, texts, shingle, percent))
    same = known.join(smallest.withColumnRenamed("id", "b"), ["same1", "same2"]).filter("id <> b").select(
        F.col("b").alias("a"), F.col("id").alias("b"))
    # members left in another component than their bucket's leader, where the bucket has others
    label = components(links)
    placed = members.filter("size > 2 and id <> leader").join(label.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    of_leader = label.select(F.col("node").alias("leader"), F.col("component").alias("main"))
    placed = stored(placed.join(of_leader, "leader", "left").withColumn("main", F.coalesce("main", "leader")))
    rest = _small_rest(placed.filter(F.col("size") <= SMALL)).union(
        _large_rest(placed.filter(F.col("size") > SMALL), texts, shingle, percent)).distinct()
    more = _verified(rest, classes, texts, shingle, percent)
    label = components(links.union(more).union(same))
    return (rows.select("id", F.col("n").alias("n_shingles"))
            .join(label.withColumnRenamed("node", "id"), "id", "left")
            .withColumn("component", F.coalesce("component", "id")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents (all columns) that are the smallest id of their component; null ids stay."""
    gone = near_duplicates(docs, id_col, text_col, **options).filter("component < id").select("id").distinct()
    name = "__gone__"
    while name in docs.columns:
        name += "_"
    return docs.join(gone.withColumnRenamed("id", name), col(id_col).cast(gone.schema["id"].dataType) == F.col(name), "left_anti")


def report(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Digest per document: doc_id, n_shingles, component_id, kept."""
    found = near_duplicates(docs, id_col, **options)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))
