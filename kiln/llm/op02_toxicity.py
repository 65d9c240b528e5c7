"""Toxicity: noisy-channel deobfuscation, then a word score of the restored text.

Channel. A writer may hide a word by look-alike signs (``1d10t``), accents,
separators inside (``i.d.i.o.t``), spaced letters (``i d i o t``), repeated
letters (``idiooot``) or a wildcard (``id*ot``). Every such span is turned into
a lattice: each sign may stand for itself, for the letters it looks like, for
any letter (wildcards) or for nothing (separators, repetitions), at a cost.
Source. A character 4-gram model (27 signs, interpolated down to unigrams) is
counted over all documents. Viterbi search through the lattice finds the most
likely letters (a beam only bounds the cost of the exact search). Three fixed letters in a row leave the model one
state, so a lattice is searched in the parts between them, and a part met again is not searched again; spans that
show no sign of hiding restore to their plain letters without a search. Signs at a word's ends are punctuation
unless they may stand for letters: then both readings are in the lattice. Each
gap of spaced letters may also be a word edge.

Score. Restored words are marks if they single out toxic rows among the
labelled rows that may be learned from (a sample of at most ``max_labelled``,
chosen by a hash of the id); 4- and 5-grams of letters are marks if they do so
among the sample's rows without such a word. Each mark has the share of toxic
rows among those that have it. A text is clean with the product of its marks'
clean shares (noisy or), and without any mark its score is the share of toxic
rows among those with none.

What goes to the driver and the tasks is bounded: the 27^4 counts of the
model, the sample's ids, and at most twice ``max_marks`` marks.

Defined results: null and empty texts score like texts without a mark; without
labelled rows every score is 0; repeated rows are scored one by one; extra
columns are not touched.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.frames import col, stored
from kiln.llm.op03_near_dedup import shingle_sets, signatures
from kiln.llm.op09_language import fold
from kiln.llm.textbytes import bound_batches, flat, slices

# Letters that signs may stand for, and signs that may stand for nothing.
LOOKALIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i",
    "м": "m", "т": "t", "н": "h", "к": "k", "α": "a", "ο": "o", "ι": "i", "ß": "b",
}
WILDCARD = "*#?%&"
SEPARATOR = " .-_,'`~^:;/\\\"()[]{}<>*#|+=·•"
INVISIBLE = re.compile("[­​-‏⁠﻿]")
LETTERS = "abcdefghijklmnopqrstuvwxyz"
COST = {"lookalike": 1.0, "wildcard": 2.5, "separator": 0.2, "repeat": 0.1, "double": 4.0, "itself": 6.0}
#: States kept by the first search, whose path bounds the cost of the exact one.
BEAM = 2
#: States from which a step of the search is done on all 27^3 states at once.
DENSE = 300
#: Steps of a part whose letters are kept for the next time, and how many such parts.
PART, PARTS = 16, 50_000
#: Rounds of thinning near copies in the labelled sample.
ROUNDS = 8

_PLAIN = re.compile(r"\W*([A-Za-z]+)[\W_]*")
_RUN = re.compile(r"(.)\1\1")
_HIDING = frozenset(LOOKALIKE) | frozenset(WILDCARD)
_PUNCTUATION = rf"(?:[^\w{re.escape(''.join(sorted(_HIDING)))}]|_)+"
_EDGE = re.compile(rf"^{_PUNCTUATION}|{_PUNCTUATION}$")
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_HAS_LETTER = re.compile(r"[^\W\d_]")



class _Folded(dict):
    """A sign's letters without accents, for ``str.translate``."""

    def __missing__(self, code: int) -> str:
        self[code] = got = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        return got


_FOLDED = _Folded()

_CODE = np.zeros(256, np.uint32)
_CODE[0x41:0x5B] = np.arange(1, 27)
_CODE[0x61:0x7B] = np.arange(1, 27)


#: What one sign may stand for: letters, nothing or a word edge, with their cost.
Step = tuple[tuple[str, float], ...]


class CharModel:
    """Interpolated character 4-gram model over a-z and the word edge."""

    def __init__(self, counts: np.ndarray, strength: float = 4.0):
        n4 = counts.reshape(27, 27, 27, 27).astype(np.float64)
        p = np.full(27, 1 / 27)
        for n in (n4.sum(axis=(0, 1, 2)), n4.sum(axis=(0, 1)), n4.sum(axis=0), n4):
            total = n.sum(axis=-1, keepdims=True)
            p = (n + strength * np.broadcast_to(p, n.shape)) / (total + strength)
        cost = (-np.log(p)).astype(np.float32).reshape(27 ** 3, 27)
        self.cost = cost.tolist()
        self.dense = cost.astype(np.float64).reshape(27, 729, 27)
        self.parts: dict[tuple[int, bool, tuple[Step, ...]], str] = {}

    def decode(self, lattice: list[Step]) -> str:
        """Letters of the cheapest path; each step offers letters, nothing or a word edge (a space) with their cost."""
        out: list[str] = []
        part: list[Step] = []  # from a step with a choice to the third fixed letter in a row behind one
        start = context = fixed = 0  # letters before the part, and before this step as far as they are fixed
        for step in lattice:
            letter = step[0][0] if len(step) == 1 else " "
            if not letter:  # costs the same on every path
                continue
            if letter == " ":
                if not part:
                    start = context
                part.append(step)
                fixed = 0
                continue
            context = (context * 27 + ord(letter) - 96) % 19683
            if not part:
                out.append(letter)
                continue
            part.append(step)
            fixed += 1
            if fixed == 3:
                out.append(self._part(start, part, False))
                part = []
        if part:
            out.append(self._part(start, part, True))
        return "".join(out)

    def _part(self, start: int, part: list[Step], end: bool) -> str:
        """Letters of the cheapest path through a part, to a word edge if it is the lattice's end."""
        if len(part) > PART:
            return self._search(start, part, end)
        key = (start, end, tuple(part))
        got = self.parts.get(key)
        if got is None:
            got = self._search(start, part, end)
            if len(self.parts) >= PARTS:
                self.parts.clear()
            self.parts[key] = got
        return got

    def _search(self, start: int, part: list[Step], end: bool) -> str:
        if all(len(step) < 6 for step in part):  # without wildcards there are few states
            return self._decode(start, part, end, 0, math.inf)[1]
        most, text, whole = self._decode(start, part, end, BEAM, math.inf)
        return text if whole else self._decode(start, part, end, 0, most + 1e-6)[1]

    def _decode(self, start: int, lattice: list[Step], end: bool, beam: int, most: float) -> tuple[float, str, bool]:
        """Cost and letters of the cheapest path, and whether no state was left out but those that cost over ``most``."""
        states = {start: (0.0, "")}
        whole = True
        ahead = list(accumulate((min(price for _, price in step) for step in lattice[::-1]), initial=0.0))[::-1]
        for k, step in enumerate(lattice):
            if not beam and len(states) > DENSE:
                return 0.0, self._decode_dense(states, lattice[k:], end), True
            bound = most - ahead[k + 1]
            following: dict[int, tuple[float, str]] = {}
            for context, (spent, text) in states.items():
                row = self.cost[context]
                for letter, price in step:
                    if letter == " ":
                        if not context:
                            continue
                        total, to = spent + price + row[0], 0
                    elif letter:
                        code = ord(letter) - 96
                        total, to = spent + price + row[code], (context * 27 + code) % 19683
                    else:
                        total, to = spent + price, context
                    if total > bound:
                        continue
                    have = following.get(to)
                    if have is None or total < have[0]:
                        following[to] = (total, text + letter)
            if beam and len(following) > beam:
                whole = False
                following = dict(sorted(following.items(), key=lambda kv: (kv[1][0], kv[1][1]))[:beam])
            states = following
        return *min((spent + (self.cost[context][0] if end else 0.0), text) for context, (spent, text) in states.items()), whole

    def _decode_dense(self, states: dict[int, tuple[float, str]], lattice: list[Step], end: bool) -> str:
        """The rest of the search, each step on all states at once."""
        spent = np.full(19683, np.inf)
        for context, (total, _) in states.items():
            spent[context] = total
        taken = []
        for step in lattice:
            price = np.full(27, np.inf)
            for letter, own in step:
                if letter.strip():
                    price[ord(letter) - 96] = own
            options = dict(step)
            letters = np.flatnonzero(np.isfinite(price))
            best = np.full((729, 27), np.inf)
            oldest = np.zeros((729, 27), np.uint8)  # the sign that leaves the context
            if len(letters):
                total = spent.reshape(27, 729, 1) + self.dense[:, :, letters]
                oldest[:, letters] = total.argmin(axis=0)
                best[:, letters] = total.min(axis=0) + price[letters]
            best = best.ravel()
            edge = -1
            if " " in options:
                total = spent + self.dense.reshape(19683, 27)[:, 0]
                total[0] = np.inf
                if total.min() + options[" "] < best[0]:
                    edge = int(total.argmin())
                    best[0] = total[edge] + options[" "]
            stay = spent + options.get("", np.inf) < best
            best[stay] = spent[stay] + options.get("", np.inf)
            taken.append((oldest, stay, edge))
            spent = best
        at = int((spent + self.dense.reshape(19683, 27)[:, 0] if end else spent).argmin())
        out: list[str] = []
        for oldest, stay, edge in reversed(taken):
            if stay[at]:
                continue
            if not at and edge >= 0:
                out.append(" ")
                at = edge
                continue
            out.append(chr(96 + at % 27))
            at = int(oldest.ravel()[at]) * 729 + at // 27
        return states[at][1] + "".join(out[::-1])


def char_counts(texts: DataFrame) -> np.ndarray:
    """4-gram counts of all texts over the 27 signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(27 ** 4, np.int64)
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part.column(0))
                code = np.insert(_CODE[data], np.repeat(offsets, 2), 0)
                gram = ((code[:-3] * 27 + code[1:-2]) * 27 + code[2:-1]) * 27 + code[3:]
                total += np.bincount(gram, minlength=27 ** 4)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"gram": seen, "n": total[seen]})

    found = texts.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(27 ** 4, np.int64)
    out[found.column("gram").to_numpy()] = found.column("n").to_numpy()
    return out


@lru_cache(maxsize=10_000)
def _step(sign: str, empty: float) -> Step:
    """What a sign may stand for, and nothing at the cost ``empty`` if its place allows it."""
    plain = unicodedata.normalize("NFKD", sign)[:1].lower()
    options: dict[str, float] = {}

    def offer(letter: str, cost: float) -> None:
        options[letter] = min(cost, options.get(letter, math.inf))

    if plain in LETTERS and plain:
        offer(plain, 0.0)
    for letter in LOOKALIKE.get(sign, LOOKALIKE.get(plain, "")):
        offer(letter, COST["lookalike"])
    if sign in WILDCARD:
        for letter in LETTERS:
            offer(letter, COST["wildcard"])
    if sign in SEPARATOR or not options:
        offer("", COST["separator"] if sign in SEPARATOR else COST["itself"])
    if empty < math.inf:
        offer("", empty)
    return tuple(options.items())


def lattice(span: str) -> list[Step]:
    """What each sign of a span may stand for."""
    steps: list[Step] = []
    lengths = [len(m[0]) for m in re.finditer(r"(.)\1*", span, re.S) for _ in m[0]]
    first = next((k for k, sign in enumerate(span) if sign.isalnum()), -1)
    last = next((k for k in range(len(span) - 1, -1, -1) if span[k].isalnum()), len(span))
    for k, sign in enumerate(span):
        empty = math.inf
        if not first <= k <= last and all(letter for letter, _ in _step(sign, math.inf)):  # at an end it may be punctuation
            empty = COST["separator"] if lengths[k] > 2 or sign in "!?" and k > last else COST["itself"]
        if k and sign == span[k - 1]:  # a repeated sign may add nothing
            empty = min(empty, COST["double"] if lengths[k] == 2 else COST["repeat"])
        steps.append(_step(sign, empty))
    return steps


_GAP = (("", 0.0), (" ", 0.0))


class Restorer:
    """Restored words of texts; keeps a bounded cache of decoded spans."""

    def __init__(self, model: CharModel, cache: int = 200_000):
        self.model, self.size = model, cache
        self.words: dict[str, str] = {}

    def word(self, token: str) -> str:
        """Restored form of one token without white space ('' if it holds no letter or look-alike)."""
        got = self.words.get(token)
        if got is None:
            got = self._word(token)
            if len(self.words) >= self.size:
                self.words.clear()
            self.words[token] = got
        return got

    def _word(self, token: str) -> str:
        ascii = token.isascii()
        if ascii and token.isalpha() and not _RUN.search(token):
            return token.lower()
        plain = _PLAIN.fullmatch(token)
        if plain and not _RUN.search(plain[1]) and _HIDING.isdisjoint(token[:plain.start(1)] + token[plain.end(1):]):
            return plain[1].lower()
        token = _EDGE.sub("", token if ascii else INVISIBLE.sub("", token))
        if not _HAS_LETTER.search(token):
            return ""
        folded = (token if ascii else token.translate(_FOLDED)).lower()
        if folded.isascii() and folded.isalpha() and not _RUN.search(folded):
            return folded
        if folded.isalpha() and not any(c in LOOKALIKE for c in folded) and not _RUN.search(folded):
            return folded
        return self.model.decode(lattice(folded))

    def spaced(self, text: str) -> list[str]:
        """Restored words of runs of single signs."""
        return [w for m in _SPACED.finditer(text) for w in self.words_of_span(m[0])]

    def words_of_span(self, span: str) -> list[str]:
        """Restored words of a run of single signs, in which each gap may be a word edge."""
        key = " ".join(span.split())
        got = self.words.get(key)
        if got is None:
            folded = INVISIBLE.sub("", key).translate(_FOLDED).lower()
            steps = lattice("".join(folded.split())) if _HAS_LETTER.search(folded) else []
            got = self.model.decode([x for step in steps for x in (_GAP, step)][1:])
            if len(self.words) >= self.size:
                self.words.clear()
            self.words[key] = got
        return got.split()

    def restored(self, text: str) -> str:
        """The whole text restored: hidden words and spaced letters replaced, single spaces between words."""
        text = _SPACED.sub(lambda m: " ".join(self.words_of_span(m[0])) or m[0], text)
        return " ".join(self.word(t) or t for t in text.split())

    def word_set(self, text: str) -> set[str]:
        """Distinct restored words of a text (of spaced letters, the joined words too)."""
        out = {self.word(t) for t in set(text.split())}
        out.update(self.spaced(text))
        out.discard("")
        return out


@lru_cache(maxsize=20_000)
def features(word: str) -> frozenset[str]:
    """A restored word (with edges) and its 4- and 5-grams."""
    edged = f"^{word}$"
    return frozenset([edged, *[edged[i:i + n] for n in (4, 5) for i in range(len(edged) - n + 1)]])


def _labelled(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_id: str,
              label_col: str, max_labelled: int) -> DataFrame:
    """(text, toxic) of the sample. Its ids are few enough for every task by ``max_labelled``."""
    chosen = (labels.select(col(label_id).alias("labelled"), col(label_col).alias("toxic"))
              .filter("labelled is not null and toxic is not null").groupBy("labelled").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("labelled"), "labelled").limit(max_labelled))
    return (docs.filter(learn).select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
            .join(F.broadcast(chosen), F.col("id") == F.col("labelled")).select("text", "toxic", "id"))


def without_copies(sample: DataFrame) -> DataFrame:
    """The sample with one row of each group of near copies, so that a copied text's words count once.

    In each of ``ROUNDS`` rounds, rows that agree in two MinHash samples of their
    3-word shingles are thinned to the smallest id. The keys of the (bounded)
    sample are gone through at the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets, first = shingle_sets(part.column(0), 3)
                minima = np.zeros((part.num_rows, 2 * ROUNDS), np.uint64)
                some = np.diff(first) > 0
                minima[some] = signatures(sets, first)[0][:, :2 * ROUNDS]
                keys = (minima[:, ::2] << np.uint64(32)) | minima[:, 1::2]
                yield pa.RecordBatch.from_arrays([part.column(2), pa.array(keys.view(np.int64).tolist(), pa.list_(pa.int64()))], ["id", "keys"])

    id_type = sample.schema["id"].dataType.simpleString()
    rows = sorted(((r["id"], r["keys"]) for r in sample.mapInArrow(run, f"id {id_type}, keys array<long>").collect()))
    for k in range(ROUNDS):
        seen: set[int] = set()
        rows = [r for r in rows if not (r[1][k] in seen or seen.add(r[1][k]))]
    kept = sample.sparkSession.createDataFrame([(r[0],) for r in rows], f"kept {id_type}")
    return sample.join(F.broadcast(kept), F.col("id") == F.col("kept")).select("text", "toxic")


def marks_of(sample: DataFrame, model: CharModel, known: dict[str, float], whole: bool, surprise: float,
             odds: float, least: float, max_marks: int) -> dict[str, float]:
    """Marks of the sample's rows that have no known mark: whole words, or grams
    of letters. A mark is ``surprise`` deviations more frequent in toxic rows than
    by chance, toxic at ``odds`` to one, and in a share ``least`` of toxic rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, known)
        for batch in batches:
            toxic, clean = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = scorer.restore.word_set(text or "")
                if known and any(map(scorer.of_word, words)):
                    continue
                found = {"", *[f"^{w}$" for w in words]} if whole else {""}.union(*map(features, words))
                (toxic if label == 1 else clean).update(found)
            words = list(toxic | clean)
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array([toxic[w] for w in words], pa.int64()),
                 pa.array([clean[w] for w in words], pa.int64())], ["mark", "toxic", "clean"])

    counted = stored(sample.mapInArrow(run, "mark string, toxic long, clean long").groupBy("mark")
                     .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter("toxic > 0 or mark = ''"))
    both = counted.filter("mark = ''").first()
    if both is None:
        return {}
    t, c = both["toxic"], both["clean"]
    share = t / (t + c)
    n = F.col("toxic") + F.col("clean")
    unlikely = (F.col("toxic") - n * share) / F.sqrt(n * F.lit(max(share * (1 - share), 1e-9)))
    best = (counted.filter("mark <> ''").withColumn("surprise", unlikely)
            .filter((F.col("surprise") >= surprise) & (F.col("toxic") >= odds * F.col("clean"))
                    & (F.col("toxic") >= max(4.0, least * t)))
            .orderBy(F.desc("surprise"), "mark").limit(max_marks).collect())
    return {r["mark"]: (r["toxic"] + 2 * share) / (r["toxic"] + r["clean"] + 2) for r in best}


class Scorer:
    """Marks of texts, by token, with a bounded cache."""

    def __init__(self, model: CharModel, marks: dict[str, float], cache: int = 200_000):
        self.restore, self.marks, self.size = Restorer(model), marks, cache
        self.heads = {mark[:4] for mark in marks if len(mark) < 6 and not (mark[:1] == "^" and mark[-1:] == "$")}
        self.by_token: dict[str, set[str]] = {}  # only tokens with marks
        self.unmarked: set[str] = set()

    def of_word(self, word: str) -> set[str]:
        """Marks among the features of a restored word."""
        edged = f"^{word}$"
        if edged in self.marks or self.heads and not self.heads.isdisjoint([edged[i:i + 4] for i in range(len(edged) - 3)]):
            return features(word) & self.marks.keys()
        return set()

    def of_token(self, token: str) -> set[str]:
        got = self.by_token.get(token)
        if got is None:
            word = self.restore.word(token)
            got = self.of_word(word) if word else set()
            if len(self.by_token) + len(self.unmarked) >= self.size:
                self.by_token.clear()
                self.unmarked.clear()
            if got:
                self.by_token[token] = got
            else:
                self.unmarked.add(token)
        return got

    def of_text(self, text: str) -> set[str]:
        found = set().union(*map(self.of_token, set(text.split()) - self.unmarked))
        for word in self.restore.spaced(text):
            found |= self.of_word(word)
        return found


def share_unmarked(sample: DataFrame, model: CharModel, marks: dict[str, float]) -> float:
    """Share of toxic rows among those of the sample that have no mark (0 without any row)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, marks)
        for batch in batches:
            plain = [label for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                     if not scorer.of_text(text or "")]
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(plain)], pa.int64()),
                                              "toxic": pa.array([sum(x == 1 for x in plain)], pa.int64())})

    r = sample.mapInArrow(run, "n long, toxic long").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic")).first()
    return (r["toxic"] or 0) / ((r["n"] or 0) + 1)


def toxicity(rows: DataFrame, model: CharModel, marks: dict[str, float], unmarked: float) -> DataFrame:
    """``rows`` (doc_id, held_out, text) with score and the marks found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, marks)
        for batch in batches:
            found = [sorted(scorer.of_text(text or "")) for text in batch.column(2).to_pylist()]
            score = [1 - math.prod(1 - marks[w] for w in hits) if hits else unmarked for hits in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score, pa.float64()), pa.array(found, pa.list_(pa.string()))],
                ["doc_id", "held_out", "score", "marks"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {id_type}, held_out boolean, score double, marks array<string>")


def restored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, restored_text) of every row."""
    bound_batches(docs.sparkSession)
    texts = docs.select(col(text_col).cast("string").alias("text"))
    model = CharModel(char_counts(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(model)
        for batch in batches:
            out = [None if t is None else restore.restored(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], [id_col, "restored_text"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(col(id_col), col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"`{id_col}` {kind}, restored_text string")


def report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
           label_col: str = "toxic", max_labelled: int = 20_000, max_marks: int = 2_000) -> DataFrame:
    """doc_id, held_out, score, predicted, marks; labels are learned outside fold 2 of 4."""
    bound_batches(docs.sparkSession)
    model = CharModel(char_counts(docs.select(col(text_col).cast("string").alias("text"))))
    learn = F.coalesce(fold(id_col, 4) != 2, F.lit(False))
    # the sample's ids are drawn among those that may be learned from
    usable = labels.filter(F.coalesce(fold(label_id, 4) != 2, F.lit(False)))
    sample = stored(_labelled(docs, usable, learn, id_col, text_col, label_id, label_col, max_labelled))
    sample = stored(without_copies(sample))
    marks = marks_of(sample, model, {}, True, 5.0, 3.0, 0.01, max_marks)
    marks |= marks_of(sample, model, marks, False, 7.0, 6.0, 0.02, max_marks)
    unmarked = share_unmarked(sample, model, marks)
    rows = docs.select(col(id_col).alias("doc_id"), F.coalesce(fold(id_col, 4) == 2, F.lit(False)).alias("held_out"),
                       col(text_col).cast("string").alias("text"))
    return toxicity(rows, model, marks, unmarked).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))
