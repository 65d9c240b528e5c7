"""Each operator against a brute-force version or an exact property, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.llm import (op01_quality, op02_toxicity, op03_near_dedup, op04_extract, op05_chat, op06_substring_dedup,
                      op07_pieces, op08_decontaminate, op09_language, op10_suffix_dedup)
from kiln.llm.lyndon import suffix_array

ODD = [None, "", " \n\t", "one", "ONE", "é ü\n\nü é", "a b " * 40, "x" * 3000]


def corpus(n: int = 60, seed: int = 1) -> list[tuple[int, str | None]]:
    """Texts with copies, near copies, shared passages and odd ones."""
    r = random.Random(seed)
    vocabulary = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    texts: list[str | None] = [" ".join(r.choices(vocabulary, k=r.randint(1, 160))) for _ in range(n)]
    base = r.choices(vocabulary, k=150)
    for _ in range(45):  # a bucket of more than op03_near_dedup.SMALL near copies
        t = list(base)
        for _ in range(r.randint(0, 20)):
            t[r.randrange(150)] = r.choice(vocabulary)
        texts.append(" ".join(t))
    texts += texts[:5] + ODD
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    """With columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "en", 7, "x") for i, t in rows],
                                 "doc_id long, text string, lang string, n_chars long, kept string").repartition(5)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def test_quality_counts_and_empty(spark, docs, rows):
    trusted = spark.createDataFrame([(i,) for i, _ in rows[:20]], "doc_id long")
    got = {r["doc_id"]: r for r in op01_quality.report(docs, trusted).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        w = words(t)
        seen = Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
        again = np.zeros(len(w), bool)
        for k in range(len(w) - 7):
            if seen[tuple(w[k:k + 8])] > 1:
                again[k:k + 8] = True
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (
            len(w), sum(map(len, w)), int(again.sum()), len(lines) - len(set(lines))), (i, t)
        failed = len(w) < 20 or 100 * again.sum() > 30 * len(w)
        assert r["base_failed"] == failed and (not failed or not r["kept"])
    assert op01_quality.report(docs.limit(0), trusted).count() == 0
    kept = op01_quality.quality_filter(docs, trusted)
    assert kept.columns == docs.columns
    assert all(w == 0 for w in op01_quality.fit(docs, trusted.limit(0)))


def test_quality_rejects_words_that_trusted_text_lacks(spark):
    good = [(i, " ".join(f"g{(i * 7 + k) % 50}" for k in range(45)), 1) for i in range(40)]
    bad = [(100 + i, " ".join(f"###{(i * 5 + k) % 50}" for k in range(45)), 0) for i in range(10)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    kept = {r["doc_id"] for r in op01_quality.quality_filter(df, df.filter("quality = 1")).collect()}
    assert kept == set(range(40))


def near_components(rows):
    """(set size, smallest linked id) of every id, by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = words(lower(t))
        sets[i] = set(zip(w, w[1:])) if len(w) > 1 else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in sets:
        for j in sets:
            common = len(sets[i] & sets[j])
            if j < i and common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_found(df):
    found = {r["doc_id"]: r for r in op03_near_dedup.report(df, shingle=2).collect()}
    assert all(r["kept"] == (i == r["component_id"]) for i, r in found.items())
    return {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()}


def test_near_duplicates_equal_brute_force(docs, rows):
    want = near_components(rows)
    assert near_found(docs) == want
    kept = op03_near_dedup.near_dedup(docs, shingle=2)
    assert kept.columns == docs.columns and kept.count() == len({c for _, c in want.values()})


def test_near_duplicates_in_large_groups_without_a_centre(spark, monkeypatch):
    """Families that drift from one shared passage: large buckets, few links with their smallest members."""
    monkeypatch.setattr(op03_near_dedup, "SMALL", 4)
    monkeypatch.setattr(op03_near_dedup, "PER_PART", 7)
    r = random.Random(5)
    vocabulary = [f"v{i}" for i in range(3000)]
    passage = r.choices(vocabulary, k=110)
    texts = []
    for _ in range(6):
        own = r.choices(vocabulary, k=60)
        for _ in range(25):
            own[r.randrange(60)] = r.choice(vocabulary)
            own[r.randrange(60)] = r.choice(vocabulary)
            texts.append(" ".join(passage + own))
    r.shuffle(texts)
    rows = list(enumerate(texts))
    want = near_components(rows)
    assert 1 < len({c for _, c in want.values()}) < 100
    assert near_found(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == want


def test_near_duplicates_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (3, "a b c"), (3, "a b c"), (5, "a b c"), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in op03_near_dedup.report(df, shingle=2).collect()), key=str)
    assert got == sorted([(None, None, True), (3, 3, True), (3, 3, True), (5, 3, False), (None, None, True)], key=str)
    assert op03_near_dedup.report(df.limit(0), shingle=2).count() == 0


def test_substring_dedup_equals_brute_force(spark, docs, rows):
    first = {}
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - 9):
            first.setdefault(tuple(w[k:k + 10]), i)
    want = {}
    for i, t in rows:
        w = words(t)
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 9):
            if first[tuple(w[k:k + 10])] < i:
                gone[k:k + 10] = True
        left = " ".join(x for x, g in zip(w, gone) if not g)
        want[i] = (len(w), int(gone.sum()), hashlib.sha256(left.encode()).hexdigest())
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in op06_substring_dedup.report(docs, window=10).collect()}
    assert got == want
    assert op06_substring_dedup.report(docs.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40))
def test_suffix_array(values):
    assert suffix_array(np.array(values, np.int64)) == sorted(range(len(values)), key=lambda i: values[i:])


def test_suffix_dedup_equals_brute_force(spark, docs, rows):
    length = 200
    seen = Counter()
    raw = {i: (t or "").encode() for i, t in rows}
    for b in raw.values():
        for k in range(len(b) - length + 1):
            seen[b[k:k + length]] += 1
    want = {}
    for i, b in raw.items():
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = True
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        n_spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want[i] = (len(b), int(gone.sum()), n_spans, hashlib.sha256(left).hexdigest())
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in op10_suffix_dedup.report(docs, length=length).collect()}
    assert got == want
    left = op10_suffix_dedup.suffix_dedup(docs, length=length)
    assert left.columns == docs.columns and left.count() == len(rows)
    assert left.filter("text is not null and n_chars <> length(text)").count() == 0


def test_suffix_dedup_of_a_passage_in_very_many_texts(spark):
    """One passage in a third of the texts at different places, with the same and with other words around it."""
    r = np.random.default_rng(5)
    words_ = ["".join(chr(97 + c) for c in r.integers(0, 26, 6)) for _ in range(4000)]
    some = lambda n: " ".join(r.choice(words_, n))
    passage, frame_ = some(80), (some(9), some(7))
    texts = [some(60) for _ in range(240)]
    texts += [f"{some(int(r.integers(1, 30)))} {passage} {some(5)}" for _ in range(60)] + [f"{frame_[0]} {passage} {frame_[1]}"] * 60
    texts += [None, "", passage[:399], passage[:400]]
    data = [(f"row-{i}", t, 1) for i, t in enumerate(texts)] + [("row-1", texts[1], 1), (None, None, 2)]
    df = spark.createDataFrame(data, "doc_id string, text string, spans int")
    seen = Counter(t.encode()[k:k + 400] for _, t, _ in data if t for k in range(len(t.encode()) - 399))
    want = Counter()
    for i, t, _ in data:
        b, gone = (t or "").encode(), np.zeros(len((t or "").encode()), bool)
        for k in range(len(b) - 399):
            if seen[b[k:k + 400]] > 1:
                gone[k:k + 400] = True
        want[i, len(b), int(gone.sum()), int(gone.any()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()] += 1
    out = op10_suffix_dedup.report(df.repartition(6))
    assert Counter(tuple(x) for x in out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()) == want
    assert op10_suffix_dedup.report(df.filter("spans > 5")).count() == 0
    assert op10_suffix_dedup.suffix_dedup(df).columns == df.columns


def test_decontamination_equals_brute_force(spark, docs, rows):
    items = [(1, rows[10][1]), (2, "ONE"), (3, None), (4, ""), (5, " ".join(words(rows[20][1])[:12])), (5, "one"), (None, "w1 w2")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    want = {}
    for i, t in rows:
        w = pattern.findall(lower(t))
        hit, found = np.zeros(len(w), bool), set()
        for item, x in items:
            y = pattern.findall(lower(x))
            n = min(10, len(y))
            for k in range(len(y) - n + 1) if n else ():
                for a in range(len(w) - n + 1):
                    if w[a:a + n] == y[k:k + n]:
                        hit[a:a + n] = True
                        found |= {str(item)} if item is not None else set()
        want[i] = (len(w), int(hit.sum()), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit.any()))
    for size in (8_000_000, 100):  # in one block, and in many
        got = {r["doc_id"]: tuple(r)[1:] for r in op08_decontaminate.report(docs, bench, block_bytes=size).collect()}
        assert got == want
    assert op08_decontaminate.decontaminate(docs, bench.limit(0)).count() == len(rows)
    assert op08_decontaminate.decontaminate(docs, bench).columns == docs.columns


def test_pieces_both_forms_and_round_trip(spark, docs, rows):
    pieces = op07_pieces.Pieces()
    score = {t: (i, s) for t, i, s in zip(pieces.text, pieces.id, pieces.score)}

    def best(w):
        nodes = [(0, -1, [])]
        for e in range(1, len(w) + 1):
            top = None
            for s in range(max(0, e - pieces.longest), e):
                if w[s:e] in score:
                    c = (nodes[s][0] + score[w[s:e]][1], s, [score[w[s:e]][0]])
                elif e - s == 1:
                    c = (nodes[s][0] + op07_pieces.BYTES_SCORE, s, [pieces.byte_id[b] for b in w[s:e].encode()])
                else:
                    continue
                top = c if top is None or c[0] > top[0] else top
            nodes.append(top)
        out, e = [], len(w)
        while e:
            out, e = nodes[e][2] + out, nodes[e][1]
        return out

    texts = [t for _, t in rows if t] + ["a  b\n\nc ", "日本語 🎉 ▁x", "y" * 70 + " " * 40, "tab\t\x00 é"]
    cut = {t: [w for w in re.split(r"(?<! )(?= )|(?<=\n)|(?=\n)", t) if w] for t in texts}
    tokens, first, _, _ = op07_pieces.Lattice(pieces, []).encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert tokens[first[k]:first[k + 1]].tolist() == [i for w in cut[t] for i in best(w)]
    some = sorted({w for t in texts[-4:] for w in cut[t] if w})
    got = op07_pieces.relational_encode(spark.createDataFrame([(w,) for w in some], "word string"), pieces).collect()
    assert {r["word"]: r["ids"] for r in got} == {w: best(w) for w in some}
    encoded = op07_pieces.encoded(docs, frequent=50)
    back = {r["doc_id"]: r["text"] for r in op07_pieces.decoded(encoded).collect()}
    assert back == dict(rows)
    assert op07_pieces.report(docs, frequent=50).filter("not round_trip").count() == 0


def test_pieces_of_long_words_are_the_best_path(spark, docs, rows, monkeypatch):
    """Words are not cut: tokens of every form cost what the best path of the whole word costs."""
    monkeypatch.setattr(op07_pieces, "BLOCK", 50)
    pieces = op07_pieces.Pieces()
    score = {t: (i, s) for t, i, s in zip(pieces.text, pieces.id, pieces.score)}
    r = random.Random(3)
    words = ["http://example.org/" + "international/representation/" * 9, "".join(r.choices("0123456789abcdef", k=64)),
             "".join(r.choices("aeinorstlé日🎉", k=1500)), " " * 77 + "understanding" * 4, "x" * 3000]

    def best(w):
        nodes = [(0, 0, [])]
        for e in range(1, len(w) + 1):
            top = None
            for s in range(max(0, e - pieces.longest), e):
                ids, own = [score[w[s:e]][0]] if w[s:e] in score else None, score.get(w[s:e], (0, op07_pieces.BYTES_SCORE))[1]
                if ids is None and e - s == 1:
                    ids = [pieces.byte_id[b] for b in w[s:e].encode()]
                if ids is not None and (top is None or nodes[s][0] + own > top[0]):
                    top = (nodes[s][0] + own, s, ids)
            nodes.append(top)
        out, e = [], len(w)
        while e:
            out, e = nodes[e][2] + out, nodes[e][1]
        return out

    want = [best(w) for w in words]
    for most in (10, 1024):  # one by one in blocks, and together
        monkeypatch.setattr(op07_pieces, "LONG_BYTES", most)
        tokens, first, _, _ = op07_pieces.Lattice(pieces, []).encode(pa.array(words))
        assert [tokens[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == want
    some = [1, 3]
    got = op07_pieces.relational_encode(spark.createDataFrame([(words[k],) for k in some], "word string"), pieces).collect()
    assert {x["word"]: x["ids"] for x in got} == {words[k]: want[k] for k in some}
    back = {x["doc_id"]: x["text"] for x in op07_pieces.decoded(op07_pieces.encoded(docs, frequent=50)).collect()}
    assert back == dict(rows)
    assert op07_pieces.report(docs, frequent=50).filter("not round_trip").count() == 0


def test_toxicity_finds_hidden_words(spark):
    r = random.Random(5)
    voc = ["".join(r.choices("aeilnorst", k=5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        w = r.choices(voc, k=40)
        toxic = i % 4 == 0
        if toxic:
            w[r.randrange(40)] = r.choice(["blockhead", "dumbface", "goofball"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    hidden = ["bl0ckhe@d", "d.u.m.b.f.a.c.e", "gooooofball", "b l o c k h e a d", "DUMBFACE!"]
    rows += [(1000 + k, " ".join(r.choices(voc, k=20)) + f" {h} " + " ".join(r.choices(voc, k=20))) for k, h in enumerate(hidden)]
    rows += [(2000, None), (2001, ""), (None, "blockhead")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = op02_toxicity.report(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    by = {x["doc_id"]: x for x in got}
    assert len(got) == len(rows) and all(0 <= x["score"] <= 1 for x in got)
    assert all(by[1000 + k]["predicted"] == 1 for k in range(len(hidden)))
    assert by[2000]["predicted"] == by[2001]["predicted"] == 0 and by[None]["predicted"] == 1
    held = [x for x in got if x["held_out"] and x["doc_id"] < 1000]
    assert all(x["predicted"] == int(x["doc_id"] % 4 == 0) for x in held)
    none = op02_toxicity.report(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {x["score"] for x in none.collect()} == {0.0}


def test_toxicity_restores_hidden_edges_gaps_and_wildcards(monkeypatch):
    text = " ".join(["you are a stupid man", "what an idiot he is", "that is such a total asshole", "a big ass"] * 40)
    counts = np.zeros(27 ** 4, np.int64)
    code = [0, 0] + [ord(c) - 96 if c != " " else 0 for c in text] + [0, 0]
    for a, b, c, d in zip(code, code[1:], code[2:], code[3:]):
        counts[((a * 27 + b) * 27 + c) * 27 + d] += 1
    hidden = {"$tupid": "stupid", "@sshole": "asshole", "a$$": "ass", "id**t": "idiot", "idiot###": "idiot", "idiot%%%": "idiot", "idiot!": "idiot",
              "(idiot?": "idiot", "#stupid": "stupid", '"stupid"': "stupid", "s***id": "stupid"}
    for dense in (300, 0):  # by single states, and on all states
        monkeypatch.setattr(op02_toxicity, "DENSE", dense, raising=False)
        monkeypatch.setattr(op02_toxicity, "BEAM", 2 if dense else 1)
        restore = op02_toxicity.Restorer(op02_toxicity.CharModel(counts))
        assert {h: restore.word(h) for h in hidden} == hidden
        assert restore.spaced("so a s t u p i d man") == ["a", "stupid"]
        assert restore.spaced("s t u p i d  i d i o t") == ["stupid", "idiot"]
        assert restore.restored("so a $ t u p i d man") == "so a stupid man"


def test_toxicity_searches_each_hidden_part_once(monkeypatch):
    """Words that end alike share their search; the letters are those of the cheapest of all paths."""
    counts = np.random.default_rng(3).integers(0, 9, 27 ** 4)
    model = op02_toxicity.CharModel(counts)
    searched = []
    decode = op02_toxicity.CharModel._decode
    monkeypatch.setattr(op02_toxicity.CharModel, "_decode", lambda self, *a: searched.append(1) or decode(self, *a))
    restore = op02_toxicity.Restorer(model)
    r = random.Random(4)
    stems = {"".join(r.sample("aeilnorst", 5)) for _ in range(200)}
    ends = {restore.word(f"{stem}heit%%%")[5:] for stem in stems}
    assert len(ends) == 1 and len(searched) <= 2

    def cheapest(steps):
        best = None
        for path in product(*steps):
            context, cost = 0, 0.0
            for letter, price in path:
                cost += price
                if letter == " " and not context:
                    break
                if letter:
                    code = 0 if letter == " " else ord(letter) - 96
                    cost += model.cost[context][code]
                    context = 0 if letter == " " else (context * 27 + code) % 19683
            else:
                cost += model.cost[context][0]
                best = min(best or (cost, path), (cost, path))
        return "".join(letter for letter, _ in best[1])

    spans = ["m0ron", "i1!abc$tup1d", "b*dword", "abc**xyz1", "aaabbcc0dde", "a.b.c1defgh*", "1abc", "abcd", "4bcdef5hij##"]
    for span in spans:
        assert model.decode(op02_toxicity.lattice(span)) == cheapest(op02_toxicity.lattice(span)), span
    spaced = [x for step in op02_toxicity.lattice("st0pit") for x in (op02_toxicity._GAP, step)][1:]
    assert model.decode(spaced) == cheapest(spaced)


def test_language_held_out(spark):
    r = random.Random(6)
    made = {"xx": "abc", "yy": "mnop", "zz": "uvwé"}
    rows = [(i, " ".join("".join(r.choices(made[lang], k=5)) for _ in range(30)), lang)
            for i, lang in enumerate(r.choices(list(made), k=200))]
    rows += [(900, None, "xx"), (901, "12 !?", "xx"), (None, "abc abc", None)]
    got = {x["doc_id"]: x for x in op09_language.report(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in rows[:200])
    assert got[900]["lang_pred"] == got[901]["lang_pred"] == "und" and got[None]["lang_pred"] == "xx"
    empty = op09_language.report(spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")).collect()
    assert empty[0]["lang_pred"] == "und"


def test_extraction(spark):
    page = ("<html><body><header><h1>Site</h1></header><div class='cookie-notice'>We use</div><main><article class=post>"
            "<h1>T &lt;x&gt;</h1><p>A \n b<br>c &amp d<div class=ad>buy</div><ul><li>one<li>two</ul><form>x</form>"
            "<aside>s</aside><script>if(a<b){'</p>'}</script><p>x < y</article>"
            "<section id=comments><article><p>hi</p></article></section></main><footer>f</footer>")
    plain = "<body><nav>menu</nav><div id=main-text><p>only text of some length</p></div></body>"
    rows = [(1, "https://h.example/1", page), (2, "https://h.example/2", page), (3, "https://g.example/", plain),
            (4, None, None), (5, "https://h.example/3", ""), (6, "https://h.example/4", plain)]
    got = {x["page_id"]: (x["text"], x["n_chars"]) for x in op04_extract.extracted(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    text = "T <x>\nA b c & d\none\ntwo\nx < y"
    assert got[1] == got[2] == (text, len(text))
    assert got[3][0] == got[6][0] == "only text of some length" and got[4] == got[5] == ("", 0)
    wrapper = op04_extract.aligned([(t, False) for t in ["<a>", "#", "</a>"]], ["<a>", "</a>", "<hr>"])
    assert op04_extract.written(wrapper) == "<a> (#)? </a> (<hr>)?"
    other = op04_extract.aligned(wrapper, op04_extract._tokens("<a> (#)? (<b> #)+ </a>"))
    assert op04_extract.written(other) == "<a> (#)? ((<b> #)+)? </a> (<hr>)?"
    assert op04_extract._tokens(op04_extract.written(other)) == other
    assert op04_extract.folded("<li> # <li> # <li> # </ul>".split()) == (
        ["(<li> #)+", "</ul>"], [(0, 0), (0, 1)] * 3 + [(1, 0)])
    assert op04_extract.folded("<a> # # <a> # # # <b>".split()) == (
        ["(<a> (#)+)+", "#", "<b>"], [(0, 0), (0, 1), (0, 1), (0, 0), (0, 1), (0, 1), (1, 0), (2, 0)])
    assert op04_extract.matched("<a> </a>", "<a> (#)? </a>") == [0, 2]
    assert op04_extract.matched("# </a>", "(#)? (<b>)? # </a>") == [2, 3]
    assert op04_extract.matched("# </a>", "(#)+ </a>") == [0, 1] and op04_extract.matched("<x> #", "# <b>") == [-1, 0]
    assert op04_extract.extracted(spark.createDataFrame(rows[:0], "page_id long, url string, html string")).count() == 0


def test_extraction_takes_what_varies(spark):
    """No element or class says what is the article: places with one text on all pages are the template's."""
    def page(i, promo=""):
        body = "".join(f"<p>text {i} {k} of the story</p>" for k in range(1 + i % 3))
        return f"<body><div><p>Welcome to our site, the best of all sites there are</p></div>{promo}<div><h2>Story {i}</h2>{body}" \
               "<p><b>Read more stories</b></p><section>All rights reserved</section></div></body>"

    def expected(i):
        return "\n".join([f"Story {i}"] + [f"text {i} {k} of the story" for k in range(1 + i % 3)])

    rows = [(i, "https://h.example/", page(i, "<section>Buy now, buy here</section>" if i % 2 else "")) for i in range(12)]
    rows += [(100 + i, f"https://few{i}.example/", page(i)) for i in range(2)]
    rows += [(200 + i, "https://copies.example/", page(1)) for i in range(9)]
    rows += [(300, "https://h.example/", None), (301, None, "<p>alone</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in op04_extract.extracted(pages).collect()}
    assert all(got[i] == expected(i) for i in range(12))
    assert got[300] == "" and got[301] == "alone"
    # too few pages, or only copies of one page, show no template
    assert all(got[i].endswith("Read more stories\nAll rights reserved") for i in (100, 101, *range(200, 209)))
    hosts = {r["host"]: r for r in op04_extract.wrappers(op04_extract._with_host(pages, "page_id", "url", "html")).collect()}
    assert hosts["h.example"]["pages"] == 13 and hosts["copies.example"]["pages"] == 9
    # with another expression the result is another: it decides what is taken
    r = hosts["h.example"]
    numbers = op04_extract._numbers
    take, differing = numbers(" ".join(r["take"])), numbers(" ".join(r["differing"]))
    main = tuple(r["main"].split("/"))
    assert op04_extract.article(page(4), r["wrapper"], main, take, differing) == got[4]
    assert op04_extract.article(page(4), "<html> #", main, take, differing) != got[4]


def test_extraction_keeps_copied_content_in_articles(spark):
    def page(i):
        return f"<body><div>menu</div><article><h1>Same title</h1><p>story {i}</p><section>Same license</section></article></body>"
    rows = [(i, "https://h.example/", page(i)) for i in range(8)]
    got = op04_extract.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: f"Same title\nstory {i}\nSame license" for i in range(8)}


def test_chat_trees_and_round_trip(spark):
    tricky = "a\\<|im_end|>\n<|im_start|>x \\\\ <\\| <"
    messages = spark.createDataFrame(
        [(1, 1, None, "user", tricky, 0.0), (1, 2, 1, "assistant", "low", 1.0), (1, 3, 1, "assistant", tricky, 2.0),
         (1, 4, 3, "user", None, 0.0), (1, 4, 3, "user", None, 0.0), (2, 9, 8, "a\nb", "orphan", None)],
        "conv long, node long, parent long, role string, text string, score double")
    got = {r["conv"]: r for r in op05_chat.formatted(messages).select(
        "conv", "leaf", op05_chat.turns_of(F.col("formatted")).alias("turns"),
        op05_chat.loss_text(F.col("formatted"), F.col("loss")).alias("learned")).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("user", tricky), ("assistant", tricky), ("user", "")]
    assert got[1]["learned"] == tricky and [(t["role"], t["text"]) for t in got[2]["turns"]] == [("a\nb", "orphan")]
    assert op05_chat.formatted(messages, top=5).count() == 3
    assert op05_chat.report(messages.limit(0)).count() == 0
    long = spark.createDataFrame([(7, i, "assistant", str(i)) for i in range(70)], "conv_id long, turn long, role string, text string")
    r = op05_chat.report(op05_chat.chains(long)).first()
    assert r["n_turns"] == 70 and r["loss_chars"] == sum(len(str(i)) for i in range(70))


def test_empty_tables_nulls_and_more_columns(spark):
    labels = spark.createDataFrame([(1, 1, 1), (None, 0, 0)], "doc_id long, quality int, toxic int")
    # a column named as one of the operators' own, and a document without anything
    docs = spark.createDataFrame([(1, "abc", "xx", "u"), (1, "abc", "xx", "u"), (2, "", None, None), (None, None, None, None)],
                                 "doc_id long, text string, lang string, score string")
    for report in (lambda d: op02_toxicity.report(d, labels), op07_pieces.report, op09_language.report, op10_suffix_dedup.report):
        assert report(docs.limit(0)).count() == 0
        assert sorted((r["doc_id"] or 0) for r in report(docs).collect()) == [0, 1, 1, 2]
    assert op02_toxicity.report(docs, labels.limit(0)).count() == 4
    assert {r["n_bytes"] for r in op10_suffix_dedup.report(docs).collect()} == {0, 3}


def test_string_ids_give_what_integers_give(spark, docs):
    def name(i):
        return None if i is None else f"doc/{i:06d}"

    named = docs.select(F.when(F.col("doc_id").isNotNull(), F.format_string("doc/%06d", "doc_id")).alias("doc_id"), "text")
    assert near_found(named) == {name(i): (n, name(c)) for i, (n, c) in near_found(docs).items()}
    kept = op03_near_dedup.near_dedup(docs, shingle=2)
    assert {r["doc_id"] for r in op03_near_dedup.near_dedup(named, shingle=2).collect()} == {name(r["doc_id"]) for r in kept.collect()}
    cut = [(name(r["doc_id"]), *r[1:]) for r in op06_substring_dedup.report(docs).collect()]
    assert sorted(map(str, map(tuple, op06_substring_dedup.report(named).collect()))) == sorted(map(str, cut))
    assert any(r[2] for r in cut)
