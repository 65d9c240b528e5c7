"""Collocations, compression classifier and tokenizer alignment against plain Python, with odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.llm import op11_collocations, op12_compress_quality, op13_token_alignment, queries
from kiln.llm.transducer import Transducer, union
from tests.conftest import SF_SMALL

ODD = [None, "", " ", "  ", "\n", "a  b", " a", "a ", "a\n \nb", "x \n y", "▁x a▁b", "<s> </s> <|endoftext|> <0x41>", "日本語 🎉 テスト",
       "Ａ ﬁ", "\x00a\tb", "a   b", "it's 's we'll ", "    x", "a 　 b", "x" * 20_000, "ab " * 20_000]


# ------------------------------------------------------------ collocations

def collocations(docs, least, top=2000, longest=5):
    counts, n = {}, Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = (text or "").translate({c: c + 32 for c in range(65, 91)})
        c = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            c.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in counts.items():
        found = {p: a for p, a in c.items() if len(p) >= 2 and a >= least}
        needless = {q[i:i + k] for q, a in found.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)
                    if a >= found[q[i:i + k]]}
        rows = []
        for p in set(found) - needless:
            score, _, left, right = min((1000 * c[p] * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -c[p], " ".join(p).encode(), left, right))
        out += [(lang, i + 1, r[2].decode(), -r[1], r[3], r[4], n[lang], -r[0]) for i, r in enumerate(sorted(rows)[:top])]
    return sorted(out)


def test_collocations_equal_brute_force(spark, monkeypatch):
    r = random.Random(5)
    words = ["a", "b", "B", "é", "dd", "\x01x", "e!", "f.", "g\n", "\tq", " "]
    texts = [(" ".join(r.choices(words, r.choices(range(1, 9), k=len(words)), k=r.randint(0, 60))), r.choice(["en", None, "und", "x y", ""]))
             for _ in range(100)]
    texts += [(None, "en"), ("", None), ("same words here again and again " * 30, "en")] * 3
    docs = spark.createDataFrame([(t, x, 1, "p") for t, x in texts], "text string, lang string, n long, phrase string")
    got = sorted(tuple(x) for x in op11_collocations.report(docs, least=2).collect())
    assert got == collocations(texts, 2) and got
    monkeypatch.setattr(op11_collocations, "SHARD_BYTES", 300)  # many shards, texts in several blocks
    monkeypatch.setattr(op11_collocations, "BLOCK_BYTES", 50)
    monkeypatch.setattr(op11_collocations, "RANGE_BYTES", 100)
    assert sorted(tuple(x) for x in op11_collocations.report(docs, top=5, least=3).collect()) == collocations(texts, 3, 5)
    assert op11_collocations.report(docs.limit(0)).count() == 0


def test_collocations_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted(tuple(x) for x in queries.QUERIES["op11_collocations"](spark, SF_SMALL).collect())
    assert got == collocations([(x["text"], x["lang"]) for x in docs.collect()], 100)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 4).flatmap(lambda n: st.lists(st.lists(st.integers(0, 6), min_size=n, max_size=n), min_size=1, max_size=60)))
def test_transducers(rows):
    grams, counts = np.unique(np.array(rows, np.int64), axis=0, return_counts=True)
    route = grams[:, 0] % 3
    order = np.argsort(route, kind="stable")
    parts = [Transducer.load(t.dump()) for _, t in Transducer.pieces(grams[order], counts[order], route[order])]
    assert np.array_equal(np.concatenate([p.paths() for p in parts]), grams[order])
    for p in parts:
        assert np.array_equal(p.weights_of(p.paths()), p.weights)
        assert not p.weights_of(p.paths() + 7).any()
    again, total, place = union(parts + [Transducer.of(grams, counts)])
    assert np.array_equal(again, grams) and np.array_equal(total, 2 * counts) and len(place) == 2 * len(grams)


def test_transducers_share_states():
    grams = np.array([(a, b, c) for a in range(50) for b in (1, 2) for c in (3, 4)], np.int64)
    t = Transducer.of(grams, np.arange(len(grams)))
    assert [len(first) - 1 for first, _, _ in t.arcs] == [1, 1, 1]
    assert np.array_equal(t.weights_of(grams), np.arange(len(grams)))


# ------------------------------------------------- compression classifier

def labelled(spark, n=400):
    r = random.Random(1)
    good = ["alpha", "river", "because", "people", "under", "green"]
    rows = []
    for i in range(n):
        bad = i % 4 == 0
        rows.append((i, " ".join(r.choice(good) + ("###!" if bad else "") for _ in range(r.randint(5, 400))), int(not bad)))
    rows += [(n + k, t, None) for k, t in enumerate(ODD)] + [(0, "twice", 0)]
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in rows], "doc_id long, text string, score string, held_out double").repartition(4)
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (9_999, 1)], "doc_id long, quality int")
    return rows, df, labels


def test_compression_classifier(spark):
    rows, df, labels = labelled(spark)
    got = op12_compress_quality.report(df, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    truth = {i: q for i, t, q in rows if q is not None and t != "twice"}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth and r["doc_id"] != 0]
    assert len(held) > 40 and all(r["predicted"] == truth[r["doc_id"]] for r in held)
    again = op12_compress_quality.report(df.repartition(2), labels).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_gain_is_the_difference_of_block_sizes():
    r = random.Random(2)
    blocks = [bytes(r.choices(b"abc def", k=200)) for _ in range(300)]
    dictionaries = [op12_compress_quality.dictionary(b, 2048) for b in (blocks, [x.upper() for x in blocks])]
    assert op12_compress_quality.dictionary([b"few"], 2048) == b"few"
    text = "abc def ABC " * 300 + "é"
    sizes = []
    for d in dictionaries:
        c = zstandard.ZstdCompressor(level=op12_compress_quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d),
                                     write_content_size=False, write_checksum=False, write_dict_id=False)
        raw = text.encode()
        sizes.append(sum(len(c.compress(raw[i:i + 256])) for i in range(0, len(raw), 256)))
    g, b = (op12_compress_quality.Sizes(d, 256) for d in dictionaries)
    assert op12_compress_quality.gains(pa.array([text, ""]), g, b) == [(sizes[1] - sizes[0]) / len(text.encode()), 0.0]


def test_isotonic_curve():
    x, y = np.array([0.0, 1, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1, 0])
    at, share = op12_compress_quality.isotonic(x, y, np.ones(6))
    assert np.allclose(at, [0, 1, 2, 3, 4]) and np.allclose(share, [0.001, 0.5, 0.5, 2 / 3, 2 / 3])


def test_classifier_without_labels(spark):
    _, df, labels = labelled(spark, 40)
    assert {r["score"] for r in op12_compress_quality.report(df, labels.limit(0)).collect()} == {0.5}
    only = op12_compress_quality.report(df, labels.filter("quality = 1")).collect()
    assert {r["score"] for r in only} == {1.0}
    assert op12_compress_quality.report(df.limit(0), labels).count() == 0


def test_classifier_held_out_on_the_table(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    got = queries.QUERIES["op12_quality_classifier"](spark, sf).filter("held_out").join(
        spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert got >= 0.95


# ---------------------------------------------------- tokenizer alignment

@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))


def alignment(docs, tokenizers):
    """Digest of every document by the tokenizers' own encoding of whole texts and plain loops."""
    paths = op13_token_alignment.default_paths(None, None)
    names = op13_token_alignment.ByteLevel(paths[0]).bytes, op13_token_alignment.SentencePieces(paths[1]).bytes
    total, found = Counter(), {}
    for i, t in docs:
        sides = [tokenizers[0].encode(" " + t, add_special_tokens=False).ids, tokenizers[1].encode(t)] if t else [[], []]
        if t and any(b"".join(names[k][x] for x in ids) != (" " + t).encode() for k, ids in enumerate(sides)):
            sides = [[], []]
        spans = []
        for k, ids in enumerate(sides):
            end, out = 0, []
            for x in ids:
                out.append((end, end + len(names[k][x]), x))
                end = out[-1][1]
            spans.append(out)
        pairs, start = [], 0
        for s, e, x in spans[0]:
            while spans[1][start][1] <= s:
                start += 1
            k = start
            while k < len(spans[1]) and spans[1][k][0] < e:
                pairs.append((x, spans[1][k][2]))
                k += 1
        groups, at = [], [0, 0]
        for end in sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]}):
            own = []
            for k in (0, 1):
                stop = at[k]
                while stop < len(spans[k]) and spans[k][stop][1] <= end:
                    stop += 1
                own.append([x for _, _, x in spans[k][at[k]:stop]])
                at[k] = stop
            groups.append(own)
        total.update(pairs)
        found[i] = len(sides[0]), len(sides[1]), groups, pairs
    most = {}
    for (_, b), n in total.items():
        most[b] = max(n, most.get(b, 0))
    digest = {}
    for i, (n_a, n_b, groups, pairs) in found.items():
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        digest[i] = (n_a, n_b, len(groups), len(pairs), sum(total[p] == most[p[1]] for p in pairs), sum(total[p] for p in pairs),
                     hashlib.sha256(text.encode()).hexdigest() if text else "")
    return digest, {i: x[2] for i, x in found.items()}, total


def odd_documents():
    r = random.Random(3)
    signs = [" ", " ", " ", "\n", "\t", "a", "b", "the", "é", "1", "!", " ", "ß", "　", "'s", "\x1c", "\x85", "語"]
    texts = ODD + ["".join(r.choices(signs, k=r.randint(1, 40))) for _ in range(600)] + ["".join(r.choices([*signs, "▁"], k=20)) for _ in range(60)]
    return list(enumerate(texts)) + [(0, "again under an id"), (0, "again under an id")]


def test_alignment_equals_whole_text_encoding(spark, tokenizers, monkeypatch):
    docs = odd_documents()
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_a long, slice string").repartition(3)
    keyed = [((i, t), t) for i, t in docs]
    want, groups, total = alignment(keyed[:-1], tokenizers)
    once = df.filter("doc_id <> 0").unionByName(spark.createDataFrame([(0, None, 1, "x"), (0, docs[-1][1], 1, "x")], df.schema))
    got = sorted(tuple(x) for x in op13_token_alignment.report(once, slice_bytes=3000).collect())
    assert got == sorted((i, *want[i, t]) for (i, t), _ in keyed[:-1])
    assert op13_token_alignment.report(df).count() == len(docs)  # repeated rows stay
    back = {(r["doc_id"], len(r["groups"])): [[g["a"], g["b"]] for g in r["groups"]]
            for r in op13_token_alignment.groups(once).collect()}
    assert all(back[i, len(g)] == g for (i, _), g in groups.items() if i)
    links = {(r["a"], r["b"]): r["n"] for r in op13_token_alignment.links(once, slice_bytes=10_000).collect()}
    assert links == dict(total)


def test_alignment_forgets_units_and_takes_empty_tables(spark, tokenizers, monkeypatch):
    aligner = op13_token_alignment.Aligner(*op13_token_alignment.default_paths(None, None))
    monkeypatch.setattr(op13_token_alignment, "REMEMBER", 3)
    texts = ["one two three four", "five one two", "six seven"]
    for t in texts * 2:
        x = aligner.aligned([t, None])
        assert x.groups_a.values.to_pylist() == tokenizers[0].encode(" " + t, add_special_tokens=False).ids
        assert x.n_a.tolist()[1] == 0
    assert op13_token_alignment.report(spark.createDataFrame([], "doc_id string, text string")).collect() == []


def test_alignment_of_the_table(spark, tokenizers):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    want, _, _ = alignment([(r["doc_id"], r["text"]) for r in docs.collect()], tokenizers)
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.QUERIES["op13_token_alignment"](spark, SF_SMALL).collect()}
    assert got == want
