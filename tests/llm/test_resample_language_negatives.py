"""Resampling, language identification and hard negatives against brute force, held-out accuracy, and edge cases with values."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanery.llm import common, importance, langid, negatives, queries

SCHEMA = "doc_id long, text string, lang string, score double, rank int, bucket long, row long, label int"


def frame(spark, rows):
    """Documents (id, text, lang) with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 0.5, 3, 4, 5, 6) for r in rows], SCHEMA)


EDGES = [(1, None, "en"), (2, "", "en"), (3, " \n\t--", None), (4, "One two", "en"), (4, "One two", "en"), (5, "x" * 300_000, "de"), (6, "Żółć é 中文 \x1c 👍", None), (None, "no id at all here", "en"), (7, "a b " * 50_000, "fr")]

# 11


def resampled_by_hand(docs, target, percent=25, least=20, n=10_000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(lower))
        return words, [zlib.crc32(f.encode()) % n for f in [*words, *map(" ".join, zip(words, words[1:]))]]

    told = [(k, *features(t)) for k, t in docs]
    s, t = collections.Counter(b for _, _, f in told for b in f), collections.Counter(b for x in target for b in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    out = []
    for k, words, f in told:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + n) / ((s[b] + 1) * (big_t + n)))) for b in f) // len(f) if f else 0
        score = None
        if k is not None:
            h = int(hashlib.sha256(f"7:{k}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([k, len(f), weight, score, len(words)])
    able = sorted((r for r in out if r[4] >= least and r[0] is not None), key=lambda r: (-r[3], r[0]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: percent * len(able) // 100])}
    return [(*r[:4], rank.get(id(r))) for r in out]


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_resampling_against_brute_force(spark, sf_dir):
    docs, bench = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")
    want = resampled_by_hand([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()])
    assert as_rows(importance.resample(docs, bench)) == sorted(want, key=str)


def test_resampling_of_edges(spark):
    rows = EDGES + [(k, " ".join("w%d" % (k * j % 17) for j in range(10 + k)), "en") for k in range(20, 60)]
    target = spark.createDataFrame([(1, None), (2, "w1 w2 w3"), (2, "w1 w2 w3")], "item_id long, text string")
    got = importance.resample(frame(spark, rows).repartition(3), target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert as_rows(got) == sorted(resampled_by_hand([r[:2] for r in rows], [None, "w1 w2 w3", "w1 w2 w3"]), key=str)
    # repeated rows of one score share its ranks out; few buckets meet in numbers
    twice = importance.resample(frame(spark, rows + rows), target, buckets=7)
    assert as_rows(twice) == sorted(resampled_by_hand([r[:2] for r in rows + rows], [None, "w1 w2 w3", "w1 w2 w3"], n=7), key=str)
    assert importance.resample(frame(spark, []), target).count() == 0
    nothing = as_rows(importance.resample(frame(spark, rows), target.where("false")))
    assert nothing == sorted(resampled_by_hand([r[:2] for r in rows], []), key=str)


def test_words_have_offsets_of_bytes():
    split = importance.Split(importance.Regex(importance.WORD), behavior="removed", invert=True)
    n, found = importance.buckets_of("Éa B-c9  中文x", split, 1 << 32)
    want = ["Éa", "b", "Éa b", "c9", "b c9", "中文x", "c9 中文x"]
    assert n == 4 and found.tolist() == [zlib.crc32(w.encode()) for w in want]


# 12


def runs_by_hand(text, buckets):
    """Buckets of all runs, each hashed by itself."""
    found = []
    for n in range(langid.SHORTEST, langid.LONGEST + 1):
        for k in range(len(text) - n + 1):
            h = langid.LONGEST
            for c in text[k : k + n]:
                h = (h * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2**64
            h ^= h >> 29
            found.append((h * 0xBF58476D1CE4E5B9 % 2**64) >> (64 - (buckets.bit_length() - 1)))
    return found


def reduced(text):
    return re.sub(r"[\W\d_]+", " ", " " + text.lower() + " ")


def test_language_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(rng.randint(1, 7)))
    rows = [(k, " ".join(word("abcdeé" if k % 3 else "deßfgh") for _ in range(rng.randint(1, 30))), "one" if k % 3 else "two") for k in range(40)]
    buckets = 256
    model = langid.fit(frame(spark, rows).repartition(3), buckets)
    counts = {name: collections.Counter(b for _, t, x in rows if x == name for b in runs_by_hand(reduced(t), buckets)) for name in ("one", "two")}
    shares = collections.Counter(x for _, _, x in rows)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(frame(spark, rows), model).collect()}
    for k, t, _ in rows:
        told = {}
        for name, c in counts.items():
            total = sum(c.values()) + langid.SMOOTHING * buckets
            told[name] = math.log(shares[name] / len(rows)) + sum(math.log((c[b] + langid.SMOOTHING) / total) for b in runs_by_hand(reduced(t), buckets))
        best = max(told, key=told.get)
        assert got[k][0] == best and got[k][1] == pytest.approx(1 / sum(math.exp(x - told[best]) for x in told.values()), rel=1e-6)


def test_long_texts_in_pieces_count_alike(monkeypatch):
    texts = ["abcdefghij" * 7, "", "xy", None, "é" * 33]
    count = lambda step: collections.Counter(p for load in langid.pieces(texts, step) for row, bucket in langid.runs(*load, 512, step) for p in zip(row.tolist(), bucket.tolist()))
    want = collections.Counter((k, b) for k, t in enumerate(texts) for b in runs_by_hand(t or "", 512))
    assert count(10**6) == want and all(count(step) == want for step in (1, 2, 3, 5, 70))


def test_language_of_edges(spark):
    model = langid.fit(frame(spark, EDGES))
    assert model.languages == ["de", "en", "fr"] and np.exp(model.matrix).sum(0) == pytest.approx([1] * 3)
    got = langid.predict(frame(spark, EDGES), model)
    assert got.columns == ["doc_id", "lang_pred", "score"]
    told = sorted(((r.doc_id, r.lang_pred) for r in got.collect()), key=str)
    assert told[:6] == [(1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (5, "de")] and told[7:] == [(7, "fr"), (None, "en")]
    assert all(0 <= r.score <= 1 for r in got.collect()) and [r.score for r in got.where("doc_id < 4").collect()] == [0.0] * 3
    assert langid.predict(frame(spark, []), model).count() == 0
    none = langid.fit(frame(spark, []))
    assert {(r.lang_pred, r.score) for r in langid.predict(frame(spark, EDGES), none).collect()} == {("und", 0.0)}


def test_many_languages_share_a_bounded_matrix(spark, monkeypatch):
    monkeypatch.setattr(langid, "CELLS", 1 << 12)
    monkeypatch.setattr(langid, "LOOKUP", 64)
    rows = [(k, chr(0x4E00 + k) * 5 + " ab", "l%03d" % k) for k in range(100)]
    model = langid.fit(frame(spark, rows))
    assert model.matrix.shape == (32, 100)
    got = langid.predict(frame(spark, rows), model)
    assert got.count() == 100 and got.where("lang_pred like 'l%'").count() == 100


def test_held_out_languages_are_told(spark):
    d = "/root/testdata/sf0.01"
    got = queries.op12_language_naive_bayes(spark, d).join(common.table(spark, d, "documents").select("doc_id", "lang"), "doc_id").toPandas()
    assert got.columns.tolist() == ["doc_id", "held_out", "lang_pred", "score", "lang"]
    assert got.held_out.tolist() == [zlib.crc32(str(k).encode()) % 3 == 1 for k in got.doc_id]
    held = got[got.held_out]
    assert len(held) > 300 and (held.lang == held.lang_pred).mean() > 0.98


# 13


def mined_by_hand(rows, every=100, most=5, percent=80):
    good = [(k, [math.floor(256 * x) for x in v], y) for k, v, y in rows if k is not None and y is not None and v is not None and all(x is not None and math.isfinite(256 * x) for x in v)]
    out = []
    for i, (a, va, ya) in enumerate(good):
        if a % every:
            continue
        scored = [(-sum(x * z for x, z in zip(va, v)), k, y) for j, (k, v, y) in enumerate(good) if j != i and len(v) == len(va)]
        for p, pos, y in sorted(r for r in scored if r[2] == ya)[:most]:
            below = sorted(r for r in scored if r[2] != ya and 80 * -p <= 100 * -r[0] <= 100 * -p)[:most]
            out += [(a, pos, n + 1, neg, -p, -s) for n, (s, neg, _) in enumerate(below)]
    return sorted(out)


def vectors(spark, rows, kind="array<double>"):
    return spark.createDataFrame([(*r, 9, 9, 9) for r in rows], f"vec_id long, embedding {kind}, label int, block int, row int, wide int")


def test_packed_products_are_exact():
    rng = np.random.default_rng(5)
    for size, wide in ((1, 64), (300, 64), (30_000, 7), (1 << 28, 3), (1 << 40, 5)):
        c, a = rng.integers(-size, size + 1, (23, wide)), rng.integers(-size, size + 1, (4, wide))
        packed = negatives.Packed(c.astype(float), a.astype(float))
        want = [[max(-(1 << 63), min((1 << 63) - 1, sum(int(x) * int(y) for x, y in zip(p, q)))) for q in c] for p in a]
        assert packed.products(a.astype(float)).tolist() == want
        assert packed.fields == {1: 6, 300: 2, 30_000: 1}.get(size, packed.fields)
    assert negatives.Packed(np.zeros((3, 0)), np.zeros((1, 0))).products(np.zeros((1, 0))).tolist() == [[0, 0, 0]]
    assert negatives.Packed(np.full((3, 64), -0.0), np.ones((1, 64))).products(np.ones((1, 64))).tolist() == [[0, 0, 0]]


def test_negatives_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, [rng.choice([-0.5, 0.0, 0.25, 0.3, 1.0]) for _ in range(6)], k % 3) for k in range(400)]
    rows += rows[100:103] + [(100, [1.0] * 6, 2)]  # repeated rows, an id twice
    rows += [(None, [1.0] * 6, 1), (200, None, 1), (300, [1.0] * 6, None), (500, [None] * 6, 1), (600, [float("nan")] * 6, 1), (700, [float("inf")] * 6, 1), (800, [0.0] * 6, 1), (900, [1.0] * 3, 1), (901, [1.0] * 3, 1), (902, [0.9] * 3, 0), (1000, [], 1), (1001, [], 1)]
    want = mined_by_hand(rows)
    got = negatives.mine(vectors(spark, rows), block=64)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 50
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 2)
    assert sorted(tuple(r) for r in negatives.mine(vectors(spark, rows), block=10_000).collect()) == want
    assert negatives.mine(vectors(spark, [])).count() == 0
    assert negatives.mine(vectors(spark, [(100, [1.0], 1), (101, [1.0], 2)])).count() == 0  # an anchor without positives


def test_very_large_components(spark):
    rows = [(0, [1e9, 2e9], 1), (1, [2e9, 1e9], 1), (2, [1e9, 1e9], 0), (3, [1.9e9, 1e9], 0), (4, [1e300, 0.0], 0), (5, [1e308, 0.0], 1)]
    top = (1 << 63) - 1  # all scores lie beyond 64 bits; row 5 isn't finite once scaled
    assert sorted(tuple(r) for r in negatives.mine(vectors(spark, rows)).collect()) == [(0, 1, 1, 2, top, top), (0, 1, 2, 3, top, top), (0, 1, 3, 4, top, top)]
