"""The operators against brute force, exact round trips and held-out accuracy; and their edge cases."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gleanery.llm import ann, bpe, common, decontaminate, lm, neardup, pii, quality, queries, secrets, tokencount, toxicity

SCHEMA = "doc_id long, text string, spans int, word string, id long"


def frame(spark, texts):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(k, t, 1, "x", 2) for k, t in texts], SCHEMA)


EDGES = [(1, None), (2, ""), (3, "   \n\t"), (4, "one two"), (4, "one two"), (5, "x" * 30_000), (6, "żółć é 中文   \x1c 👍"), (None, "no id at all")]


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return common.table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).toPandas()


def test_every_operator_takes_edges_and_empty_tables(spark):
    detector = secrets.Detector(secrets.infer({"0a0a": 2}), secrets.infer({"ggg": 2}))
    net = toxicity.train(["you idiot"] * 4 + ["a fine day"] * 4, np.array([1] * 4 + [0] * 4))
    label = lambda d: quality.score_documents(d, quality.fit(d))
    score = lambda d: lm.score_documents(d, lm.fit(d, 10, 3, 20, 5), F.col("doc_id") >= 0)
    count = lambda d: tokencount.count_documents(tokencount.write_files(d, queries.vocabulary()), 50256)
    many = (lambda d: bpe.digest_documents(d, queries.vocabulary()), pii.digest_documents, lambda d: secrets.digest_documents(d, detector), lambda d: toxicity.score_documents(d, net), label, score, neardup.link_documents, count)
    full, none = frame(spark, EDGES), frame(spark, [])
    for f in many:
        assert f(full).count() == len(EDGES)
        assert f(none).count() == 0
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "too short")], "item_id long, text string")
    assert decontaminate.overlaps(full, bench).count() == decontaminate.overlaps(none, bench).count() == decontaminate.overlaps(full, bench.where("false")).count() == 0
    assert toxicity.drop_toxic(full, net).columns == full.columns
    assert pii.redact_documents(full).where("text is null").count() == 1


# 1


def found_of(words, item):
    """Places of the item's words found in the words, by plain loops over all diagonals that some run of the item meets."""
    at = collections.defaultdict(list)
    for n, w in enumerate(item):
        at[w].append(n)
    found = set()
    for shift in {n - m for n, w in enumerate(words) for m in at.get(w, ())}:
        first, last = max(0, -shift), min(len(item), len(words) - shift)
        same = [item[k] == words[k + shift] for k in range(first, last)]
        if sum(same) < 4:
            continue
        wide = min(decontaminate.STRETCH, len(same))
        if 100 * sum(same) >= decontaminate.AGREE * len(same):
            inside = range(len(same))
        else:
            inside = {k + i for k in range(len(same) - wide + 1) if 100 * sum(same[k : k + wide]) >= decontaminate.AGREE * wide for i in range(wide)}
        found |= {first + k for k in inside if same[k]}
    return found


def test_decontamination_against_brute_force(spark, docs, texts, sf_dir, monkeypatch):
    bench = common.table(spark, sf_dir, "benchmark")
    items = {r.item_id: r.text.lower().split() for r in bench.collect()}
    rng = random.Random(1)
    planted = []
    for k, item in list(items.items())[:10]:  # with one word in seven replaced
        words = ["zz%d" % rng.randint(0, 9) if n % 7 == 3 else w for n, w in enumerate(item)]
        planted.append((10_000 + k, " ".join(["aa bb cc", *words, "dd ee"])))
    planted += [(10_000, "other words of one id"), (None, " ".join(next(iter(items.values())))), *planted[:2]]
    every = docs.select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    of = lambda: {(r.doc_id, r.item_id): r.n_found for r in decontaminate.overlaps(every, bench).collect()}
    got = of()
    want = {}
    for d, words in [*zip(texts.doc_id, (t.lower().split() for t in texts.text)), *((k, t.split()) for k, t in planted if k is not None)]:
        vocabulary = set(words)
        for i, item in items.items():
            if sum(w in vocabulary for w in item) >= decontaminate.LEAST_WORDS:
                n = len(found_of(words, item))
                if n >= 8 and (100 * n >= 50 * len(item) or n >= 30):
                    want[d, i] = max(n, want.get((d, i), 0))
    # without substitutions no true overlap is missed; seeds may miss some with them
    assert set(got) <= set(want) and all(got[k] <= want[k] for k in got)
    assert {k: n for k, n in want.items() if n == len(items[k[1]])}.items() <= got.items()
    assert len({k for k in got if k[0] >= 10_000}) >= 9
    # both ways to join give the same rows
    monkeypatch.setattr(decontaminate, "BROADCAST_RUNS", 0)
    assert of() == got


def test_parts_of_benchmark_texts_go(spark):
    rng = random.Random(11)
    fresh = lambda n: ["w%d" % rng.randint(0, 10**6) for _ in range(n)]
    item, long, short, tiny = fresh(60), fresh(400), fresh(9), fresh(6)
    split = item[:30] + ["put", "in"] + item[30:]
    spoilt = [w if k % 5 else "zz%d" % k for k, w in enumerate(item)]
    texts = {
        1: fresh(80) + item[15:45] + fresh(80),  # half of it, in other text
        2: fresh(80) + item[10:50] + fresh(80),
        3: fresh(80) + split + fresh(80),  # on two diagonals
        4: fresh(80) + long[200:240] + fresh(80),  # a part of a long one
        5: fresh(80) + short + fresh(80),
        6: short[:8],
        7: fresh(20) + spoilt + fresh(20),
        8: fresh(80) + item[40:] + fresh(5) + item[:20] + fresh(80),  # pieces out of order
        20: fresh(80) + item[15:35] + fresh(80),  # a third
        21: fresh(80) + item[:7] + fresh(80),
        22: short[:7],
        9: fresh(30) + tiny + fresh(30),
        23: fresh(200),
        25: fresh(30) + tiny[:5] + fresh(30) + tiny[5:],
        26: fresh(30) + ["only", "four", "words", "here"],
    }
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()] + [(None, " ".join(item)), (None, "clean"), (24, None), (1, "clean rows of an id stay"), (2, texts[2] and " ".join(texts[2]))], "doc_id long, text string")
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate((item, long, short, tiny))] + [(4, "only four words here"), (None, " ".join(texts[23]))], "item_id long, text string")
    left = [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()]
    assert sorted(left, key=str) == [1, 20, 21, 22, 23, 24, 25, 26, None]
    assert decontaminate.drop_contaminated(docs, bench.where("false")).count() == docs.count()
    got = {(r.doc_id, r.item_id): r.n_found for r in decontaminate.overlaps(docs, bench).collect()}
    assert got[1, 0] == 30 and got[3, 0] == 60 and got[5, 2] == 9 and got[6, 2] == 8 and got[9, 3] == 6


# 2 and 9


def plain(patterns, value):
    return sorted((kind, m.start(), m.end()) for kind, pattern, good in patterns for m in re.finditer(pattern, value) if good(m))


def digits(m):
    return re.sub("[^0-9]", "", m.group())


PII = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and pii.luhn(digits(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
]
ANY_CASE = "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("password", "passwd", "secret", "token"))
SECRETS = [
    ("assign", rf"""({ANY_CASE}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 12),
    ("access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 18),
    ("hex", "[0-9a-f]+", lambda m: len(m.group()) >= 16),
]
BITS = ["a.b", "@", "x", "-", ".", "1", "23", "+1 ", "(269) ", "555-3296", "4524132264652876", " ", "256", "255.1", "é", "token", "=", '"', ":", "PASSWORD", "AKIA", "ABCD1234EFGH5678", "deadbeef01", "\n", "api_key", "'", "+", "ſecret"]


def test_base_spans_against_plain_patterns(texts):
    rng = random.Random(5)
    made = ["".join(rng.choice(BITS) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    for value in [*made, *texts.text]:
        assert sorted(s[:3] for s in pii.find(value) if s[0] in pii.BASE) == plain(PII, value)
        assert sorted(s[:3] for s in secrets.base_spans(value)) == plain(SECRETS, value)


def test_pii_scores_and_redaction():
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")
    kinds = {s[0] for s in pii.find("account DE89 3704 0044 0532 0130 00, call 212-555-0187. Another quite long sentence goes here; order 123-45-6789")}
    assert kinds == {"iban", "phone_local"}
    assert pii.redacted("mail a@b.co or +1 (269) 555-3296 4524132264652876") == "mail <EMAIL> or <PHONE> <CARD>"


def test_digest_columns(spark):
    row = pii.digest_documents(frame(spark, [(1, "x a@b.co 1.2.3.4")])).first()
    assert (row.n_email, row.n_ip, row.base_sha256, row.spans) == (1, 1, hashlib.sha256(b"email:2:8,ip:9:16").hexdigest(), "email:2:8,ip:9:16")
    assert pii.digest_documents(frame(spark, [(1, None)])).first().base_sha256 == hashlib.sha256(b"").hexdigest()


def test_inferred_formats():
    rng = random.Random(2)
    shapes = collections.Counter("".join(rng.choice("0a") for _ in range(40)) for _ in range(200)) + collections.Counter("AGAG" + "".join(rng.choice("0AG") for _ in range(16)) for _ in range(200))
    others = collections.Counter("g" * n for n in range(16, 40)) + collections.Counter("gggg0-gggggg-gggg" for _ in range(20))
    found = secrets.Detector(secrets.infer(shapes), secrets.infer(others))
    value = "see 3f2504e0-4f89-41d3-9a0c-0305e82c3301 and averyveryverylongword and file7-readme-draft"
    spans = [s for s in found.find(value) if s[0] == "inferred"]
    assert [value[s[1] : s[2]] for s in spans] in (["3f2504e0-4f89-41d3-9a0c-0305e82c3301"], [])
    assert not [s for s in found.find("averyveryverylongword") if s[0] == "inferred"]
    assert [s[0] for s in found.find("key 0A1B2C3D4E5F60718293A4B5C6D7E8F9 end")] == ["inferred"]
    # the automaton is small: states were merged
    assert len(found.credentials.steps) < 200


def test_automata_by_plain_products():
    rng = random.Random(9)
    shapes = collections.Counter("".join(rng.choice("0aA") for _ in range(rng.randint(1, 4))) for _ in range(300))
    own = secrets.infer(dict(shapes))
    for x in [*list(shapes)[:20], "0g", "", "gggg"]:
        p, at = 1.0, 0
        for c in [*x, None]:
            seen, ends = own.seen[at], own.ends[at]
            p *= ((ends if c is None else seen.get(c, 0)) + secrets.UNSEEN) / (sum(seen.values()) + ends + secrets.UNSEEN * secrets.SYMBOLS)
            at = at if c is None else own.steps[at].get(c, 0)
        assert own.bits(x) == pytest.approx(math.log2(p), abs=1e-9)
    # every string that was counted ends once in some state, and merging loses no count
    assert sum(own.ends) == 300 and sum(sum(c.values()) for c in own.seen) == sum(len(x) * n for x, n in shapes.items())


# 3


def exact(index: pd.DataFrame, asked: pd.DataFrame, k: int):
    v = np.stack(index.embedding).astype(float)
    ids = index.vec_id.to_numpy()
    out = {}
    for q, x in zip(asked.vec_id, asked.embedding):
        score = v @ np.asarray(x, float)
        order = [n for n in np.lexsort((ids, -score)) if ids[n] != q][:k]
        out[q] = [(int(ids[n]), float(score[n])) for n in order]
    return out


def test_nearest(spark, sf_dir, monkeypatch):
    vectors = common.table(spark, sf_dir, "embeddings")
    data = vectors.toPandas()
    hot = data.embedding[0]
    extra = [(10_000 + k, [float(x) for x in hot]) for k in range(200)] + [(20_000, None), (20_001, [0.0] * 64), (20_002, [float("nan")] * 64), (20_003, [None] * 64)]
    both = vectors.select("vec_id", F.col("embedding").cast("array<double>")).union(spark.createDataFrame(extra, "vec_id long, embedding array<double>"))
    good = pd.concat([data[["vec_id", "embedding"]], pd.DataFrame(extra[:200], columns=["vec_id", "embedding"])])
    monkeypatch.setattr(ann, "BLOCK", 300)
    got = ann.nearest(both, both.where("vec_id % 20 = 0"), least=60).toPandas()
    want = exact(good, good[good.vec_id % 20 == 0], 20)
    assert set(got.query_id) == set(want)
    hits = 0
    for q, rows in got.groupby("query_id"):
        rows = rows.sort_values("rank")
        assert list(rows["rank"]) == list(range(1, 21)) and q not in set(rows.vec_id)
        true = dict(want[q])
        hits += len(set(rows.vec_id) & set(true))
        assert all(abs(true[v] - s) < 1e-9 for v, s in zip(rows.vec_id, rows.score) if v in true)
    assert hits / (20 * len(want)) >= 0.9
    # the hot vector's nearest are its copies of smallest id
    assert list(got[got.query_id == 0].sort_values("rank").vec_id)[:20] == [10_000 + k for k in range(20)]
    assert ann.nearest(both.where("false"), both).count() == 0
    # lengths don't mix; scores may be subnormal; other columns may clash
    odd = spark.createDataFrame([(0, [1.0, 2.0], 1, 2), (1, [1.0], 1, 2), (2, [2.0, 1.0], 1, 2), (3, [1e-200, 0.0], 1, 2), (4, [3.0, 3.0, 3.0], 1, 2), (5, [], 1, 2)], "vec_id long, embedding array<double>, block int, wide int")
    assert [tuple(r) for r in ann.nearest(odd, odd).orderBy("query_id", "rank").collect()] == [(0, 1, 2, 4.0), (0, 2, 3, 1e-200), (2, 1, 0, 4.0), (2, 2, 3, 2e-200), (3, 1, 2, 2e-200), (3, 2, 0, 1e-200)]
    few = both.where("vec_id < 3")
    assert ann.nearest(few, few.where("vec_id = 0")).count() == 2


# 4


def links_of(rows):
    """Components by comparing all pairs."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset())
    root = list(range(len(rows)))

    def top(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x and y and min(len(x), len(y)) * 100 >= 75 * max(len(x), len(y)):
                both = len(x & y)
                if 100 * both >= 75 * (len(x) + len(y) - both):
                    root[max(top(a), top(b))] = min(top(a), top(b))
    low = {}
    for k, (i, _) in enumerate(rows):
        low[top(k)] = min(low.get(top(k), i), i)
    return [(i, len(sets[k]), low[top(k)], i == low[top(k)]) for k, (i, _) in enumerate(rows)]


def test_near_duplicates_against_all_pairs(spark, texts):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randint(0, 99)) for _ in range(80)) for _ in range(6)]
    rows = [(int(i), t) for i, t in zip(texts.doc_id, texts.text)][:80]
    for k in range(150):  # copies over the whole range around the threshold, and a passage that many share
        words = base[k % 6].split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "n%d" % rng.randint(0, 999)
        if k % 3 == 0:
            words = base[0].split()[:40] + ["m%d" % rng.randint(0, 9999) for _ in range(40)]
        rows.append((5000 + k, " ".join(words)))
    rows += [(9000, "One two"), (9001, "one  TWO"), (9002, "one two three"), (9003, None), (9004, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(links_of(rows))
    for small, alike in ((8, 0.4), (8, 2.0)):  # dense nodes, recursion to the last level
        got = sorted(tuple(r) for r in neardup.link_documents(df, small=small, alike=alike, block=3 * small).select("doc_id", "n_shingles", "component_id", "kept").collect())
        assert got == want


def test_refuted_pairs_hold_no_link_back(spark, monkeypatch):
    monkeypatch.setattr(neardup, "EVEN", neardup.MAYBE)  # the first round ties on every proposal, so many ties are refuted
    rng = random.Random(5)
    rows = []
    for k in range(12):  # two linked texts, and one that is near both but linked with neither
        words = ["t%d" % rng.randint(0, 10**6) for _ in range(204)]
        rows.append((3 * k, " ".join(words)))
        rows.append((3 * k + 1, " ".join(words[:100] + ["u%d" % k] + words[101:])))
        rows.append((3 * k + 2, " ".join(words[:168] + ["v%d" % rng.randint(0, 10**6) for _ in range(36)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in neardup.link_documents(df).select("doc_id", "n_shingles", "component_id", "kept").collect())
    assert got == sorted(links_of(rows))
    assert sum(not r[3] for r in got) == 12


def test_chunks_are_bounded_and_settle_every_pair(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 500)
    rng = random.Random(8)
    base = ["t%d" % rng.randint(0, 10**6) for _ in range(150)]
    rows = [(k, " ".join("x%d" % rng.randint(0, 10**6) if rng.random() < 0.02 else w for w in base)) for k in range(40)]
    rows += [(k, t) for k, t in rows[:5]] + [(3, "the same id with another text altogether than before")]  # repeated rows; one id, two texts
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for small in (6, 1000):
        got = neardup.link_documents(df, small=small, block=10).collect()
        assert len(got) == 46
        components = {r.doc_id: r.component_id for r in got}
        assert components == {d: c for d, _, c, _ in links_of(rows[:40])}
        assert sorted(r.n_shingles for r in got if r.doc_id == 3)[0] == 5


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)]
    root = {}

    def top(a):
        while root.setdefault(a, a) != a:
            a = root[a]
        return a

    for a, b in edges:
        if a != b:
            root[max(top(a), top(b))] = min(top(a), top(b))
    got = {r.id: r.component_id for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {a: top(a) for a in list(root)}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


# 5


def test_encoding_is_the_librarys(texts):
    from tokenizers import Tokenizer

    theirs, own = Tokenizer.from_file(queries.vocabulary()), bpe.Codec(queries.vocabulary())
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "\t", "a", "the", "ing", "é", "中", "👍", "'s", "'LL", "'re", "1", "23", "<|endoftext|>", "<|endof", " ", "...", "$$$", "Ⅷ", "\r\n", "aaaa", "====", "\x1c", "\x85"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["".join(rng.choice("abehtin =-") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    for value in [*made, *texts.text, "a" * 5000, "-" * 300]:
        ids = theirs.encode(value, add_special_tokens=False).ids
        assert own.encode(value).tolist() == ids
        assert own.decode(own.encode(value)) == theirs.decode(ids, skip_special_tokens=False)


# 6


def test_toxicity_on_the_held_out_fold(spark, docs, sf_dir):
    labels = common.table(spark, "/root/testdata/sf0.01", "labels")
    more = common.table(spark, "/root/testdata/sf0.01", "documents")
    scored = toxicity.score_documents(more, toxicity.fit(more, labels)).join(labels, "doc_id").toPandas()
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in zip(scored.doc_id, scored.held_out))
    assert scored.score.between(0, 1).all() and ((scored.score >= 0.3) == (scored.predicted == 1)).all()
    held = scored[scored.held_out]
    # 34 toxic texts to learn from; the README has the figures of larger tables
    assert (held.predicted == held.toxic).mean() >= 0.88 and held.predicted[held.toxic == 1].mean() >= 0.5


def test_gradients_of_the_network():
    net = toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    found = toxicity.features(["idiot", "the", "tree", "a"])
    index, mask = np.array([[0, 1, 2, 3] * 6, [3, 2, 1, 1] * 6]), np.ones((2, 24), bool)
    mask[1, 15:] = False
    run = lambda: net.gradients(*found, index, mask, np.array([1.0, 0.0]), np.zeros(4, bool))
    _, grad = run()
    for k, value in net.p.items():
        flat, at = value.reshape(-1), int(np.argmax(np.abs(np.asarray(grad[k]).reshape(-1))))
        kept = flat[at]
        flat[at] = kept + 1e-4
        up, _ = run()
        flat[at] = kept - 1e-4
        down, _ = run()
        flat[at] = kept
        assert abs((up - down) / 2e-4 - np.asarray(grad[k]).reshape(-1)[at]) < 1e-3


def test_long_texts_are_learned_from(spark):
    rng = random.Random(2)
    of = lambda words: " ".join(rng.choice(words) + str(rng.randint(0, 9)) for _ in range(2000))
    rows = [(k, of(("idiot", "moron", "scum", "filth")) if k % 2 else of(("lake", "river", "meadow", "forest"))) for k in range(0, 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert min(len(t) for _, t in rows) > toxicity.LONGEST
    net = toxicity.fit(docs, spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, toxic int"))
    got = {r.doc_id: r.predicted for r in toxicity.score_documents(docs, net).collect()}
    assert np.mean([got[k] == k % 2 for k in got]) > 0.95
    model = quality.fit(docs)  # stretches of long texts train its scorer, too
    assert np.abs(model.weights).max() > 0
    long = [(k, "token = " + "".join(rng.choice("0123456789abcdef") for _ in range(200))) for k in range(20)]
    assert sum(secrets.fit(spark.createDataFrame(long, "doc_id long, text string")).credentials.ends) > 0


def test_repeated_rows_are_learned_from_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "_train", lambda word, shape, first, label: (seen.append(len(label)), (np.ones(quality.BUCKETS), float(len(label))))[1])
    docs = spark.createDataFrame([(1, "the same words in every row")] * 500 + [(k, "other words %d" % k) for k in range(30)], "doc_id long, text string")
    assert quality.fit(docs, sample=10).bias <= 10


def test_features_of_a_word_are_its_own():
    words = ["a", "it", "day", "lake", "x!", "idiot", "..."]
    together = toxicity.features(words)
    for k, w in enumerate(words):
        bucket, groups, _ = toxicity.features([w])
        assert bucket[0] == together[0][k] and list(groups) == list(together[1][together[2][k] : together[2][k + 1]])


def test_scores_of_the_network_by_plain_loops():
    net = toxicity.train(["you idiot and fool go away"] * 6 + ["a fine day at the lake"] * 6, np.array([1] * 6 + [0] * 6))
    p, n = net.p, toxicity.STATE
    sigmoid = lambda x: 1 / (1 + np.exp(-x))

    def logit(words):
        x = [net.inputs(*toxicity.features([w]))[0] for w in words]
        states = np.zeros((len(x), 2 * n))
        for k, d in enumerate("fb"):
            h = np.zeros(n)
            for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
                g = x[t] @ p[f"in_{d}"] + p[f"off_{d}"]
                z, r = sigmoid(g[:n] + h @ p[f"own_{d}"][:, :n]), sigmoid(g[n : 2 * n] + h @ p[f"own_{d}"][:, n : 2 * n])
                h = h + z * (np.tanh(g[2 * n :] + (r * h) @ p[f"own_{d}"][:, 2 * n :]) - h)
                states[t, k * n : (k + 1) * n] = h
        weight = np.exp(np.tanh(states @ p["att"] + p["att_off"]) @ p["att_out"])
        return (weight / weight.sum()) @ states @ p["out"] + p["out_off"][0]

    values = ["You IDIOT", "a day", "", " ".join("word%d" % k for k in range(61)) + " fool", "one"]
    want = []
    for v in values:
        words = v.lower().split()
        best = max((logit(words[a : a + toxicity.WINDOW]) for a in toxicity.windows(len(words))), default=0) if words else None
        want.append(0.0 if best is None else sigmoid(net.scale[0] * best + net.scale[1]))
    assert toxicity.Scorer(net).of(pa.array(values)) == pytest.approx(want, abs=1e-4)


# 7


def test_quality_against_labels(spark):
    d = "/root/testdata/sf0.01"
    docs = common.table(spark, d, "documents")
    scored = quality.score_documents(docs, quality.fit(docs)).join(common.table(spark, d, "labels"), "doc_id").toPandas()
    assert (scored.kept == (scored.quality == 1)).mean() >= 0.93
    assert ((scored.posterior > 0.5) == (scored.quality == 1)).mean() >= 0.95


def test_accuracies_find_the_useless_labeller():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.7
    votes = np.zeros((4000, len(quality.HEURISTICS)), np.int8)
    for h, right in enumerate((0.95, 0.9, 0.85, 0.5)):
        votes[:, h] = np.where(rng.random(4000) < right, truth, ~truth) * 2 - 1
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    odds, posterior = quality.accuracies(patterns, counts.astype(float))
    assert ((posterior[inverse.reshape(-1)] > 0.5) == truth).mean() > 0.9
    assert abs(odds[3, 2]) < 0.6 < odds[0, 2]


def test_expectation_maximisation_by_plain_loops():
    rng = np.random.default_rng(5)
    rows = [tuple(int(v) for v in rng.choice([-1, 0, 1], len(quality.HEURISTICS), p=[0.2, 0.4, 0.4])) for _ in range(150)]
    patterns, counts = zip(*collections.Counter(rows).items())
    odds, posterior = quality.accuracies(np.array(patterns), np.array(counts, float), rounds=5)
    belief = {r: 0.1 if min(r) < 0 else 0.9 for r in set(rows)}
    for _ in range(5):
        good = [{v: 0.5 + sum(belief[r] for r in rows if r[h] == v) for v in (-1, 0, 1)} for h in range(len(rows[0]))]
        bad = [{v: 0.5 + sum(1 - belief[r] for r in rows if r[h] == v) for v in (-1, 0, 1)} for h in range(len(rows[0]))]
        each = [{v: math.log(g[v] / sum(g.values())) - math.log(b[v] / sum(b.values())) for v in g} for g, b in zip(good, bad)]
        each = [{-1: min(0, e[-1]), 0: e[0], 1: max(0, e[1])} for e in each]
        share = (sum(belief[r] for r in rows) + 1) / (len(rows) + 2)
        belief = {r: 1 / (1 + math.exp(-(math.log(share / (1 - share)) + sum(e[v] for e, v in zip(each, r))))) for r in belief}
    assert posterior == pytest.approx([belief[p] for p in patterns], abs=1e-9)
    assert odds[0] == pytest.approx([each[0][v] for v in (-1, 0, 1)], abs=1e-9)


def test_scorer_by_plain_sums(spark):
    docs = spark.createDataFrame([(k, "plain words stand here, number %d." % k if k % 2 else "BUY BUY BUY BUY %d" % k) for k in range(40)], "doc_id long, text string")
    model = quality.fit(docs)
    got = {r.doc_id: r.score for r in quality.score_documents(docs, model).collect()}
    for r in docs.collect():
        raw, at = common.texts_as_bytes(pa.array([r.text]))
        word, shape = quality.features_of(raw, *common.word_hashes(raw, at))
        total = sum(model.weights[a] + model.weights[b] for a, b in zip(word, shape)) / len(r.text.split())
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-(model.bias + total))), abs=1e-9)


# 8


def test_language_model_against_counts(spark, docs, texts):
    training = common.fold_of(F.col("doc_id"), 7) != 2
    model = lm.fit(docs.where(training), vocabulary=80, classes=8, carried=300, seeds=40)
    got = lm.score_documents(docs, model, training).toPandas().set_index("doc_id")
    counts = collections.Counter()
    for i, t in zip(texts.doc_id, texts.text):
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(t.encode().lower().split())
            counts[b" "] += 1
    n, v = sum(counts.values()), len(counts)
    for i, t in zip(texts.doc_id, texts.text):
        words = [*t.encode().lower().split(), b" "]
        row = got.loc[i]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert row.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel=1e-9)
        assert row.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
        path = [len(model.mass) - 1, *(model.class_of(w.decode()) for w in words[:-1]), len(model.mass) - 1]
        given = sum(math.log10(counts[w] + lm.UNSEEN_WORD) - math.log10(model.mass[k, 0] + lm.UNSEEN_WORD * (model.mass[k, 1] + 1)) for w, k in zip(words, path[1:]))
        assert row.score == pytest.approx(given + sum(model.steps[a, b] for a, b in zip(path, path[1:])), rel=1e-9)
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_exchange_finds_planted_classes():
    pairs = np.zeros((12, 12))
    for a in range(12):
        for b in range(12):
            pairs[a, b] = 50 if (a % 3 + 1) % 3 == b % 3 else 1
    own = lm.exchange(pairs, 3, 10)
    assert all(len({own[k] for k in range(c, 12, 3)}) == 1 for c in range(3)) and len(set(own)) == 3


def test_exchange_heeds_neighbours_that_do_not_move():
    pairs = np.zeros((8, 8))  # six words, two still ones; the words meet the still ones alone
    for w in range(6):
        pairs[w, 6 + (w >= 3)] = pairs[6 + (w >= 3), w] = 50
    own = lm.exchange(pairs, 2, 10, 2)
    assert len(own) == 6 and len(set(own[:3])) == len(set(own[3:])) == 1 and own[0] != own[3]


def test_gains_are_differences_of_likelihood():
    rng = np.random.default_rng(3)
    for _ in range(20):
        pairs, k = rng.integers(0, 6, (9, 9)).astype(float), 4
        own = rng.integers(0, k, 9)
        table_of = lambda own: np.eye(k)[own].T @ pairs @ np.eye(k)[own]
        w = int(rng.integers(9))
        alone = pairs.copy()
        alone[w] = alone[:, w] = 0
        out, into = pairs[w] @ np.eye(k)[own], pairs[:, w] @ np.eye(k)[own]
        out[own[w]] -= pairs[w, w]
        into[own[w]] -= pairs[w, w]
        got = lm.gains(np.eye(k)[own].T @ alone @ np.eye(k)[own], out, into, pairs[w, w])
        want = np.array([lm.likelihood(table_of(np.where(np.arange(9) == w, b, own))) for b in range(k)])
        assert got - got[0] == pytest.approx(want - want[0], abs=1e-9)


def test_exchange_is_the_plain_one():
    rng = np.random.default_rng(4)
    for _ in range(8):
        pairs, k = rng.integers(0, 9, (12, 12)).astype(float), 3
        own = np.arange(12) % k
        for _ in range(4):
            for w in range(12):
                each = [lm.likelihood(np.eye(k)[o].T @ pairs @ np.eye(k)[o]) for o in (np.where(np.arange(12) == w, b, own) for b in range(k))]
                if max(each) > each[own[w]] + 1e-9:
                    own[w] = int(np.argmax(each))
        assert list(lm.exchange(pairs, k, 4)) == list(own)


def test_the_whole_vocabulary_is_clustered(spark):
    rng = random.Random(12)
    kinds = [[c + "%d" % k for k in range(40)] for c in "abc"]
    skewed = [1 / (k + 1) for k in range(40)]
    lines = [" ".join(rng.choices(kinds[n % 3], skewed)[0] for n in range(30)) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    model = lm.fit(docs, vocabulary=200, classes=3, seeds=12)
    of = {w: model.class_of(w) for kind in kinds for w in kind}
    assert all(len({of[w] for w in kind}) == 1 and of[kind[0]] < 3 for kind in kinds) and len(set(of.values())) == 3
    assert model.mass[:, 0].sum() == 1500 * 31 and model.mass[:, 1].sum() == 121


def test_shapes_of_words():
    words = ["der", "Haus.", "12", "12,", "a-b", "...", "été", "internationally", "x1y?!"]
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    _, _, start, end = common.word_hashes(raw, np.array([0, len(raw)]))
    assert list(lm.shapes(raw, start, end)) == [1, 9, 7, 15, 6, 8, 2, 4, 14]


def test_the_end_counts_whatever_its_rank(spark):
    docs = spark.createDataFrame([(k, "a b c d " * 50 + "e%d" % k) for k in range(4)], "doc_id long, text string")
    for carried in (3, 4, 100):  # none, the frequent ones, all
        model = lm.fit(docs, vocabulary=2, classes=2, carried=carried)
        got = lm.score_documents(docs.union(docs), model, F.lit(True)).toPandas()
        n, v = 4 * 202, 9
        want = 200 * math.log10(201 / (n + v + 1)) + math.log10(2 / (n + v + 1)) + math.log10(5 / (n + v + 1))
        assert list(got.n_known) == [202] * 8 and list(got.base_score) == pytest.approx([want] * 8, rel=1e-9)


def test_dense_texts_are_searched_in_time():
    rng = random.Random(9)
    piece = lambda: rng.choice(["call 600 700 800", "mail a%d@b.pl" % rng.randint(0, 99), "+48 600 700 800", "tel. 61 852 33 11", "1.2.3.4", "123-45-6789", "x"])
    small = " ".join(piece() for _ in range(400))
    # what search finds free is what a look at every span finds free
    found = pii.find(small)
    before = [(s, e) for k, s, e, _ in found if k not in ("iban", "phone_local", "ssn")]
    for kind, pattern in (("phone_local", pii._LOCAL_PHONE), ("ssn", pii._SSN)):
        free = {m.span() for m in pattern.finditer(small) if not any(s < m.end() and m.start() < e for s, e in before)}
        assert {(s, e) for k, s, e, _ in found if k == kind} <= free
    dense = " ".join("phone 61 852 %02d %02d or a%d@b.pl" % (k % 100, k // 100 % 100, k) for k in range(10_000))
    began = time.perf_counter()
    assert len(pii.find(dense)) >= 10_000
    assert time.perf_counter() - began < 5


# 10


def test_counts_over_block_borders(spark, docs):
    files = tokencount.write_files(docs.repartition(3), queries.vocabulary(), block=64)
    got = {r.doc_id: r.n_tokens for r in tokencount.count_documents(common.stash(files, "tokens"), 50256).collect()}
    want = {r.doc_id: r.n_tokens for r in bpe.digest_documents(docs, queries.vocabulary()).collect()}
    assert got == want
    raw = [(0, 0, 2, np.array([5, 6, 9], "<u2").tobytes()), (0, 1, 2, np.array([7, 8, 8], "<u2").tobytes()), (0, 2, 2, np.array([9, 9, 1], "<u2").tobytes())]
    small = spark.createDataFrame([(*r, None) for r in raw], tokencount._FILE)
    assert sorted((r.ordinal, r.n_tokens) for r in tokencount.count_tokens(small, 9).collect()) == [(0, 2), (1, 3), (2, 0)]


# pipeline


def test_ranges_of_blocks_and_wide_ids(spark, docs, monkeypatch):
    files = tokencount.write_files(docs.repartition(2), queries.vocabulary(), block=50)
    want = sorted((r.doc_id, r.n_tokens) for r in tokencount.count_documents(files, 50256).collect())
    monkeypatch.setattr(tokencount, "RANGE", 3)
    assert sorted((r.doc_id, r.n_tokens) for r in tokencount.count_documents(files, 50256).collect()) == want
    wide = spark.createDataFrame([(0, 0, 4, np.array([70000, 9, 8, 65536 + 9, 1, 9], "<u4").tobytes(), None)], tokencount._FILE)
    assert sorted((r.ordinal, r.n_tokens) for r in tokencount.count_tokens(wide, 9).collect()) == [(0, 1), (1, 3)]


def test_pipeline_keeps_and_drops(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.01"
    docs = common.table(spark, d, "documents")
    bench = common.table(spark, d, "benchmark").first().text
    rng = random.Random(8)
    clean = " ".join("w%d" % rng.randint(0, 10**6) for _ in range(60))
    extra = [(90_001, clean), (90_002, clean + " end"), (90_003, "Words before. " + bench + " words after."), (90_004, " ".join("q%d" % rng.randint(0, 10**6) for _ in range(50)) + " a@b.co"), (90_005, ("you idiot moron scum trash " * 5).strip())]
    df = docs.unionByName(spark.createDataFrame([(k, t, "en", "src0", len(t)) for k, t in extra], docs.schema))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = common.stash(stage(spark, df, d), "t-" + name.replace(" ", ""))
        assert df.columns == docs.columns
    left = {r.doc_id: r.text for r in df.where("doc_id > 90000").collect()}
    assert set(left) == {90_001, 90_004} and left[90_004].endswith("<EMAIL>")
    out = corpus_pipeline.STAGES[-1][1](spark, df, d)
    own = bpe.Codec(queries.vocabulary())
    assert {own.decode(np.frombuffer(r.ids, "<u4")) for r in out.where("doc_id > 90000").collect()} == set(left.values())


def test_stages_take_edges_and_empty_tables(spark, sf_dir):
    import corpus_pipeline

    schema = "doc_id long, text string, kept_id long, held_row long, kept_key long, key string"
    rows = [(k, t, 7, 8, 9, "x") for k, t in EDGES]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        full, none = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
        out = stage(spark, full, sf_dir)
        assert out.columns == full.columns and out.count() == len(rows) - (name == "near duplicates"), name
        assert stage(spark, none, sf_dir).count() == 0
    out = corpus_pipeline.encode(spark, spark.createDataFrame(rows, schema), sf_dir)
    assert out.columns == ["doc_id", "ids", "n_tokens"] and out.count() == len(rows)


def test_hashes_of_words_and_shingles():
    raw, at = common.texts_as_bytes(pa.array(["Ab cd", "", "ab\tCD\n", "abcd", "x " * 9]))
    hashed, first, start, end = common.word_hashes(raw, at)
    assert np.diff(first).tolist() == [2, 0, 2, 1, 9]
    assert hashed[0] == hashed[2] and hashed[1] == hashed[3] and hashed[4] not in (hashed[0], hashed[1])
    assert bytes(raw[start[1] : end[1]]) == b"cd"
    sets, of = neardup.shingles(raw, at)
    assert np.diff(of).tolist() == [1, 0, 1, 1, 1]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_as_sql(spark, sf_dir, name):
    from compare import connect, difference

    assert difference(queries.QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir).execute(queries.ORACLE_SQL[name]).df()) == ""
