"""Toxicity: a bidirectional gated recurrent network with attention pooling, over words and their characters.

A text is read in overlapping windows of words. A word enters as the vector of its hashed form and the mean vector of its
hashed character groups, so that unseen spellings are read too. Attention weighs the states of both directions; the window's
logit follows, and the highest of a text decides. The network is trained here, in numpy, on a bounded sample of labelled
texts; as labels are of whole texts, it learns from the windows that look worst, first by how
features are spread over the labels, then by its own view.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import fold_of, whole

#: Words in a window, and from one window to the next.
WINDOW, STRIDE = 24, 12
#: Hashed words, hashed character groups, and the sizes of their vectors, of a direction's state, and of the attention.
WORDS, GROUPS, WIDE, STATE, ATTEND = 1 << 12, 1 << 13, 12, 8, 8
#: Labelled texts of either label, of smallest hash, that it learns from, of up to so many characters each; and so many longer ones besides, whole up to so
#: many characters, with a stretch at a place by their hash beyond.
SAMPLE, LONGEST = 2000, 8_000
LONG, WHOLE = 200, 60_000
#: Passes (more over small samples, for so many steps at least), windows in a step, rate, and share of words whose own vector is left out in training.
PASSES, STEPS, GROUP, RATE, LEAVE_OUT = 6, 300, 128, 0.01, 0.3
#: The folds of ids: the last is never learned from. From which score a text is toxic.
FOLDS, HELD_OUT, TOXIC = 4, 2, 0.3
#: Words whose vectors a task keeps, and characters of texts that it reads at once.
KEPT_WORDS, SLICE_CHARS = 60_000, 200_000

_EDGE = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word its bucket; and the buckets of its character groups, one after another, with their offsets.

    Signs at a word's edges are left out. Groups are all runs of three characters, with marks for both ends, and the first three to five.
    """
    cores = ["\x02" + (w.strip(_EDGE) or w) + "\x03\x03" for w in words]
    bucket = np.array([zlib.crc32(c.encode("utf-8", "replace")) for c in cores], np.int64) % WORDS
    flat = np.frombuffer("".join(cores).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    size = np.array([len(c) for c in cores], np.int64)
    start = np.cumsum(size) - size
    padded = np.concatenate([flat, np.zeros(8, np.uint64)])
    n = len(flat)
    with np.errstate(over="ignore"):
        rolled = [padded[k : k + n] * np.uint64(0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019 * k & 0xFFFFFFFFFFFFFFFF | 1) for k in range(6)]
        three = rolled[0] + rolled[1] + rolled[2]
        # a short word's fronts end with it: what stands behind belongs to another word
        own = [rolled[k][start] * (size > k).astype(np.uint64) for k in (3, 4, 5)]
        fronts = [three[start] + own[0], three[start] + own[0] + own[1], three[start] + own[0] + own[1] + own[2]]
    to = lambda x: ((x >> np.uint64(29)) % np.uint64(GROUPS)).astype(np.int64)
    counts = size - 2 + 3
    offsets = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(offsets[-1], np.int64)
    inner = np.ones(n, bool)
    inner[np.concatenate([start + size - 1, start + size - 2])] = False
    place = np.ones(offsets[-1], bool)
    for k, front in enumerate(fronts):
        at = offsets[1:] - 3 + k
        place[at] = False
        out[at] = to(front + np.uint64(k + 1))
    out[place] = to(three)[inner]
    return bucket, out, offsets


def windows(n: int) -> np.ndarray:
    """Where windows start in a text of n words: the last one reaches its end."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE) if n > WINDOW else np.zeros(1, np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    def __init__(self, seed: int = 6):
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.p = {"word": draw(WORDS, WIDE), "group": draw(GROUPS, WIDE)}
        for d in ("f", "b"):
            self.p |= {f"in_{d}": draw(2 * WIDE, 3 * STATE), f"off_{d}": np.zeros(3 * STATE, np.float32), f"own_{d}": draw(STATE, 3 * STATE)}
        self.p |= {"att": draw(2 * STATE, ATTEND), "att_off": np.zeros(ATTEND, np.float32), "att_out": draw(ATTEND), "out": draw(2 * STATE), "out_off": np.zeros(1, np.float32)}
        self.scale = np.array([1.0, 0.0, 0.0], np.float32)

    def inputs(self, bucket: np.ndarray, groups: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The input vector of each word."""
        sums = np.add.reduceat(self.p["group"][groups], offsets[:-1], axis=0) if len(groups) else np.zeros((0, WIDE), np.float32)
        return np.hstack([self.p["word"][bucket], sums / np.sqrt(np.diff(offsets))[:, None].astype(np.float32)]) if len(bucket) else np.zeros((0, 2 * WIDE), np.float32)

    def project(self, x: np.ndarray) -> np.ndarray:
        """What the gates of both directions get from input vectors."""
        return np.hstack([x @ self.p[f"in_{d}"] + self.p[f"off_{d}"] for d in ("f", "b")])

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows. gates: windows x words x both directions' three gates; mask: which words there are."""
        count, steps, _ = gates.shape
        states = np.zeros((count, steps, 2 * STATE), np.float32)
        for k, d in enumerate(("f", "b")):
            own = self.p[f"own_{d}"]
            h = np.zeros((count, STATE), np.float32)
            for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
                g = gates[:, t, k * 3 * STATE : (k + 1) * 3 * STATE]
                m = mask[:, t, None]
                zr = 1 / (1 + np.exp(-(g[:, : 2 * STATE] + h @ own[:, : 2 * STATE])))
                z, r = zr[:, :STATE], zr[:, STATE:]
                new = np.tanh(g[:, 2 * STATE :] + (r * h) @ own[:, 2 * STATE :])
                after = np.where(m, h + z * (new - h), h)
                if keep is not None:
                    keep.append((k, d, t, h, z, r, new, m))
                h = after
                states[:, t, k * STATE : (k + 1) * STATE] = h
        hidden = np.tanh(states @ self.p["att"] + self.p["att_off"])
        weight = np.where(mask, hidden @ self.p["att_out"], -1e9)
        weight = np.exp(weight - weight.max(1, keepdims=True)) * mask
        weight /= np.maximum(weight.sum(1, keepdims=True), 1e-9)
        pooled = np.einsum("wt,wts->ws", weight, states)
        if keep is not None:
            keep.append((states, hidden, weight, pooled))
        return pooled @ self.p["out"] + self.p["out_off"][0]

    def gradients(self, bucket, groups, offsets, index, mask, label, left_out) -> tuple[float, dict[str, np.ndarray]]:
        """The loss of windows and its gradients. index: the word at each place; left_out: words whose own vector is nought."""
        p = self.p
        x = self.inputs(bucket, groups, offsets)
        x[left_out, :WIDE] = 0
        gates = self.project(x)[index]
        keep: list = []
        logit = self.forward(gates, mask, keep)
        prob = _sigmoid(logit)
        loss = float(-np.mean(label * np.log(prob + 1e-9) + (1 - label) * np.log(1 - prob + 1e-9)))
        states, hidden, weight, pooled = keep.pop()
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        d_logit = ((prob - label) / len(label)).astype(np.float32)
        grad["out"], grad["out_off"][0] = pooled.T @ d_logit, d_logit.sum()
        d_pooled = d_logit[:, None] * p["out"]
        d_states = weight[:, :, None] * d_pooled[:, None, :]
        d_weight = np.einsum("wts,ws->wt", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
        grad["att_out"] = np.einsum("wt,wta->a", d_score, hidden)
        d_hidden = d_score[:, :, None] * p["att_out"] * (1 - hidden**2)
        grad["att"] = np.einsum("wts,wta->sa", states, d_hidden)
        grad["att_off"] = d_hidden.sum((0, 1))
        d_states += d_hidden @ p["att"].T
        d_gates = np.zeros_like(gates)
        d_h = {0: np.zeros_like(pooled[:, :STATE]), 1: np.zeros_like(pooled[:, :STATE])}
        for k, d, t, h, z, r, new, m in reversed(keep):
            own = p[f"own_{d}"]
            total = d_h[k] + d_states[:, t, k * STATE : (k + 1) * STATE]
            here = total * m
            d_new = here * z * (1 - new**2)
            d_z = here * (new - h) * z * (1 - z)
            back = d_new @ own[:, 2 * STATE :].T
            d_r = back * h * r * (1 - r)
            d_zr = np.hstack([d_z, d_r])
            grad[f"own_{d}"][:, : 2 * STATE] += h.T @ d_zr
            grad[f"own_{d}"][:, 2 * STATE :] += (r * h).T @ d_new
            d_h[k] = total * ~m + here * (1 - z) + back * r + d_zr @ own[:, : 2 * STATE].T
            d_gates[:, t, k * 3 * STATE : (k + 1) * 3 * STATE] = np.hstack([d_zr, d_new])
        by_word = np.zeros((len(bucket), 6 * STATE), np.float32)
        np.add.at(by_word, index[mask], d_gates[mask])
        d_x = np.zeros_like(x)
        for k, d in enumerate(("f", "b")):
            part = by_word[:, k * 3 * STATE : (k + 1) * 3 * STATE]
            grad[f"in_{d}"] = x.T @ part
            grad[f"off_{d}"] = part.sum(0)
            d_x += part @ p[f"in_{d}"].T
        d_x[left_out, :WIDE] = 0
        np.add.at(grad["word"], bucket, d_x[:, :WIDE])
        each = d_x[:, WIDE:] / np.sqrt(np.diff(offsets))[:, None].astype(np.float32)
        np.add.at(grad["group"], groups, np.repeat(each, np.diff(offsets), axis=0))
        return loss, grad

    def score(self, worst: np.ndarray, empty: np.ndarray) -> np.ndarray:
        """Scores of texts from the logits of their worst windows; texts without words get the score of the lowest logit, 0."""
        return np.where(empty, 0.0, _sigmoid(self.scale[0] * worst + self.scale[1]))


def _gather(starts: list[np.ndarray], sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows' words in the joined texts, their mask, and the first window of each text."""
    base = np.concatenate([[0], np.cumsum(sizes)])
    first = np.concatenate([[0], np.cumsum([len(s) for s in starts])])
    text = np.repeat(np.arange(len(starts)), np.diff(first))
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    at = start[:, None] + np.arange(WINDOW)
    mask = at < np.array(sizes, np.int64)[text][:, None]
    return np.where(mask, at + base[text][:, None], 0), mask, first


def train(texts: list[str], labels: np.ndarray, seed: int = 6) -> Network:
    """Fit the network. With one label only, or no texts, it is left untrained and its scores are that label's share."""
    net = Network(seed)
    labels = np.asarray(labels, np.float32)
    if not len(labels) or labels.min() == labels.max():
        share = float(np.clip(labels.mean() if len(labels) else 0.0, 0.01, 0.99))
        net.scale[:] = (0.0, np.log(share / (1 - share)), 0.0)
        return net
    rng = np.random.default_rng(seed)
    known: dict[str, int] = {}
    ids = [np.array([known.setdefault(w, len(known)) for w in t.lower().split()], np.int32) for t in texts]
    labels, ids = labels[[len(x) > 0 for x in ids]], [x for x in ids if len(x)]
    bucket, groups, offsets = features(list(known))
    del known
    joined = np.concatenate(ids)
    index, mask, first = _gather([windows(len(x)) for x in ids], [len(x) for x in ids])
    index = joined[index]
    owner = np.repeat(np.arange(len(ids)), np.diff(first))
    # how the features are spread over labels tells which windows to begin with
    feature = np.concatenate([bucket + GROUPS, groups])
    of_word = np.concatenate([np.arange(len(bucket)), np.repeat(np.arange(len(bucket)), np.diff(offsets))])
    order = np.argsort(of_word, kind="stable")
    feature, spans = feature[order], np.concatenate([[0], np.cumsum(np.diff(offsets) + 1)])
    seen = np.zeros((2, GROUPS + WORDS))
    for words, y in zip(ids, labels):
        own = np.unique(words)
        at = np.concatenate([np.arange(spans[w], spans[w + 1]) for w in own])
        seen[int(y), np.unique(feature[at])] += 1
    odds = np.log((seen[1] + 1) / (labels.sum() + 2)) - np.log((seen[0] + 1) / ((1 - labels).sum() + 2))
    suspicion = np.maximum.reduceat(odds[feature], spans[:-1])
    view = np.where(mask, suspicion[index], -99).max(1)
    del feature, of_word, order, spans, seen, odds
    moment: dict[str, tuple] = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0

    def logits() -> np.ndarray:
        parts = [(a, min(a + 20_000, len(bucket))) for a in range(0, len(bucket), 20_000)]
        gates = np.concatenate([net.project(net.inputs(bucket[a:b], groups[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])) for a, b in parts])
        return np.concatenate([net.forward(gates[index[a : a + 2048]], mask[a : a + 2048]) for a in range(0, len(index), 2048)])

    turns = max(PASSES, STEPS * GROUP // (4 * len(labels)))
    for turn in range(turns):
        if turn in (turns // 3, 2 * turns // 3):
            view = logits()
        ranked = np.lexsort((-view, owner))
        worst = ranked[first[:-1]]
        second = ranked[np.minimum(first[:-1] + 1, first[1:] - 1)]
        clean = labels == 0
        any_of = first[:-1] + (rng.random(len(labels)) * np.diff(first)).astype(np.int64)
        chosen = np.unique(np.concatenate([worst, second[clean], any_of[clean]]))
        for part in np.array_split(rng.permutation(chosen), max(1, len(chosen) // GROUP)):
            words, local = np.unique(index[part], return_inverse=True)
            local = local.reshape(index[part].shape)
            spans_of = np.diff(offsets)[words]
            at = np.concatenate([np.arange(offsets[w], offsets[w + 1]) for w in words])
            _, grad = net.gradients(bucket[words], groups[at], np.concatenate([[0], np.cumsum(spans_of)]), local, mask[part], labels[owner[part]], rng.random(len(words)) < LEAVE_OUT)
            step += 1
            for k, g in grad.items():
                m, v = moment[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.p[k] -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    worst = np.maximum.reduceat(logits(), first[:-1])
    a, b = 1.0, 0.0
    for _ in range(300):  # the scale of scores: two numbers, by plain descent on the sample
        error = _sigmoid(a * worst + b) - labels
        a, b = max(0.05, a - 0.05 * float((error * worst).mean())), b - 0.2 * float(error.mean())
    net.scale[:] = (a, b, 0.0)
    return net


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Network:
    """Train on labelled texts outside the held-out fold: ``sample`` of either label at most, those of smallest hash.

    Rows without a label or an id don't count; of an id with several labels the highest does.
    """
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marked = marked.where(fold_of(F.col("doc_id"), FOLDS) != HELD_OUT)
    size = F.length("text")
    cut = F.substring(F.col("text"), 1 + F.pmod(F.xxhash64("text"), size - WHOLE + 1).cast("int"), F.lit(WHOLE))
    texts = whole(docs).where(size > 0).select("doc_id", F.xxhash64("text").alias("key"), (size > LONGEST).alias("long"), F.when(size > WHOLE, cut).otherwise(F.col("text")).alias("text"))
    parts = []
    for label in (0, 1):
        # labels are narrow: the smallest hashes are found there; a part of them has no text, or a long one, so twice as many are looked up
        few = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample)
        found = texts.join(F.broadcast(few), "doc_id")
        for long, most in ((False, sample), (True, min(sample, LONG))):
            parts.append(found.where(F.col("long") == long).orderBy(F.xxhash64("doc_id"), "doc_id", "key").limit(most).select("text", "toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((y, zlib.crc32(t.encode()), t) for batch in batches for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        net = train([t for *_, t in rows], np.array([y for y, *_ in rows], np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((net.p, net.scale))], pa.binary())], ["net"])

    # the sample is bounded, so one task can train on it; the driver gets the weights alone
    weights = reduce(DataFrame.unionByName, parts).repartition(1).mapInArrow(run, "net binary").first()
    net = Network()
    if weights is not None:
        net.p, net.scale = pickle.loads(weights["net"])
    else:
        net = train([], np.zeros(0))
    return net


class Scorer:
    """Scores columns of texts; keeps what the network's gates get from the words met so far."""

    def __init__(self, net: Network):
        self.net = net
        self.known: dict[str, int] = {}
        self.gates = np.zeros((0, 6 * STATE), np.float32)

    def of(self, column: pa.Array) -> np.ndarray:
        return np.concatenate([self._slice(texts) for texts in _slices(column)] or [np.zeros(0)])

    def _slice(self, texts: list[str]) -> np.ndarray:
        split = [t.lower().split() for t in texts]
        if len(self.known) > KEPT_WORDS:
            self.known, self.gates = {}, self.gates[:0]
        known = self.known
        fresh = [w for w in dict.fromkeys(w for words in split for w in words) if w not in known]
        if fresh:
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            self.gates = np.concatenate([self.gates, self.net.project(self.net.inputs(*features(fresh)))])
        joined = np.array([known[w] for words in split for w in words], np.int64)
        sizes = [len(words) for words in split]
        index, mask, first = _gather([windows(n) for n in sizes], sizes)
        logits = np.full(len(index), -30.0)
        for a in range(0, len(index) if len(joined) else 0, 1024):
            logits[a : a + 1024] = self.net.forward(self.gates[joined[index[a : a + 1024]]], mask[a : a + 1024])
        return self.net.score(np.maximum.reduceat(logits, first[:-1]), np.array(sizes) == 0)


def score_documents(docs: DataFrame, net: Network) -> DataFrame:
    """For every row doc_id, held_out, score (0 to 1), predicted (1 from TOXIC on).

    All windows of the whole text count. A null text is empty, and a text without words scores 0. Equal rows get equal
    scores; an empty table gives none; other columns don't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.of(batch.column(1)), pa.float64())], ["doc_id", "score"])

    scored = whole(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, net: Network) -> DataFrame:
    """The rows, with all their columns, whose text isn't toxic; a null or empty text stays."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            yield batch.filter(pa.array(scorer.of(batch.column(at)) < TOXIC, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _slices(column: pa.Array) -> Iterator[list[str]]:
    texts, size = [], 0
    for text in column:
        text = text.as_py() or ""
        if texts and size + len(text) > SLICE_CHARS:
            yield texts
            texts, size = [], 0
        texts.append(text)
        size += len(text)
    if texts:
        yield texts
