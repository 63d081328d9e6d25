"""Quality from weak labels: overlapping heuristics vote, expectation-maximisation weighs them, a hashed linear scorer learns.

Each heuristic says good, bad or nothing of a text. How often each pattern of votes occurs, over all texts, is all that
expectation-maximisation needs to estimate how accurate each heuristic is, without labels. The posterior of a
text's votes is its training label for a linear scorer over hashed words and signs, which then scores every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import batches_of, whole, word_hashes

#: Buckets of hashed words; shapes of words are hashed too.
BUCKETS = 1 << 15
#: Distinct texts, of smallest hash, that the scorer learns from, and how many characters of each: of a longer one, a stretch at a place by its hash.
SAMPLE, STRETCH = 6000, 8_000
#: Passes over the sample, rate, and decay of weights.
PASSES, RATE, DECAY = 12, 0.5, 1e-5
#: Words before a word among which it may stand already.
AGAIN = 8
#: From which score a text is kept.
KEEP = 0.5

HEURISTICS = ("capitals", "signs", "bars", "repeats", "pairs", "regular", "short", "lengths", "plain")


def votes_of(raw: np.ndarray, offsets: np.ndarray, hashed: np.ndarray, first: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A row of votes for each text: 1 good, -1 bad, 0 nothing; in the order of HEURISTICS. An empty text gets bad and nothing."""
    rows = len(offsets) - 1
    text = np.repeat(np.arange(rows), np.diff(offsets))
    count = lambda mask: np.bincount(text[mask], minlength=rows).astype(float)
    upper = count((raw >= 65) & (raw <= 90))
    lower = count((raw >= 97) & (raw <= 122))
    high = count(raw >= 128)
    bars = count(raw == ord("|"))
    ends = count((raw == ord(".")) | (raw == ord(",")) | (raw == ord("?")))
    signs = count((raw > 32) & (raw < 127) & ~((raw >= 48) & (raw <= 57)) & ~((raw >= 65) & (raw <= 90)) & ~((raw >= 97) & (raw <= 122))) - ends - bars
    n = np.diff(first).astype(float)
    word_text = np.repeat(np.arange(rows), np.diff(first))
    size = np.bincount(word_text, weights=end - start, minlength=rows)
    order = np.lexsort((hashed, word_text))
    fresh = np.ones(len(hashed), bool)
    fresh[1:] = (hashed[order][1:] != hashed[order][:-1]) | (word_text[order][1:] != word_text[order][:-1])
    distinct = np.bincount(word_text[order][fresh], minlength=rows)
    again = np.zeros(len(hashed), bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (word_text[1:] == word_text[:-1])
    twice = np.bincount(word_text[again], minlength=rows)
    some = np.maximum(n, 1)
    letters = np.maximum(upper + lower + high, 1)

    bad = lambda mask: np.where(mask, -1, 0)
    varied = distinct / np.minimum(some, 200)
    plain = (upper / letters <= 0.2) & (signs / some <= 0.1) & (bars / some <= 0.02)
    regular = (ends / some >= 0.03) & (ends / some <= 0.6) & (twice / some <= 0.05)
    votes = np.stack([
        bad(upper / letters >= 0.4),
        bad(signs / some >= 0.4),
        bad(bars / some >= 0.1),
        bad(varied <= 0.2),
        bad(twice / some >= 0.2),
        np.where(regular, 1, bad(ends / some < 0.01)),
        bad(n < 4),
        np.where(np.abs(size / some - 5.5) <= 2.5, 1, bad(np.abs(size / some - 5.5) > 6)),
        np.where(plain, 1, 0),
    ], axis=1)
    votes[n == 0] = [0, 0, 0, 0, 0, 0, -1, 0, 0]
    return votes.astype(np.int8)


def features_of(raw: np.ndarray, hashed: np.ndarray, first: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word, and of its shape (first, last and last but one byte by class, and whether it stood among the AGAIN words before)."""
    kind = np.zeros(256, np.uint64)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 4
    for k, c in enumerate(b".,!?|#$%&*-'\""):
        kind[c] = 5 + k
    own = kind[raw] if len(raw) else kind[:0]
    a, b, c = (own[x] if len(own) else own for x in (start, end - 1, np.maximum(start, end - 2)))
    place = np.arange(len(hashed)) - np.repeat(first[:-1], np.diff(first))
    again = np.zeros(len(hashed), bool)
    for k in range(1, AGAIN + 1):
        again[k:] |= (hashed[k:] == hashed[:-k]) & (place[k:] >= k)
    shape = ((a * np.uint64(400) + b * np.uint64(20) + c) * np.uint64(2) + again.astype(np.uint64)) % np.uint64(BUCKETS // 4)
    return (hashed % np.uint64(BUCKETS - BUCKETS // 4)).astype(np.int64) + BUCKETS // 4, shape.astype(np.int64)


def _sums(weights: np.ndarray, word: np.ndarray, shape: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The mean weight of a text's words and of their shapes, by text."""
    sums = np.concatenate([[0.0], np.cumsum(weights[word] + weights[shape])])
    n = np.diff(first)
    return (sums[first[1:]] - sums[first[:-1]]) / np.maximum(n, 1)


def accuracies(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """By expectation-maximisation: log-odds by heuristic and vote (last row: the share of good), and each pattern's posterior.

    Votes are independent given the truth. A text with any vote for bad starts as bad; half a text of each outcome is added, so that no odds are infinite.
    """
    posterior = np.where((patterns < 0).any(1), 0.1, 0.9)
    hot = (patterns[:, :, None] == np.array([-1, 0, 1])).astype(float)
    for _ in range(rounds):
        good = np.einsum("p,phv->hv", counts * posterior, hot) + 0.5
        bad = np.einsum("p,phv->hv", counts * (1 - posterior), hot) + 0.5
        odds = np.log(good / good.sum(1, keepdims=True)) - np.log(bad / bad.sum(1, keepdims=True))
        # a heuristic may be useless, but its good vote never speaks for bad
        odds[:, 0], odds[:, 2] = np.minimum(odds[:, 0], 0), np.maximum(odds[:, 2], 0)
        share = float((counts * posterior).sum() + 1) / (counts.sum() + 2)
        log_odds = np.log(share / (1 - share)) + np.einsum("phv,hv->p", hot, odds)
        after = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        if np.abs(after - posterior).max(initial=0) < 1e-9:
            break
        posterior = after
    return np.vstack([odds, [share, 0, 0]]) if len(patterns) else np.zeros((len(HEURISTICS) + 1, 3)), posterior


@dataclass
class Model:
    odds: np.ndarray
    posterior: dict[bytes, float]
    weights: np.ndarray
    bias: float


def vote_documents(docs: DataFrame) -> DataFrame:
    """doc_id, votes (binary, a byte for each heuristic) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in batches_of("text", batches):
            votes = votes_of(raw, offsets, *word_hashes(raw, offsets))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([v.tobytes() for v in votes], pa.binary())], ["doc_id", "votes"])

    return whole(docs).mapInArrow(run, "doc_id long, votes binary")


def stretch_of(text: str, key: int) -> str:
    """The text, or STRETCH characters of a longer one, from a place that the key chooses, without the words cut at its borders."""
    if len(text) <= STRETCH:
        return text
    at = key % (len(text) - STRETCH + 1)
    words = text[at : at + STRETCH].split(" ")
    return " ".join(words[1:-1]) if len(words) > 2 else text[at : at + STRETCH]


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Weigh the heuristics by the votes of all texts, then train the scorer on ``sample`` distinct texts and the posteriors of their votes.

    The votes are of whole texts; what is learned from is bounded in rows and in characters, and one task trains on it. The driver gets
    the counts of vote patterns (at most 3 to the power of the heuristics) and the weights.
    """
    counted = vote_documents(docs).groupBy("votes").agg(F.count("*").alias("n")).collect()
    patterns = np.array([np.frombuffer(r["votes"], np.int8) for r in counted]).reshape(-1, len(HEURISTICS))
    odds, posterior = accuracies(patterns, np.array([r["n"] for r in counted], float))
    known = {bytes(r["votes"]): float(p) for r, p in zip(counted, posterior)}
    # keys of texts are chosen first, so that only the chosen texts travel, each once however many rows hold it
    texts = whole(docs).select("text", F.xxhash64("text").alias("key"))
    few = texts.select("key").distinct().orderBy(F.xxhash64("key"), "key").limit(sample)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in batches_of("text", batches):
            votes = votes_of(raw, offsets, *word_hashes(raw, offsets))
            cut = [stretch_of(t, k) for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(cut, pa.string()), pa.array([known.get(v.tobytes(), 0.5) for v in votes], pa.float64())], ["key", "text", "label"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = pa.Table.from_batches(list(batches), pa.schema([("key", pa.int64()), ("text", pa.string()), ("label", pa.float64())])).sort_by("key")
        weights, bias = np.zeros(BUCKETS), 0.0
        if got.num_rows:
            parts, sizes = [], []
            column = pa.RecordBatch.from_arrays([got.column("text").combine_chunks()], ["text"])
            for _, raw, offsets in batches_of("text", [column]):
                found = word_hashes(raw, offsets)
                parts.append(features_of(raw, *found))
                sizes.append(np.diff(found[1]))
            first = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            word, shape = (np.concatenate([p[k] for p in parts]).astype(np.int32) for k in (0, 1))
            weights, bias = _train(word, shape, first, got.column("label").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([weights.tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])

    # a text comes once for each row that holds it until here: partly reduced before it travels
    picked = texts.join(F.broadcast(few), "key", "left_semi").select("text", "key").mapInArrow(label, "key long, text string, label double")
    once = picked.groupBy("key").agg(F.first("text").alias("text"), F.first("label").alias("label"))
    got = once.repartition(1).mapInArrow(learn, "weights binary, bias double").first()
    weights, bias = (np.frombuffer(got["weights"]).copy(), float(got["bias"])) if got is not None else (np.zeros(BUCKETS), 0.0)
    return Model(odds, known, weights, bias)


def _train(word: np.ndarray, shape: np.ndarray, first: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels; good and bad weigh the same in all; adaptive steps over small groups of texts."""
    weights, seen, bias = np.zeros(BUCKETS), np.full(BUCKETS, 1e-6), 0.0
    n = len(label)
    mass = np.array([max(1e-9, (1 - label).sum()), max(1e-9, label.sum())])
    balance = label * (n / 2 / mass[1]) + (1 - label) * (n / 2 / mass[0])
    rng = np.random.default_rng(7)
    for _ in range(PASSES):
        for group in np.array_split(rng.permutation(n), max(1, n // 64)):
            span = np.diff(first)[group]
            at = np.concatenate([np.arange(first[g], first[g + 1]) for g in group]) if span.sum() else np.zeros(0, np.int64)
            local = np.concatenate([[0], np.cumsum(span)])
            p = 1 / (1 + np.exp(-np.clip(bias + _sums(weights, word[at], shape[at], local), -30, 30)))
            error = (p - label[group]) * balance[group]
            part = np.repeat(error / np.maximum(span, 1), span)
            grad = np.bincount(word[at], part, BUCKETS) + np.bincount(shape[at], part, BUCKETS)
            grad = grad / len(group)
            hit = np.flatnonzero(grad)
            seen[hit] += grad[hit] ** 2
            weights[hit] -= RATE * (grad[hit] / np.sqrt(seen[hit]) + DECAY * weights[hit])
            bias -= 0.1 * error.mean()
    return weights, bias


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """For every row doc_id, score (0 to 1, higher: better), posterior (of its votes), kept (score >= KEEP).

    A null text is empty; an empty text has the posterior of its one vote and is scored by the bias alone, capped below KEEP. Equal
    rows get equal scores; an empty table gives none; other columns don't matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in batches_of("text", batches):
            found = word_hashes(raw, offsets)
            word, shape = features_of(raw, *found)
            score = 1 / (1 + np.exp(-np.clip(model.bias + _sums(model.weights, word, shape, found[1]), -30, 30)))
            score = np.where(np.diff(found[1]) == 0, np.minimum(score, KEEP / 2), score)
            posterior = [model.posterior.get(v.tobytes(), 0.5) for v in votes_of(raw, offsets, *found)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array(posterior, pa.float64()), pa.array(score >= KEEP)], ["doc_id", "score", "posterior", "kept"])

    return whole(docs).mapInArrow(run, "doc_id long, score double, posterior double, kept boolean")
