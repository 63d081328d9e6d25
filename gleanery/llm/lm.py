"""Language-model scores: class-based n-grams after Brown.

Words belong to classes. The classes of a vocabulary, the most frequent words, come from exchange clustering: a word moves to the class that raises
the likelihood of the bigrams most. The most frequent ones among them move one by one; then all words of the vocabulary move in batches, each
judged against the classes of the round before, as in published work on distributed clustering. Other words belong to a class by
their shape. A text's probability is the product of class transitions and of words given their class, both smoothed.

Words are 64-bit hashes, and arrays in tasks. Counts of words and of pairs are tables; the driver gets only what the parameters bound: the
vocabulary, the carried counts, and a table of class pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import LOWER, batches_of, stash, whole, word_hashes

#: Words that are clustered, the classes they go to, and how many of them are exchanged one by one at first.
VOCABULARY, CLASSES, SEEDS = 20_000, 128, 400
#: Words at most whose counts travel to all tasks; other words' counts are joined.
CARRIED = 200_000
#: Rounds of exchange one by one, and in batches.
ROUNDS, BATCHES = 3, 3
#: Pseudo-counts of transitions and of words in a class.
UNSEEN_STEP, UNSEEN_WORD = 0.5, 0.5
#: Classes by shape: digits or other signs in the word, capitals don't count, by length and by ending.
SHAPES = 16
#: What stands for the end of a text among words.
END = -1
#: Parts of an octave of counts.
FINE = 16

_MARK = np.zeros(256, bool)
_MARK[list(b".,;:!?")] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_ENDING = np.zeros(256, bool)
_ENDING[list(b"ensr")] = True


def shapes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The class by shape, below SHAPES, of words that start and end at places of the bytes."""
    if not len(start):
        return np.zeros(0, np.int64)
    low = LOWER[raw]
    plain = np.maximum.accumulate(np.where(_MARK[low], -1, np.arange(len(low))))
    stop = np.maximum(plain[end - 1] + 1, start)  # without the marks at its end
    size = stop - start
    count = lambda of: np.concatenate([[0], np.cumsum(of[low])])
    letters, digits = count(_LETTER), count(_DIGIT)
    usual = np.minimum(2, size // 5) * 2 + ((size > 0) & _ENDING[low[stop - 1]])
    odd = letters[stop] - letters[start] < size
    return 8 * (stop < end) + np.where(odd, np.where(digits[stop] - digits[start] == size, 7, 6), usual)


class Index:
    """Places of keys among sorted distinct ones (unsigned 64-bit); keys are hashes, so their first bits tell nearly where they stand."""

    BITS = 18

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.start = np.searchsorted(keys >> np.uint64(64 - self.BITS), np.arange((1 << self.BITS) + 1, dtype=np.uint64)).astype(np.int32)

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        slot = (asked >> np.uint64(64 - self.BITS)).astype(np.int64)
        out = np.full(len(asked), -1, np.int64)
        at, stop = self.start[slot], self.start[slot + 1]
        todo = np.flatnonzero(at < stop)
        at, stop, own = at[todo], stop[todo], asked[todo]
        while len(todo):
            same = self.keys[at] == own
            out[todo[same]] = at[same]
            at = at + 1
            more = ~same & (at < stop)
            todo, at, stop, own = todo[more], at[more], stop[more], own[more]
        return out


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sums of their counts, and where each stands first."""
    every, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
    return every[first], np.add.reduceat(n[order], first) if len(first) else n[:0], order[first]


class Tally:
    """Counts keys of many slices of a task; a part is ready when MOST distinct ones have gathered."""

    MOST = 400_000

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.extra: list[np.ndarray] = []

    def add(self, keys: np.ndarray, extra: np.ndarray | None = None) -> bool:
        kept, counts, at = _merged([keys], [np.ones(len(keys), np.int64)])
        self.keys.append(kept)
        self.counts.append(counts)
        self.extra.append(kept if extra is None else extra[at])
        return sum(map(len, self.keys)) > self.MOST

    def part(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, counts, at = _merged(self.keys, self.counts)
        extra = np.concatenate(self.extra)[at]
        self.__init__()
        return keys, counts, extra


def count_words(docs: DataFrame) -> DataFrame:
    """word (its hash), c, kind (its shape): how often each word of the texts occurs; END, of kind SHAPES, once a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, texts = Tally(), 0

        def part(ends: int) -> pa.RecordBatch:
            words, counts, kinds = tally.part()
            if ends:
                words, counts, kinds = np.append(words.view(np.int64), END), np.append(counts, ends), np.append(kinds, SHAPES)
            return pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts), pa.array(kinds.astype(np.int32))], ["word", "c", "kind"])

        for batch, raw, offsets in batches_of("text", batches):
            words, _, start, end = word_hashes(raw, offsets)
            texts += batch.num_rows
            if tally.add(words, shapes(raw, start, end)):
                yield part(0)
        yield part(texts)

    return whole(docs).mapInArrow(run, "word long, c long, kind int").groupBy("word").agg(F.sum("c").alias("c"), F.max("kind").alias("kind"))


def _entropy(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def likelihood(table: np.ndarray) -> float:
    """Of bigrams, but for a constant: n log n over class bigrams less that over the classes' left and right margins."""
    return float(_entropy(table).sum() - _entropy(table.sum(1)).sum() - _entropy(table.sum(0)).sum())


def gains(table: np.ndarray, out: np.ndarray, into: np.ndarray, loop: float) -> np.ndarray:
    """What each class would gain by taking a word that the table of class bigrams lacks, but for what is the same for every choice.

    ``out`` and ``into`` count the word's bigrams towards and from the classes, ``loop`` those with itself.
    """
    to, by = np.flatnonzero(out), np.flatnonzero(into)
    gain = (_entropy(table[:, to] + out[to]) - _entropy(table[:, to])).sum(1) + (_entropy(table[by] + into[by, None]) - _entropy(table[by])).sum(0)
    spot = np.diagonal(table)
    gain += _entropy(spot + out + into + loop) - _entropy(spot + out) - _entropy(spot + into) + _entropy(spot)
    # whichever class takes the word, the others' margins grow by its bigrams with them; so does its own, before the rest of the word comes
    rows, columns = table.sum(1) + into, table.sum(0) + out
    return gain - (_entropy(rows + out.sum() + loop) - _entropy(rows) + _entropy(columns + into.sum() + loop) - _entropy(columns))


def exchange(pairs: np.ndarray, classes: int, rounds: int, still: int = 0) -> np.ndarray:
    """The class of each word from the matrix of bigram counts: words move, one by one, to where the likelihood is highest.

    The last ``still`` symbols are neighbours alone: each is a class of its own, which no word joins.
    """
    n, k = len(pairs) - still, classes + still
    own = np.concatenate([np.arange(n) % classes, classes + np.arange(still)])
    member = np.eye(k)[own]
    left, right = pairs @ member, pairs.T @ member  # of each word: counts towards and from the classes
    table = member.T @ left
    for _ in range(rounds):
        moved = 0
        for w in range(n):
            a, loop = own[w], pairs[w, w]
            out, into = left[w].copy(), right[w].copy()
            out[a] -= loop
            into[a] -= loop
            table[a] -= out
            table[:, a] -= into
            table[a, a] -= loop
            gain = gains(table, out, into, loop)[:classes]
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            table[b] += out
            table[:, b] += into
            table[b, b] += loop
            if b != a:
                moved += 1
                own[w] = b
                left[:, a] -= pairs[:, w]
                left[:, b] += pairs[:, w]
                right[:, a] -= pairs[w]
                right[:, b] += pairs[w]
        if not moved:
            break
    return own[:n]


def path_of(codes: np.ndarray, first: np.ndarray, edge: int) -> np.ndarray:
    """The codes of many texts' words, one text after another, with the edge before and after each."""
    rows = len(first) - 1
    out = np.full(len(codes) + rows + 1, edge, codes.dtype)
    out[np.arange(len(codes)) + 1 + np.repeat(np.arange(rows), np.diff(first))] = codes
    return out


def count_pairs(docs: DataFrame, words: Index) -> DataFrame:
    """code (first symbol * number of symbols + second), n: bigrams of the texts.

    Symbols are places in the vocabulary, then shapes of other words, then a text's edge.
    """
    size = len(words.keys) + SHAPES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def part() -> pa.RecordBatch:
            codes, counts, _ = tally.part()
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

        for _, raw, offsets in batches_of("text", batches):
            keys, first, start, end = word_hashes(raw, offsets)
            at = words(keys)
            path = path_of(np.where(at < 0, len(words.keys) + shapes(raw, start, end), at), first, size - 1)
            if tally.add(path[:-1] * size + path[1:]):
                yield part()
        yield part()

    return whole(docs).mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def fold(pairs: DataFrame, symbol: np.ndarray, bins: int) -> np.ndarray:
    """The matrix of pairs of bins, of which each symbol has one."""
    size = len(symbol)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(bins * bins)
        for batch in batches:
            a, b = np.divmod(batch.column(0).to_numpy(), size)
            sums += np.bincount(symbol[a] * bins + symbol[b], batch.column(1).to_numpy(), bins * bins)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some].astype(np.int64))], ["cell", "n"])

    got = pairs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(bins * bins)
    out[got.column("cell").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(bins, bins)


def move_all(pairs: DataFrame, of: np.ndarray, table: np.ndarray, words: int, classes: int) -> np.ndarray:
    """The class of each symbol after a batch: every word goes where the likelihood is highest, the others in the classes ``of`` before."""
    size, k = len(of), len(table)
    slots = 2 * k + 1

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = np.divmod(batch.column(0).to_numpy(), size)
            n = batch.column(1).to_numpy()
            loop = a == b
            first, second = (a < words) & ~loop, (b < words) & ~loop
            loop &= a < words
            codes = [a[first] * slots + of[b[first]], b[second] * slots + k + of[a[second]], a[loop] * slots + 2 * k]
            codes, counts, _ = _merged(codes, [n[first], n[second], n[loop]])
            yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], ["code", "n"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for at, slot, n in zip(*(batch.column(c).to_pylist() for c in range(3))):
                own = int(of[at])
                row = np.zeros(slots)
                row[slot] = n
                out, into, loop = row[:k], row[k : 2 * k], row[2 * k]
                rest = table.copy()
                rest[own] -= out
                rest[:, own] -= into
                rest[own, own] -= loop
                gain = gains(rest, out, into, loop)
                b = int(np.argmax(gain[:classes]))
                best.append(b if gain[b] > gain[own] + 1e-9 else own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.int64())], ["at", "class"])

    found = pairs.mapInArrow(sides, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    each = found.select(F.expr(f"code div {slots}").alias("at"), F.struct(F.expr(f"code % {slots}").alias("slot"), "n").alias("s")).groupBy("at").agg(F.collect_list("s").alias("s"))
    chosen = each.select("at", F.col("s.slot").alias("slots"), F.col("s.n").alias("counts")).mapInArrow(choose, "at long, class long").toArrow()
    out = of.copy()
    out[chosen.column("at").to_numpy()] = chosen.column("class").to_numpy()
    return out


def cluster(pairs: DataFrame, counts: np.ndarray, kinds: np.ndarray, classes: int, seeds: int, batches: int = BATCHES) -> tuple[np.ndarray, np.ndarray]:
    """The class of each symbol, and the table of class pairs. counts and kinds: of the vocabulary's words."""
    words = len(counts)
    k = classes + SHAPES + 1
    others = classes + np.arange(SHAPES + 1)
    of = np.concatenate([classes + kinds, others]).astype(np.int64)
    first = np.argsort(-counts, kind="stable")[:seeds]
    seeds = len(first)
    if seeds:
        # all words that aren't seeds, by shape, and the end are neighbours that don't move
        symbol = of - classes + seeds
        symbol[first] = np.arange(seeds)
        of[first] = exchange(fold(pairs, symbol, seeds + SHAPES + 1), classes, ROUNDS, SHAPES + 1)
    table = fold(pairs, of, k)
    for _ in range(batches if words else 0):
        moved = move_all(pairs, of, table, words, classes)
        after = fold(pairs, moved, k)
        if likelihood(after) <= likelihood(table):
            break
        of, table = moved, after
    return of, table


@dataclass
class Model:
    """What scoring needs: bounded in size but for ``rare``, which stays a table."""

    rare: DataFrame  # word, c: counts of the words that are not carried
    tokens: int
    distinct: int
    ends: int
    carried: Index
    counts: np.ndarray  # of the carried words
    kinds: np.ndarray  # and their classes
    steps: np.ndarray  # log10 of class transitions
    mass: np.ndarray  # of each class: tokens, and distinct words

    def class_of(self, word: str) -> int:
        """The class of a word (in lower case)."""
        raw = np.frombuffer(word.encode(), np.uint8)
        key, _, start, end = word_hashes(raw, np.array([0, len(raw)]))
        at = int(self.carried(key)[0])
        return int(self.kinds[at]) if at >= 0 else len(self.mass) - SHAPES - 1 + int(shapes(raw, start, end)[0])


def fit(training: DataFrame, vocabulary: int = VOCABULARY, classes: int = CLASSES, carried: int = CARRIED, seeds: int = SEEDS) -> Model:
    """Count words and bigrams of all training texts and cluster the vocabulary. No texts: all counts are zero."""
    counts = stash(count_words(training), "words")
    # the carried words are those from a count on: a histogram of counts tells from which
    octave = F.when(F.col("word") != END, F.floor(F.log2("c") * FINE).cast("int"))
    total, room, least = {"n": 0, "v": 0, "ends": 0}, carried, 0
    spread = counts.groupBy(octave.alias("o")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    for r in sorted(spread, key=lambda r: -1 if r["o"] is None else r["o"], reverse=True):
        total["n"] += r["n"]
        total["v"] += r["v"]
        if r["o"] is None:
            total["ends"] = r["n"]
        elif room is not None and r["v"] <= room:
            room, least = room - r["v"], r["o"]
        elif room is not None:
            room, least = None, r["o"] + 1
    top = counts.where(octave >= least).toArrow()
    order = np.argsort(top.column("word").to_numpy().view(np.uint64))
    keys, c, kinds = (top.column(x).to_numpy()[order] for x in ("word", "c", "kind"))
    keys = keys.view(np.uint64)
    kinds = kinds.astype(np.int64)
    chosen = np.sort(np.lexsort((keys, -c))[:vocabulary])
    words = Index(keys[chosen])
    pairs = stash(count_pairs(training, words), "pairs")
    of, table = cluster(pairs, c[chosen], kinds[chosen], classes, min(seeds, vocabulary))
    k = len(table)
    steps = np.log10((table + UNSEEN_STEP) / (table.sum(1, keepdims=True) + UNSEEN_STEP * k))
    # every word by its shape, but for the clustered ones
    mass = np.zeros((k, 2))
    for r in counts.groupBy("kind").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect():
        mass[classes + r["kind"]] = r["n"], r["v"]
    np.subtract.at(mass, classes + kinds[chosen], np.stack([c[chosen], np.ones(len(chosen))], 1))
    own = classes + kinds
    own[chosen] = of[: len(chosen)]
    np.add.at(mass, own[chosen], np.stack([c[chosen], np.ones(len(chosen))], 1))
    rare = counts.where((F.col("word") != END) & (octave < least)).select("word", "c")
    return Model(rare, total["n"], total["v"], total["ends"], Index(keys), c, own, steps, mass)


def score_documents(docs: DataFrame, model: Model, training: Column) -> DataFrame:
    """For every row doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``training`` tells of a doc_id whether its texts trained the model; held_out is its opposite. A null text is empty: one token, the
    end. A word that training lacks has count zero. Equal rows come back as often as they came. Without training texts every
    probability comes from pseudo-counts alone. An empty table gives no rows; other columns don't matter.
    """
    carried, own, steps, ends = model.carried, model.kinds, model.steps, model.ends
    last = len(model.mass) - 1
    with np.errstate(divide="ignore"):
        below = np.log10(model.mass[:, 0] + UNSEEN_WORD * (model.mass[:, 1] + 1))
    base_of, emitted = np.log10(model.counts + 1.0), np.log10(model.counts + UNSEEN_WORD)
    never = float(np.log10(UNSEEN_WORD))
    end_base, end_model = float(np.log10(ends + 1)), float(np.log10(ends + UNSEEN_WORD) - below[last])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch, raw, offsets in batches_of("text", batches):
            keys, first, start, end = word_hashes(raw, offsets)
            rows, n = batch.num_rows, np.diff(first)
            text = np.repeat(np.arange(rows), n)
            at = carried(keys)
            known = at >= 0
            kind = np.where(known, own[at] if len(own) else 0, last - SHAPES + shapes(raw, start, end))
            path = path_of(kind, first, last)
            edge = first + np.arange(rows + 1)
            walked = np.add.reduceat(steps[path[:-1], path[1:]], edge[:-1]) if rows else np.zeros(0)
            given = np.where(known, emitted[at] if len(own) else 0.0, never) - below[kind]
            base = np.bincount(text[known], base_of[at[known]] if len(own) else None, rows) + end_base
            score = walked + np.bincount(text, given, rows) + end_model
            seen = np.bincount(text[known], minlength=rows) + (ends > 0)
            # words whose counts have to be joined, each once a text
            order = np.lexsort((keys[~known], text[~known]))
            word, of = keys[~known][order], text[~known][order]
            fresh = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (of[1:] != of[:-1])])) if len(word) else np.zeros(0, np.int64)
            times = np.diff(np.append(fresh, len(word)))
            lists = pa.array(np.searchsorted(of[fresh], np.arange(rows + 1)), pa.int32())
            rare = [pa.ListArray.from_arrays(lists, pa.array(x)) for x in (word[fresh].view(np.int64), times.astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number + np.arange(rows)), pa.array(n + 1), pa.array(seen), pa.array(base), pa.array(score), *rare], ["doc_id", "row", "n_tokens", "n_known", "base", "model", "words", "times"])
            number += rows

    told = stash(whole(docs).mapInArrow(run, "doc_id long, row long, n_tokens long, n_known long, base double, model double, words array<long>, times array<long>"), "scored")
    rare = told.select("row", F.inline(F.arrays_zip("words", "times"))).select("row", F.col("words").alias("word"), F.col("times").alias("n"))
    joined = rare.join(model.rare, "word")
    more = joined.groupBy("row").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_base"), F.sum(F.col("n") * (F.log10(F.col("c") + UNSEEN_WORD) - never)).alias("more_model"))
    each = told.drop("words", "times").join(more, "row", "left")
    plus = lambda c: F.coalesce(F.col(f"more_{c}"), F.lit(0))
    return each.select(
        "doc_id",
        (~F.coalesce(training, F.lit(False))).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + plus("known")).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + plus("base") - F.col("n_tokens") * F.lit(float(np.log10(model.tokens + model.distinct + 1)))).alias("base_score"),
        (F.col("model") + plus("model")).alias("score"),
    )
