"""Credentials: automata inferred from labelled ones score every candidate by how likely its format is.

Labelled credentials are what the base patterns find. Their strings, as classes of characters, form a prefix tree
with counts; states whose continuations don't differ more than chance allows are merged (Hoeffding's bound), which leaves a probabilistic
automaton. A second automaton comes from other long runs of the same characters. A candidate counts as a credential if the first
automaton makes it so much likelier than the second, in all and by character.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleanery.llm import spans
from gleanery.llm.common import stash, whole
from gleanery.llm.spans import Span

BASE = ("assign", "access", "hex")
ADDED = ("inferred",)

_ASSIGN = re.compile(r"""(?ai:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

#: Credentials and other runs, each, that the automata are fitted on: those of smallest hash; of longer ones the first LONGEST characters.
SAMPLE, LONGEST = 1500, 96
#: Confidence of the test that tells states apart, and the pseudo-count of symbols a state has not seen.
ALPHA, UNSEEN = 0.05, 0.2
#: Bits by which a candidate must be likelier as a credential: in all, and by character.
BITS, BITS_EACH = 12.0, 0.6

#: Characters to classes: digits, letters a-f and g-z in either case; the others stand for themselves.
CLASSES = str.maketrans({**dict.fromkeys("0123456789", "0"), **dict.fromkeys("abcdef", "a"), **dict.fromkeys("ghijklmnopqrstuvwxyz", "g"), **dict.fromkeys("ABCDEF", "A"), **dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "G")})
SYMBOLS = 12  # the five classes, six other characters, and the end


def base_spans(text: str) -> list[Span]:
    """The leftmost matches of each base kind that don't overlap and are long enough."""
    out = [("assign", *m.span(), 1.0) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    out += [("access", *m.span(), 1.0) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [("hex", *m.span(), 1.0) for m in _HEX.finditer(text)]
    return out


def _examples(text: str) -> tuple[list[str], list[str]]:
    """Shapes of the base kinds' credentials, and of the candidates outside of them."""
    found = base_spans(text)
    good = [m.group(1).translate(CLASSES) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 12]
    good += [text[s:e].translate(CLASSES) for k, s, e, _ in found if k != "assign"]
    taken = spans.Taken(found)
    other = [m.group().translate(CLASSES) for m in _CANDIDATE.finditer(text) if not taken.meets(m.start(), m.end())]
    return good, other


@dataclass
class Automaton:
    """States with counted steps; ``ends`` counts the strings that stop in a state."""

    steps: list[dict[str, int]] = field(default_factory=lambda: [{}])
    seen: list[Counter] = field(default_factory=lambda: [Counter()])
    ends: list[int] = field(default_factory=lambda: [0])

    def bits(self, shape: str) -> float:
        """log2 of the probability of a shape."""
        total, at = 0.0, 0
        for c in [*shape, None]:
            seen, ends = self.seen[at], self.ends[at]
            n = (ends if c is None else seen[c]) + UNSEEN
            total += math.log2(n / (sum(seen.values()) + ends + UNSEEN * SYMBOLS))
            if c is not None:
                at = self.steps[at].get(c, 0)
        return total


def infer(shapes: dict[str, int]) -> Automaton:
    """The prefix tree of counted shapes, with compatible states merged.

    States are settled in order of depth. A state next to the settled ones is merged into the first of them that is compatible,
    with all below it, or else is settled itself. States are compatible if the shares of strings that stop or go on with each
    symbol differ by no more than Hoeffding's bound, there and below. No shapes: one state that has seen nothing.
    """
    steps: list[dict[str, int]] = [{}]
    seen, ends = [Counter()], [0]
    for shape, n in sorted(shapes.items()):
        at = 0
        for c in shape:
            seen[at][c] += n
            if c not in steps[at]:
                steps[at][c] = len(steps)
                steps.append({})
                seen.append(Counter())
                ends.append(0)
            at = steps[at][c]
        ends[at] += n
    total = lambda q: ends[q] + sum(seen[q].values())
    slack = math.sqrt(0.5 * math.log(2 / ALPHA))

    def alike(p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            a, b = todo.pop()
            na, nb = total(a), total(b)
            if not na or not nb:
                continue
            bound = slack * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            if abs(ends[a] / na - ends[b] / nb) > bound:
                return False
            for c in seen[a].keys() | seen[b].keys():
                if abs(seen[a][c] / na - seen[b][c] / nb) > bound:
                    return False
                if c in steps[a] and c in steps[b]:
                    todo.append((steps[a][c], steps[b][c]))
        return True

    def pour(into: int, tree: int) -> None:
        todo = [(into, tree)]
        while todo:
            a, b = todo.pop()
            ends[a] += ends[b]
            seen[a] += seen[b]
            for c, below in steps[b].items():
                if c in steps[a]:
                    todo.append((steps[a][c], below))
                else:
                    steps[a][c] = below

    settled = [0]
    fresh = [(0, c) for c in sorted(steps[0])]
    while fresh:
        above, c = fresh.pop(0)
        q = steps[above][c]
        if q in settled:
            continue
        into = next((p for p in settled if alike(p, q)), None)
        if into is None:
            settled.append(q)
            fresh += [(q, x) for x in sorted(steps[q])]
        else:
            steps[above][c] = into
            pour(into, q)
            fresh += [(p, x) for p in settled for x in sorted(steps[p]) if steps[p][x] not in settled and (p, x) not in fresh]
    new = {q: k for k, q in enumerate(settled)}
    return Automaton([{c: new[t] for c, t in steps[q].items()} for q in settled], [seen[q] for q in settled], [ends[q] for q in settled])


@dataclass
class Detector:
    """Two automata, and the finder that uses them."""

    credentials: Automaton
    others: Automaton
    known: dict[str, float] = field(default_factory=dict)

    def gain(self, shape: str) -> float:
        """Bits by which the shape is likelier as a credential, or minus infinity where that is too few by character."""
        if (gain := self.known.get(shape)) is None:
            gain = self.credentials.bits(shape) - self.others.bits(shape)
            gain = gain if gain >= BITS_EACH * len(shape) else -math.inf
            if len(self.known) > 50_000:
                self.known.clear()
            if len(shape) <= LONGEST:
                self.known[shape] = gain
        return gain

    def find(self, text: str) -> list[Span]:
        """The base spans, and candidates apart from them whose format is likely."""
        out = base_spans(text)
        taken = spans.Taken(out)
        for m in _CANDIDATE.finditer(text):
            run = m.group()
            if (gain := self.gain(run.translate(CLASSES))) >= BITS and not taken.meets(m.start(), m.end()):
                out.append(("inferred", *m.span(), round(1 - 2.0 ** -min(gain, 60), 6)))
        return out


def fit(docs: DataFrame, sample: int = SAMPLE) -> Detector:
    """The automata of a table. Examples come from all rows; those of smallest hash are fitted on, ``sample`` of either sort."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: tuple[Counter, Counter] = (Counter(), Counter())
            for text in batch.column(1).to_pylist():
                for counter, shapes in zip(found, _examples(text)):
                    counter.update(x[:LONGEST] for x in shapes)
            rows = [(k, x, n) for k in (0, 1) for x, n in found[k].items()]
            yield pa.RecordBatch.from_pydict({"other": [x[0] for x in rows], "shape": [x[1] for x in rows], "n": [x[2] for x in rows]}, schema=pa.schema([("other", pa.int32()), ("shape", pa.string()), ("n", pa.int64())]))

    counted = whole(docs).mapInArrow(run, "other int, shape string, n long").groupBy("other", "shape").agg(F.sum("n").alias("n"))
    # texts are read once for both sorts; each is ordered by hash on its own and bounded before it reaches the driver
    ordered = stash(counted, "shapes").withColumn("h", F.xxhash64("shape"))
    parts = [ordered.where(F.col("other") == k).orderBy("h", "shape").limit(sample) for k in (0, 1)]
    rows = parts[0].union(parts[1]).collect()
    return Detector(*(infer({r["shape"]: r["n"] for r in rows if r["other"] == k}) for k in (0, 1)))


def find_documents(docs: DataFrame, detector: Detector) -> DataFrame:
    """doc_id and spans (kind, start, end, score, value) of every whole text.

    A null or empty text has no spans; equal rows give equal rows; an empty table gives none; other columns don't matter.
    """
    return spans.find_in(docs, detector.find)


def digest_documents(docs: DataFrame, detector: Detector) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for every row; nulls and empty texts as in find_documents."""
    return spans.digest_of(docs, detector.find, BASE, ADDED)
