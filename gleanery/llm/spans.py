"""Spans of a text (kind, start, end in code points, score) and their digests."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gleanery.llm.common import whole

Span = tuple[str, int, int, float]

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("value", pa.string())])


class Taken:
    """Places that spans take; whether another meets them is found by search."""

    def __init__(self, found: Iterable[Span]):
        self.ends: list[int] = []
        self.starts: list[int] = []
        for _, start, end, _ in sorted(found, key=lambda x: x[1]):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def meets(self, start: int, end: int) -> bool:
        at = bisect.bisect_right(self.ends, start)
        return at < len(self.starts) and self.starts[at] < end


def joined(spans: list[Span], kinds: tuple[str, ...]) -> str:
    """kind:start:end, by start and then by the order of kinds, comma-joined."""
    rank = {k: n for n, k in enumerate(kinds)}
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in sorted(spans, key=lambda x: (x[1], rank[x[0]], x[2])))


def find_in(docs: DataFrame, find: Callable[[str], list[Span]]) -> DataFrame:
    """doc_id and spans: array of (kind, start, end, score, value), by start, for every row.

    ``find`` gets the whole text (null: empty) and lists its spans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"kind": k, "start": s, "end": e, "score": p, "value": text[s:e]} for k, s, e, p in sorted(find(text), key=lambda x: (x[1], x[2]))] for text in map(str, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(SPAN))], ["doc_id", "spans"])

    return whole(docs).mapInArrow(run, "doc_id long, spans array<struct<kind string, start long, end long, score double, value string>>")


def digest_of(docs: DataFrame, find: Callable[[str], list[Span]], base: tuple[str, ...], added: tuple[str, ...]) -> DataFrame:
    """For every row: doc_id, a count for each base kind, base_sha256 of the base spans, spans (all of them)."""
    names = ["doc_id", *(f"n_{k}" for k in base), "base_sha256", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[] for _ in base]
            sums, all_spans = [], []
            for text in batch.column(1):
                spans = find(text.as_py())
                own = [x for x in spans if x[0] in base]
                for column, kind in zip(counts, base):
                    column.append(sum(x[0] == kind for x in own))
                sums.append(hashlib.sha256(joined(own, base).encode()).hexdigest())
                all_spans.append(joined(spans, base + added))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sums, pa.string()), pa.array(all_spans, pa.string())], names)

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in base), "base_sha256 string", "spans string"])
    return whole(docs).mapInArrow(run, schema)
