"""Hard negatives by exact inner products, several candidates to a multiplication.

Components become whole numbers. Those of several candidates are biased, so that none is negative, and set into separated fields of one wide integer; an
anchor's component multiplies such an integer once, and the sum over components holds all the candidates' products, a field each. Fields are as wide as
the longest vectors of a block ask for: two or three to a 64-bit integer for common embeddings; where one field outgrows it, Python's own integers are used.

Candidates are dealt out in blocks, and anchors meet every block. A first pass finds each anchor's positives, a second one the negatives for their scores.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.common import stash

#: Rows of a block, anchors that meet it in one task, and anchors multiplied at once.
BLOCK, ANCHOR_BLOCK, AT_ONCE = 8_192, 8_192, 16
#: A component becomes so many times itself, rounded down.
SCALE = 256
#: Positives of an anchor, negatives of a pair, and the percent of the positive's score that a negative has at least.
POSITIVES, NEGATIVES, LEAST_PERCENT = 5, 5, 80

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _bits(vectors: np.ndarray) -> int:
    """A power of two above the length of the longest vector."""
    largest = float(np.abs(vectors).max(initial=0.0))
    return math.frexp(largest * math.sqrt(float(((vectors / largest) ** 2).sum(1).max())))[1] + 1 if largest else 0


class Packed:
    """Candidates' whole components in fields of wide integers."""

    def __init__(self, vectors: np.ndarray, anchors: np.ndarray):
        self.n, wide = vectors.shape
        # no product is larger than the two lengths' product; a bit for the sign, one for rounding
        self.width = max(2, _bits(vectors) + _bits(anchors) + 2)
        self.kind = np.uint64 if self.width <= 62 else object
        self.fields = 64 // self.width if self.kind is np.uint64 else 4
        self.rows = -(-self.n // self.fields)
        self.bias = -int(min(0.0, vectors.min(initial=0.0)))
        whole = self._whole(vectors)
        filled = np.zeros((self.rows * self.fields, wide), whole.dtype)
        filled[: self.n] = whole
        filled = filled.reshape(self.fields, self.rows, wide) + self._number(self.bias)
        self.packed = np.zeros((wide, self.rows), self.kind)
        for f in range(self.fields):
            self.packed += filled[f].T * self._number(1 << (f * self.width))
        self.ones = sum(1 << (f * self.width) for f in range(self.fields))

    def _whole(self, vectors: np.ndarray) -> np.ndarray:
        if self.kind is object:
            return np.vectorize(int, otypes=[object])(vectors) if vectors.size else vectors.astype(object)
        return vectors.astype(np.int64).astype(np.uint64)

    def _number(self, x: int):
        return np.uint64(x & 0xFFFFFFFFFFFFFFFF) if self.kind is np.uint64 else x

    def products(self, anchors: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors by candidates, as 64-bit integers; beyond these the nearest one."""
        whole = self._whole(anchors)
        total = np.zeros((len(anchors), self.rows), self.kind)
        for j, field in enumerate(self.packed):
            total += whole[:, j, None] * field[None, :]
        # take the bias out of every field again, and raise each by half its range so that none is negative
        half = 1 << (self.width - 1)
        shift = [self._number(self.ones * (half - self.bias * sum(map(int, a)))) for a in anchors]
        total = total + np.array(shift, self.kind)[:, None]
        mask, parts = self._number((1 << self.width) - 1), []
        for f in range(self.fields):
            part = (total >> self._number(f * self.width)) & mask
            if self.kind is object:
                part = np.clip(part - half, _LOW, _HIGH)
            parts.append(part.astype(np.int64) - (0 if self.kind is object else half))
        return np.concatenate(parts, axis=1)[:, : self.n]


def whole_components(column: pd.Series, scale: int) -> np.ndarray:
    """Vectors of one length as rows of whole numbers, held in doubles."""
    return np.floor(np.stack([np.asarray(x, np.float64) for x in column]) * scale)


def _first(score: np.ndarray, ids: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """The k of the places ``at`` with highest scores, ties by smaller ids."""
    if len(at) > k:
        at = at[score[at] >= np.partition(score[at], len(at) - k)[len(at) - k]]
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _scored(rows: pd.DataFrame, anchors: pd.DataFrame, scale: int):
    """For each anchor its place and the scores of all rows."""
    if not len(rows) or not len(anchors):
        return
    asked = whole_components(anchors["v"], scale)
    held = Packed(whole_components(rows["v"], scale), asked)
    for first in range(0, len(asked), AT_ONCE):
        for k, score in enumerate(held.products(asked[first : first + AT_ONCE])):
            yield first + k, score


def positives_of_block(rows: pd.DataFrame, anchors: pd.DataFrame, k: int, scale: int) -> pd.DataFrame:
    """The best k rows of an anchor's label in one block, without itself: anchor_row, positive_id, positive_row, positive_score."""
    ids, label, own = (rows[c].to_numpy(np.int64) for c in ("vec_id", "label", "row"))
    wanted, me = (anchors[c].to_numpy(np.int64) for c in ("label", "row"))
    out = [(np.zeros(0, np.int64),) * 4]
    for a, score in _scored(rows, anchors, scale):
        best = _first(score, ids, np.flatnonzero((label == wanted[a]) & (own != me[a])), k)
        out.append((np.full(len(best), me[a]), ids[best], own[best], score[best]))
    return pd.DataFrame(dict(zip(("anchor_row", "positive_id", "positive_row", "positive_score"), map(np.concatenate, zip(*out)))))


def negatives_of_block(rows: pd.DataFrame, anchors: pd.DataFrame, k: int, percent: int, scale: int) -> pd.DataFrame:
    """The best k rows of another label in one block for each score of a positive: anchor_row, positive_score, negative_id, negative_row, negative_score."""
    ids, label, own = (rows[c].to_numpy(np.int64) for c in ("vec_id", "label", "row"))
    wanted, me = (anchors[c].to_numpy(np.int64) for c in ("label", "row"))
    out = [(np.zeros(0, np.int64),) * 5]
    for a, score in _scored(rows, anchors, scale):
        other = label != wanted[a]
        for top in map(int, anchors["scores"].iat[a]):
            least = -((-percent * top) // 100)
            best = _first(score, ids, np.flatnonzero(other & (score <= top) & (score >= least)), k)
            out.append((np.full(len(best), me[a]), np.full(len(best), top), ids[best], own[best], score[best]))
    return pd.DataFrame(dict(zip(("anchor_row", "positive_score", "negative_id", "negative_row", "negative_score"), map(np.concatenate, zip(*out)))))


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, the vector as v, its length as wide: rows whose id, label and vector are there, of components alone that are finite when scaled."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
    return rows.where("vec_id is not null and label is not null and v is not null").where(~bad).withColumn("wide", F.size("v"))


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = LEAST_PERCENT, scale: int = SCALE, block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, from vectors (vec_id, embedding, label).

    Anchors are the rows whose vec_id is divisible by ``every``. An anchor's positives are the first rows of its label, without itself; its negatives for
    a positive are the first of other labels that score no more than it, and at least ``percent`` of it. Higher scores come first, ties by smaller vec_id.

    Rows without an id, label or vector, and with a null or non-finite component, take no part; zero vectors do. A row's candidates have vectors of its own
    length. A row that comes twice is two rows, each a candidate of the other; anchors are rows too. Scores beyond 64 bits are told as the nearest 64-bit
    integer. An empty table, and an anchor without positives or negatives, give no rows. Other columns don't matter.
    """
    # written once: a row keeps its number, and blocks are dealt from narrow rows
    held = stash(usable(vectors, scale).withColumn("row", F.monotonically_increasing_id()), "vectors")
    anchors = held.where(F.col("vec_id") % every == 0)
    blocks = max(1, math.ceil(held.count() / block))
    parts = max(1, math.ceil(anchors.count() / ANCHOR_BLOCK))
    groups = ["wide", "block", "part"]
    copies = lambda name, n: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    dealt = held.select("*", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int").alias("block")).select("*", copies("part", parts))
    deal = lambda df: df.select("*", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int").alias("part"), copies("block", blocks))

    def find_positives(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return positives_of_block(rows, asked, positives, scale)

    def find_negatives(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return negatives_of_block(rows, asked, negatives, percent, scale)

    near = dealt.groupBy(*groups).cogroup(deal(anchors).groupBy(*groups)).applyInPandas(find_positives, "anchor_row long, positive_id long, positive_row long, positive_score long")
    first = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    near = stash(near.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives), "positives")

    # an anchor has at most so many scores as positives
    asked = stash(anchors.join(near.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_set("positive_score").alias("scores")), "row"), "anchors")
    far = dealt.groupBy(*groups).cogroup(deal(asked).groupBy(*groups)).applyInPandas(find_negatives, "anchor_row long, positive_score long, negative_id long, negative_row long, negative_score long")
    best = Window.partitionBy("anchor_row", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    named = near.join(anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id")), "anchor_row")
    return named.join(far, ["anchor_row", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
