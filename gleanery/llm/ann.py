"""Nearest neighbours by a forest of hash prefixes.

A tree gives each vector a long string of bits, the signs of random projections, and keeps the strings sorted. A query
descends to the vectors that share the longest prefix with its own string, and then all trees ascend together, a bit at a time,
until enough candidates have been met. The candidates' exact inner products decide.

The index is dealt out in blocks of vectors; each block's forest is searched by all queries, in blocks too, and the best of
all blocks are merged. Work for a query is the candidates of each block, not its vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors in a block of the index, and queries that search it at once.
BLOCK, QUERY_BLOCK = 20_000, 5_000
#: Trees, bits of a string, and candidates that a query asks of a block at least.
TREES, BITS, LEAST = 48, 32, 400
#: The share of a block's vectors that a query asks for: so much of an index of 10,000 vectors, and less of a larger one by this power. Measured on vectors
#: that are nearly random, the hardest ones; see share_of.
SHARE, POWER = 0.48, 0.12
#: Seed of the projections.
SEED = 20


def share_of(vectors: int) -> float:
    """The share of candidates for an index of so many vectors.

    On random vectors of 64 components the share that gives a recall of 0.9 at 20 was 0.52 of 2,000, 0.43 of 10,256 and 0.35 of 51,282 vectors:
    the more there are, the nearer the nearest stand.
    """
    return min(1.0, SHARE * (10_000 / max(1, vectors)) ** POWER)


class Forest:
    """Sorted strings of bits of a block's vectors, by tree."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.trees, self.bits = trees, bits
        self.planes = np.random.default_rng(seed).standard_normal((trees, vectors.shape[1] + 1, bits)).astype(np.float32)
        vectors = vectors / np.abs(vectors).max(initial=0.0)  # so that squares neither vanish nor overflow
        # the longest vector's length turns largest inner product into smallest angle: one more component fills each up to it
        self.longest = float(np.sqrt((vectors**2).sum(1)).max(initial=0.0)) or 1.0
        filled = np.hstack([vectors / self.longest, np.sqrt(np.maximum(0, 1 - ((vectors / self.longest) ** 2).sum(1)))[:, None]])
        strings = self._strings(filled.astype(np.float32))
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    @staticmethod
    def _unit(vectors: np.ndarray) -> np.ndarray:
        vectors = vectors / np.abs(vectors).max(1, keepdims=True)
        return vectors / np.sqrt((vectors**2).sum(1, keepdims=True))

    def _strings(self, filled: np.ndarray) -> np.ndarray:
        weights = (np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64)).astype(np.float64)
        return np.stack([((filled @ plane) > 0) @ weights for plane in self.planes]).astype(np.uint64)

    def candidates(self, queries: np.ndarray, want: int) -> Iterator[np.ndarray]:
        """For each query the vectors met, ascending in all trees at once until at least ``want`` are (or all)."""
        n = self.sorted.shape[1]
        want = min(want, n)
        strings = self._strings(np.hstack([self._unit(queries), np.zeros((len(queries), 1))]).astype(np.float32))
        low = np.empty((self.bits + 1, self.trees, len(queries)), np.int64)
        high = np.empty_like(low)
        for kept in range(self.bits + 1):
            drop = np.uint64(self.bits - kept)
            first = (strings >> drop) << drop
            last = first + ((np.uint64(1) << drop) - np.uint64(1))
            for t in range(self.trees):
                low[kept, t] = np.searchsorted(self.sorted[t], first[t], "left")
                high[kept, t] = np.searchsorted(self.sorted[t], last[t], "right")
        sizes = (high - low).sum(1)
        seen = np.zeros(n, bool)
        for q in range(len(queries)):
            # the shortest prefix whose ranges could hold enough, then on upwards
            kept = int(np.flatnonzero(sizes[:, q] >= want)[-1])
            met: list[np.ndarray] = []
            count = 0
            while count < want and kept >= 0:
                # a bit up in each tree in turn, until enough are met
                for t in range(self.trees):
                    here = self.order[t, low[kept, t, q] : high[kept, t, q]]
                    fresh = here[~seen[here]]
                    seen[fresh] = True
                    met.append(fresh)
                    count += len(fresh)
                    if count >= want:
                        break
                kept -= 1
            found = np.sort(np.concatenate(met))
            seen[found] = False
            yield found


def _stack(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in column])


def search_block(index: pd.DataFrame, queries: pd.DataFrame, k: int, share: float, least: int = LEAST) -> pd.DataFrame:
    """The best k of one block for each query. Equal vectors stand in the forest once; each holds all its ids."""
    columns = {"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)}
    if not len(index) or not len(queries):
        return pd.DataFrame(columns)
    vectors, asked = _stack(index["v"]), _stack(queries["v"])
    ids, own = index["vec_id"].to_numpy(np.int64), queries["vec_id"].to_numpy(np.int64)
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    distinct, group = np.unique(vectors, axis=0, return_inverse=True)
    group = group.reshape(-1)
    members = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[members], np.arange(len(distinct) + 1))
    forest = Forest(distinct)
    want = max(least, k + 1, math.ceil(share * len(distinct)))
    out = []
    for q, met in enumerate(forest.candidates(asked, want)):
        # summed in one order whatever else is in the block, so that equal vectors of two blocks score alike
        score = np.einsum("ij,j->i", distinct[met], asked[q])
        # k + 1 distinct vectors, and what ties with the last of them, are enough: the query itself may be among them
        if len(met) > k + 1:
            keep = score >= np.partition(score, len(score) - k - 1)[len(score) - k - 1]
            met, score = met[keep], score[keep]
        # of equal vectors only the k + 1 of smallest id can be among the nearest
        rows = [members[starts[m] : min(starts[m + 1], starts[m] + k + 1)] for m in met]
        found = np.concatenate(rows)
        score = np.repeat(score, [len(r) for r in rows])
        hit = ids[found]
        keep = hit != own[q]
        hit, score = hit[keep], score[keep]
        best = np.lexsort((hit, -score))[:k]
        out.append((np.full(len(best), own[q]), hit[best], score[best]))
    if not out:
        return pd.DataFrame(columns)
    return pd.DataFrame(dict(zip(columns, map(np.concatenate, zip(*out)))))


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, the vector as v (doubles), and its length as wide: rows whose vector is there, not zero, and of finite components alone."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & F.col("vec_id").isNotNull()).where(~bad & F.exists("v", lambda x: x != 0))
    return good.withColumn("wide", F.size("v"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, share: float | None = None, least: int = LEAST) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query the k vectors found of largest inner product, ties to smaller ids.

    A query's own id is no candidate; with fewer than k others all come back. Null vectors, zero ones and those with
    null or infinite components or NaN take no part. A query's candidates are the vectors of its own length. Equal vectors are all candidates, and score
    alike in every block. Empty tables give no rows. Other columns don't matter; an id that comes twice counts twice.
    """
    base, asked = usable(vectors), usable(queries)
    total = base.count()
    share = share_of(total) if share is None else share
    blocks = max(1, math.ceil(total / BLOCK))
    query_blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    dealt = base.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    index = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))) if query_blocks > 1 else dealt.withColumn("part", F.lit(0))
    sought = asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return search_block(left, right, k, share, least)

    groups = ["wide", "block", "part"]
    found = index.groupBy(*groups).cogroup(sought.groupBy(*groups)).applyInPandas(search, "query_id long, vec_id long, score double")
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
