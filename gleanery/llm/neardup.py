"""Near-duplicates by a chosen-path set similarity join.

A document is the set of its shingles of five words. Documents with equal sets are one class. Independent trees branch the classes by
minwise tokens: at a node some places of the minwise signature are chosen, by hash of the node, and its classes go to children by
their tokens there. Small nodes are compared exhaustively; large ones branch again, unless their classes are much alike on average, as in a group
of copies, which branching would not part: there, and at the last level, the classes of different components are compared in blocks. A pair of the
least similarity shares a chosen token with probability 0.75, so trees are repeated until the chance that all of them part such a pair is negligible.

Comparison in a node is by signature, of classes that share a token with another one alone. Each proposal is confirmed on the full sets. Of two rounds the
first proposes only pairs that are rather links and would join components, in few trees, so that a group of copies costs few pairs; a large
node compares its classes with representatives there. The second knows the components found and leaves out no pair of different ones, in the
first tree that brings it together. Pairs travel in chunks of bounded size, each with the sets that it names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import batches_of, components, discard, forget, mix, stars, stash, whole, word_hashes

#: Words in a shingle; a link needs PERCENT * union <= 100 * intersection.
SHINGLE, PERCENT = 5, 75
#: Independent trees: 0.25 to the power of TREES is the chance to part a pair of the least similarity at the first level.
TREES = 12
#: Places chosen at a node of the second level, of the third, and so on; the first level chooses one.
BRANCHES = (2, 2, 2)
#: Classes in a node up to which all its pairs are compared in one task; classes in a block of a larger one, and representatives of it.
SMALL, BLOCK, REPRESENTATIVES = 2000, 1000, 256
#: Classes in a node up to which many nodes travel to a task's code at once; larger ones travel one by one.
TINY = 16
#: Mean similarity of a node's classes from which it isn't branched any more.
ALIKE = 0.4
#: Minwise places of a signature, of 8 bits each.
PLACES = 256
#: Shares of equal places: below MAYBE a pair can't be a link (nearly five standard deviations), from EVEN on it rather is.
MAYBE, EVEN = 0.62, 0.74
#: Trees of the first round.
FIRST = 2
#: Shingles of the full sets that a task holds at once to confirm pairs (two sets may hold more).
CHUNK = 2_000_000

_rng = np.random.default_rng(4)
_FACTOR = (_rng.integers(0, 1 << 32, PLACES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, PLACES, dtype=np.uint64).astype(np.uint32)
_STEP = [np.uint64(x | 1) for x in (0x8CB92BA72F3D8DD7, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0x9FB21C651E98DF25)]


def shingles(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row's shingles, one row after another, and their offsets.

    A row of fewer words than a shingle has has one, the whole sequence; a row without words has none.
    """
    words, first, _, _ = word_hashes(raw, offsets)
    n = np.diff(first)
    rows = len(n)
    with np.errstate(over="ignore"):
        count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
        row = np.repeat(np.arange(rows), count)
        start = np.cumsum(count) - count
        at = first[:-1][row] + np.arange(len(row)) - start[row]
        size = np.minimum(n, SHINGLE)[row]
        padded = np.concatenate([words, np.zeros(SHINGLE, np.uint64)])
        total = size.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D)
        for k in range(SHINGLE):
            total += np.where(k < size, padded[at + k] * _STEP[k], np.uint64(0))
        hashed = mix(total)
    order = np.lexsort((hashed, row))
    hashed, row = hashed[order], row[order]
    fresh = np.ones(len(hashed), bool)
    fresh[1:] = (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
    hashed, row = hashed[fresh], row[fresh]
    return hashed, np.searchsorted(row, np.arange(rows + 1))


def signatures(hashed: np.ndarray, offsets: np.ndarray, places: int) -> np.ndarray:
    """Minwise values (rows x places, 32 bits) of sets of hashes; an empty set has the largest values."""
    short = (hashed >> np.uint64(32)).astype(np.uint32)
    out = np.full((len(offsets) - 1, places), np.iinfo(np.uint32).max, np.uint32)
    factor, add = _FACTOR[:places], _ADD[:places]
    with np.errstate(over="ignore"):
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:])):
            for c in range(a, b, 4096):
                part = short[c : min(b, c + 4096)]
                np.minimum(out[k], (part[:, None] * factor + add).min(0), out=out[k])
    return out


def set_hashes(hashed: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each whole set; 0 for an empty one."""
    with np.errstate(over="ignore"):
        mixed = np.concatenate([mix(hashed + np.uint64(1)), np.zeros(1, np.uint64)])
        return (np.add.reduceat(mixed, at[:-1]) * (np.diff(at) > 0)).view(np.int64)


def tokens_of(signed: np.ndarray) -> pa.ListArray:
    """The token of each tree, from the first places of signatures."""
    tokens = mix(signed[:, :TREES].astype(np.uint64) + (np.arange(TREES, dtype=np.uint64) << np.uint64(32)))
    return pa.ListArray.from_arrays(pa.array(np.arange(0, TREES * len(signed) + 1, TREES), pa.int32()), pa.array(tokens.view(np.int64).reshape(-1)))


def sign_documents(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), n_shingles, id (hash of the whole set), tokens (a long for each tree)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in batches_of("text", batches):
            hashed, at = shingles(raw, offsets)
            flat = tokens_of(signatures(hashed, at, TREES))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.diff(at), pa.int64()), pa.array(set_hashes(hashed, at)), flat], ["doc_id", "key", "n_shingles", "id", "tokens"])

    return keyed(docs).mapInArrow(run, "doc_id long, key long, n_shingles long, id long, tokens array<long>")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), key (hash of the text)."""
    return whole(docs).withColumn("key", F.xxhash64("text"))


def sketch_members(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, n_shingles, places (binary, 8 bits each), tokens, own (the sorted hashes of the full set, binary) of the texts whose doc_id and key are ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raw, offsets in batches_of("text", batches):
            hashed, at = shingles(raw, offsets)
            signed = signatures(hashed, at, PLACES)
            places = [p.tobytes() for p in (signed & np.uint32(0xFF)).astype(np.uint8)]
            own = [hashed[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(set_hashes(hashed, at)), pa.array(np.diff(at), pa.int64()), pa.array(places, pa.binary()), tokens_of(signed), pa.array(own, pa.binary())], ["id", "n_shingles", "places", "tokens", "own"])

    # sorted on both sides at every size: a broadcast of the wanted would have to grow with the table
    texts = keyed(docs).join(wanted.hint("merge"), ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
    return texts.select("doc_id", "text").mapInArrow(run, "id long, n_shingles long, places binary, tokens array<long>, own binary")


def _sized(rows: DataFrame, level: int) -> DataFrame:
    """Rows (tree, node, id) of nodes with two classes or more, with the node's size and level, written."""
    count = rows.groupBy("tree", "node").agg(F.count("*").alias("size")).where("size > 1")
    return stash(rows.join(count, ["tree", "node"]).select("tree", "node", "id", "size", F.lit(level).alias("level")), "nodes")


def _token(chosen: Column) -> Column:
    return F.hex(F.substring(F.col("places"), chosen + 1, 1))


def grow(nodes: DataFrame, members: DataFrame, small: int = SMALL, branches: tuple[int, ...] = BRANCHES, alike: float = ALIKE) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Leaves (tree, node, id, size, level) below the nodes of the first level: the small ones, and the large ones that aren't branched (None: none).

    Third, the rows of the first level's nodes that are branched (None: none).
    """
    places = members.select("id", "places")
    ends, large_ends, branched = [], [], None
    for level in range(len(branches) + 1):
        ends.append(nodes.where(F.col("size") <= small))
        large = nodes.where(F.col("size") > small)
        if large.isEmpty():
            break
        if level == len(branches):
            large_ends.append(large)
            break
        chosen = lambda k, salt: F.pmod(F.xxhash64("node", "tree", F.lit(k), F.lit(salt)), F.lit(PLACES)).cast("int")
        # the chance that two classes of a node agree at a place is their mean similarity; some dozens of classes tell it
        few = large.where(F.pmod(F.xxhash64("id", "tree"), F.ceil(F.col("size") / 64)) == 0).join(places, "id")
        told = few.select("tree", "node", F.inline(F.array(*[F.struct(F.lit(k).alias("k"), _token(chosen(k, -1 - level)).alias("token")) for k in range(4)])))
        agree = told.groupBy("tree", "node", "k", "token").agg(F.count("*").alias("n")).groupBy("tree", "node", "k").agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("p"))
        likeness = agree.groupBy("tree", "node").agg((F.avg("p") >= alike).alias("alike"))
        judged = stash(large.join(likeness, ["tree", "node"], "left"), "large")
        large_ends.append(judged.where("alike").drop("alike"))
        parted = judged.where("not coalesce(alike, false)")
        branched = parted if level == 0 else branched
        rest = parted.join(places, "id")
        below = F.array(*[F.struct(F.lit(k).alias("k"), _token(chosen(k, level)).alias("token")) for k in range(branches[level])])
        nodes = _sized(rest.select("tree", "node", "id", F.inline(below)).select("tree", F.xxhash64("node", "k", "token").alias("node"), "id"), level + 1)
    leaves, rest = ends[0], None
    for more in ends[1:]:
        leaves = leaves.unionByName(more)
    for more in large_ends:
        rest = more if rest is None else rest.unionByName(more)
    return leaves, None if rest is None or rest.isEmpty() else rest, branched


@dataclass
class Items:
    """Classes of a node as arrays. ``tokens`` and ``compared`` (bits of trees) tell which pairs an earlier tree compares; None: not asked."""

    ids: np.ndarray
    sizes: np.ndarray
    known: np.ndarray
    signed: np.ndarray
    tokens: np.ndarray | None = None
    compared: np.ndarray | None = None

    @classmethod
    def of(cls, columns: dict[str, pa.Array]) -> Items:
        ids, sizes, known = (columns[c].to_numpy(zero_copy_only=False) for c in ("id", "n_shingles", "component"))
        signed = _flat(columns["places"], len(ids), PLACES)
        if "tokens" not in columns:
            return cls(ids, sizes, known, signed)
        tokens = columns["tokens"].flatten().to_numpy(zero_copy_only=False).reshape(len(ids), TREES)
        return cls(ids, sizes, known, signed, tokens, columns["compared"].to_numpy(zero_copy_only=False))

    def part(self, rows: slice | np.ndarray) -> Items:
        return Items(*(None if x is None else x[rows] for x in (self.ids, self.sizes, self.known, self.signed, self.tokens, self.compared)))


def _flat(column: pa.Array, rows: int, width: int) -> np.ndarray:
    """A binary column of values of one width as a matrix."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32, rows + 1, column.offset * 4) if rows else np.zeros(1, np.int32)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].reshape(rows, width) if rows else np.zeros((0, width), np.uint8)


def propose(tree: int, own: Items, other: Items | None, least: float, unite: bool) -> tuple[list[int], list[int]]:
    """Places in ``own`` and in ``other`` (None: in ``own`` again) of pairs to confirm: at least a share of equal places, of different components.

    With ``unite`` a proposal ties its components while it goes, so a group of copies gives one pair for each, not all. A pair that an
    earlier tree compares exhaustively is left to it.
    """
    against = own if other is None else other
    root: dict[int, int] = {}

    def top(c: int) -> int:
        while (up := root.get(c, c)) != c:
            root[c] = root.get(up, up)
            c = up
        return c

    first, second = [], []
    for i in range(len(own.ids)):
        start = i + 1 if other is None else 0
        sizes = against.sizes[start:]
        good = (against.known[start:] != own.known[i]) & (PERCENT * np.maximum(sizes, own.sizes[i]) <= 100 * np.minimum(sizes, own.sizes[i]))
        rest = np.flatnonzero(good) + start
        if len(rest) and own.compared is not None:
            earlier = [t for t in range(tree) if own.compared[i] >> t & 1]
            rest = rest[~(against.tokens[rest][:, earlier] == own.tokens[i, earlier]).any(1)]
        if not len(rest):
            continue
        found = rest[(against.signed[rest] == own.signed[i]).mean(1) >= least]
        if unite:
            for j in found.tolist():
                a, b = top(int(own.known[i])), top(int(against.known[j]))
                if a != b:
                    root[max(a, b)] = min(a, b)
                    first.append(i)
                    second.append(j)
        else:
            first += [i] * len(found)
            second += found.tolist()
    return first, second


class Chunks:
    """Gathers pairs to rows (chunk, a, b) whose classes' full sets hold about CHUNK shingles together, so that a task can hold them."""

    def __init__(self, tree: int = 0):
        self.tree = tree
        self.rows: list[tuple[int, list[int], list[int]]] = []
        self._clear()

    def _clear(self) -> None:
        self.a: list[int] = []
        self.b: list[int] = []
        self.held: set[int] = set()
        self.size = 0

    def flush(self) -> None:
        if self.a:
            with np.errstate(over="ignore"):
                name = mix(np.array([self.a[0], self.b[0]], np.int64).view(np.uint64) + np.uint64(self.tree + 1))
            self.rows.append((int((name[0] ^ (name[1] << np.uint64(1))).view(np.int64)), self.a, self.b))
            self._clear()

    def add(self, own: Items, other: Items, first: list[int], second: list[int]) -> None:
        for i, j in zip(first, second):
            pair = (int(own.ids[i]), int(own.sizes[i])), (int(other.ids[j]), int(other.sizes[j]))
            more = sum(n for x, n in pair if x not in self.held)
            if self.a and self.size + more > CHUNK:
                self.flush()
                more = sum(n for _, n in pair)
            self.size += more
            self.held.update(x for x, _ in pair)
            self.a.append(pair[0][0])
            self.b.append(pair[1][0])

    def batch(self) -> pa.RecordBatch:
        self.flush()
        longs = pa.list_(pa.int64())
        out = pa.RecordBatch.from_arrays([pa.array([r[0] for r in self.rows], pa.int64()), pa.array([r[1] for r in self.rows], longs), pa.array([r[2] for r in self.rows], longs)], ["chunk", "a", "b"])
        self.rows = []
        return out


_CHUNK = "chunk long, a array<long>, b array<long>"


def propose_small(leaves: DataFrame, items: DataFrame, least: float, unite: bool) -> DataFrame:
    """Chunks of pairs proposed by small nodes. items: what Items has of each class."""
    names = items.columns
    rows = leaves.hint("merge").join(items, "id")
    tiny = rows.where(F.col("size") <= TINY).groupBy("tree", "node").agg(F.collect_list(F.struct(*names)).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, chunks = batch.column(1), Chunks()
            values = lists.flatten()
            every = Items.of(dict(zip(names, values.flatten())))
            ends = np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
            for tree, a, b in zip(batch.column(0).to_pylist(), np.concatenate([[0], ends[:-1]]), ends):
                own = every.part(slice(a, b))
                chunks.add(own, own, *propose(tree, own, None, least, unite))
            yield chunks.batch()

    def node(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        tree = group.column("tree")[0].as_py()
        own, chunks = Items.of({c: group.column(c).chunk(0) for c in names}), Chunks(tree)
        chunks.add(own, own, *propose(tree, own, None, least, unite))
        return pa.Table.from_batches([chunks.batch()])

    larger = rows.where(F.col("size") > TINY).select("tree", "node", *names)
    return tiny.select("tree", "own").mapInArrow(run, _CHUNK).unionByName(larger.groupBy("tree", "node").applyInArrow(node, _CHUNK))


def _across(left: DataFrame, right: DataFrame, names: list[str], least: float, unite: bool) -> DataFrame:
    """Chunks of pairs of left and right rows (tree, node, x, y and the items) of one block."""

    def cross(group: pa.Table) -> pa.Table:
        chunks = Chunks(group.column("tree")[0].as_py())
        sides = [group.filter(pa.compute.equal(group.column("left"), is_left)).sort_by("id").combine_chunks() for is_left in (True, False)]
        if all(side.num_rows for side in sides):
            own, other = (Items.of({c: side.column(c).chunk(0) for c in names}) for side in sides)
            chunks.add(own, other, *propose(chunks.tree, own, other, least, unite))
        return pa.Table.from_batches([chunks.batch()])

    both = left.withColumn("left", F.lit(True)).unionByName(right.withColumn("left", F.lit(False)))
    return both.groupBy("tree", "node", "x", "y").applyInArrow(cross, _CHUNK)


def _part(salt: int, n: Column) -> Column:
    return F.pmod(F.xxhash64("id", F.lit(salt)), n).cast("int")


def propose_star(large: DataFrame, items: DataFrame, block: int, least: float) -> DataFrame:
    """Chunks of pairs of a large node's classes with its representatives, REPRESENTATIVES or so of them: work grows with the node, not with its square."""
    names = items.columns
    blocks = F.ceil(F.col("size") / block).cast("int")
    rows = large.join(items, "id")
    left = rows.where(_part(3, F.ceil(F.col("size") / REPRESENTATIVES)) == 0)
    left = left.select("tree", "node", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("x"), F.lit(0).alias("y"), *names)
    right = rows.select("tree", "node", _part(1, blocks).alias("x"), F.lit(0).alias("y"), *names)
    return _across(left, right, names, least, True)


def propose_large(large: DataFrame, items: DataFrame, component: DataFrame, block: int, least: float, unite: bool) -> DataFrame:
    """Chunks of pairs of a large node's classes of different components, in blocks.

    Classes of a node's most common component need no comparison with each other. The others are compared with all, block by
    block: a pair of blocks is a group, so no task gets a whole node. Ids and signatures travel, not sets.
    """
    names = items.columns
    tied = large.join(component, "id")
    main = tied.groupBy("tree", "node", "component").agg(F.count("*").alias("n")).groupBy("tree", "node").agg(F.max_by("component", F.struct("n", -F.col("component"))).alias("main"), F.sum("n").alias("all"), F.max("n").alias("n"))
    blocks = lambda n: F.ceil(n / block).cast("int")
    main = main.where(F.col("all") > F.col("n")).select("tree", "node", "main", blocks(F.col("all")).alias("blocks"), blocks(F.col("all") - F.col("n")).alias("odd_blocks"))
    rows = large.join(main, ["tree", "node"]).join(items, "id")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = rows.where("component <> main").select("tree", "node", _part(1, F.col("odd_blocks")).alias("x"), every("blocks").alias("y"), *names)
    right = rows.select("tree", "node", every("odd_blocks").alias("x"), _part(2, F.col("blocks")).alias("y"), *names)
    return _across(left, right, names, least, unite)


def are_linked(x: bytes, y: bytes) -> bool:
    """Whether two full sets are similar enough."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def confirm(chunks: DataFrame, members: DataFrame) -> DataFrame:
    """(a, b) that tie what those of the chunks' pairs tie that are links, by the full sets of both. A set travels once for each chunk that names it."""
    sets = chunks.select(F.col("chunk").alias("of_chunk"), F.explode(F.array_distinct(F.concat("a", "b"))).alias("id")).hint("merge").join(members.select("id", "own"), "id")

    def check(pairs: pa.Table, full: pa.Table) -> pa.Table:
        own = dict(zip(full.column("id").to_pylist(), full.column("own")))
        linked = [(x, y) for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()) for x, y in zip(a, b) if x != y and are_linked(own[x].as_py(), own[y].as_py())]
        linked = stars([x for x, _ in linked], [y for _, y in linked])
        return pa.Table.from_arrays([pa.array([x for x, _ in linked], pa.int64()), pa.array([y for _, y in linked], pa.int64())], ["a", "b"])

    return chunks.groupBy("chunk").cogroup(sets.groupBy("of_chunk")).applyInArrow(check, "a long, b long")


def link_documents(docs: DataFrame, small: int = SMALL, branches: tuple[int, ...] = BRANCHES, alike: float = ALIKE, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_key for every row: connected components of documents that share enough shingles.

    A null or blank text has no shingles and is linked with nothing; a text of under five words is one shingle. Equal texts are
    linked. Rows with one doc_id are one document: linked with each other, each with the size of its own set, and each comes back. Rows without an id come
    back alone, without a component. text_key is a hash of the row's text. Empty tables give no rows; other columns don't matter.
    """
    signed = stash(sign_documents(docs), "signed")
    filled = signed.where("n_shingles > 0 and doc_id is not null")
    # one row for each distinct set; its smallest doc_id stands for it
    classes = stash(filled.groupBy("id").agg(F.min(F.struct("doc_id", "key")).alias("first"), F.first("tokens").alias("tokens")), "classes")
    nodes = _sized(classes.select("id", F.posexplode("tokens").alias("tree", "node")), 0)
    # only classes that share a token with another can have a link: from here on these alone count
    wanted = classes.join(nodes.select("id").distinct(), "id", "left_semi").select("first.doc_id", "first.key")
    members = stash(sketch_members(docs, wanted), "members")
    leaves, large, branched = grow(nodes, members, small, branches, alike)
    # rows of one doc_id with different sets
    several = filled.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z").select("doc_id", "a")
    links = stash(filled.select("doc_id", F.col("id").alias("b")).join(several, "doc_id").where("a <> b").select("a", "b").distinct(), "links")
    component = None
    for final in (False, True):
        if final:
            items = members.select("id", "n_shingles", "places", "tokens").join(component, "id")
            # in which trees all pairs of a class's first node are compared: where it isn't branched
            if branched is None:
                items = items.withColumn("compared", F.lit(-1))
            else:
                bits = branched.groupBy("id").agg(F.bit_or(F.expr("shiftleft(1, tree)")).alias("parted"))
                items = items.join(bits, "id", "left").withColumn("compared", F.bitwise_not(F.coalesce("parted", F.lit(0)))).drop("parted")
            # a node of one component has nothing to propose
            mixed = leaves.join(component, "id").groupBy("tree", "node").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d")
            some = stash(leaves.join(mixed.select("tree", "node"), ["tree", "node"], "left_semi"), "mixed")
            proposed = propose_small(some, items, MAYBE, False)
            if large is not None:
                proposed = proposed.unionByName(propose_large(large, items, component, block, MAYBE, False))
        else:
            items = members.select("id", "n_shingles", "places", F.col("id").alias("component"))
            proposed = propose_small(leaves.where(F.col("tree") < FIRST), items, EVEN, True)
            if large is not None:
                proposed = proposed.unionByName(propose_star(large.where(F.col("tree") < FIRST), items, block, EVEN))
        chunks = stash(proposed, "chunks")
        links = links.unionByName(stash(confirm(chunks, members), "links"))
        discard(chunks)
        tied = stash(components(links), "components")
        component = members.select("id").join(tied.select("id", F.col("component_id").alias("component")), "id", "left").select("id", F.coalesce("component", "id").alias("component"))
        forget(docs.sparkSession)
    owned = classes.select("id", "first.doc_id").join(tied.select("id", F.col("component_id").alias("component")), "id", "left").select("id", "doc_id", F.coalesce("component", "id").alias("component"))
    lowest = owned.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_class = owned.join(lowest, "component").select("id", "component_id")
    out = filled.select("doc_id", "n_shingles", "key", "id").join(of_class, "id").select("doc_id", "n_shingles", "component_id", "key")
    rest = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "key")
    return out.unionByName(rest).select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), F.col("key").alias("text_key"))
