"""What the operators share: tables, durable intermediate tables, folds, texts as arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the array code of a task handles at once.
SLICE_BYTES = 1 << 20

#: ASCII letters to lower case, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The bytes between words: the space and 09 to 0D.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True

#: An odd factor and its inverse modulo 2**64, for hashes of byte runs.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; one file or a folder of files."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or in local mode a default."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    import tempfile

    context.setCheckpointDir(tempfile.mkdtemp(prefix="gleanery-"))
    return context.getCheckpointDir().rstrip("/")


def stash(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it back: lineage ends there, lost executors cost nothing.

    The table goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    where, files = _at(spark, path)
    files.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._stash_path = path
    return out


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(context._jsc.hadoopConfiguration())


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again."""
    for df in tables:
        where, files = _at(df.sparkSession, df._stash_path)
        files.delete(where, True)


def forget(spark: SparkSession) -> None:
    """Shuffle files of jobs whose results are written go once the driver's JVM has dropped their plans; ask it to, at the end of a round."""
    spark.sparkContext._jvm.System.gc()


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def whole(docs: DataFrame, *names: str) -> DataFrame:
    """doc_id and text (null: empty), and what else is named; no other column comes along."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *names)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads 64-bit values evenly."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def texts_as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, and the offset of each of its rows (one more than rows); no copy."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        kind = np.int64
    elif pa.types.is_string(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind, count=len(column) + 1, offset=column.offset * np.dtype(kind).itemsize).astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so many bytes, or of one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last
        first = last


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << int(n).bit_length()
        with np.errstate(over="ignore"):
            _powers = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, b, np.uint64))]) for b in (BASE, BASE_INVERSE))
    return _powers


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of many rows, A-Z in lower case; words are runs without the six white-space bytes.

    Returns the hashes in order, the first word of each row (one more than rows), and where each word starts and ends.
    """
    rows = len(offsets) - 1
    n = len(raw)
    # a space between rows, so that no word runs over a border
    at = offsets + np.arange(rows + 1)
    data = np.full(n + rows + 1, 32, np.uint8)
    keep = np.ones(n + rows + 1, bool)
    keep[at[1:] - 1] = False
    keep[-1] = False
    data[keep] = LOWER[raw]
    space = IS_SPACE[data]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(end) < len(start):
        end = np.append(end, len(data))
    up, down = _power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64)])
        hashed = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    first = np.searchsorted(start, at)
    shift = np.searchsorted(at[1:], start, side="right")
    return hashed, first, start - shift, end - shift


def batches_of(column: str, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Small runs of rows of Arrow batches, with the bytes and offsets of a text column."""
    for batch in batches:
        raw, offsets = texts_as_bytes(batch.column(batch.schema.get_field_index(column)))
        for first, last in slices(offsets):
            yield batch.slice(first, last - first), raw[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b): (id, component_id), the smallest id reachable; only ids with an edge.

    In a round every id goes to the first of itself and its neighbours, in an order by hash, and edges are carried along; those within one id
    vanish. The graph shrinks by a share in each round, whatever its shape. A round's edges are written to the shared folder. It ends when none is left.
    """

    def images(now: DataFrame, name: str, to: str) -> DataFrame:
        ends = now.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        first = ends.groupBy("u").agg(F.min(F.struct(F.xxhash64("v").alias("h"), "v")).alias("m"))
        return first.select(F.col("u").alias(name), F.when(F.col("m.h") < F.xxhash64("u"), F.col("m.v")).otherwise(F.col("u")).alias(to))

    rounds = []
    now = stash(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not rounds or not now.isEmpty():
        rounds.append(now)
        carried = now.join(images(now, "u", "x"), "u").join(images(now, "v", "y"), "v").where("x <> y")
        now = stash(carried.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "edges")
    tied = images(rounds[0], "id", "at")
    for later in rounds[1:]:
        tied = tied.join(images(later, "at", "to"), "at", "left").select("id", F.coalesce("to", "at").alias("at"))
    return tied.join(tied.groupBy("at").agg(F.min("id").alias("component_id")), "at").select("id", "component_id")


def stars(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A few edges that tie what the pairs tie: each id with the smallest one it reaches."""
    root: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = root[up]
            x = up
        return x

    for x, y in zip(a, b):
        x, y = top(x), top(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(x, top(x)) for x in list(root) if top(x) != x]
