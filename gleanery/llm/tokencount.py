"""Token counts of flat token files without an index: a scan for separators.

A flat file is the tokens of many documents one after another, each followed by the end-of-document id; it lies in blocks of one
size, which know nothing of documents. Each block is searched on its own; what runs over its borders is put together by a prefix
scan over the blocks' summaries: how many documents ended before, and how many tokens the open one has so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanery.llm.bpe import codec, small_batches
from gleanery.llm.common import stash, whole

#: Tokens in a block.
BLOCK = 1 << 16
#: Names of documents in a row of a list.
LISTED = 4096

#: Blocks of a file that one window scans; ranges of them are scanned after.
RANGE = 4096

_FILE = "file int, block int, width int, data binary, names array<long>"


def write_files(docs: DataFrame, path: str, separator: str = "<|endoftext|>", block: int = BLOCK) -> DataFrame:
    """Flat token files of all texts: rows (file, block, width, data) hold ids of so many bytes, two where the vocabulary allows, and rows (file, block, names) list the documents in order.

    A partition is a file. The separator's string in a text is ordinary text. A null or empty text has the separator alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        width = own.width
        end = np.array([own.special[separator]], width)
        file = TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        size = blocks = lists = 0

        def row(number: int, data: bytes | None, names: list | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([file], pa.int32()), pa.array([number], pa.int32()), pa.array([end.itemsize], pa.int32()), pa.array([data], pa.binary()), pa.array([names], pa.list_(pa.int64()))], ["file", "block", "width", "data", "names"])

        for batch in batches:
            for at in range(0, batch.num_rows, LISTED):
                yield row(lists, None, batch.column(0).slice(at, LISTED).to_pylist())
                lists += 1
            for one in small_batches(batch):
                for ids in own.encode_all(one.column(1).to_pylist(), special=False):
                    held += [ids.astype(width), end]
                    size += len(ids) + 1
                    if size >= block:
                        flat = np.concatenate(held)
                        full = size // block * block
                        for at in range(0, full, block):
                            yield row(blocks, flat[at : at + block].tobytes(), None)
                            blocks += 1
                        held, size = [flat[full:]], size - full
        if size:
            yield row(blocks, np.concatenate(held).tobytes(), None)

    return whole(docs).mapInArrow(run, _FILE)


def summarise(files: DataFrame, end: int) -> DataFrame:
    """file, block, n_ends, head (tokens before the first end, or all), tail (after the last), inner (lengths between ends), by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for data, width in zip(batch.column(2), batch.column(3).to_pylist()):
                tokens = np.frombuffer(data.as_py(), f"<u{width}")
                ends = np.flatnonzero(tokens == end)
                n = len(ends)
                rows.append((n, int(ends[0]) if n else len(tokens), len(tokens) - 1 - int(ends[-1]) if n else 0, (np.diff(ends) - 1).tolist()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds))], ["file", "block", "n_ends", "head", "tail", "inner"])

    # a reader's batches hold many blocks; few at a time stay in memory, as each is cut to its summary
    return files.where("data is not null").select("file", "block", "data", "width").mapInArrow(run, "file int, block int, n_ends long, head long, tail long, inner array<long>")


def _open(parts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows (n_ends, left: tokens after the last end, or all) in order with ended (ends before the row), islands (rows with an end up to it), and so_far (tokens open after it)."""
    up_to = Window.partitionBy(*keys).orderBy(order)
    marked = parts.withColumn("ended", F.coalesce(F.sum("n_ends").over(up_to.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("islands", F.sum((F.col("n_ends") > 0).cast("int")).over(up_to))
    return marked.withColumn("so_far", F.sum("left").over(Window.partitionBy(*keys, "islands").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def count_tokens(files: DataFrame, end: int) -> DataFrame:
    """file, ordinal (from 0), n_tokens (without the end) of every document that ends in the files.

    Tokens after a file's last end belong to no document. An empty table gives no rows. A file's blocks follow their numbers. However large a file is, a
    window holds the narrow summaries of RANGE blocks, or of all its ranges; the lengths inside blocks are joined after.
    """
    blocks = stash(summarise(files, end), "summaries")
    narrow = blocks.select("file", F.expr(f"block div {RANGE}").alias("range"), "block", "n_ends", "head", F.when(F.col("n_ends") > 0, F.col("tail")).otherwise(F.col("head")).alias("left"))
    inside = _open(narrow, ["file", "range"], "block")
    ranges = inside.groupBy("file", "range").agg(F.sum("n_ends").alias("n_ends"), F.max_by("so_far", "block").alias("left"))
    by_file = Window.partitionBy("file").orderBy("range")
    ranges = _open(ranges, ["file"], "range").select("file", "range", F.col("ended").alias("ended_before"), F.coalesce(F.lag("so_far").over(by_file), F.lit(0)).alias("open_before"))
    by_range = Window.partitionBy("file", "range").orderBy("block")
    first = F.col("ended") == 0  # no end yet in the range: what was open before it still is
    placed = inside.withColumn("held", F.coalesce(F.lag("so_far").over(by_range), F.lit(0))).join(ranges, ["file", "range"])
    placed = placed.where("n_ends > 0").select("file", "block", (F.col("ended") + F.col("ended_before")).alias("ended"), (F.col("head") + F.col("held") + F.when(first, F.col("open_before")).otherwise(0)).alias("length"))
    lengths = F.concat(F.array("length"), F.col("inner"))
    each = placed.join(blocks.select("file", "block", "inner"), ["file", "block"])
    return each.select("file", "ended", F.posexplode(lengths).alias("k", "n_tokens")).select("file", (F.col("ended") + F.col("k")).alias("ordinal"), "n_tokens")


def count_documents(files: DataFrame, end: int) -> DataFrame:
    """doc_id, n_tokens: the counts of the files' documents, named by the files' lists. A document listed twice comes twice."""
    lists = files.where("names is not null").select("file", F.col("block").cast("long").alias("list"), "names", F.size("names").cast("long").alias("n"))
    before = Window.partitionBy("file").orderBy("list").rowsBetween(Window.unboundedPreceding, -1)
    named = lists.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).select("file", "first", F.posexplode("names").alias("k", "doc_id"))
    named = named.select("file", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")
    return count_tokens(files, end).join(named, ["file", "ordinal"]).select("doc_id", "n_tokens")
