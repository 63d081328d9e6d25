"""Texts into content-hashed blocks, and what of them was seen before."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.config import CONFIG
from gleanery.functions.chrome import looks_like_chrome
from gleanery.functions.text import block_hash, paragraphs, stable_text

_BARE_LINK = re.compile(r"^\[[^\]\s]+\]$")


def cut_blocks(parts: list[str], chrome: list[bool], border: list[bool], most: int) -> list[tuple[int, str, str]]:
    """(pos, text, cut) of a page's paragraphs. A block ends where furniture and content meet ('flip'), after a paragraph whose hash
    says so ('content'), or when it is full ('ceiling'); a bare link stays with what stands before it."""
    out: list[tuple[int, str, str]] = []
    held: list[str] = []
    size = 0

    def emit(cut: str) -> None:
        nonlocal held, size
        out.append((len(out), "\n\n".join(held), cut))
        held, size = [], 0

    bare = [bool(_BARE_LINK.match(p)) for p in parts]
    for k, part in enumerate(parts):
        if held and not bare[k] and chrome[k] != chrome[k - 1]:
            emit("flip")
        held.append(part)
        size += len(part) + 2
        if (border[k] or size >= most) and not (k + 1 < len(parts) and bare[k + 1]):
            emit("content" if border[k] else "ceiling")
    if held:
        emit("end")
    return out


def segment(pages: DataFrame, page: str, text: str, most: int = CONFIG.segment_max_chars, target: int = CONFIG.segment_target_paragraphs) -> DataFrame:
    """page, pos, text, cut, hash, chars of all blocks. Paragraphs, one a row, are judged by columns; only the fold over a page's is Python."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(r.page, p, t, c) for r in batch.itertuples() for p, t, c in cut_blocks(list(r.parts), list(r.chrome), list(r.border), most)]
            yield pd.DataFrame(rows, columns=["page", "pos", "text", "cut"])

    # texts are dealt out before they are judged: a file of one row group would be a single task
    dealt = pages.select(F.col(page), F.col(text)).repartition(F.xxhash64(F.col(page), F.col(text)))
    each = dealt.select(F.col(page).alias("page"), F.posexplode(paragraphs(F.coalesce(F.col(text), F.lit("")))).alias("pos", "part"))
    # a paragraph whose hash says so ends a block
    border = F.conv(F.substring(F.sha2(stable_text(F.col("part")), 256), 1, 8), 16, 10).cast("long") % target == 0
    judged = each.select("page", F.struct("pos", "part", looks_like_chrome(F.col("part")).alias("chrome"), border.alias("border")).alias("p"))
    whole = judged.groupBy("page").agg(F.array_sort(F.collect_list("p")).alias("p"))
    ready = whole.select("page", F.col("p.part").alias("parts"), F.col("p.chrome").alias("chrome"), F.col("p.border").alias("border"))
    blocks = ready.mapInPandas(run, f"page {pages.schema[page].dataType.simpleString()}, pos int, text string, cut string")
    return blocks.withColumn("hash", block_hash(F.col("text"))).withColumn("chars", F.length("text"))


def reuse_against(blocks: DataFrame, seen: DataFrame) -> DataFrame:
    """Blocks with fresh: not among the seen hashes, and the first of its hash in this batch. Columns: hash, page, pos."""
    marked = blocks.join(seen.select("hash").distinct().withColumn("_seen", F.lit(True)), "hash", "left")
    first = F.row_number().over(Window.partitionBy("hash").orderBy("page", "pos")) == 1
    return marked.withColumn("fresh", F.col("_seen").isNull() & first).drop("_seen")


def line_ceiling(a: DataFrame, b: DataFrame, key: str, text: str) -> DataFrame:
    """key, ceiling: of b's lines (weighted by length + 1) the share that a has too, as often as it has them."""
    lines = lambda d, name: d.select(key, F.explode(F.split(text, "\n")).alias("line")).groupBy(key, "line").agg(F.count("*").alias(name))
    both = lines(b, "nb").join(lines(a, "na"), [key, "line"], "left")
    weight = F.length("line") + 1
    return both.groupBy(key).agg((F.sum(weight * F.least(F.coalesce("na", F.lit(0)), F.col("nb"))) / F.sum(weight * F.col("nb"))).alias("ceiling"))


def seen_in(block: Column, before: Column) -> Column:
    """Whether a block's lines stand one after another in an earlier text."""
    return F.concat(F.lit("\n"), before, F.lit("\n")).contains(F.concat(F.lit("\n"), block, F.lit("\n")))


def partition_chrome(blocks: DataFrame, page: str, text: str) -> DataFrame:
    """Blocks with chrome and sent: furniture isn't sent, unless a page is furniture alone."""
    marked = blocks.withColumn("chrome", looks_like_chrome(F.col(text)))
    rest = F.count_if(~F.col("chrome")).over(Window.partitionBy(page))
    return marked.withColumn("sent", ~F.col("chrome") | (rest == 0))
