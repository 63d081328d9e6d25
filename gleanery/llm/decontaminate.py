"""Benchmark decontamination by spaced seeds, in DataFrame functions alone.

A mask picks some of a run of words and ignores the others; two passages that differ by substituted words still agree under a mask
where the differences fall on ignored places. The hashes of all masked runs of the benchmark are joined with those of the documents.
Around each hit the two texts are laid over each other, word by word, and stretches that agree well enough are found; what is found of a benchmark
text in all its places counts together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanery.llm.common import stash

#: Masks: which words of a run count. Fixed for all runs.
MASKS = ((0, 1, 2, 4, 7, 8), (0, 1, 3, 5, 6, 9))
#: So many of a hundred words of a stretch must agree; so many words at least must be found, and so many of a hundred of the benchmark text's.
AGREE, LEAST_WORDS, COVER = 70, 8, 50
#: Words of a stretch, and found words that are enough of however long a benchmark text.
STRETCH, ENOUGH = 13, 30
#: Benchmark texts of fewer words than LEAST_WORDS must be found word by word as a whole; those of fewer than this are too short to tell anything.
SHORTEST = 5
#: Masked runs of the benchmark up to which they, and its texts, are sent to all executors; beyond it both sides are shuffled.
BROADCAST_RUNS = 200_000
#: White space between words, as in the other operators.
BREAK = "[\\x20\\x09-\\x0D]+"


def words_of(text: Column) -> Column:
    """Lower case, words between white space; one empty word for null or blank texts."""
    return F.split(F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(" \t\n\x0b\f\r")), BREAK)


def _runs(words: str, at: str, kinds: list[int]) -> Column:
    """Structs of mask and hash of the run that starts at a place of an array column: a number below 100 is a spaced mask, 100 + n all of n words.

    A run that reaches beyond the text is null.
    """

    def run(kind: int) -> Column:
        places = MASKS[kind] if kind < 100 else range(kind - 100)
        hashed = F.xxhash64(F.lit(kind), *[F.expr(f"get({words}, {at} + {i})") for i in places])
        return F.struct(F.lit(kind).alias("mask"), F.when(F.size(words) > F.col(at) + max(places), hashed).alias("run"))

    return F.array(*map(run, kinds))


def _starts(words: str) -> Column:
    """Where runs start in an array column; null if it is shorter than any run."""
    return F.when(F.size(words) >= SHORTEST, F.sequence(F.lit(0), F.size(words) - SHORTEST))


def _row(of: str = "") -> Column:
    """A key of a row: equal rows share it."""
    return F.xxhash64(F.col(f"{of}doc_id").cast("long"), F.col(f"{of}doc_id").isNull(), F.col(f"{of}text"))


def _held(docs: DataFrame, benchmark: DataFrame, agree: int, least_words: int, cover: int, stretch: int, enough: int) -> DataFrame:
    """row, item_id, n_found, n_item of rows that hold enough of a benchmark text."""
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text")).alias("item")).where(F.size("item") >= SHORTEST)
    items = stash(items.distinct(), "items")
    # a text of fewer words than the least has one run, that of its own length; the others have those of the least length, and spaced ones
    kinds = [*range(len(MASKS)), *(100 + n for n in range(SHORTEST, least_words + 1))]
    runs = items.select(F.size("item").alias("n"), "item_id", "item", F.explode(_starts("item")).alias("item_at")).select("n", "item_id", "item_at", F.inline(_runs("item", "item_at", kinds)))
    own = F.when(F.col("n") < least_words, F.col("mask") == F.col("n") + 100).otherwise((F.col("mask") < 100) | (F.col("mask") == 100 + least_words))
    seeds = stash(runs.where(F.col("run").isNotNull() & own).select("item_id", "item_at", "mask", "run"), "seeds")
    few = seeds.count() <= BROADCAST_RUNS
    # only runs of the kinds that the benchmark has, six at most, are looked for
    wanted = sorted(r["mask"] for r in seeds.select("mask").distinct().collect()) or [0]
    pages = docs.select(_row().alias("row"), words_of(F.col("text")).alias("words"))
    tests = pages.select("row", "words", F.explode(_starts("words")).alias("doc_at")).select("row", "doc_at", F.inline(_runs("words", "doc_at", wanted)))
    met = tests.join(F.broadcast(seeds) if few else seeds, ["mask", "run"])
    # a diagonal has many hits and is laid once; only rows that are met travel, once however often they come
    shifts = stash(met.select("row", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct(), "diagonals")
    texts = docs.select(_row().alias("row"), "text")
    laid = shifts.join(F.broadcast(items) if few else items, "item_id").join(texts, "row").withColumn("words", words_of(F.col("text")))
    laid = laid.withColumn("from_item", F.greatest(F.lit(0), -F.col("shift"))).withColumn("from_doc", F.greatest(F.lit(0), F.col("shift")))
    laid = laid.withColumn("n_laid", F.least(F.size("item") - F.col("from_item"), F.size("words") - F.col("from_doc")))
    pairs = F.zip_with(F.slice("words", F.col("from_doc") + 1, F.col("n_laid")), F.slice("item", F.col("from_item") + 1, F.col("n_laid")), lambda a, b: a == b)
    laid = laid.select("row", "item_id", "from_item", "n_laid", F.size("item").alias("n_item"), pairs.alias("pairs"), F.least(F.lit(stretch), F.col("n_laid")).alias("wide"))
    places = F.sequence(F.lit(1), F.col("n_laid"))
    agreeing = lambda x: F.size(F.filter(x, lambda same: same))
    good = F.filter(F.sequence(F.lit(1), F.col("n_laid") - F.col("wide") + 1), lambda k: 100 * agreeing(F.slice("pairs", k, F.col("wide"))) >= agree * F.col("wide"))
    inside = F.array_distinct(F.flatten(F.transform(good, lambda k: F.sequence(k, k + F.col("wide") - 1))))
    told = F.when(100 * agreeing(F.col("pairs")) >= agree * F.col("n_laid"), places).otherwise(inside)
    found = laid.select("row", "item_id", "n_item", F.transform(F.filter(told, lambda k: F.element_at("pairs", k)), lambda k: k + F.col("from_item")).alias("found"))
    counted = found.where(F.size("found") > 0).groupBy("row", "item_id", "n_item").agg(F.size(F.array_distinct(F.flatten(F.collect_set("found")))).alias("n_found"))
    part = (F.col("n_found") >= least_words) & ((100 * F.col("n_found") >= cover * F.col("n_item")) | (F.col("n_found") >= enough))
    return counted.where(F.when(F.col("n_item") < least_words, F.col("n_found") == F.col("n_item")).otherwise(part))


def overlaps(docs: DataFrame, benchmark: DataFrame, agree: int = AGREE, least_words: int = LEAST_WORDS, cover: int = COVER, stretch: int = STRETCH, enough: int = ENOUGH) -> DataFrame:
    """doc_id, item_id, n_found, n_item (words): which part of each benchmark text a document holds, in one piece or in several.

    Along the diagonal of every hit each window of ``stretch`` words (of the overlap, if that is shorter) is judged by itself: if ``agree`` of 100 words
    agree, its agreeing words of the benchmark text are found; so are all of a diagonal that agrees as a whole. The words found on all
    diagonals count together, so words put in or left out part a copy but don't hide it. At least ``least_words`` must be found, and ``cover``
    of 100 of the benchmark text's or ``enough``. A benchmark text of fewer words than that must be there as a whole, word by word; one of under SHORTEST words
    meets nothing. Null and empty texts, and empty tables, give no rows; nor do rows without an id, and benchmark texts without one. Of several rows
    with one id the best counts. Other columns don't matter.
    """
    ids = docs.where("doc_id is not null").select(_row().alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    held = _held(docs, benchmark, agree, least_words, cover, stretch, enough)
    return held.join(ids, "row").groupBy("doc_id", "item_id").agg(F.max("n_found").cast("long").alias("n_found"), F.max("n_item").cast("long").alias("n_item"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, that hold no benchmark text and no great part of one.

    Each row is judged by its own text: rows without an id too, and other rows of an id stay.
    """
    held = _held(docs, benchmark, AGREE, LEAST_WORDS, COVER, STRETCH, ENOUGH).select("row").distinct()
    return docs.alias("d").join(held.alias("h"), _row("d.") == F.col("h.row"), "left_anti")
