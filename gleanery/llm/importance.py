"""Target-distribution importance resampling: documents whose words look like a target's are drawn more often.

Words come from an untrained pre-tokeniser, a Split by a pattern, over texts whose ASCII letters are lower-case; it tells each word's offsets. Windows of
one and of two neighbouring offset pairs are the features, and a feature's bucket is a CRC. Two histograms of buckets, of the corpus and of the target,
give each bucket a gain; a document's weight is the mean gain of its features, and the draw adds Gumbel noise that only its id decides.

Texts are split once: buckets are written, two bytes a feature, and read again for the histogram and for the weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import PreTokenizedString, Regex
from tokenizers.pre_tokenizers import Split

from gleanery.llm.common import stash

#: Words: runs of digits, lower-case ASCII letters and all that isn't ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Buckets of the histograms, words that a document needs to be drawn, percent of such documents that are drawn, and the seed of the draw.
BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 25, 7

_FEATURES = "doc_id long, n_words long, buckets binary"


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def buckets_of(text: str | None, split: Split, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """The number of words, and the buckets of all runs of one and of two words."""
    if not text:
        return 0, np.zeros(0, np.int64)
    data = text.encode().lower()  # of bytes, only A-Z
    held = PreTokenizedString(data.decode())
    split.pre_tokenize(held)
    crc, found, before = zlib.crc32, [], None
    for _, (start, end), _ in held.get_splits(offset_referential="original", offset_type="byte"):
        word = data[start:end]
        one = crc(word)
        found.append(one)
        if before is not None:
            found.append(crc(word, before))
        before = crc(b" ", one)
    return (len(found) + 1) // 2, np.array(found, np.int64) % buckets


def features(texts: DataFrame, id_column: str = "doc_id", buckets: int = BUCKETS) -> DataFrame:
    """A row for each text: its id as doc_id, n_words, and the buckets of its features as bytes (two each, or four beyond 65,536 buckets)."""
    kind = _kind(buckets)

    def split_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Split(Regex(WORD), behavior="removed", invert=True)
        for batch in batches:
            told = [buckets_of(t.as_py(), split, buckets) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for n, _ in told], pa.int64()), pa.array([b.astype(kind).tobytes() for _, b in told], pa.binary())], names=["doc_id", "n_words", "buckets"])

    return texts.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(split_batches, _FEATURES)


def histogram(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features by bucket: each task counts what it reads, Spark adds the counts, and one number a bucket comes back."""
    kind = _kind(buckets)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch.column(0):
                total += np.bincount(np.frombuffer(held.as_buffer(), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for row in found.select("buckets").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed share of the target and of the corpus, rounded down."""
    n, in_corpus, in_target = len(corpus), float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (in_corpus + n) / ((s + 1.0) * (in_target + n)))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight, the mean gain of all features rounded down; without features 0."""
    kind = _kind(len(gain))

    def mean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(b.as_buffer(), kind) for b in batch.column(2)]
            size = [len(b) for b in held]
            weight = [int(gain[b].sum()) // len(b) if len(b) else 0 for b in held]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(mean, "doc_id long, n_words long, n_features long, weight long")


def draw(weighed: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """score and rank besides what is there: rank counts the drawn rows from 1, in falling order of score, ties in order of ids; others have none.

    Scores are whole numbers between bounds that the gains and the noise set, so a table of counts by score stays small however many rows there are. It
    tells where a score's ranks begin and which scores are drawn at all; only rows of these are sorted, each score by itself.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    scored = weighed.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long"))
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    counts = scored.where(able).groupBy("score").agg(F.count("*").alias("n"))
    steps = counts.select("score", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.expr(f"(sum(n) over ()) * {percent} div 100").alias("take"))
    placed = scored.join(F.broadcast(steps.where("before < take")), "score", "left").withColumn("in_reach", able & F.col("take").isNotNull())
    columns = [*weighed.columns, "score"]
    place = F.col("before") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id", "n_features"))
    drawn = placed.where("in_reach").select(*columns, "take", place.alias("place")).select(*columns, F.when(F.col("place") <= F.col("take"), F.col("place")).alias("rank"))
    return drawn.unionByName(placed.where("not in_reach").select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(documents: DataFrame, target: DataFrame, target_id: str = "item_id", buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of documents (doc_id, text) against the texts of the target.

    A null or empty text, or one without words, has no features and weight 0. A row without an id counts in the statistics, but has no score and
    isn't drawn. Repeated rows are all there and all counted. With an empty target all gains come from the corpus alone; an empty table gives no rows.
    Other columns don't matter.
    """
    corpus, wanted = stash(features(documents, "doc_id", buckets), "features", "zstd"), features(target, target_id, buckets)
    weighed = stash(weigh(corpus, gains(histogram(corpus, buckets), histogram(wanted, buckets))), "weights")
    return draw(weighed, percent, least_words, seed).select("doc_id", "n_features", "weight", "score", "rank")
