"""Language of a text by multinomial naive Bayes over hashed character n-grams.

Texts are reduced to lower-case letters with one space for all between them. Runs of one to four characters are hashed into buckets; counts by language
and bucket are one aggregation over all training texts. The matrix of log-probabilities, of a bounded size, goes to every task, where a text's counts
meet it as a sparse row: looked up by bucket and added up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of a run, from and to; buckets at most, a power of two; cells of the matrix at most: with very many languages there are fewer buckets.
SHORTEST, LONGEST, BUCKETS, CELLS = 1, 4, 1 << 16, 1 << 25
#: Added to each count.
SMOOTHING = 0.5
#: What a text without letters gets.
UNDETERMINED = "und"
#: Characters that array code handles at once, and cells of a look-up.
STEP, LOOKUP = 1 << 16, 1 << 19


@dataclass
class Model:
    """Languages in order, their log shares of the training texts, and log-probabilities by bucket and language."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray


def has_letter(text: Column) -> Column:
    """Whether the text holds a letter of any script; null: no."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def letters_of(text: Column) -> Column:
    """Lower-case letters, with one space for each run of other characters, at both ends too."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(text), F.lit(" ")), r"[^\p{L}\p{M}]+", " ")


def grams(codes: np.ndarray, buckets: int) -> Iterator[np.ndarray]:
    """For each length, the bucket of the run that starts at each place (shorter by the length); buckets are a power of two."""
    codes = codes.astype(np.uint64) + np.uint64(1)
    shift = np.uint64(64 - max(1, buckets.bit_length() - 1))
    with np.errstate(over="ignore"):
        hashed = np.full(len(codes) + 1, LONGEST, np.uint64)
        for n in range(1, LONGEST + 1):
            # a run's hash and that of the run without its last character differ by one step
            hashed = hashed[:-1] * np.uint64(0x9E3779B97F4A7C15)
            hashed += codes[n - 1 :]
            if n >= SHORTEST and len(hashed):
                found = hashed ^ (hashed >> np.uint64(29))
                found *= np.uint64(0xBF58476D1CE4E5B9)
                found >>= shift
                yield found.view(np.int64) & (buckets - 1)


def pieces(texts: Iterable[str | None], step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Bounded loads of pieces of texts: all characters, the length of each piece, and its row.

    A text longer than a step comes in several pieces; each holds what runs that start in its step reach of the next one.
    """
    codes: list[np.ndarray] = []
    rows: list[int] = []
    size = 0
    for row, text in enumerate(texts):
        told = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
        for first in range(0, len(told), step):
            codes.append(told[first : first + step + LONGEST - 1])
            rows.append(row)
            size += len(codes[-1])
            if size >= step:
                yield np.concatenate(codes), np.array([len(c) for c in codes]), np.array(rows)
                codes, rows, size = [], [], 0
    if size:
        yield np.concatenate(codes), np.array([len(c) for c in codes]), np.array(rows)


def runs(codes: np.ndarray, lengths: np.ndarray, rows: np.ndarray, buckets: int, step: int = STEP) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of every run that starts in the step of a piece and ends within the piece, for each length in turn."""
    of, ends = np.repeat(rows, lengths), np.cumsum(lengths)
    at = np.arange(len(codes))
    left = np.repeat(ends, lengths) - at
    own = at - np.repeat(ends - lengths, lengths) < step
    for n, bucket in zip(range(SHORTEST, LONGEST + 1), grams(codes, buckets)):
        inside = (left[: len(bucket)] >= n) & own[: len(bucket)]
        yield of[: len(bucket)][inside], bucket[inside]


def fit(documents: DataFrame, buckets: int = BUCKETS) -> Model:
    """A model of the rows with a text and a lang. Repeated rows count each; texts without letters count in the shares of languages alone.

    Three aggregations by language come to the driver: its texts, and its counts by bucket, whose number CELLS bounds.
    """
    told = documents.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang is not null and text is not null")
    shares = {r.lang: r.n for r in told.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(shares)
    if not languages:
        return Model([], np.zeros(0), np.zeros((buckets, 0)))
    while buckets > 2 and buckets * len(languages) > CELLS:
        buckets //= 2
    place = {name: k for k, name in enumerate(languages)}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            of_row = np.array([place[x.as_py()] for x in batch.column(0)], np.int64)
            for k in np.unique(of_row):
                total = totals.setdefault(k, np.zeros(buckets, np.int64))
                for load in pieces(batch.column(1)[int(r)].as_py() for r in np.flatnonzero(of_row == k)):
                    for _, bucket in runs(*load, buckets):
                        total += np.bincount(bucket, minlength=buckets)
        for k, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), k, np.int64)), pa.array(at), pa.array(total[at])], names=["language", "bucket", "n"])

    counts = np.zeros((buckets, len(languages)))
    summed = told.select("lang", letters_of(F.col("text")).alias("text")).mapInArrow(count, "language long, bucket long, n long").groupBy("language", "bucket").agg(F.sum("n").alias("n"))
    for batch in summed.toArrow().to_batches():
        language, bucket, n = (batch.column(k).to_numpy() for k in range(3))
        counts[bucket, language] = n
    every = np.array([shares[name] for name in languages], float)
    return Model(languages, np.log(every / every.sum()), np.log((counts + SMOOTHING) / (counts.sum(0) + SMOOTHING * buckets)))


def score_texts(texts: Iterable[str | None], rows: int, model: Model) -> np.ndarray:
    """Log-probabilities of each reduced text together with each language."""
    out = np.repeat(model.prior[None, :], rows, axis=0)
    buckets, languages = model.matrix.shape
    most = max(1, LOOKUP // max(1, languages))
    for load in pieces(texts):
        for row, bucket in runs(*load, buckets):
            for first in range(0, len(row), most):
                r, b = row[first : first + most], bucket[first : first + most]
                # rows come in order: each one's cells stand together
                starts = np.flatnonzero(np.diff(r, prepend=-1))
                out[r[starts]] += np.add.reduceat(model.matrix[b], starts, axis=0)
    return out


def predict(documents: DataFrame, model: Model, *more: Column) -> DataFrame:
    """doc_id, what else is named, lang_pred and score of every row: the likeliest language and its posterior probability.

    A null text, one without a letter, and every text when nothing was learned get "und" and score 0. Ties go to the language that comes first by name.
    Rows without an id and repeated rows are judged each by itself; texts of any length are read whole, in pieces; an empty table gives no rows; other
    columns don't matter.
    """
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *more, F.when(has_letter(F.col("text")), letters_of(F.col("text"))).alias("letters"))
    at = len(narrow.columns) - 1
    schema = narrow.drop("letters").schema.add("lang_pred", "string").add("score", "double")
    held = documents.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            texts = batch.column(at)
            name, sure = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            known = np.flatnonzero(~texts.is_null().to_numpy(zero_copy_only=False))
            if len(known) and model.languages:
                found = score_texts((texts[int(k)].as_py() for k in known), len(known), model)
                best = found.argmax(1)
                name[known] = np.array(model.languages, object)[best]
                sure[known] = 1 / np.exp(found - found.max(1, keepdims=True)).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(name, pa.string()), pa.array(sure)], names=[*batch.schema.names[:at], "lang_pred", "score"])

    return narrow.mapInArrow(judge, schema)
