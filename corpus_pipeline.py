"""Cleaning of a training corpus in stages; the subpackage gleanery.llm holds the operators.

Each stage gets what the one before kept, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import bpe, decontaminate, neardup, pii, queries, toxicity
from gleanery.llm.common import stash, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network rejects go; it learns from the labelled ones.

    A null or empty text stays; equal rows share one fate; without labels nothing is learned and nothing goes; an empty table gives none; other
    columns stay as they are.
    """
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: of the smallest id, and among rows of that id, of the smallest hash of the text.

    Repeated rows are a group. Null and blank texts are near nothing: one row of each id stays. Rows without an id all stay. An empty table gives none;
    other columns stay as they are, of repeated rows one row's.
    """
    told = neardup.link_documents(docs.where("doc_id is not null")).where("kept")
    kept = told.groupBy(F.col("component_id").alias("kept_id")).agg(F.min("text_key").alias("kept_key"))
    key = F.xxhash64(F.coalesce("d.text", F.lit("")))
    one = docs.alias("d").join(kept.alias("k"), (F.col("d.doc_id") == F.col("k.kept_id")) & (key == F.col("k.kept_key")), "left_semi").dropDuplicates(["doc_id"])
    return one.unionByName(docs.where("doc_id is null"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark text, or a great part of one, go.

    Null and empty texts hold nothing and stay; each row is judged by its own text, with an id or without; an empty table, or an empty benchmark, changes
    nothing; other columns stay as they are.
    """
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows stay, repeated ones too; personal data in their texts is replaced by its kind. A null text stays null; other columns stay as they are."""
    return pii.redact_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's text as token ids: doc_id, ids (binary), n_tokens. A null or empty text has no ids; an empty table gives no rows; other columns go."""
    return bpe.encode_documents(docs, queries.vocabulary()).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal data", redact_personal_data),
    ("encoding", encode),
]

#: SQL can't express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over documents, each written and read again but the last."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stash(docs, name.replace(" ", "-"))
    return docs
