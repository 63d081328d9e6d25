"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm import ann, bpe, decontaminate, importance, langid, lm, neardup, negatives, oracles, pii, quality, secrets, tokencount, toxicity
from gleanery.llm.common import fold_of, stash, table


def vocabulary() -> str:
    """Where the byte-level vocabulary lies; installed on every machine."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


#: The end-of-document id of that vocabulary.
END_OF_DOCUMENT = 50256


def op1_decontaminate_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of each benchmark text each document holds: doc_id, item_id, n_found, n_item. See decontaminate.overlaps."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_secrets_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credentials in every text: counts, digest and spans. The automata learn from all documents. See secrets.digest_documents."""
    docs = table(spark, sf_dir, "documents")
    return secrets.digest_documents(docs, secrets.fit(docs))


def op3_ann_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for each vector whose id is divisible by 20. See ann.nearest."""
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


def op4_neardup_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of near-duplicates of every document. See neardup.link_documents."""
    return neardup.link_documents(table(spark, sf_dir, "documents")).drop("text_key")


def op5_bpe_prefix_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every text encoded and decoded again. See bpe.digest_documents."""
    return bpe.digest_documents(table(spark, sf_dir, "documents"), vocabulary())


def op6_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every text by a network that learns from the labelled ones outside the held-out fold. See toxicity.score_documents."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_quality_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every text by a scorer that learns from weighed heuristics, without labels. See quality.score_documents."""
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.fit(docs))


def op8_lm_brown_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The probability of every text by a class model, and by counts alone, learned from the training folds. See lm.score_documents."""
    docs = table(spark, sf_dir, "documents")
    training = fold_of(F.col("doc_id"), 7) != 2
    return lm.score_documents(docs, lm.fit(docs.where(training)), training)


def op9_pii_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: counts, digest and spans. See pii.digest_documents."""
    return pii.digest_documents(table(spark, sf_dir, "documents"))


def op10_token_counts_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents from flat token files, which are written first. See tokencount.count_documents."""
    files = stash(tokencount.write_files(table(spark, sf_dir, "documents"), vocabulary()), "tokens", "zstd")
    return tokencount.count_documents(files, END_OF_DOCUMENT)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weight of every document for the benchmark's distribution, and the rank of those drawn. See importance.resample."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_language_naive_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those outside the held-out fold. See langid.predict."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of(F.col("doc_id"), 3) == 1
    model = langid.fit(docs.where(~held_out))
    return langid.predict(docs, model, held_out.alias("held_out"))


def op13_hard_negatives_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the vectors whose id is divisible by 100, after labels of every seventh id have moved by one. See negatives.mine."""
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(vectors.withColumn("label", moved))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate_spaced_seeds,
        op2_secrets_grammar,
        op3_ann_prefix_forest,
        op4_neardup_chosen_path,
        op5_bpe_prefix_dp,
        op6_toxicity_bigru,
        op7_quality_weak_labels,
        op8_lm_brown_classes,
        op9_pii_checksums,
        op10_token_counts_separator_scan,
        op11_importance_resampling,
        op12_language_naive_bayes,
        op13_hard_negatives_packed,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate_spaced_seeds": oracles.decontamination(),
    "op4_neardup_chosen_path": oracles.near_duplicates(),
    "op11_importance_resampling": oracles.resampling(),
    "op13_hard_negatives_packed": oracles.hard_negatives(),
}
