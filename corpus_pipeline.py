"""From raw documents to tokens: five stages, each a Spark job over all that its predecessor kept.

``run`` writes each stage's result as a Parquet table in the session's shared folder and hands the reread
table on, so a lost executor repeats a stage's tasks and nothing before it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe_tree, budget_mix, langid_ftrl, linked_secrets, minhash_bbit
from marquee.session import materialise, scratch_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Least calibrated probability of a language that keeps a document.
LEAST_LANGUAGE_SCORE = 0.5
# Five words and a similarity of 0.8.
NEAR = minhash_bbit.Near(words=5, percent=80)
# Texts go to Python in batches of at most so many bytes; a batch of the usual number of rows may hold many times that.
BATCH_BYTES = "8m"


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier knows: no letters, no text, or doubt rejects.

    The language column becomes the predicted one.  Learned from the documents' own labels, outside the
    held-out third.
    """
    _small_batches(spark)
    model = langid_ftrl.fit(docs.where(~langid_ftrl.held_out()))
    found = langid_ftrl.predict(docs.select(*COLUMNS), model)
    kept = found.where((F.col("lang_pred") != langid_ftrl.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    _small_batches(spark)
    return minhash_bbit.deduplicated(docs.select(*COLUMNS), NEAR)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by their kind; ``n_chars`` is counted again.

    A null text stays null and has null characters; an empty text and an empty table stay as they are;
    rows that repeat are treated alike.
    """
    clean = linked_secrets.redacted(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("long"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source of its own; null and empty texts have no words and follow whole repeats only;
    equal documents are taken in the order of their rows; an empty table stays empty.
    """
    return budget_mix.mixed(docs.select(*COLUMNS))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the hash of the decoded ids to compare with the text.

    A null text counts as empty and has no tokens; rows that repeat are encoded alike; an empty table stays empty.
    """
    _small_batches(spark)
    ranks = bpe_tree.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe_tree.encode(docs.select("doc_id", "lang", "source", "text"), ranks, public_tokenizers.PATTERN, checked=True).drop("text")


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", duplicate_stage),
    ("secret_scan", secret_stage),
    ("source_mix", mixing_stage),
    ("byte_bpe", token_stage),
]

# Training, sketching and tokenising are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch_scope(spark) as job:
        for name, stage in STAGES:
            # What a stage stored on its way goes when its result is written.
            with scratch_scope(spark) as scope:
                made = scope.keep(materialise(stage(spark, docs, sf_dir), f"stage-{name}"))
            job.drop(docs)
            docs = made
        return job.keep(docs)
