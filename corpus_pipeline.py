"""The corpus pipeline: toxicity, near-duplicates, personal data, mixing, encoding.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and returns the
columns of documents, but for the last, which returns the encoded corpus.

Defined results: a null text counts as the empty one and stays null until it is encoded; texts without words
are copies of each other, and the smallest id of them stays; repeated rows are copies; a null id goes last
among copies; of equally likely choices the smallest id, then the text's digest decides; without usable labels
no document is toxic; very long texts are single values; columns beside those of documents are kept, whatever
their names, until the last stage; an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import mixing, pii, simhash, spm, toxicity
from tidebook.llm.common import materialize
from tidebook.session import table

MODEL = "piece_bpe_32k.model"
BATCH = "1000"  # rows of whole texts that a task hands to its Python worker at once


def small_batches(spark: SparkSession) -> None:
    """A batch lies in memory in the JVM and in the worker; results are read later, so the setting stays with the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; labels teach the lexicon, none of them decides."""
    small_batches(spark)
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.below(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a likeness of 0.8 or more of their five-word runs; op4's digest bits miss most of these."""
    small_batches(spark)
    return simhash.distinct_documents(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind; n_chars follows the new text."""
    return pii.redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, repeated as often as it takes them."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the SHA-256 of what they decode to."""
    small_batches(spark)
    return spm.encoded(docs.select("doc_id", "lang", "source", "text"), spm.load(public_tokenizers.path(MODEL)))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Learned decisions, fingerprints and token ids cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
