"""Corpus pipeline: five stages over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, which ``run`` writes as Parquet and rereads as the
next stage's docs. All but the last return the columns of documents:

1. ``quality_rules``: documents that fail the rules or the likelihood ratio go;
2. ``ngram_jaccard``: one document of each group of near copies stays
   (five-word shingles, Jaccard similarity 0.8 or more);
3. ``decontamination``: documents that hold a benchmark item go;
4. ``pii``: personal data in the text is replaced by its kind, ``n_chars``
   follows the new text;
5. ``sentence_pieces``: doc_id, n_tokens and ids of every document left.

A null or empty text fails the quality rules. Rows are told apart by doc_id
and text; columns that a stage does not name pass through unchanged.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetyard.llm.decontamination import leaks_any
from fleetyard.llm.frames import read, written
from fleetyard.llm.ngram_join import one_of_each
from fleetyard.llm.pii import masked_text
from fleetyard.llm.quality_rules import keep_good
from fleetyard.llm.sentence_pieces import with_ids


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, read(spark, sf_dir, "labels"))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return docs.filter(~leaks_any(docs, read(spark, sf_dir, "benchmark")))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = docs.withColumn("text", masked_text(docs))
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return with_ids(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_rules", quality_rules),
    ("ngram_jaccard", ngram_jaccard),
    ("decontamination", decontamination),
    ("pii", pii),
    ("sentence_pieces", sentence_pieces),
]

# Fitted and hashed stages are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each over everything its predecessor kept."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
