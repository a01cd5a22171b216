"""The registered queries of the operators, each over its whole tables."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetyard.llm import sql
from fleetyard.llm.frames import read


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; its source is the host, its language the path."""
    from fleetyard.llm.quality_classifier import quality

    docs = read(spark, sf_dir, "documents")
    return quality(docs, read(spark, sf_dir, "labels"), host=docs["source"], path=docs["lang"])


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by the Jaccard similarity of their 4-word shingles."""
    from fleetyard.llm.ngram_join import jaccard_join

    return jaccard_join(read(spark, sf_dir, "documents"), k=4, percent=85)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    from fleetyard.llm.secret_scan import secret_spans

    return secret_spans(read(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents."""
    from fleetyard.llm.decontamination import find_leaks

    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and the likelihood-ratio verdict of every document."""
    from fleetyard.llm.quality_rules import quality_rules

    return quality_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that occur earlier."""
    from fleetyard.llm.substring_dedup import substring_digest

    return substring_digest(read(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of every document, read back."""
    import public_tokenizers

    from fleetyard.llm.token_files import token_file_digest

    return token_file_digest(read(spark, sf_dir, "documents"),
                             public_tokenizers.path("word_bpe_49k.json"), end_id=2)


def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, encoded and decoded again."""
    import public_tokenizers

    from fleetyard.llm.sentence_pieces import piece_digest

    return piece_digest(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from labels that are not held out."""
    from fleetyard.llm.toxicity import toxicity

    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    from fleetyard.llm.pii import pii_spans

    return pii_spans(read(spark, sf_dir, "documents"))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation folded from its event log, rendered and read back."""
    from fleetyard.llm.chat_format import chat_digest, with_probe

    return chat_digest(with_probe(read(spark, sf_dir, "conversations")))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged, and repaired at least cost."""
    from fleetyard.llm.structure_repair import repair_digest

    return repair_digest(read(spark, sf_dir, "conversations"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of every language."""
    from fleetyard.llm.collocations import collocations

    return collocations(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_secret_scan": op3_secret_scan,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_token_files": op7_token_files,
    "op8_sentence_pieces": op8_sentence_pieces,
    "op9_toxicity": op9_toxicity,
    "op10_pii": op10_pii,
    "op11_chat_format": op11_chat_format,
    "op12_structure_repair": op12_structure_repair,
    "op13_collocations": op13_collocations,
}
ORACLE_SQL: dict[str, str] = {
    "op11_chat_format": sql.CHAT_FORMAT,
    "op12_structure_repair": sql.STRUCTURE_REPAIR,
    "op13_collocations": sql.COLLOCATIONS,
}
