"""From raw documents to token ids in five stages; each one's output is the next one's input.

Defined cases: a document with a null or empty text fails the base rule and goes; null and shared ids are kept
and judged by their own texts; repeated rows are near duplicates, of which one stays; a null source is a
source of its own; an empty table gives an empty result; columns beyond those of ``documents``, whatever
their names, are carried to the last stage, which returns ids only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from claimworks.llm import mixing, near_dedup, quality_classifier, quality_rules, sentencepiece_codec
from claimworks.llm.common import table
from claimworks.llm.queries import MIX_WEIGHTS, PIECES
from claimworks.plans.workspace import write_table

# Words whose ids a worker of the last stage remembers, besides what the stages before have left in memory.
REMEMBERED_WORDS = 60_000


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or the learned list rejects go."""
    return quality_rules.accepted(docs, table(spark, sf_dir, "labels"))


def classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under one half go."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, model)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, similarity 0.8)."""
    return near_dedup.one_of_each(docs, size=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are replicated to the sources' target weights and shuffled."""
    return mixing.mix(docs, MIX_WEIGHTS).select(docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, checked against the other library and decoded again."""
    return sentencepiece_codec.encode_documents(docs, PIECES, whole=True, words=REMEMBERED_WORDS)


STAGES = [
    ("quality rules", rules),
    ("quality classifier", classifier),
    ("near-duplicate removal", dedup),
    ("source mixing", mixed),
    ("sentencepiece encoding", tokens),
]

# Stages learn from labels and search by hashes: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
