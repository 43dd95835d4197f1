"""The operators as queries over a scale-factor folder, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.llm import (
    chat_format, conversation_audit, html_extract, mixing, near_dedup, quality_classifier,
    quality_rules, sentencepiece_codec, sharding, spelling_variants, token_counts, token_files, vector_search,
)
from claimworks.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
NEIGHBOURS = 20
# How far the triangle inequality is relaxed. Measured share of pairs compared and recall: 0.93, 0.96 of 500
# vectors, 0.91, 0.97 of 2,000 and 0.79, 0.96 of 51,282 (64 dimensions without structure, see the README).
PRUNING = 6.0
SHARDS = 24
# The hot source counts twice, every other one once.
MIX_WEIGHTS = {"src0": 2.0}


def op1_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """20 nearest vectors of every 20th one."""
    vectors = table(spark, sf_dir, "embeddings")
    return vector_search.nearest(vectors, F.col("vec_id") % 20 == 0, NEIGHBOURS, PRUNING)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measurements and the learned list's verdict."""
    judged, _ = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.BASE, "base_failed", "rule", "kept")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans and checksums of all documents, read back from the files."""
    files = token_files.write_token_files(table(spark, sf_dir, "documents"), BYTE_BPE)
    return token_files.read_spans(files)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.score(docs, model)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repaired and rendered turns of every conversation."""
    return chat_format.format_conversations(table(spark, sf_dir, "conversations"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, replicated to the target weights."""
    return mixing.mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS)


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, checked against the other library and decoded again."""
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), PIECES)


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents on 4-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op11_conversation_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and its audit of every damaged conversation."""
    return conversation_audit.audit_conversations(table(spark, sf_dir, "conversations"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of all documents."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECES)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frequent words of all documents with their near words, forms and roots."""
    return spelling_variants.spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_vector_search, op2_quality_rules, op3_token_files, op4_quality_classifier, op5_sharding,
        op6_html_extract, op7_chat_format, op8_mixing, op9_sentencepiece, op10_near_dedup, op11_conversation_audit,
        op12_token_counts, op13_spelling_variants,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op5_sharding": sharding.oracle_sql(SHARDS),
    "op8_mixing": mixing.oracle_sql(MIX_WEIGHTS),
    "op10_near_dedup": near_dedup.oracle_sql(size=4, percent=80),
    "op11_conversation_audit": conversation_audit.oracle_sql(),
    "op13_spelling_variants": spelling_variants.oracle_sql(),
}
