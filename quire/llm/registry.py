"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import (ann, bpe, divergence, fingerprint, minhash, packing, pii, pitmanyor, quality, quotes, spelling,
                       tokencount, urlfilter)
from quire.llm.common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
COUNTED = "byte_bpe_50k.json"


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return bpe.bpe_digest(table(spark, sf_dir, "documents"), tokenizer)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations hold no quotations, so every message first gets those of
    the two messages before it; cleaning and linking must undo that."""
    sent = quotes.with_quotations(table(spark, sf_dir, "conversations"))
    return quotes.link_quotations(sent).select(
        "conv_id", "turn", "role", "position", "parent_turn",
        F.sha2(F.col("clean_text").cast("binary"), 256).alias("clean_sha256"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search_every(table(spark, sf_dir, "embeddings"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def op9_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.score_documents(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_by_words(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"), least=7, times=10)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"), threshold=10, top=10)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counter = tokencount.TokenCounter(spark, public_tokenizers.path(COUNTED))
    return tokencount.token_counts(table(spark, sf_dir, "documents"), counter)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": op1_pii,
        "op2_bpe": op2_bpe,
        "op3_fingerprints": op3_fingerprints,
        "op4_quotations": op4_quotations,
        "op5_neighbours": op5_neighbours,
        "op6_quality": op6_quality,
        "op7_url_filter": op7_url_filter,
        "op8_near_duplicates": op8_near_duplicates,
        "op9_pitman_yor": op9_pitman_yor,
        "op10_packing": op10_packing,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_source_divergence": op12_source_divergence,
        "op13_token_counts": op13_token_counts,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_quotations": quotes.op4_sql(),
        "op7_url_filter": urlfilter.op7_sql(),
        "op12_source_divergence": divergence.op12_sql(),
    }
