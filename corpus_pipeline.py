"""The corpus pipeline: quality, near-duplicates, personal data, packing.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
works on all rows its predecessor kept. All but the last return the columns of
``documents``; the last returns where each piece of each document is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm import minhash, packing, pii, quality
from quire.llm.common import staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (five words, 0.8)."""
    return minhash.keep_one(docs, words=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes marks; n_chars follows the new text."""
    return pii.redact_pii(docs, "text", "n_chars" if "n_chars" in docs.columns else None)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequence, position and capacity of every piece of every document."""
    return packing.pack_by_words(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# The classifier, the deobfuscation and best-fit packing have no SQL form;
# tests/llm/test_pipeline.py holds run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; each stage's rows are
    written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
