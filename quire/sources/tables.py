"""Readers for the input tables (parquet).

Every reader returns a lazily planned DataFrame; callers project the columns
they need so that Catalyst prunes the parquet scan to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Splits are the scan's own: a file of one row group stays one task."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df
