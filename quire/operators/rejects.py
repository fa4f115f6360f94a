"""Fault isolation (S6, A10): rejects as data.

A row that cannot be used is not an exception but a row with a ``reject_reason``. One
pass writes every row to one of two tables, accepted or rejected, and counts both
as it goes (``observe``), so the accounting needs no second scan and cannot differ
from the tables it accounts for. The counts are taken in the tasks that write, of
which Spark counts each finished one once.

Defined results: a null reason accepts a row; a null path has no suffix, hence an
unsupported format; a null ``parse_ok`` counts as not read. Repeated rows are routed
each by itself. An empty table gives two empty tables and counts of zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quire.operators import suitability as SU
from quire.operators.report import book_format

FILE_REASONS = ("unsupported_format", "unreadable")
CHAPTER_REASONS = ("length", "title", "boilerplate", "legal_ratio")


def file_reason(path: Column, parse_ok: Column) -> Column:
    """Why a discovered file gives no book; null if it does."""
    return (F.when(book_format(F.coalesce(path, F.lit(""))) == "unsupported", F.lit("unsupported_format"))
            .when(~F.coalesce(parse_ok, F.lit(False)), F.lit("unreadable")))


def with_file_reason(files: DataFrame) -> DataFrame:
    return files.withColumn("reject_reason", file_reason(F.col("path"), F.col("parse_ok")))


def with_chapter_reason(chapters: DataFrame) -> DataFrame:
    """Why a chapter gives no cards (first failing rule); null if it may."""
    found = SU.suitability_columns(chapters)
    return found.select(*chapters.columns, F.col("first_reason").alias("reject_reason"))


@dataclass
class Routed:
    """Both tables of a routed pass and its counts: ``discovered``, ``accepted`` and
    one per reason."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def route(reasoned: DataFrame, path: str, reasons: tuple[str, ...]) -> Routed:
    """Write the rows of ``reasoned`` (which has ``reject_reason``) under ``path``, apart by
    whether they are rejected. Each table is read again from its own folder."""
    seen = Observation()
    r = F.col("reject_reason")
    marked = reasoned.withColumn("is_rejected", r.isNotNull())
    marked.observe(
        seen, F.count(F.lit(1)).alias("discovered"), F.count_if(r.isNull()).alias("accepted"),
        *[F.count_if(r == x).alias(x) for x in reasons],
    ).write.mode("overwrite").partitionBy("is_rejected").parquet(path)
    back = reasoned.sparkSession.read.schema(marked.schema).parquet(path)
    return Routed(back.where(~F.col("is_rejected")).drop("reject_reason", "is_rejected"),
                  back.where("is_rejected").drop("is_rejected"), dict(seen.get))


def reject_accounting(files: DataFrame, chapters: DataFrame) -> DataFrame:
    """The same counts for tables that are not being written: rows per level and
    outcome, each table aggregated once."""
    both = (with_file_reason(files).select(F.lit("file").alias("level"), "reject_reason")
            .unionByName(with_chapter_reason(chapters).select(F.lit("chapter").alias("level"), "reject_reason")))
    return both.groupBy("level", F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("rows"))
