"""Chapter suitability rules.

All rules are row-local: the lower-cased content is computed once per row in
a projection and every substring test reads it (no regex, no UDF). The
predicate is written in the reference's order, cheapest first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

MIN_CONTENT_CHARS = 200

# Title substrings that mark a chapter as not worth studying.
SKIP_TITLE_PATTERNS = [
    "title page", "cover", "dedication", "acknowledgment",
    "copyright", "disclaimer", "about", "author",
]

# Content substrings of front/back matter; 3 or more present -> unsuitable.
SKIP_CONTENT_PATTERNS = [
    "copyright", "disclaimer", "acknowledgment", "acknowledgement",
    "dedication", "about the author", "table of contents", "index",
    "bibliography", "references", "endnotes", "footnotes",
    "published by", "all rights reserved", "isbn",
    "visit us at", "www.", "http://", "https://",
]
SKIP_CONTENT_LIMIT = 3

# Legal substrings; the summed length of those present over the content
# length above the ratio -> unsuitable.
LEGAL_PATTERNS = ["©", "copyright", "all rights reserved", "disclaimer", "liability"]
LEGAL_RATIO_LIMIT = 0.3


def _present(low: Column, pat: str) -> Column:
    return F.when(low.contains(pat), 1).otherwise(0)


def title_columns(df: DataFrame, title: str = "title") -> DataFrame:
    """Add title_ok (F2); the content is not read."""
    x = df.select("*", T.once(F.lower(F.col(title)).alias("_low_title")))
    title_hit = F.lit(False)
    for p in SKIP_TITLE_PATTERNS:
        title_hit = title_hit | F.col("_low_title").contains(p)
    return x.select(*df.columns, (~title_hit).alias("title_ok"))


def content_columns(df: DataFrame, content: str = "content") -> DataFrame:
    """Add long_enough, skip_count and legal_ratio."""
    x = df.select("*", T.once(F.lower(F.col(content)).alias("_low_content"),
                              F.length(T.strip(F.col(content))).alias("_stripped_len")))
    lc = F.col("_low_content")
    long_enough = F.col("_stripped_len") >= MIN_CONTENT_CHARS
    skip_count = sum((_present(lc, p) for p in SKIP_CONTENT_PATTERNS), F.lit(0))
    legal_len = sum((_present(lc, p) * len(p) for p in LEGAL_PATTERNS), F.lit(0))
    legal_ratio = F.try_divide(legal_len.cast("double"), F.length(F.col(content)).cast("double"))
    return x.select(
        *df.columns,
        long_enough.alias("long_enough"),
        skip_count.cast("int").alias("skip_count"),
        F.coalesce(legal_ratio, F.lit(0.0)).alias("legal_ratio"),
    )


def suitability_columns(df: DataFrame, title: str = "title", content: str = "content") -> DataFrame:
    """Add the rule columns: long_enough, title_ok, skip_count, legal_ratio,
    suitable and first_reason (null when suitable)."""
    x = content_columns(title_columns(df, title), content)
    reason = (
        F.when(~F.col("long_enough"), F.lit("length"))
        .when(~F.col("title_ok"), F.lit("title"))
        .when(F.col("skip_count") >= SKIP_CONTENT_LIMIT, F.lit("boilerplate"))
        .when(F.col("legal_ratio") > LEGAL_RATIO_LIMIT, F.lit("legal_ratio"))
    )
    return x.withColumn("first_reason", reason).withColumn("suitable", F.col("first_reason").isNull())


def suitable_chapters(chapters: DataFrame) -> DataFrame:
    """chapters that pass every rule (input columns only)."""
    return suitability_columns(chapters).where(F.col("suitable")).select(*chapters.columns)


def suitability_funnel(chapters: DataFrame) -> DataFrame:
    """chapters per first failing rule ('suitable' for the rest)."""
    s = suitability_columns(chapters)
    return s.groupBy(F.coalesce("first_reason", F.lit("suitable")).alias("reason")).agg(
        F.count(F.lit(1)).alias("chapters")
    )


def suitability_funnel_by_book(chapters: DataFrame) -> DataFrame:
    """F6 per book: chapters per book and first failing rule, with a row per
    book (null reason) and one for the corpus (null book and reason)."""
    s = suitability_columns(chapters).select(
        "book_id", F.coalesce("first_reason", F.lit("suitable")).alias("reason"))
    return s.rollup("book_id", "reason").agg(F.count(F.lit(1)).alias("chapters"))
