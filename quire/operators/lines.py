"""Line and page operators of the paged format.

Input ``lines``: ``book_id, line_no, page_num, line`` -- one row per raw text
line, ``line_no`` ordering the lines of a book. A paged book comes from one
input record, so the per-book groups here are bounded by one record's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import text as T


def page_lines(pages: DataFrame, text_col: str = "text") -> DataFrame:
    """L1: split page text into numbered lines (``book_id, page_num, line_no,
    line``); ``line_no`` restarts on every page."""
    return pages.select(
        "book_id", "page_num", F.posexplode(F.split(text_col, "\n", -1)).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no").cast("long"))


def cleaned_lines(lines: DataFrame) -> DataFrame:
    """L2 + L3: cleaned text of every line and the first noise rule it fails
    (null when the line is kept)."""
    # The cleaned text is produced by a generator so that filters on it are
    # not pushed below it (which would re-run the cleaning regexes per test).
    clean = F.inline(F.array(F.struct(T.clean_line(F.col("line")).alias("clean"))))
    return lines.select("book_id", "page_num", "line_no", clean).withColumn(
        "noise_rule", T.noise_rule(F.col("clean"))
    )


def kept_lines(lines: DataFrame) -> DataFrame:
    """Lines that survive the header/footer filter."""
    return cleaned_lines(lines).where(F.col("noise_rule").isNull()).drop("noise_rule")


def noise_profile(lines: DataFrame) -> DataFrame:
    """L4: lines dropped per rule per book (first failing rule counts)."""
    c = cleaned_lines(lines)
    r = F.col("noise_rule")
    return c.groupBy("book_id").agg(
        F.count("*").alias("lines"),
        F.count_if(r.isNull()).alias("kept"),
        F.count_if(r == "short").alias("short"),
        F.count_if(r == "digits").alias("digits"),
        F.count_if(r == "page_number").alias("page_number"),
        F.count_if(r == "digit_like").alias("digit_like"),
    )


def page_text(pages: DataFrame) -> DataFrame:
    """Cleaned text of each page with at least one kept line (kept lines
    joined by newline in line order). ``pages`` is ``segment.page_facts``."""
    return pages.where(F.col("ptext").isNotNull()).select("book_id", "page_num", "ptext")
