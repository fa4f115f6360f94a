"""Chapter segmentation.

Paged books
-----------
Four boundary strategies produce *skinny* boundary tables with one schema::

    book_id, strategy, priority, ordinal, title, start_page, end_page, file_name

A boundary covers the half-open page range ``[start_page, end_page)`` clipped
to the book's page count. The cascade (B8) decides, per book, which strategy
wins from the skinny tables and the set of pages that have text; the wide page
text is joined only once, for the winning boundaries.

Per-book windows (``row_number``/``lead``) run over outline entries, heading
candidates and heading lines of *one* paged book, which comes from a single
input record, so every such window group is bounded by one record.

Spine books
-----------
A spine book (B1) is keyed by its host and may own a large share of all items;
its chapters are numbered with ``number_once`` (no whole-book window, one evaluation
of the HTML).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import lines as L
from quire.operators.numbering import number_once

STRATEGIES = {"toc": 1, "font": 2, "pattern": 3, "chunks": 4}
BOUNDARY_COLS = ["book_id", "strategy", "priority", "ordinal", "title", "start_page", "end_page", "file_name"]


_once = T.once


def _fmt(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _with_strategy(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn("strategy", F.lit(name)).withColumn("priority", F.lit(STRATEGIES[name]))


# ---------------------------------------------------------------------------
# Page facts: one pass over the lines
# ---------------------------------------------------------------------------


def page_facts(lines: DataFrame) -> DataFrame:
    """One row per page: ``book_id, page_num, ptext, heads``.

    ``ptext`` is the cleaned page text (L5; null when no line survives the
    header/footer filter) and ``heads`` the page's heading lines (L8) as
    ``array<struct<line_no, rule, title>>`` in line order. Every line is
    cleaned and tested once; the page is the grouping unit, so the shuffle
    is spread over pages, not books."""
    lf = lines.select(
        "book_id", "page_num", "line_no",
        _once(T.clean_line(F.col("line")).alias("clean"), T.heading_rule(F.col("line")).alias("rule"),
              T.strip(F.col("line")).alias("title")),
    ).withColumn("kept", T.noise_rule(F.col("clean")).isNull())
    return lf.groupBy("book_id", "page_num").agg(
        F.expr("listagg(CASE WHEN kept THEN clean END, '\\n') WITHIN GROUP (ORDER BY line_no)").alias("ptext"),
        F.array_sort(F.collect_list(F.when(F.col("rule").isNotNull(), F.struct("line_no", "rule", "title")))).alias("heads"),
    )


def book_pages(pages: DataFrame) -> DataFrame:
    """Pages per book (``book_id, page_count``); blank pages count."""
    return pages.groupBy("book_id").agg((F.max("page_num") + 1).cast("long").alias("page_count"))


def with_next_text(pages: DataFrame) -> DataFrame:
    """``book_id, page_num, next_text``: first page at or after this one that
    has text (null when none). A range [s, e) has text iff next_text(s) < e.
    The window runs over the pages of one book (one input record)."""
    w = Window.partitionBy("book_id").orderBy(F.col("page_num").desc()).rowsBetween(Window.unboundedPreceding, 0)
    # Reduce the page to a flag first so that only skinny rows are shuffled
    # for the window.
    flags = pages.select("book_id", "page_num", F.col("ptext").isNotNull().alias("has_text"))
    nt = F.min(F.when(F.col("has_text"), F.col("page_num"))).over(w)
    return flags.select("book_id", "page_num", nt.alias("next_text"))


# ---------------------------------------------------------------------------
# Boundary strategies
#
# Boundaries leave ``end_page`` null when they run to the end of the book;
# ``finish`` fills it with the page count and formats the file names.
# ---------------------------------------------------------------------------

RAW_COLS = ["book_id", "strategy", "priority", "ordinal", "title", "start_page", "end_page"]


def toc_boundaries(toc: DataFrame) -> DataFrame:
    """B2: outline entries with level <= 2, in outline order; a boundary ends
    where the next kept entry starts, the last one at the end of the book.
    The ordinal counts every kept entry (numbers have gaps where text is
    empty)."""
    w = Window.partitionBy("book_id").orderBy("entry_no")
    # 0-based start; a page <= 0 is clamped to 0 (the reference would index
    # from the end of the book).
    start = F.greatest(F.col("page") - 1, F.lit(0)).cast("long")
    b = toc.where(F.col("level") <= 2).select(
        "book_id", "title", start.alias("start_page"),
        F.row_number().over(w).alias("ordinal"), F.lead(start).over(w).alias("end_page"),
    )
    return _with_strategy(b, "toc").select(*RAW_COLS)


def font_candidates(spans: DataFrame, max_pages: int = 10) -> DataFrame:
    """Stripped spans on the first ``max_pages`` pages, longer than 5
    characters and heading-like."""
    s = spans.where(F.col("page_num") < max_pages).select(
        "book_id", "page_num", "span_no", "font_size", _once(T.strip(F.col("text")).alias("text"))
    )
    return s.where((F.length("text") > 5) & T.heading_like(F.col("text")))


def modal_font_size(candidates: DataFrame) -> DataFrame:
    """Most frequent candidate size per book; ties go to the largest size."""
    counts = candidates.groupBy("book_id", "font_size").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("book_id").agg(
        F.max_by("font_size", F.struct("n", "font_size")).alias("heading_size")
    )


def font_boundaries(spans: DataFrame, max_pages: int = 10) -> DataFrame:
    """Sorted distinct pages having a candidate at least as large as the
    modal size minus one; title = first candidate on that page (among all
    candidates), else 'Chapter {i}'."""
    cands = font_candidates(spans, max_pages)
    per_page = cands.groupBy("book_id", "page_num").agg(
        F.min_by("text", "span_no").alias("first_text"), F.max("font_size").alias("max_size"))
    chosen = per_page.join(modal_font_size(cands), "book_id").where(
        F.col("max_size") >= F.col("heading_size") - 1)
    w = Window.partitionBy("book_id").orderBy("page_num")
    b = chosen.select(
        "book_id", F.col("page_num").alias("start_page"),
        F.row_number().over(w).alias("ordinal"), F.lead("page_num").over(w).alias("end_page"),
        "first_text",
    ).withColumn("title", F.coalesce("first_text", _fmt("Chapter ", F.col("ordinal").cast("string"))))
    return _with_strategy(b, "font").select(*RAW_COLS)


def heading_lines(pages: DataFrame) -> DataFrame:
    """Heading lines (``book_id, page_num, line_no, rule, title``)."""
    return pages.select("book_id", "page_num", F.explode("heads").alias("h")).select(
        "book_id", "page_num", "h.line_no", "h.rule", "h.title")


def pattern_boundaries(pages: DataFrame) -> DataFrame:
    """Every heading line starts a chapter that ends at the next heading's
    page; several headings on one page leave all but the last empty."""
    w = Window.partitionBy("book_id").orderBy("line_no")
    b = heading_lines(pages).select(
        "book_id", "title", F.col("page_num").alias("start_page"),
        F.row_number().over(w).alias("ordinal"), F.lead("page_num").over(w).alias("end_page"),
    )
    return _with_strategy(b, "pattern").select(*RAW_COLS)


def chunk_boundaries(book_pages_df: DataFrame, pages_per_chunk: int = 10) -> DataFrame:
    """B7 (before numbering): fixed chunks of ``pages_per_chunk`` pages. The
    ordinal is the chunk index; chapter numbers and 'Section {n}' titles are
    dense over the non-empty chunks and are set by ``resolve``."""
    n = pages_per_chunk
    b = book_pages_df.select(
        "book_id", "page_count",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("page_count") - 1, F.lit(n).cast("long"))).alias("start_page"),
    )
    b = b.select(
        "book_id", "start_page",
        (F.floor(F.col("start_page") / n) + 1).cast("int").alias("ordinal"),
        F.least(F.col("start_page") + n, F.col("page_count")).cast("long").alias("end_page"),
        F.lit(None).cast("string").alias("title"),
    )
    return _with_strategy(b, "chunks").select(*RAW_COLS)


def finish(raw: DataFrame, book_pages_df: DataFrame) -> DataFrame:
    """Close open-ended boundaries at the page count and add file names
    (T9)."""
    b = raw.join(book_pages_df, "book_id").withColumn(
        "end_page", F.coalesce("end_page", "page_count").cast("long"))
    s1, e = (F.col("start_page") + 1).cast("string"), F.col("end_page").cast("string")
    name = (
        F.when(F.col("strategy") == "toc", _fmt("page_", s1, "_to_", e, ".pdf"))
        .when(F.col("strategy") == "chunks", _fmt("pages_", s1, "_to_", e, ".pdf"))
        .otherwise(_fmt("chapter_", F.col("ordinal").cast("string"), ".pdf"))
    )
    return b.withColumn("file_name", name)


def all_boundaries(pages: DataFrame, toc: DataFrame, spans: DataFrame, book_pages_df: DataFrame,
                   pages_per_chunk: int = 10) -> DataFrame:
    raw = (
        toc_boundaries(toc).unionByName(font_boundaries(spans)).unionByName(pattern_boundaries(pages))
        .unionByName(chunk_boundaries(book_pages_df, pages_per_chunk))
    )
    return finish(raw, book_pages_df)


# ---------------------------------------------------------------------------
# Emptiness, the cascade (B8) and text assembly
# ---------------------------------------------------------------------------


def mark_text(boundaries: DataFrame, pages: DataFrame) -> DataFrame:
    """Add ``has_text``: the range [start, min(end, page_count)) holds a page
    with text. One equi-join on the start page, no range join."""
    nt = with_next_text(pages).withColumnRenamed("page_num", "start_page")
    b = boundaries.join(nt, ["book_id", "start_page"], "left")
    hi = F.least(F.col("end_page"), F.col("page_count"))
    return b.withColumn("has_text", F.coalesce(F.col("next_text") < hi, F.lit(False))).drop("next_text")


def resolve(boundaries: DataFrame, pages: DataFrame) -> DataFrame:
    """Per book the first strategy (by priority) with a non-empty
    boundary wins; its non-empty boundaries become the chapters.
    ``chapter_number`` is the ordinal, dense for chunks (which also get their
    'Section {n}' titles). The windows run over one book's boundaries."""
    ne = mark_text(boundaries, pages).where("has_text")
    best = F.min("priority").over(Window.partitionBy("book_id"))
    won = ne.withColumn("_best", best).where(F.col("priority") == F.col("_best")).drop("_best")
    dense = F.row_number().over(Window.partitionBy("book_id").orderBy("start_page"))
    is_chunk = F.col("strategy") == "chunks"
    won = won.withColumn("chapter_number", F.when(is_chunk, dense).otherwise(F.col("ordinal")).cast("int"))
    return won.withColumn(
        "title", F.when(is_chunk, _fmt("Section ", F.col("chapter_number").cast("string"))).otherwise(F.col("title"))
    )


def assemble(boundaries: DataFrame, pages: DataFrame, keep_empty: bool = False) -> DataFrame:
    """Text of each boundary: its pages with text, in page order,
    joined by a blank line. Ranges are expanded to pages and equi-joined on
    ``(book_id, page_num)``, so the join is spread over pages."""
    b = boundaries.withColumn("_hi", F.least(F.col("end_page"), F.col("page_count")))
    b = b.withColumn("page_num", F.explode_outer(
        F.when(F.col("start_page") < F.col("_hi"), F.sequence(F.col("start_page"), F.col("_hi") - 1))))
    txt = pages.where(F.col("ptext").isNotNull()).select("book_id", "page_num", "ptext")
    j = b.join(txt, ["book_id", "page_num"], "left" if keep_empty else "inner")
    keys = [c for c in boundaries.columns]
    out = j.groupBy(*keys).agg(
        F.expr("listagg(ptext, '\\n\\n') WITHIN GROUP (ORDER BY page_num)").alias("content"))
    return out.withColumn("content", F.coalesce("content", F.lit("")))


def range_words(boundaries: DataFrame, pages: DataFrame) -> DataFrame:
    """``book_id, chapter_number, words`` of each boundary: pages are joined
    by blank lines, so their word counts add up and no text is moved. A running sum over
    the pages of a book turns the words of a range into the difference of two rows, found
    by two equi-joins; ranges are not expanded to pages, however much they overlap."""
    counts = pages.select("book_id", "page_num", F.when(F.col("ptext").isNotNull(), T.word_count(F.col("ptext"))).otherwise(0).cast("long").alias("w"))
    upto = F.sum("w").over(Window.partitionBy("book_id").orderBy("page_num"))
    sums = counts.select("book_id", "page_num", upto.alias("upto"), (upto - F.col("w")).alias("before"))
    first = sums.select("book_id", F.col("page_num").alias("start_page"), "before")
    last = sums.select("book_id", F.col("page_num").alias("_last"), "upto")
    b = boundaries.select("book_id", "chapter_number", "start_page", (F.least("end_page", "page_count") - 1).alias("_last"))
    # Pages of a book are numbered without gaps, so both ends of a range exist.
    return b.where(F.col("start_page") <= F.col("_last")).join(first, ["book_id", "start_page"]).join(last, ["book_id", "_last"]).select(
        "book_id", "chapter_number", (F.col("upto") - F.col("before")).alias("words"))


def chapter_rows(assembled: DataFrame) -> DataFrame:
    return assembled.select("book_id", "strategy", F.col("chapter_number").cast("int").alias("chapter_number"),
                            "title", "content", "file_name", "start_page", "end_page")


def strategy_chapters(raw: DataFrame, pages: DataFrame, book_pages_df: DataFrame) -> DataFrame:
    """Chapters one strategy alone would produce (its non-empty boundaries,
    numbered by ordinal)."""
    b = mark_text(finish(raw, book_pages_df), pages).where("has_text").drop("has_text")
    t = assemble(b, pages)
    return t.select("book_id", F.col("ordinal").cast("int").alias("chapter_number"), "title", "content", "file_name")


def cap_chapters(chapters: DataFrame, limit: int | None) -> DataFrame:
    """First ``limit`` chapters of each book by chapter order (numbers
    may have gaps, so rank instead of comparing numbers). 0/None = no cap.
    ``row_number() <= k`` is planned as a window group limit, which trims
    every partition to k rows per book before the shuffle."""
    if limit is None or limit == 0:
        return chapters
    if limit < 0:
        raise ValueError("chapter cap must be >= 0")
    rn = F.row_number().over(Window.partitionBy("book_id").orderBy("chapter_number"))
    return chapters.withColumn("_rn", rn).where(F.col("_rn") <= limit).drop("_rn")


# ---------------------------------------------------------------------------
# Spine books
# ---------------------------------------------------------------------------


def spine_documents(items: DataFrame) -> DataFrame:
    """Document items reduced to text and title parts before any shuffle
    (HTML is far wider than its text); blank documents dropped."""
    docs = items.where(F.col("item_type") == "document").select(
        "book_id", "item_id", "file_name",
        _once(T.html_parts(F.col("html")).alias("parts")),
    )
    return docs.select("book_id", "item_id", "file_name", F.col("parts.text").alias("content"), F.col("parts.title").alias("t")).where(
        F.col("content") != "")


def spine_chapters(spine: DataFrame, items: DataFrame) -> DataFrame:
    """B1: spine entries joined to their items (J1), documents only, blank
    ones dropped, numbered densely in spine order; title cascade T2."""
    j = spine.join(spine_documents(items), ["book_id", "item_id"])
    numbered = number_once(j, ["book_id"], "spine_pos", name="chapter_number")
    title = F.coalesce(F.col("t.title"), _fmt("Chapter ", F.col("chapter_number").cast("string")))
    return numbered.select(
        "book_id", "chapter_number", title.alias("title"), "content", "file_name",
        F.when((F.col("t.source") == "title") & (F.col("t.title") == ""), F.lit("title_blank"))
        .otherwise(F.coalesce(F.col("t.source"), F.lit("fallback"))).alias("title_from"),
    )


def spine_dangling(spine: DataFrame, items: DataFrame) -> DataFrame:
    """Spine entries whose item does not exist."""
    return spine.join(items.select("book_id", "item_id"), ["book_id", "item_id"], "left_anti")
