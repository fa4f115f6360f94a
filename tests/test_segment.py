"""Boundary strategies, cascade and spine chapters (B1-B10) on literal books
(FIXTURES.md section C) and the known-good counts of section D."""

from pyspark.sql import functions as F

from conftest import SF_CHECK
from quire.operators import segment as S
from quire.plans.queries import Corpus

LINES = "book_id long, line_no long, page_num long, line string"


def book_lines(spark, pages):
    """pages: list of lists of lines -> lines DataFrame of book 1."""
    rows, n = [], 0
    for p, page in enumerate(pages):
        for line in page:
            rows.append((1, n, p, line))
            n += 1
    return spark.createDataFrame(rows, LINES)


def text_page(i):
    return [f"plain text on page {i} here"]


def test_toc_numbers_have_gaps(spark):
    lines = book_lines(spark, [text_page(i) for i in range(5)])
    toc = spark.createDataFrame([(1, 0, 1, "A", 1), (1, 1, 1, "B", 3), (1, 2, 1, "C", 3)],
                                "book_id long, entry_no long, level int, title string, page long")
    pages = S.page_facts(lines)
    got = S.strategy_chapters(S.toc_boundaries(toc), pages, S.book_pages(pages)).orderBy("chapter_number").collect()
    assert [(r.chapter_number, r.title, r.file_name) for r in got] == [
        (1, "A", "page_1_to_2.pdf"), (3, "C", "page_3_to_5.pdf")]
    assert got[1].content == "plain text on page 2 here\n\nplain text on page 3 here\n\nplain text on page 4 here"


def test_modal_size_ties_to_largest(spark):
    spans = spark.createDataFrame(
        [(1, 0, i, t, s) for i, (t, s) in enumerate(
            [("Chapter One", 18.0), ("Chapter Two", 18.0), ("Section One", 16.0), ("Section Two", 16.0)])],
        "book_id long, page_num long, span_no long, text string, font_size double")
    assert S.modal_font_size(S.font_candidates(spans)).collect()[0].heading_size == 18.0


def test_pattern_two_headings_on_one_page(spark):
    lines = book_lines(spark, [["Chapter 1", "Chapter 2", "some text here"], text_page(1)])
    pages = S.page_facts(lines)
    got = S.strategy_chapters(S.pattern_boundaries(pages), pages, S.book_pages(pages)).collect()
    assert [(r.chapter_number, r.title) for r in got] == [(2, "Chapter 2")]


def test_chunks_dense_numbering(spark):
    pages_txt = [text_page(i) if not 10 <= i < 20 else ["x"] for i in range(25)]
    lines = book_lines(spark, pages_txt)
    pages = S.page_facts(lines)
    bp = S.book_pages(pages)
    r = S.resolve(S.finish(S.chunk_boundaries(bp), bp), pages)
    got = S.assemble(r, pages).orderBy("chapter_number").collect()
    assert [(r.chapter_number, r.title, r.file_name) for r in got] == [
        (1, "Section 1", "pages_1_to_10.pdf"), (2, "Section 2", "pages_21_to_25.pdf")]


def test_cap(spark):
    ch = spark.createDataFrame([(1, 1), (1, 3), (1, 4)], "book_id long, chapter_number int")
    assert [r.chapter_number for r in S.cap_chapters(ch, 2).orderBy("chapter_number").collect()] == [1, 3]
    assert S.cap_chapters(ch, 0).count() == 3


def test_known_counts_sf001(spark):
    c = Corpus(spark, SF_CHECK)
    usage = {r.strategy: (r.books, r.chapters) for r in c.resolved.groupBy("strategy").agg(
        F.countDistinct("book_id").alias("books"), F.count("*").alias("chapters")).collect()}
    assert usage == {"pattern": (500, 1122), "font": (200, 258), "chunks": (199, 202), "toc": (100, 214)}
    from quire.functions.text import word_count
    assert c.resolved.agg(F.sum(word_count("content"))).collect()[0][0] == 299554
    gaps = (c.resolved.groupBy("book_id", "strategy").agg((F.max("chapter_number") - F.count("*")).alias("g"))
            .where("g > 0").groupBy("strategy").count().collect())
    assert {r.strategy: r["count"] for r in gaps} == {"pattern": 147, "toc": 39}


def test_spine_counts_sf001(spark):
    c = Corpus(spark, SF_CHECK)
    sc = c.spine_chapters
    assert sc.count() == 180
    assert sc.select("book_id").distinct().count() == 57
    assert S.spine_dangling(c.spine, c.items).count() == 23
    src = {r.title_from: r["count"] for r in sc.groupBy("title_from").count().collect()}
    assert src == {"title": 28, "title_blank": 30, "h1": 30, "h2": 31, "h3": 32, "fallback": 29}
    # numbers run 1..n in every book
    bad = sc.groupBy("book_id").agg((F.max("chapter_number") - F.count("*")).alias("g")).where("g <> 0")
    assert bad.count() == 0
