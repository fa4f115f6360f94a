"""A3 nested: books as documents in bounded parts."""

import pytest

from quire.operators import report as A

BOOKS = "book_id string, title string, author string"
CHAPTERS = "book_id string, chapter_number int, title string, content string, extra int"


def test_parts_of_a_large_book(spark):
    books = spark.createDataFrame([("big", "B", "x"), ("small", None, None), ("none", "N", "y")], BOOKS)
    rows = [("big", n, f"t{n}", "w " * n, 0) for n in range(1, 1001)] + [("small", 2, None, None, 0)]
    chapters = spark.createDataFrame(rows[::-1], CHAPTERS).repartition(7)
    got = {(r.book_id, r.part): r for r in A.book_documents(books, chapters, 64).collect()}
    assert set(got) == {("big", k) for k in range(1, 17)} | {("small", 1), ("none", 1)}
    for k in range(1, 17):
        r = got["big", k]
        numbers = list(range(64 * (k - 1) + 1, min(64 * k, 1000) + 1))
        assert [tuple(c) for c in r.chapters] == [(n, f"t{n}", n) for n in numbers]
        assert (r.parts, r.total_chapters, r.total_words, r.title) == (16, 1000, 500500, "B")
    small, none = got["small", 1], got["none", 1]
    assert small.total_chapters == 1 and [c.chapter_number for c in small.chapters] == [2]
    assert (none.parts, none.total_chapters, none.total_words, none.chapters) == (1, 0, 0, [])


def test_empty_tables_and_bad_numbers(spark):
    books = spark.createDataFrame([("b", "B", "x")], BOOKS)
    chapters = spark.createDataFrame([("b", None, "t", "w", 0)], CHAPTERS)
    assert A.book_documents(books.limit(0), chapters.limit(0)).count() == 0
    with pytest.raises(ValueError):
        A.book_documents(books, chapters, 0)
    with pytest.raises(Exception, match="without a number"):
        A.book_documents(books, chapters).collect()
