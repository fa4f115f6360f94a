"""Totals, summaries, previews and corpus checks.

Per-book totals are plain aggregates (partial aggregation before the
shuffle), so a book holding a large share of the rows costs one partial row
per task. Top-k previews use ``row_number() <= k``, which Spark plans as a
window group limit applied before the shuffle as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import text as T


def _words(chapters: DataFrame) -> DataFrame:
    if "words" in chapters.columns:
        return chapters
    return chapters.withColumn("words", T.word_count(F.col("content")))


def book_totals(books: DataFrame, chapters: DataFrame) -> DataFrame:
    """A1: chapters and words per book; 0 for a book without chapters."""
    agg = _words(chapters).groupBy("book_id").agg(
        F.count(F.lit(1)).alias("chapters"), F.sum("words").cast("long").alias("words")
    )
    return books.select("book_id").join(agg, "book_id", "left").select(
        "book_id", F.coalesce("chapters", F.lit(0)).cast("long").alias("chapters"),
        F.coalesce("words", F.lit(0)).cast("long").alias("words"),
    )


def corpus_summary(books: DataFrame, chapters: DataFrame) -> DataFrame:
    """A2: totals over the corpus (one row)."""
    t = book_totals(books, chapters)
    return t.agg(
        F.count(F.lit(1)).alias("total_books"),
        F.coalesce(F.sum("chapters"), F.lit(0)).cast("long").alias("total_chapters"),
        F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("total_words"),
    )


def book_summary(books: DataFrame, chapters: DataFrame) -> DataFrame:
    """A3: per-book summary rows."""
    return books.select("book_id", "title", "author").join(book_totals(books, chapters), "book_id")


def book_documents(books: DataFrame, chapters: DataFrame, per_part: int = 256) -> DataFrame:
    """A3, nested: books as documents with their totals and ``chapters``, an array of
    (chapter_number, title, words) in order. A book comes in parts of ``per_part``
    consecutive chapter numbers, so that no row grows with a book: part k holds the numbers
    after (k - 1) * per_part, ``parts`` is the book's number of rows. A book without chapters is
    one row (part 1) with an empty array. Chapter numbers have to be unique within a book, as
    numbering makes them (``numbering_audit`` tells); a part without any is no row, and a null
    number is an error."""
    if per_part < 1:
        raise ValueError("a part holds one chapter at least")
    number = F.coalesce("chapter_number", F.raise_error(F.lit("a chapter without a number")).cast("int"))
    ch = _words(chapters).select(
        "book_id", (F.floor((number - 1) / per_part) + 1).cast("long").alias("part"),
        F.struct(number.alias("chapter_number"), F.col("title"), F.col("words").cast("long").alias("words")).alias("chapter"))
    nested = ch.groupBy("book_id", "part").agg(F.array_sort(F.collect_list("chapter")).alias("chapters"))
    totals = ch.groupBy("book_id", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("chapter.words").alias("words")).groupBy("book_id").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("n").alias("total_chapters"), F.sum("words").alias("total_words"))
    none = {"total_chapters": 0, "total_words": 0, "part": 1, "parts": 1}
    x = books.select("book_id", "title", "author").join(totals, "book_id", "left").join(nested, "book_id", "left")
    return x.select("book_id", "title", "author", *[F.coalesce(k, F.lit(v).cast("long")).alias(k) for k, v in none.items()],
                    F.coalesce("chapters", F.array().cast(nested.schema["chapters"].dataType)).alias("chapters"))


def cards_per_book(books: DataFrame, cards: DataFrame) -> DataFrame:
    """Cards per book, 0 for books without cards."""
    n = cards.groupBy("book_id").agg(F.count(F.lit(1)).alias("flashcards"))
    return books.select("book_id").join(n, "book_id", "left").select(
        "book_id", F.coalesce("flashcards", F.lit(0)).cast("long").alias("flashcards")
    )


def books_without_cards(books: DataFrame, cards: DataFrame) -> DataFrame:
    """Books that get no export file (they stay in the summary)."""
    # Distinct ids are reduced map-side, so a book with very many cards
    # sends one key per task into the shuffle.
    return books.join(cards.select("book_id").distinct(), "book_id", "left_anti")


def generation_summary(books: DataFrame, chapters: DataFrame, cards: DataFrame) -> DataFrame:
    """A4: total books, chapters, cards and average cards per book (0 when
    there are no books; books without cards count in the denominator)."""
    t = book_totals(books, chapters).join(cards_per_book(books, cards), "book_id")
    s = t.agg(
        F.count(F.lit(1)).alias("total_books"),
        F.coalesce(F.sum("chapters"), F.lit(0)).cast("long").alias("total_chapters"),
        F.coalesce(F.sum("flashcards"), F.lit(0)).cast("long").alias("total_flashcards"),
    )
    return s.withColumn(
        "average_flashcards_per_book",
        F.coalesce(F.try_divide(F.col("total_flashcards").cast("double"), F.col("total_books").cast("double")), F.lit(0.0)),
    )


def avg_words_per_chapter(chapters: DataFrame) -> DataFrame:
    """Chapters, words and average words per chapter."""
    s = _words(chapters).agg(F.count(F.lit(1)).alias("chapters"), F.sum("words").cast("long").alias("words"))
    return s.withColumn(
        "avg_words", F.coalesce(F.try_divide(F.col("words").cast("double"), F.col("chapters").cast("double")), F.lit(0.0))
    )


def summary_rollup(chapters: DataFrame) -> DataFrame:
    """Per-book and corpus totals in one pass (``rollup``)."""
    return _words(chapters).rollup("book_id").agg(
        F.grouping("book_id").cast("int").alias("is_total"),
        F.count(F.lit(1)).alias("chapters"),
        F.sum("words").cast("long").alias("words"),
    )


def run_accounting(files: DataFrame) -> DataFrame:
    """Discovered, processed and skipped files; a file is skipped
    when its format is unsupported or it fails to parse (per-file fault
    isolation becomes a reason column, not an exception)."""
    f = files.withColumn("format", book_format(F.col("path")))
    unsupported = F.col("format") == "unsupported"
    return f.agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(~unsupported & F.col("parse_ok")).alias("processed"),
        F.count_if(unsupported | ~F.col("parse_ok")).alias("skipped"),
        F.count_if(unsupported).alias("unsupported"),
        F.count_if(~unsupported & ~F.col("parse_ok")).alias("failed"),
    )


def book_format(path) -> F.Column:
    """S3: format by lower-cased suffix: epub, pdf, else unsupported."""
    suf = F.lower(T.file_suffix(path))
    return F.when(suf == ".epub", F.lit("epub")).when(suf == ".pdf", F.lit("pdf")).otherwise(F.lit("unsupported"))


def format_dispatch(files: DataFrame) -> DataFrame:
    """S3 as a table: file, suffix and format."""
    return files.select("file_no", "path", T.file_suffix(F.col("path")).alias("suffix"),
                        book_format(F.col("path")).alias("format"))


def display_fields(totals: DataFrame, fmt: str = "json") -> DataFrame:
    """Display strings (thousands separators, upper-cased format)."""
    return totals.select(
        "book_id", T.thousands(F.col("words")).alias("words_display"),
        T.thousands(F.col("chapters")).alias("chapters_display"), F.upper(F.lit(fmt)).alias("format_display"),
    )


def chapter_preview(chapters: DataFrame, k: int = 3) -> DataFrame:
    """First ``k`` chapters of each book with word counts and how many
    more there are."""
    w = Window.partitionBy("book_id").orderBy("chapter_number")
    top = chapters.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    totals = chapters.groupBy("book_id").agg(F.count(F.lit(1)).alias("n"))
    return top.join(totals, "book_id").select(
        "book_id", "rank", "chapter_number", "title", T.word_count(F.col("content")).alias("words"),
        F.greatest(F.col("n") - k, F.lit(0)).alias("more"),
    )


def numbering_audit(chapters: DataFrame) -> DataFrame:
    """Chapter numbers should run 1..n; gaps = max - count."""
    a = chapters.groupBy("book_id").agg(
        F.count(F.lit(1)).alias("chapters"), F.min("chapter_number").cast("long").alias("first_number"),
        F.max("chapter_number").cast("long").alias("last_number"),
    )
    return a.withColumn("gaps", F.col("last_number") - F.col("chapters")).withColumn(
        "dense", (F.col("first_number") == 1) & (F.col("gaps") == 0)
    )


def latest_by_title(books: DataFrame) -> DataFrame:
    """Results keyed by title keep the book discovered last."""
    return books.groupBy("title").agg(
        F.max_by("book_id", "discovery_no").alias("book_id"), F.count(F.lit(1)).alias("books_with_title")
    )


def merge_latest(state: DataFrame | None, books: DataFrame) -> DataFrame:
    """R6 across runs: per title the book discovered last, of those known so far and
    those of a run (``title, book_id, discovery_no``). The larger book id wins among equal
    discovery numbers and a null number is the earliest, so the runs may come in any order
    or twice. Books without a title share one row, as in one run."""
    cols = ["title", "book_id", "discovery_no"]
    both = books.select(*cols) if state is None else state.select(*cols).unionByName(books.select(*cols))
    best = both.groupBy("title").agg(F.max(F.struct("discovery_no", "book_id")).alias("_best"))
    return best.select("title", "_best.book_id", "_best.discovery_no")


def name_collisions(books: DataFrame) -> DataFrame:
    """Export file names shared by several books."""
    return (
        books.withColumn("file_stem", T.safe_filename(F.col("title")))
        .groupBy("file_stem")
        .agg(F.count(F.lit(1)).alias("books"), F.min("book_id").alias("first_book"),
             F.max("book_id").alias("last_book"))
        .where(F.col("books") > 1)
    )
