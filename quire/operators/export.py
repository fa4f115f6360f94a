"""Card exports (K1-K6).

Each export is rendered as text rows by built-in string functions and
written by Spark's text writer, one folder per export file name
(``partitionBy('file_stem')``). Rows are range-partitioned and sorted by
``(file_stem, card order)``, so the part files of a folder, taken in name
order, hold the document in order, and no book -- however many cards it
has -- is gathered into one task or one row.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.sources import versions as V

log = logging.getLogger(__name__)

DEFAULT_RUN_TS = "1970-01-01T00:00:00"
CARD_ORDER = ("reply_id", "card_no")
FORMATS = ("json", "csv", "anki")

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

CSV_HEADER = "front,back,card_type,source,difficulty,tags"
CSV_LINE_END = "\r\n"


def json_string(col) -> Column:
    """JSON literal of a string (quotes and escapes), 'null' for null;
    non-ASCII characters stay as they are."""
    return F.regexp_extract(F.to_json(F.array(col)), r"(?s)^\[(.*)\]$", 1)


def _lit(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def export_books(books: DataFrame, cards: DataFrame) -> DataFrame:
    """Books that get an export file: books with cards (K6); when several
    share a file name the one discovered last wins, as in the reference
    where it overwrites the earlier file (R7). A book without a title is
    exported under the unknown title (T3)."""
    titled = books.withColumn("title", F.coalesce("title", F.lit("Unknown Title")))
    has_cards = titled.join(cards.select("book_id").distinct(), "book_id", "left_semi")
    named = has_cards.withColumn("file_stem", T.safe_filename(F.col("title")))
    winner = named.groupBy("file_stem").agg(F.max_by("book_id", "discovery_no").alias("book_id"))
    return named.join(winner, ["file_stem", "book_id"], "left_semi")


def _card_rows(books: DataFrame, cards: DataFrame) -> DataFrame:
    b = export_books(books, cards).select("book_id", "file_stem", F.col("title").alias("book_title"),
                                          F.col("author").alias("book_author"))
    return cards.join(b, "book_id")


def render_json(books: DataFrame, chapters: DataFrame, cards: DataFrame, run_ts: str = DEFAULT_RUN_TS,
                order=CARD_ORDER) -> DataFrame:
    """K1: JSON document per book, as blocks ``(book_id, file_stem, part,
    <order>, block)``: part 0 = header, 1 = one card, 2 = footer. Concatenated
    with newlines in ``(part, order)`` order they give the document written
    by ``json.dump(indent=2, ensure_ascii=False)``."""
    # Replies may share an id. Cards are told apart by their content, and equal ones
    # are counted, so that exactly one card of a book is its last.
    rows = _card_rows(books, cards)
    content = F.xxhash64("front", "back", "card_type", "source", "difficulty", "tags")
    rows = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_copies")).withColumn("_tie", content)
    place = F.struct(*order, "_tie")
    # One per-book aggregate gives the header fields and the last card.
    stats = rows.groupBy("book_id", "file_stem", "book_title", "book_author").agg(
        F.sum("_copies").alias("total_flashcards"), F.max(place).alias("_last"))
    n_chapters = chapters.groupBy("book_id").agg(F.count(F.lit(1)).alias("total_chapters"))
    tags = F.when(F.size("tags") == 0, F.lit("[]")).otherwise(
        _lit("[\n", F.array_join(F.transform("tags", lambda t: _lit("        ", json_string(t))), ",\n"), "\n      ]"))
    is_last = place.eqNullSafe(F.col("_last")) & (F.col("_copy") == F.col("_copies"))
    card_block = _lit(
        "    {\n",
        '      "front": ', json_string(F.col("front")), ",\n",
        '      "back": ', json_string(F.col("back")), ",\n",
        '      "card_type": ', json_string(F.col("card_type")), ",\n",
        '      "source": ', json_string(F.col("source")), ",\n",
        '      "difficulty": ', F.coalesce(F.col("difficulty").cast("string"), F.lit("null")), ",\n",
        '      "tags": ', tags, "\n",
        "    }", F.when(is_last, F.lit("")).otherwise(F.lit(",")),
    )
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy")
    body = rows.join(stats.select("book_id", "_last"), "book_id").select("*", copies).select(
        "book_id", "file_stem", F.lit(1).alias("part"), *order, card_block.alias("block"))
    heads = stats.join(n_chapters, "book_id", "left")
    header = _lit(
        "{\n",
        '  "metadata": {\n',
        '    "book_title": ', json_string(F.col("book_title")), ",\n",
        '    "book_author": ', json_string(F.col("book_author")), ",\n",
        '    "generated_at": ', json_string(F.lit(run_ts)), ",\n",
        '    "total_flashcards": ', F.col("total_flashcards").cast("string"), ",\n",
        '    "total_chapters": ', F.coalesce(F.col("total_chapters"), F.lit(0)).cast("string"), "\n",
        "  },\n",
        '  "flashcards": [',
    )
    nulls = [F.lit(None).cast(body.schema[c].dataType).alias(c) for c in order]
    # Header and footer rows of a book come from one pass over its stats row.
    ends = F.inline(F.array(F.struct(F.lit(0).alias("part"), header.alias("block")),
                            F.struct(F.lit(2).alias("part"), F.lit("  ]\n}").alias("block"))))
    edge_rows = heads.select("book_id", "file_stem", ends).select("book_id", "file_stem", "part", *nulls, "block")
    return edge_rows.unionByName(body)


def csv_field(col) -> Column:
    """Python csv (QUOTE_MINIMAL): quote a field holding a comma, a quote or
    a line break, doubling quotes; null -> ''."""
    c = F.coalesce(col, F.lit(""))
    return F.when(c.rlike('[,"\r\n]'), _lit('"', F.replace(c, F.lit('"'), F.lit('""')), '"')).otherwise(c)


def render_csv(books: DataFrame, cards: DataFrame, order=CARD_ORDER) -> DataFrame:
    """K2: CSV lines ``(book_id, file_stem, part, <order>, line)``: part 0 is
    the header, part 1 one line per card."""
    rows = _card_rows(books, cards)
    line = F.concat_ws(
        ",", csv_field(F.col("front")), csv_field(F.col("back")), csv_field(F.col("card_type")),
        csv_field(F.col("source")), csv_field(F.col("difficulty").cast("string")),
        csv_field(F.array_join("tags", ",")),
    )
    body = rows.select("book_id", "file_stem", F.lit(1).alias("part"), *order, line.alias("line"))
    nulls = [F.lit(None).cast(body.schema[c].dataType).alias(c) for c in order]
    head = rows.select("book_id", "file_stem").distinct().select(
        "book_id", "file_stem", F.lit(0).alias("part"), *nulls, F.lit(CSV_HEADER).alias("line"))
    return head.unionByName(body)


def render_deck(books: DataFrame, cards: DataFrame, order=CARD_ORDER, escape: bool = False) -> DataFrame:
    """K3: tab-separated deck lines ``front TAB back TAB tags``; tags = the
    card's tags, then Source:, Difficulty: (Unknown for null or 0), Type:,
    Book:, joined by spaces. With ``escape`` tabs and line breaks inside
    fields become spaces (the reference writes them raw)."""
    rows = _card_rows(books, cards)
    d = F.col("difficulty")
    extra = F.array(
        _lit("Source:", F.col("source")),
        F.when(d.isNull() | (d == 0), F.lit("Difficulty:Unknown")).otherwise(_lit("Difficulty:", d.cast("string"))),
        _lit("Type:", F.col("card_type")),
        _lit("Book:", F.col("book_title")),
    )
    tag_string = F.array_join(F.concat(F.col("tags"), extra), " ")

    def esc(c: Column) -> Column:
        return F.regexp_replace(c, "[\t\r\n]", " ") if escape else c

    line = F.concat_ws("\t", esc(F.col("front")), esc(F.col("back")), esc(tag_string))
    return rows.select("book_id", "file_stem", F.lit(1).alias("part"), *order, line.alias("line"))


def write_cards(books: DataFrame, chapters: DataFrame, cards: DataFrame, path: str, fmt: str = "json",
                run_ts: str = DEFAULT_RUN_TS, order=CARD_ORDER, escape: bool = False) -> str:
    """K4: write every book's cards in one format (json / csv / anki, any
    case; anything else falls back to json) under ``path/format``. Files of other
    formats and of books that are not written again stay. Returns the format."""
    f = (fmt or "").lower()
    if f not in FORMATS:
        log.warning("unknown card format %r, writing json", fmt)
        f = "json"
    if f == "json":
        rows = render_json(books, chapters, cards, run_ts, order).withColumnRenamed("block", "line")
    elif f == "csv":
        # CRLF line ends: the text writer ends every row with '\n'.
        rows = render_csv(books, cards, order)
        rows = rows.withColumn("line", F.concat("line", F.lit(CSV_LINE_END[:-1])))
    else:
        rows = render_deck(books, cards, order, escape)
    keys = ["file_stem", "part", *order]
    # Of cards in one place, the one without a comma comes last.
    ends = [F.desc(F.col("line").endswith(","))] if f == "json" else ["line"]
    (
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys, *ends)
        .select("file_stem", F.col("line").alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("file_stem")
        .text(f"{path.rstrip('/')}/{f}")
    )
    return f


@dataclass
class Published:
    """A published export: its format, folder, ``manifest(file_stem, book_id, cards)`` and
    ``removed``, the same rows of the export before for files that this one has no more."""

    fmt: str
    folder: str
    manifest: DataFrame
    removed: DataFrame


def _manifests(path: str, fmt: str) -> str:
    return f"{path.rstrip('/')}/manifests/{fmt}"


def publish_cards(books: DataFrame, chapters: DataFrame, cards: DataFrame, path: str, fmt: str = "json",
                  run_ts: str = DEFAULT_RUN_TS, order=CARD_ORDER, escape: bool = False) -> Published:
    """K4 + K6 in two phases: the files go to a new folder, then a manifest is written that names
    it. Readers follow the last complete manifest (``published``), so a run that fails changes
    nothing for them, and a book that lost its cards has no file in the new export. Each
    format is published by itself, by one job at a time. Costs of publishing do not grow with
    the number of files: nothing is moved."""
    spark = books.sparkSession
    root = path.rstrip("/")
    run = V.next_number(spark, f"{root}/files", "run")
    folder = f"{root}/files/run={run}"
    fmt = write_cards(books, chapters, cards, folder, fmt, run_ts, order, escape)
    last = published(spark, path, fmt)
    rows = _card_rows(books, cards).groupBy("file_stem", "book_id").agg(F.count(F.lit(1)).alias("cards"))
    V.write_next(rows.withColumn("folder", F.lit(f"{folder}/{fmt}")), _manifests(path, fmt))
    manifest = published(spark, path, fmt).drop("folder")
    before = manifest.limit(0) if last is None else last.drop("folder")
    return Published(fmt, f"{folder}/{fmt}", manifest, before.join(manifest.select("file_stem"), "file_stem", "left_anti"))


def published(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame | None:
    """The manifest of the current export with the ``folder`` of its files; None before the first."""
    return V.read_latest(spark, _manifests(path, fmt))


def write_summary(summary: DataFrame, per_book: DataFrame, path: str, run_id: str, run_ts: str = DEFAULT_RUN_TS) -> None:
    """K5: generation summary (with the time of the run as ``generated_at``) and per-book
    rows as JSON under ``run_id=``."""
    summary.withColumn("generated_at", F.lit(run_ts)).write.mode("overwrite").json(f"{path.rstrip('/')}/run_id={run_id}/summary")
    per_book.write.mode("overwrite").json(f"{path.rstrip('/')}/run_id={run_id}/books")
