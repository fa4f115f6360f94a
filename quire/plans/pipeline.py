"""End-to-end batch job: book tables in, cards, exports, summaries and rejects out.

Stages write their results as tables (parquet) under a shared work folder;
later stages read those tables back. Writing cuts the lineage, so a lost
executor only re-runs the current stage, and each table can be inspected or
reused. The work folder defaults to ``spark.checkpoint.dir`` (a shared
folder on a cluster); a machine-local folder is only used when that setting
is unset (tests).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators import cards as C
from quire.operators import export as K
from quire.operators import rejects as RJ
from quire.operators import report as A
from quire.operators import segment as S
from quire.session import ensure_checkpoint_dir


@dataclass
class PagedInputs:
    """Paged books: ``lines(book_id, line_no, page_num, line)``, outline
    ``toc(book_id, entry_no, level, title, page)``, layout
    ``spans(book_id, page_num, span_no, text, font_size)`` and
    ``books(book_id, discovery_no, title, author)``."""

    lines: DataFrame
    toc: DataFrame
    spans: DataFrame
    books: DataFrame


@dataclass
class SpineInputs:
    """Spine books: ``spine(book_id, spine_pos, item_id)``, ``items(book_id, item_id,
    item_type, file_name, html)`` and ``books`` as above."""

    spine: DataFrame
    items: DataFrame
    books: DataFrame


def work_dir(spark: SparkSession, run_id: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/quire-{run_id}"


def _stage(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _without(df: DataFrame, skipped: DataFrame | None) -> DataFrame:
    """Rows of books that were not skipped. Ids of the other format need not be of
    this table's type; those belong to no row here."""
    if skipped is None:
        return df
    ids = skipped.select(F.col("book_id").try_cast(df.schema["book_id"].dataType).alias("book_id")).distinct()
    return df.join(ids, "book_id", "left_anti")


def _paged_chapters(inputs: PagedInputs, skipped: DataFrame | None, cap: int | None, wd: str) -> DataFrame:
    pages = _stage(S.page_facts(inputs.lines), f"{wd}/pages")
    ranges = S.resolve(S.all_boundaries(pages, inputs.toc, inputs.spans, S.book_pages(pages)), pages)
    # Skipping and the cap work on page ranges: text is assembled for the chapters that stay.
    return S.chapter_rows(S.assemble(S.cap_chapters(_without(ranges, skipped), cap), pages))


def _spine_chapters(inputs: SpineInputs, skipped: DataFrame | None, cap: int | None) -> DataFrame:
    chapters = S.cap_chapters(S.spine_chapters(_without(inputs.spine, skipped), inputs.items), cap)
    none = F.lit(None).cast("long")
    return chapters.select("book_id", F.lit("spine").alias("strategy"), "chapter_number", "title", "content", "file_name",
                           none.alias("start_page"), none.alias("end_page"))


def _together(frames: list[DataFrame]) -> DataFrame:
    """Rows of both formats in one table; ids of different types become strings."""
    if len({f.schema["book_id"].dataType for f in frames}) > 1:
        frames = [f.withColumn("book_id", F.col("book_id").cast("string")) for f in frames]
    return reduce(DataFrame.unionByName, frames)


def run(spark: SparkSession, inputs: PagedInputs | None, replies: DataFrame | None, out_dir: str, run_id: str,
        fmt: str = "json", chapter_cap: int | None = None, cards_per_chapter: int = 5,
        run_ts: str | None = None, spine: SpineInputs | None = None, files: DataFrame | None = None,
        publish: bool = False) -> dict[str, DataFrame]:
    """Files -> chapters of paged and spine books -> suitable chapters -> card requests;
    replies -> typed cards -> exports; summaries.

    ``files(book_id, path, parse_ok)``, if given, is the catalog of the run: books whose
    file is unsupported or could not be read are skipped everywhere and kept in
    ``rejected_files`` with their reason. Chapters that give no cards are kept in
    ``rejected_chapters`` likewise, and ``accounting`` has the counts of both passes.

    ``replies`` is the output table of a batch-inference job over the requests
    (``reply_id, book_id, chapter_title`` and ``response_text``, or the columns of
    ``reply_text`` it is taken from); without it, extractive cards stand in.

    With ``publish`` the exports are published under a manifest (``export.publish_cards``):
    ``manifest`` and ``removed_files`` are added, and a run that fails leaves the last export."""
    if inputs is None and spine is None:
        raise ValueError("no books: give paged or spine inputs")
    # The exports carry the time of the run, taken once.
    run_ts = run_ts or datetime.now().isoformat()
    wd = work_dir(spark, run_id)
    found = None
    if files is not None:
        found = RJ.route(RJ.with_file_reason(files), f"{wd}/files", RJ.FILE_REASONS)
    skipped = found.rejected if found else None
    parts, shelves = [], []
    if inputs is not None:
        parts.append(_paged_chapters(inputs, skipped, chapter_cap, wd))
        shelves.append(_without(inputs.books, skipped))
    if spine is not None:
        parts.append(_spine_chapters(spine, skipped, chapter_cap))
        shelves.append(_without(spine.books, skipped))
    chapters = _stage(_together(parts), f"{wd}/chapters")
    books = _together([b.select("book_id", "discovery_no", "title", "author") for b in shelves])
    judged = RJ.route(RJ.with_chapter_reason(chapters.select("book_id", "chapter_number", "title", "content")),
                      f"{wd}/judged", RJ.CHAPTER_REASONS)
    suitable = judged.accepted
    requests = _stage(C.card_requests(suitable, cards_per_chapter), f"{wd}/requests")
    if replies is not None:
        cards = C.valid_cards(C.parse_replies(C.with_reply_text(replies)))
    else:
        cards = C.extractive_cards(suitable, cards_per_chapter).withColumnRenamed("chapter_number", "reply_id")
    cards = _stage(cards, f"{wd}/cards")
    write = K.publish_cards if publish else K.write_cards
    exported = write(books, chapters, cards, f"{out_dir}/cards", fmt, run_ts)
    summary = A.generation_summary(books, chapters, cards)
    per_book = A.book_summary(books, chapters).join(A.cards_per_book(books, cards), "book_id")
    K.write_summary(summary, per_book, f"{out_dir}/summary", run_id, run_ts)
    out = {"chapters": chapters, "requests": requests, "cards": cards, "summary": summary,
           "per_book": per_book, "rejected_chapters": judged.rejected.drop("content"),
           "strategies": chapters.groupBy("strategy").agg(
               F.countDistinct("book_id").alias("books"), F.count(F.lit(1)).alias("chapters"))}
    passes = {"chapter": judged} | ({"file": found} if found else {})
    out["accounting"] = spark.createDataFrame(
        [(level, outcome, n) for level, p in passes.items() for outcome, n in p.counts.items()],
        "level string, outcome string, rows long")
    if publish:
        out |= {"manifest": exported.manifest, "removed_files": exported.removed}
    return out | ({"rejected_files": found.rejected} if found else {})
