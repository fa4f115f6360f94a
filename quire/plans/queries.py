"""Registered queries: one per operator of the inventory.

Every query takes ``(spark, sf_dir)``, reads the whole input tables under
``sf_dir`` (shaped by the fixture views) and returns a lazily planned
DataFrame. ``quire.plans.oracle`` holds the matching DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import text as T
from quire.operators import cards as C
from quire.operators import export as K
from quire.operators import lines as L
from quire.operators import rejects as RJ
from quire.operators import report as A
from quire.operators import segment as S
from quire.operators import suitability as SU
from quire.session import stage_once
from quire.sources import fixtures as fx
from quire.sources.tables import read_table


class Corpus:
    """Lazily built fixture inputs and shared intermediate plans for one
    data folder. Nothing but ``pages`` is computed until an action runs."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf = spark, sf_dir

    # paged books
    @cached_property
    def lines(self) -> DataFrame:
        return fx.lines(self.spark, self.sf)

    @cached_property
    def page_facts(self) -> DataFrame:
        """For queries that use it once."""
        return S.page_facts(self.lines)

    @cached_property
    def pages(self) -> DataFrame:
        """The same for the cascade and the assembly, which use it several times: every line is
        cleaned, tested and shuffled once."""
        return stage_once(self.page_facts, "pages")

    @cached_property
    def book_pages(self) -> DataFrame:
        return S.book_pages(self.pages)

    @cached_property
    def toc(self) -> DataFrame:
        return fx.toc(self.lines)

    @cached_property
    def spans(self) -> DataFrame:
        return fx.spans(self.lines)

    @cached_property
    def every_toc(self) -> DataFrame:
        return fx.toc(self.lines, every=True)

    @cached_property
    def every_span(self) -> DataFrame:
        return fx.spans(self.lines, every=True)

    @cached_property
    def boundaries(self) -> DataFrame:
        return S.all_boundaries(self.pages, self.toc, self.spans, self.book_pages)

    @cached_property
    def ranges(self) -> DataFrame:
        """Chapters of the cascade as page ranges, without their text."""
        return S.resolve(self.boundaries, self.pages)

    @cached_property
    def resolved(self) -> DataFrame:
        return S.chapter_rows(S.assemble(self.ranges, self.pages))

    # spine books
    @cached_property
    def spine(self) -> DataFrame:
        return fx.spine(self.spark, self.sf)

    @cached_property
    def items(self) -> DataFrame:
        return fx.items(self.spark, self.sf)

    @cached_property
    def spine_chapters(self) -> DataFrame:
        return S.spine_chapters(self.spine, self.items)

    # books, chapters, replies, files
    @cached_property
    def books(self) -> DataFrame:
        return fx.books(self.spark, self.sf)

    @cached_property
    def chapters(self) -> DataFrame:
        return fx.chapters(self.spark, self.sf)

    @cached_property
    def raw_chapters(self) -> DataFrame:
        return fx.raw_chapters(self.spark, self.sf)

    @cached_property
    def suitable(self) -> DataFrame:
        return SU.suitable_chapters(self.chapters)

    @cached_property
    def responses(self) -> DataFrame:
        return fx.responses(self.spark, self.sf)

    @cached_property
    def parsed(self) -> DataFrame:
        return C.parse_replies(self.responses)

    @cached_property
    def cards(self) -> DataFrame:
        return C.valid_cards(self.parsed)

    @cached_property
    def files(self) -> DataFrame:
        return fx.files(self.spark, self.sf)


def _q(fn: Callable[[Corpus], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Corpus(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _chapter_cols(df: DataFrame) -> DataFrame:
    return df.select("book_id", "chapter_number", "title", "content", "file_name")


# --- scans / text functions -------------------------------------------------

def format_dispatch(c: Corpus) -> DataFrame:
    return A.format_dispatch(c.files)


def run_accounting(c: Corpus) -> DataFrame:
    return A.run_accounting(c.files)


def file_routing(c: Corpus) -> DataFrame:
    return RJ.with_file_reason(c.files).select("file_no", "path", "reject_reason")


def chapter_routing(c: Corpus) -> DataFrame:
    """Reasons where the text is read, numbers for ids and reasons only."""
    return _numbered(c, RJ.with_chapter_reason(c.raw_chapters), "title", "reject_reason")


def reject_accounting(c: Corpus) -> DataFrame:
    return RJ.reject_accounting(c.files, c.raw_chapters)


def html_text(c: Corpus) -> DataFrame:
    p = read_table(c.spark, c.sf, "pages", "page_id", "html")
    return p.select("page_id", T.html_text(F.col("html")).alias("text"))


def chapter_title(c: Corpus) -> DataFrame:
    return c.spine_chapters.select("book_id", "chapter_number", "title", "title_from")


def book_metadata(c: Corpus) -> DataFrame:
    b = c.books
    n = F.col("discovery_no")
    titles = F.when(n % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.col("title")))
    meta_title = F.when(n % 2 == 1, F.col("title")).otherwise(F.lit(""))
    return b.select(
        "book_id", T.book_title_spine(titles).alias("spine_title"),
        T.book_title_paged(meta_title, F.col("file_path")).alias("paged_title"),
        T.book_author(F.col("author")).alias("author"),
    )


def word_count(c: Corpus) -> DataFrame:
    d = read_table(c.spark, c.sf, "documents", "doc_id", "text")
    return d.select("doc_id", T.word_count(F.col("text")).cast("long").alias("words"))


def preview_text(c: Corpus) -> DataFrame:
    ch = c.raw_chapters.select(
        "book_id", "doc_id", T.preview(F.col("title"), 60).alias("title_60"),
        S._once(T.preview(F.col("content"), 80).alias("content_80"), T.preview(F.col("content"), 100).alias("content_100")))
    return _numbered(c, ch, "title_60", "content_80", "content_100")


def safe_filename(c: Corpus) -> DataFrame:
    return c.books.select("book_id", "title", T.safe_filename(F.col("title")).alias("file_stem"))


def display_fields(c: Corpus) -> DataFrame:
    return A.display_fields(A.book_totals(c.books, c.chapters), "anki")


# --- lines and pages --------------------------------------------------------

def page_lines(c: Corpus) -> DataFrame:
    return c.lines


def clean_lines(c: Corpus) -> DataFrame:
    return L.kept_lines(c.lines)


def line_noise_profile(c: Corpus) -> DataFrame:
    return L.noise_profile(c.lines)


def page_text(c: Corpus) -> DataFrame:
    return L.page_text(c.page_facts)


def _range_text(c: Corpus, toc: DataFrame) -> DataFrame:
    t = S.assemble(S.finish(S.toc_boundaries(toc), c.book_pages), c.pages, keep_empty=True)
    return t.select("book_id", "ordinal", "start_page", "end_page", "content")


def _heading_like(spans: DataFrame) -> DataFrame:
    s = spans.select("book_id", "span_no", S._once(T.strip(F.col("text")).alias("text")))
    return s.select("book_id", "span_no", T.heading_like(F.col("text")).alias("heading_like"))


def _font_candidates(spans: DataFrame) -> DataFrame:
    return S.font_candidates(spans).select("book_id", "page_num", "span_no", "text", "font_size")


def range_text(c: Corpus) -> DataFrame:
    return _range_text(c, c.toc)


def heading_like(c: Corpus) -> DataFrame:
    return _heading_like(c.spans)


def heading_pattern(c: Corpus) -> DataFrame:
    return S.heading_lines(c.page_facts).select("book_id", "line_no", "rule", "title")


# --- boundaries and chapters ------------------------------------------------

def boundaries(c: Corpus) -> DataFrame:
    return c.boundaries.select("book_id", "strategy", "ordinal", "title", "start_page", "end_page", "file_name")


def toc_chapters(c: Corpus) -> DataFrame:
    return S.strategy_chapters(S.toc_boundaries(c.toc), c.pages, c.book_pages)


def font_candidates(c: Corpus) -> DataFrame:
    return _font_candidates(c.spans)


def modal_font_size(c: Corpus) -> DataFrame:
    return S.modal_font_size(S.font_candidates(c.spans))


def font_chapters(c: Corpus) -> DataFrame:
    return S.strategy_chapters(S.font_boundaries(c.spans), c.pages, c.book_pages)


# The same with outline entries and spans of every book, where those above have
# the books that the cascade has them for.

def range_text_every(c: Corpus) -> DataFrame:
    return _range_text(c, c.every_toc)


def heading_like_every(c: Corpus) -> DataFrame:
    return _heading_like(c.every_span)


def toc_chapters_every(c: Corpus) -> DataFrame:
    return S.strategy_chapters(S.toc_boundaries(c.every_toc), c.pages, c.book_pages)


def font_candidates_every(c: Corpus) -> DataFrame:
    return _font_candidates(c.every_span)


def modal_font_size_every(c: Corpus) -> DataFrame:
    return S.modal_font_size(S.font_candidates(c.every_span))


def font_chapters_every(c: Corpus) -> DataFrame:
    return S.strategy_chapters(S.font_boundaries(c.every_span), c.pages, c.book_pages)


def pattern_chapters(c: Corpus) -> DataFrame:
    return S.strategy_chapters(S.pattern_boundaries(c.pages), c.pages, c.book_pages)


def page_chunks(c: Corpus) -> DataFrame:
    r = S.resolve(S.finish(S.chunk_boundaries(c.book_pages), c.book_pages), c.pages)
    return _chapter_cols(S.assemble(r, c.pages))


def chapters_resolved(c: Corpus) -> DataFrame:
    return c.resolved.select("book_id", "strategy", "chapter_number", "title", "content", "file_name")


def strategy_usage(c: Corpus) -> DataFrame:
    return c.ranges.groupBy("strategy").agg(
        F.countDistinct("book_id").alias("books"), F.count(F.lit(1)).alias("chapters"))


def chapter_cap(c: Corpus) -> DataFrame:
    return S.cap_chapters(c.ranges, 2).select("book_id", "chapter_number", "title")


def numbering_audit(c: Corpus) -> DataFrame:
    return A.numbering_audit(c.ranges)


def book_totals(c: Corpus) -> DataFrame:
    return A.book_totals(c.book_pages, S.range_words(c.ranges, c.pages))


def spine_chapters(c: Corpus) -> DataFrame:
    return _chapter_cols(c.spine_chapters)


def spine_dangling(c: Corpus) -> DataFrame:
    return S.spine_dangling(c.spine, c.items)


def all_chapters(c: Corpus) -> DataFrame:
    paged = c.resolved.select(F.lit("pdf").alias("format"), F.col("book_id").cast("string").alias("book_id"),
                              "chapter_number", "title", "content")
    spine = c.spine_chapters.select(F.lit("epub").alias("format"), "book_id", "chapter_number", "title", "content")
    u = spine.unionByName(paged)
    return u.select("format", "book_id", "chapter_number", "title", T.word_count(F.col("content")).cast("long").alias("words"))


# --- suitability ------------------------------------------------------------

def _numbered(c: Corpus, rules: DataFrame, *cols: str) -> DataFrame:
    """Rules are applied where the text is read; only ids and the rules'
    results are numbered and cross the network."""
    found = fx.number_chapters(rules.select("book_id", "doc_id", *cols), c.raw_chapters)
    return found.select("book_id", "chapter_number", *cols)


def suit_length(c: Corpus) -> DataFrame:
    return _numbered(c, SU.content_columns(c.raw_chapters), "long_enough")


def suit_title(c: Corpus) -> DataFrame:
    return _numbered(c, SU.title_columns(c.raw_chapters.select("book_id", "doc_id", "title")), "title_ok")


def suit_boilerplate(c: Corpus) -> DataFrame:
    return _numbered(c, SU.content_columns(c.raw_chapters), "skip_count")


def suit_legal_ratio(c: Corpus) -> DataFrame:
    return _numbered(c, SU.content_columns(c.raw_chapters), "legal_ratio")


def suitable_chapters(c: Corpus) -> DataFrame:
    rules = _numbered(c, SU.suitability_columns(c.raw_chapters), "title", "suitable")
    return rules.where("suitable").drop("suitable")


def suit_funnel(c: Corpus) -> DataFrame:
    return SU.suitability_funnel(c.raw_chapters)


def suit_funnel_by_book(c: Corpus) -> DataFrame:
    return SU.suitability_funnel_by_book(c.raw_chapters)


# --- cards --------------------------------------------------------------------

def card_requests(c: Corpus) -> DataFrame:
    return C.card_requests(c.suitable, 5)


def reply_text(c: Corpus) -> DataFrame:
    return C.with_reply_text(fx.model_runs(c.spark, c.sf))


def reply_fenced(c: Corpus) -> DataFrame:
    from quire.functions.replies import fenced_block
    return c.responses.select("reply_id", fenced_block(F.col("response_text")).alias("fenced"))


def reply_parse_stage(c: Corpus) -> DataFrame:
    return c.parsed.select("reply_id", "stage")


def reply_shape(c: Corpus) -> DataFrame:
    return c.parsed.select("reply_id", "shape")


def cards_exploded(c: Corpus) -> DataFrame:
    return C.exploded_cards(c.parsed).select("reply_id", "card_no", "status", "reply_fatal")


def cards_valid(c: Corpus) -> DataFrame:
    return c.cards.select("reply_id", "book_id", "card_no", "front", "back", "card_type",
                          F.array_join("tags", ",").alias("tags"), "source", "difficulty")


def reply_report(c: Corpus) -> DataFrame:
    return C.reply_report(c.parsed)


def _reconciled(c: Corpus) -> DataFrame:
    attempts = C.parse_replies(fx.reply_attempts(c.spark, c.sf))
    return C.reconcile(fx.requests(c.spark, c.sf), attempts)


def reply_reconciliation(c: Corpus) -> DataFrame:
    return _reconciled(c).withColumn("last_attempt", F.col("last_attempt").cast("long"))


def reconciliation_summary(c: Corpus) -> DataFrame:
    return C.reconciliation_summary(_reconciled(c))


def card_audit(c: Corpus) -> DataFrame:
    return C.card_audit(c.cards)


def card_mix(c: Corpus) -> DataFrame:
    return C.card_mix(c.cards)


def extractive_cards(c: Corpus) -> DataFrame:
    """Cards are taken where the text is read; only they are numbered."""
    rules = SU.suitability_columns(c.raw_chapters)
    found = rules.select("book_id", "doc_id", "title", S._once(
        F.when(F.col("suitable"), C.extractive_candidates(F.col("content"), 5)).alias("candidates")))
    return C.candidate_cards(_numbered(c, found, "title", "candidates")).drop("tags")


def card_preview(c: Corpus) -> DataFrame:
    return C.card_preview(c.cards, 3, 60)


# --- reports --------------------------------------------------------------------

def corpus_summary(c: Corpus) -> DataFrame:
    return A.corpus_summary(c.books, c.chapters)


def book_summary(c: Corpus) -> DataFrame:
    return A.book_summary(c.books, c.chapters)


def book_documents(c: Corpus) -> DataFrame:
    """Words are counted where the text is read; the nested chapters are shown as lines."""
    counted = c.raw_chapters.select("book_id", "doc_id", "title", S._once(T.word_count(F.col("content")).alias("words")))
    d = A.book_documents(c.books, _numbered(c, counted, "title", "words"), 8)
    line = F.transform("chapters", lambda x: F.concat_ws("|", x["chapter_number"].cast("string"), x["words"].cast("string"), x["title"]))
    return d.withColumn("chapters", F.array_join(line, "\n"))


def generation_summary(c: Corpus) -> DataFrame:
    return A.generation_summary(c.books, c.chapters, c.cards)


def cards_per_book(c: Corpus) -> DataFrame:
    return A.cards_per_book(c.books, c.cards)


def books_without_cards(c: Corpus) -> DataFrame:
    return A.books_without_cards(c.books, c.cards).select("book_id", "title")


def avg_words_per_chapter(c: Corpus) -> DataFrame:
    return A.avg_words_per_chapter(c.chapters)


def summary_rollup(c: Corpus) -> DataFrame:
    return A.summary_rollup(c.chapters)


def chapter_preview(c: Corpus) -> DataFrame:
    return A.chapter_preview(c.chapters, 3)


def latest_by_title(c: Corpus) -> DataFrame:
    return A.latest_by_title(c.books)


def latest_across_runs(c: Corpus) -> DataFrame:
    """Books with odd discovery numbers come from one run, the others from a later one."""
    odd = F.col("discovery_no") % 2 == 1
    return A.merge_latest(A.merge_latest(None, c.books.where(odd)), c.books.where(~odd))


def name_collisions(c: Corpus) -> DataFrame:
    return A.name_collisions(c.books)


# --- exports ----------------------------------------------------------------------

def export_json(c: Corpus) -> DataFrame:
    return K.render_json(c.books, c.chapters, c.cards)


def export_csv_rows(c: Corpus) -> DataFrame:
    return K.render_csv(c.books, c.cards)


def export_deck_rows(c: Corpus) -> DataFrame:
    return K.render_deck(c.books, c.cards)


# --- flagship: books -> chapters -> suitable -> cards -> summary -----------------

def corpus_cards(c: Corpus) -> DataFrame:
    """End-to-end plan: paged books through the strategy cascade, the
    suitability filter and extractive cards, summarised per book. Every
    chapter is read once: words, suitability and card candidates are
    row-local columns, then one aggregate per book."""
    ch = SU.suitability_columns(c.resolved.select("book_id", "chapter_number", "title", "content"))
    n_cards = F.when(F.col("suitable"), F.size(C.extractive_candidates(F.col("content"), 5))).otherwise(0)
    per_book = ch.groupBy("book_id").agg(
        F.count(F.lit(1)).alias("chapters"),
        F.sum(T.word_count(F.col("content"))).cast("long").alias("words"),
        F.count_if("suitable").alias("suitable_chapters"),
        F.sum(n_cards).cast("long").alias("flashcards"),
    )
    return c.book_pages.select("book_id").join(per_book, "book_id", "left").select(
        "book_id", *[F.coalesce(x, F.lit(0)).cast("long").alias(x)
                     for x in ("chapters", "words", "suitable_chapters", "flashcards")])


QUERY_FUNCS: list[Callable[[Corpus], DataFrame]] = [
    format_dispatch, run_accounting, file_routing, chapter_routing, reject_accounting, html_text, chapter_title, book_metadata, word_count, preview_text,
    safe_filename, display_fields, page_lines, clean_lines, line_noise_profile, page_text, range_text,
    heading_like, heading_pattern, boundaries, toc_chapters, font_candidates, modal_font_size, font_chapters,
    range_text_every, heading_like_every, toc_chapters_every, font_candidates_every, modal_font_size_every,
    font_chapters_every,
    pattern_chapters, page_chunks, chapters_resolved, strategy_usage, chapter_cap, numbering_audit, book_totals,
    spine_chapters, spine_dangling, all_chapters, suit_length, suit_title, suit_boilerplate, suit_legal_ratio,
    suitable_chapters, suit_funnel, suit_funnel_by_book, card_requests, reply_text, reply_fenced, reply_parse_stage, reply_shape, cards_exploded,
    cards_valid, reply_report, reply_reconciliation, reconciliation_summary, card_audit, card_mix, extractive_cards, card_preview, corpus_summary,
    book_summary, book_documents, generation_summary, cards_per_book, books_without_cards, avg_words_per_chapter,
    summary_rollup, chapter_preview, latest_by_title, latest_across_runs, name_collisions, export_json, export_csv_rows,
    export_deck_rows, corpus_cards,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _q(f) for f in QUERY_FUNCS}
