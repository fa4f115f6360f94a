"""Fixture views over the driver's tables (see FIXTURES.md section B).

The driver's tables are generic (documents, pages, conversations); these views
shape them into the inputs of the book pipeline: paged books (lines, outline,
layout spans), spine books (spine + items), books and chapters, model replies
and a file catalog. The DuckDB side of every view lives in
``quire.plans.oracle``; both give identical rows.

Every view reads its whole source table. Modulo tests decide which kind of
structure a row gets (a heading, an outline level), and some of them leave rows
out or overwrite them: ``toc`` and ``spans`` hold one book in five, so that the
cascade has books without either (``every`` gives those of all books); ``items``
drops one page in 11 and empties one in 13; ``raw_chapters`` blanks documents with
``doc_id % 97 = 5`` that no earlier branch takes; ``lines`` overwrites four of 14.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.operators.numbering import seq_number
from quire.sources.tables import read_table


def _s(x) -> Column:
    return x.cast("string")


def _host(url: Column) -> Column:
    return F.regexp_extract(url, r"^https?://([^/]+)", 1)


# --- B1. Paged books: one document = one book, 4 lines = one page ----------

def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select(
        F.col("doc_id").alias("book_id"),
        F.posexplode(F.split("text", "\n", -1)).alias("pos", "raw"),
    ).select("book_id", F.col("pos").cast("long").alias("line_no"), "raw")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = raw_lines(spark, sf_dir)
    ln, bk = F.col("line_no"), F.col("book_id")
    block = F.floor(ln / 14).cast("long")
    line = (
        F.when(bk % 5 == 4, F.col("raw"))
        .when(ln % 14 == 0, F.concat(F.lit("Chapter "), _s(block + 1)))
        .when(ln % 14 == 7, F.concat(F.lit("PART "), _s(block + 1)))
        .when(ln % 14 == 9, F.concat(F.lit("  3. Uber   "), F.col("raw"), F.lit(" ")))
        .when(ln % 14 == 10, F.concat(F.lit("12 apples "), F.col("raw")))
        .when(ln % 14 == 5, F.concat(F.lit("Page "), _s(F.floor(ln / 4).cast("long")), F.lit(" of 9")))
        .when(ln % 14 == 11, F.lit("12345"))
        .otherwise(F.col("raw"))
    )
    return r.select("book_id", "line_no", F.floor(ln / 4).cast("long").alias("page_num"), line.alias("line"))


def toc(lines_df: DataFrame, every: bool = False) -> DataFrame:
    """Outline entries of one book in five, or of ``every`` book."""
    ln, bk = F.col("line_no"), F.col("book_id")
    level = (
        F.when(bk % 10 == 5, 3).when(ln % 28 == 21, 3).when(ln % 14 == 7, 2).otherwise(1)
    ).cast("int")
    books = F.lit(True) if every else bk % 5 == 0
    return lines_df.where(books & (ln % 14).isin(0, 4, 7)).select(
        "book_id", ln.alias("entry_no"), level.alias("level"), F.col("line").alias("title"),
        (F.col("page_num") + 1).alias("page"),
    )


def spans(lines_df: DataFrame, every: bool = False) -> DataFrame:
    """Layout spans of one book in five, or of ``every`` book."""
    ln = F.col("line_no")
    size = F.when(ln % 14 == 0, 18.0).when(ln % 14 == 7, 16.0).otherwise(10.0).cast("double")
    font = F.when((ln % 14).isin(0, 7), F.lit("Serif-Bold")).otherwise(F.lit("Serif"))
    return lines_df.where(F.lit(True) if every else F.col("book_id") % 5 == 1).select(
        "book_id", "page_num", ln.alias("span_no"), F.col("line").alias("text"),
        size.alias("font_size"), font.alias("font_name"),
        (ln % 4 * 20.0).cast("double").alias("y_position"),
    )


# --- B2. Spine books: one host = one book, one page = one item -------------

def spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages", "page_id", "url")
    return p.select(
        _host(F.col("url")).alias("book_id"), F.col("page_id").alias("spine_pos"),
        F.concat(F.lit("item"), _s(F.col("page_id"))).alias("item_id"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    pid, h = F.col("page_id"), F.col("html")

    def rep(c: Column, a: str, b: str) -> Column:
        return F.replace(c, F.lit(a), F.lit(b))

    def no_title(c: Column) -> Column:
        return rep(rep(c, "<title>", "<i>"), "</title>", "</i>")

    html = (
        F.when(pid % 13 == 6, F.lit("<html><body><script>var x = 1;</script> <!-- none --></body></html>"))
        .when(pid % 6 == 1, rep(rep(h, "<title>", '<meta name="t"><i>'), "</title>", "</i>"))
        .when(pid % 6 == 2, rep(h, "<title>", "<title> </title><title>"))
        .when(pid % 6 == 3, rep(rep(no_title(h), "<h1>", '<h2 class="c"> '), "</h1>", "</h2>"))
        .when(pid % 6 == 4, rep(rep(no_title(h), "<h1>", "<h1> </h1><h3>"), "</h1><p>", "</h3><p>"))
        .when(pid % 6 == 5, rep(rep(no_title(h), "<h1>", "<p>"), "</h1>", "</p>"))
        .otherwise(h)
    )
    return p.where(pid % 11 != 3).select(
        _host(F.col("url")).alias("book_id"),
        F.concat(F.lit("item"), _s(pid)).alias("item_id"),
        F.when(pid % 7 == 5, F.lit("image")).otherwise(F.lit("document")).alias("item_type"),
        F.concat(F.lit("text/p"), _s(pid), F.lit(".xhtml")).alias("file_name"),
        html.alias("html"),
    )


# --- B3. Books and chapters: one source = one book, one document = one chapter

def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", "source")
    g = d.groupBy("source").agg(F.min(F.substring("source", 4, 1 << 20).cast("long")).alias("discovery_no"))
    n = F.col("discovery_no")
    return g.select(
        F.col("source").alias("book_id"), n,
        F.concat(F.lit("Vol/"), _s(n % 15), F.lit(': "Notes"? ')).alias("title"),
        F.when(n % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("Author "), F.col("source"))).alias("author"),
        F.concat(F.lit("/books/my_"), F.col("source"), F.lit("-vol.pdf")).alias("file_path"),
    )


def raw_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters before they are numbered (``doc_id`` gives their order)."""
    d = read_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    i, t = F.col("doc_id"), F.col("text")
    title = (
        F.when(i % 9 == 1, F.lit("Discover the Market")).when(i % 9 == 2, F.lit("About this book"))
        .when(i % 9 == 3, F.lit("Title Page")).otherwise(F.concat(F.lit("Lesson "), _s(i)))
    )
    content = (
        F.when(i % 7 == 1, F.concat(t, F.lit(" All Rights Reserved. ISBN 1. www.example.com")))
        .when(i % 7 == 2, F.concat(t, F.lit(" Copyright. Index.")))
        .when(i % 7 == 3, F.concat(F.lit("  "), t, F.lit("          ")))
        .when(i % 7 == 4, F.concat(t, F.lit(" Disclaimer: © liability, see https://example.com")))
        .when(i % 97 == 5, F.lit("  "))
        .otherwise(t)
    )
    return d.select(
        F.col("source").alias("book_id"), "doc_id", title.alias("title"), content.alias("content"),
        F.concat(F.lit("doc"), _s(i), F.lit(".xhtml")).alias("file_name"),
    )


def number_chapters(rows: DataFrame, raw: DataFrame) -> DataFrame:
    """Columns of ``rows`` (one row per raw chapter) with their
    ``chapter_number``. A source may hold a large share of all documents:
    numbered without a window over the whole source."""
    return seq_number(rows, ["book_id"], "doc_id", name="chapter_number",
                      positions=raw.select("book_id", "doc_id")).drop("doc_id")


def chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_chapters(spark, sf_dir)
    return number_chapters(raw, raw).select("book_id", "chapter_number", "title", "content", "file_name")


# --- B4. Model replies: one assistant turn = one reply ---------------------

def reply_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    flat = F.replace(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")), F.lit('"'), F.lit(" "))
    cid = F.col("conv_id")
    return c.where(F.col("role") == "assistant").select(
        "conv_id", "turn", F.concat(F.lit("src"), _s(cid % 20)).alias("book_id"),
        (cid * 100 + F.col("turn")).alias("reply_id"),
        F.concat(F.lit("Lesson "), _s(cid)).alias("chapter_title"),
        ((cid * 3 + F.col("turn")) % 14).alias("variant"),
        flat.alias("q"), F.concat(F.lit("A: "), flat).alias("a"),
    )


def cards_json(base: DataFrame) -> DataFrame:
    q, a = F.col("q"), F.col("a")
    g = F.concat(F.lit('{"front":"'), q, F.lit('","back":"'), a,
                 F.lit('","card_type":"basic","tags":["t::s","u"],"source":"S 1","difficulty":2}'))
    d = F.concat(F.lit('{"front":"'), q, F.lit('","back":"'), a, F.lit('","card_type":"cloze"}'))
    return base.select("conv_id", "turn", "reply_id", "book_id", "chapter_title", "variant", "q", "a",
                       g.alias("g"), d.alias("d"), F.lit("```\n").alias("fence"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    cj = cards_json(reply_base(spark, sf_dir))
    g, d, q, fence = F.col("g"), F.col("d"), F.col("q"), F.col("fence")
    L = F.lit
    v = F.col("variant")
    text = (
        F.when(v == 0, F.concat(L("Here you go:\n```json\n"), L('{"cards":['), g, L(","), d, L("]}\n"), fence, L("Bye {x}")))
        .when(v == 1, F.concat(fence, L('{"cards":['), g, L("]}\n"), fence))
        .when(v == 2, F.concat(L('{"cards":['), d, L(","), d, L("]}")))
        .when(v == 3, F.concat(L('Sure. {"cards":['), g, L("]} Enjoy.")))
        .when(v == 4, L("no json at all"))
        .when(v == 5, L('{"other":["no","cards"]}'))
        .when(v == 6, F.concat(L("["), g, L("]")))
        .when(v == 7, F.concat(L('{"cards":['), g, L(',{"front":"'), q, L('","card_type":"qa","difficulty":"hard"}]}')))
        .when(v == 8, F.concat(L('{"cards":['), g, L(',{"front":"'), q, L('","back":"x","card_type":"qa","difficulty":"hard"}]}')))
        .when(v == 9, F.concat(L('{"cards":[{"front":"'), q, L('","back":"x","card_type":"qa","tags":null}]}')))
        .when(v == 10, F.concat(L("```json\n{bad}\n"), fence, L('{"cards":['), g, L("]}")))
        .when(v == 11, F.concat(L('{"cards":["x",{"front":"'), q, L('","back":"x","card_type":"odd","difficulty":" 3 "}]} trailing')))
        .when(v == 12, F.concat(L('{"cards":[{"front":"'), q, L('","back":"x","card_type":"definition","difficulty":0,"tags":[]}]}')))
        .otherwise(L('{"cards":null}'))
    )
    return cj.select("reply_id", "book_id", "chapter_title", "variant", text.alias("response_text"),
                     F.col("conv_id").alias("request_id"), F.col("turn").alias("attempt"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per conversation, whose assistant turns are its attempts; besides,
    requests that nothing answers, requests sent twice and requests without an id."""
    c = read_table(spark, sf_dir, "conversations", "conv_id")
    cid = F.col("conv_id")
    return c.groupBy("conv_id").agg(F.lit(1)).select(F.explode(F.filter(F.array(
        cid, F.when(cid % 9 == 2, -1 - cid), F.when(cid % 10 == 3, cid), F.when(cid % 11 == 4, F.lit(10**15).cast("long"))),
        lambda x: x.isNotNull())).alias("request_id"), F.concat(F.lit("Lesson "), _s(cid)).alias("chapter_title")).withColumn(
        "request_id", F.nullif("request_id", F.lit(10**15).cast("long")))


def reply_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All replies as attempts of their requests, and further ones: replies to
    requests that nobody sent, and replies without an id."""
    r = responses(spark, sf_dir)
    i = F.col("request_id")
    stray = r.where(i % 8 == 1).withColumn("request_id", i + 10**12)
    lost = r.where(i % 7 == 5).withColumn("request_id", F.lit(None).cast("long"))
    return r.unionByName(stray).unionByName(lost)


def model_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message as the outcome of a model run, in one of six forms: its text is
    where the cascade looks for it, or further down than the cascade goes."""
    c = read_table(spark, sf_dir, "conversations", "conv_id", "turn", "text")
    t, v = F.col("text"), (F.col("conv_id") + F.col("turn")) % 6
    no_texts = F.array().cast("array<string>")
    items = (
        F.when(v <= 1, F.array(F.array(t, F.lit("x")), F.array(F.lit(""), F.lit("y")), no_texts))
        .when(v == 2, F.array(no_texts, F.array(F.lit("")))).when(v == 3, F.array().cast("array<array<string>>")))
    messages = F.when(v == 2, F.array(t)).when(v == 3, F.array(F.lit("m"), t)).when(v == 5, no_texts)
    return c.select("conv_id", "turn", F.when(v == 0, t).when(v == 1, F.lit("")).alias("final_output"), items.alias("items"),
                    messages.alias("messages"), F.when(v == 4, t).when(v != 5, F.lit("c")).alias("content"))


# --- B5. File catalog ------------------------------------------------------

def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages", "page_id")
    pid = F.col("page_id")
    ext = (F.when(pid % 5 == 0, ".epub").when(pid % 5 == 1, ".PDF").when(pid % 5 == 2, ".Epub")
           .when(pid % 5 == 3, ".mobi").otherwise(".pdf"))
    return p.select(pid.alias("file_no"), F.concat(F.lit("/books/a.b/f"), _s(pid), ext).alias("path"),
                    (pid % 17 != 4).alias("parse_ok"))
