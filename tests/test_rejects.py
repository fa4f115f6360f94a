"""Rejects as data: routing, reasons and counts taken while writing."""

from conftest import SF_SMALL
from quire.operators import rejects as RJ
from quire.operators import report as A
from quire.sources import fixtures as fx

FILES = "book_id string, path string, parse_ok boolean"


def test_both_tables_and_counts(spark, tmp_path):
    df = spark.createDataFrame([
        ("a", "/x/a.epub", True), ("b", "/x/b.PDF", False), ("c", "/x/c.mobi", True), ("d", "/x/d.mobi", False),
        ("e", None, True), ("f", "/x/f.pdf", None), ("a", "/x/a.epub", True), (None, "/x/g.pdf", True)], FILES)
    got = RJ.route(RJ.with_file_reason(df), str(tmp_path / "files"), RJ.FILE_REASONS)
    assert got.counts == {"discovered": 8, "accepted": 3, "unsupported_format": 3, "unreadable": 2}
    assert sorted(r.path for r in got.accepted.collect()) == ["/x/a.epub", "/x/a.epub", "/x/g.pdf"]
    assert {(r.book_id, r.reject_reason) for r in got.rejected.collect()} == {
        ("b", "unreadable"), ("f", "unreadable"), ("c", "unsupported_format"), ("d", "unsupported_format"), ("e", "unsupported_format")}
    assert got.accepted.columns == ["book_id", "path", "parse_ok"]


def test_empty_table(spark, tmp_path):
    got = RJ.route(RJ.with_file_reason(spark.createDataFrame([], FILES)), str(tmp_path / "none"), RJ.FILE_REASONS)
    assert got.counts == {"discovered": 0, "accepted": 0, "unsupported_format": 0, "unreadable": 0}
    assert got.accepted.count() == got.rejected.count() == 0


def test_counts_agree_with_run_accounting(spark, tmp_path):
    files = fx.files(spark, SF_SMALL)
    got = RJ.route(RJ.with_file_reason(files), str(tmp_path / "run"), RJ.FILE_REASONS)
    want = A.run_accounting(files).collect()[0]
    assert (got.counts["discovered"], got.counts["accepted"], got.counts["unsupported_format"], got.counts["unreadable"]) == (
        want.discovered, want.processed, want.unsupported, want.failed)
    assert got.rejected.count() == want.skipped and got.accepted.count() == want.processed


def test_chapter_reasons(spark, tmp_path):
    prose = "plain words about nothing much " * 10
    rows = [(1, 1, "Lesson", prose), (1, 2, "Lesson", "short"), (1, 3, "Cover", prose),
            (1, 4, "Lesson", prose + " isbn index bibliography"), (1, 5, None, prose)]
    df = spark.createDataFrame(rows, "book_id long, chapter_number int, title string, content string")
    got = {r.chapter_number: r.reject_reason for r in RJ.with_chapter_reason(df).collect()}
    assert {k: v for k, v in got.items() if k < 5} == {1: None, 2: "length", 3: "title", 4: "boilerplate"}
