import glob

from conftest import SF_SMALL
from quire.plans.pipeline import PagedInputs, SpineInputs, run
from quire.sources import fixtures as fx


def test_pipeline_writes_exports_and_summary(spark, tmp_path):
    lines = fx.lines(spark, SF_SMALL)
    books = lines.select("book_id").distinct().selectExpr(
        "book_id", "book_id AS discovery_no", "concat('Book ', book_id) AS title", "'A' AS author")
    out = run(spark, PagedInputs(lines, fx.toc(lines), fx.spans(lines), books), None, str(tmp_path), "t1",
              fmt="anki", chapter_cap=3)
    assert out["chapters"].groupBy("book_id").count().where("count > 3").count() == 0
    assert out["summary"].collect()[0].total_books == books.count()
    assert glob.glob(str(tmp_path / "cards" / "anki" / "file_stem=*" / "part-*"))
    assert glob.glob(str(tmp_path / "summary" / "run_id=t1" / "summary" / "part-*"))


def test_both_formats_with_rejects_and_accounting(spark, tmp_path):
    lines = fx.lines(spark, SF_SMALL)
    paged = lines.select("book_id").distinct().selectExpr(
        "book_id", "book_id AS discovery_no", "concat('Book ', book_id) AS title", "'A' AS author")
    spine, items = fx.spine(spark, SF_SMALL), fx.items(spark, SF_SMALL)
    hosts = spine.select("book_id").distinct().selectExpr(
        "book_id", "1000 + hash(book_id) AS discovery_no", "book_id AS title", "'B' AS author")
    files = paged.selectExpr("string(book_id) AS book_id", "concat('/b/', book_id, '.pdf') AS path", "book_id % 10 <> 3 AS parse_ok").union(
        hosts.selectExpr("book_id", "concat('/b/', book_id, if(book_id LIKE '%.org', '.mobi', '.epub'))", "true"))
    out = run(spark, PagedInputs(lines, fx.toc(lines), fx.spans(lines), paged), None, str(tmp_path), "t2", fmt="json",
              run_ts="2024-05-06T07:08:09", spine=SpineInputs(spine, items, hosts), files=files)
    counts = {(r.level, r.outcome): r["rows"] for r in out["accounting"].collect()}
    skipped = {r.book_id for r in out["rejected_files"].collect()}
    assert len(skipped) == counts["file", "unsupported_format"] + counts["file", "unreadable"] > 0
    assert {r.reject_reason for r in out["rejected_files"].collect()} == {"unsupported_format", "unreadable"}
    chapters = out["chapters"].select("book_id", "strategy").collect()
    assert not skipped & {r.book_id for r in chapters}
    assert {"spine", "pattern"} <= {r.strategy for r in chapters}
    assert counts["chapter", "discovered"] == len(chapters)
    assert counts["chapter", "accepted"] == out["requests"].count()
    by_reason = {r.reject_reason: r["count"] for r in out["rejected_chapters"].groupBy("reject_reason").count().collect()}
    assert by_reason == {o: n for (level, o), n in counts.items() if level == "chapter" and n and o not in ("discovered", "accepted")}
    assert out["summary"].collect()[0].total_books == counts["file", "accepted"]
    assert spark.read.json(f"{tmp_path}/summary/run_id=t2/summary").collect()[0].generated_at == "2024-05-06T07:08:09"


def test_replies_of_a_model_run(spark, tmp_path):
    books = spark.createDataFrame([(1, 1, "T", "A")], "book_id long, discovery_no long, title string, author string")
    lines = spark.createDataFrame([(1, 0, 0, "Chapter 1"), (1, 1, 0, "some text here")], "book_id long, line_no long, page_num long, line string")
    card = '{"cards":[{"front":"f","back":"b","card_type":"qa"}]}'
    replies = spark.createDataFrame([(1, 1, "c", None, [["x"], [card]], None, "no")],
                                    "reply_id long, book_id long, chapter_title string, final_output string, "
                                    "items array<array<string>>, messages array<string>, content string")
    out = run(spark, PagedInputs(lines, fx.toc(lines).limit(0), fx.spans(lines).limit(0), books), replies, str(tmp_path), "t3", "csv")
    assert [(r.front, r.source) for r in out["cards"].collect()] == [("f", "c")]
    assert "rejected_files" not in out
    again = run(spark, PagedInputs(lines, fx.toc(lines).limit(0), fx.spans(lines).limit(0), books), replies, str(tmp_path / "p"), "t4", "csv",
                publish=True)
    assert [(r.file_stem, r.cards) for r in again["manifest"].collect()] == [("T", 1)] and again["removed_files"].count() == 0
