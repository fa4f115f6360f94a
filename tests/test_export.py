"""Exports (K1-K6): rendered rows and written files."""

import csv
import glob
import io
import json
import os

from pyspark.sql import functions as F

from quire.operators import export as K

BOOKS = "book_id string, discovery_no long, title string, author string"
CARDS = ("reply_id long, book_id string, card_no int, front string, back string, card_type string, "
         "tags array<string>, source string, difficulty long")


def sample(spark):
    books = spark.createDataFrame([("b1", 1, 'My "Book": é', "Ann"), ("b2", 2, "Empty", "")], BOOKS)
    cards = spark.createDataFrame([
        (1, "b1", 1, "a, b", 'say "hi"\nnow', "basic", ["t::s", "u"], "S", None),
        (1, "b1", 2, "q2", "x", "cloze", [], "S", 0),
        (2, "b1", 1, "q3", "y", "qa", ["z"], "T", 3),
    ], CARDS)
    chapters = spark.createDataFrame([("b1", 1), ("b1", 2), ("b2", 1)], "book_id string, chapter_number int")
    return books, chapters, cards


def read_folder(path, sep="\n"):
    parts = sorted(glob.glob(os.path.join(path, "part-*")))
    return "".join(open(p, encoding="utf-8", newline="").read() for p in parts)


def test_json_document_matches_python(spark, tmp_path):
    books, chapters, cards = sample(spark)
    K.write_cards(books, chapters, cards, str(tmp_path), "JSON", run_ts="2024-01-01T00:00:00")
    stem = "My__Book___é"
    text = read_folder(str(tmp_path / "json" / f"file_stem={stem}"))
    expected = {
        "metadata": {"book_title": 'My "Book": é', "book_author": "Ann", "generated_at": "2024-01-01T00:00:00",
                     "total_flashcards": 3, "total_chapters": 2},
        "flashcards": [
            {"front": "a, b", "back": 'say "hi"\nnow', "card_type": "basic", "source": "S", "difficulty": None,
             "tags": ["t::s", "u"]},
            {"front": "q2", "back": "x", "card_type": "cloze", "source": "S", "difficulty": 0, "tags": []},
            {"front": "q3", "back": "y", "card_type": "qa", "source": "T", "difficulty": 3, "tags": ["z"]},
        ],
    }
    assert text == json.dumps(expected, indent=2, ensure_ascii=False) + "\n"
    # K6: no file for a book without cards
    assert not glob.glob(str(tmp_path / "json" / "file_stem=Empty"))


def test_csv_round_trip(spark, tmp_path):
    books, chapters, cards = sample(spark)
    K.write_cards(books, chapters, cards, str(tmp_path), "csv")
    text = read_folder(str(tmp_path / "csv" / "file_stem=My__Book___é"))
    buf = io.StringIO()
    w = csv.writer(buf)
    w.writerow(["front", "back", "card_type", "source", "difficulty", "tags"])
    w.writerow(["a, b", 'say "hi"\nnow', "basic", "S", None, "t::s,u"])
    w.writerow(["q2", "x", "cloze", "S", 0, ""])
    w.writerow(["q3", "y", "qa", "T", 3, "z"])
    assert text == buf.getvalue()
    back = spark.read.csv(str(tmp_path / "csv" / "file_stem=My__Book___é"), header=True, multiLine=True, escape='"')
    assert back.where(F.col("front") == "a, b").collect()[0].back == 'say "hi"\nnow'


def test_deck_difficulty_unknown(spark):
    books, chapters, cards = sample(spark)
    lines = {(r.reply_id, r.card_no): r.line for r in K.render_deck(books, cards).collect()}
    assert lines[(1, 2)] == "q2\tx\tSource:S Difficulty:Unknown Type:cloze Book:My \"Book\": é"
    assert lines[(1, 1)].endswith("t::s u Source:S Difficulty:Unknown Type:basic Book:My \"Book\": é")
    assert lines[(2, 1)] == "q3\ty\tz Source:T Difficulty:3 Type:qa Book:My \"Book\": é"
    esc = {(r.reply_id, r.card_no): r.line for r in K.render_deck(books, cards, escape=True).collect()}
    assert "\n" not in esc[(1, 1)]


def test_unknown_format_falls_back_to_json(spark, tmp_path):
    books, chapters, cards = sample(spark)
    assert K.write_cards(books, chapters, cards, str(tmp_path), "xml") == "json"


def test_name_collision_last_wins(spark):
    books = spark.createDataFrame([("b1", 1, "Same", "A"), ("b2", 2, "Same", "B")], BOOKS)
    cards = spark.createDataFrame([(1, "b1", 1, "q", "a", "basic", [], "S", 1),
                                   (2, "b2", 1, "q", "a", "basic", [], "S", 1)], CARDS)
    assert [r.book_id for r in K.export_books(books, cards).collect()] == ["b2"]


def test_exports_keep_other_formats_and_books(spark, tmp_path):
    books = spark.createDataFrame([("b1", 1, "One", "A"), ("b2", 2, "Two", "B"), ("b3", 3, None, "C")], BOOKS)
    rows = [(i, f"b{i}", 1, "q", "a", "basic", [], "S", 1) for i in (1, 2, 3)]
    cards = spark.createDataFrame(rows, CARDS)
    chapters = spark.createDataFrame([(f"b{i}",) for i in (1, 2, 3)], "book_id string")
    K.write_cards(books, chapters, cards, str(tmp_path), "json")
    K.write_cards(books, chapters, cards.where("book_id = 'b1'"), str(tmp_path), "csv")
    K.write_cards(books, chapters, cards.where("book_id = 'b1'"), str(tmp_path), "json")
    found = {p.rsplit("/", 2)[-2] + "/" + p.rsplit("=", 1)[-1] for p in glob.glob(str(tmp_path / "*" / "file_stem=*"))}
    assert found == {"json/One", "json/Two", "json/Unknown_Title", "csv/One"}
