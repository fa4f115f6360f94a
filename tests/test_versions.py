"""Versioned tables: exports with a manifest (K4, K6) and latest books across runs."""

import glob
import json

import pytest

from quire.operators import export as K
from quire.operators import report as A
from quire.sources import versions as V
from test_export import BOOKS, CARDS, read_folder, sample


def files_of(spark, path, fmt):
    m = K.published(spark, path, fmt)
    return {r.file_stem: r.folder for r in m.collect()}


def test_books_that_lose_their_cards_lose_their_files(spark, tmp_path):
    path = str(tmp_path / "out")
    books, chapters, cards = sample(spark)
    more = cards.union(spark.createDataFrame([(3, "b2", 1, "q", "a", "qa", [], "S", 1)], CARDS))
    assert K.published(spark, path, "json") is None
    first = K.publish_cards(books, chapters, more, path, "json")
    assert first.removed.count() == 0
    assert {(r.file_stem, r.book_id, r.cards) for r in first.manifest.collect()} == {("Empty", "b2", 1), ("My__Book___é", "b1", 3)}
    second = K.publish_cards(books, chapters, cards, path, "json")
    assert [(r.file_stem, r.book_id) for r in second.removed.collect()] == [("Empty", "b2")]
    assert [p.rsplit("=", 1)[1] for p in glob.glob(f"{second.folder}/file_stem=*")] == ["My__Book___é"] == list(files_of(spark, path, "json"))
    assert len(json.loads(read_folder(f"{second.folder}/file_stem=My__Book___é"))["flashcards"]) == 3
    # Another format has a manifest of its own.
    assert K.publish_cards(books, chapters, more, path, "CSV").fmt == "csv"
    assert set(files_of(spark, path, "csv")) == {"Empty", "My__Book___é"} and set(files_of(spark, path, "json")) == {"My__Book___é"}


def test_a_failed_run_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    books, chapters, cards = sample(spark)
    K.publish_cards(books, chapters, cards, path, "csv")
    before = files_of(spark, path, "csv")

    def lost(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(K.V, "write_next", lost)
    with pytest.raises(RuntimeError):
        K.publish_cards(books, chapters, cards.limit(0), path, "csv")
    monkeypatch.undo()
    assert files_of(spark, path, "csv") == before
    # The next run takes a folder that the failed one has not touched.
    assert K.publish_cards(books, chapters, cards, path, "csv").folder.split("run=")[1].startswith("3/")


def test_an_export_without_cards(spark, tmp_path):
    books, chapters, cards = sample(spark)
    path = str(tmp_path / "out")
    K.publish_cards(books, chapters, cards, path, "csv")
    last = K.publish_cards(books, chapters, cards.limit(0), path, "csv")
    assert last.manifest.count() == 0 and [r.book_id for r in last.removed.collect()] == ["b1"]


def test_runs_in_either_order_give_the_same_table(spark, tmp_path):
    one = spark.createDataFrame([("a", 1, "T", "x"), ("b", 9, "U", "x"), ("c", None, None, "x"), ("d", 4, "W", "x")], BOOKS)
    two = spark.createDataFrame([("e", 2, "T", "x"), ("f", 3, "U", "x"), ("g", 4, "W", "x"), ("h", 5, None, "x")], BOOKS)
    want = {("T", "e", 2), ("U", "b", 9), (None, "h", 5), ("W", "g", 4)}
    for name, runs in {"forth": (one, two), "back": (two, one), "again": (one, two, one)}.items():
        path = str(tmp_path / name)
        for run in runs:
            V.write_next(A.merge_latest(V.read_latest(spark, path), run), path)
        assert {tuple(r) for r in V.read_latest(spark, path).collect()} == want
        assert V.versions(spark, path) == list(range(1, len(runs) + 1))


def test_a_version_without_its_marker_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    V.write_next(spark.range(3), path)
    V.write_next(spark.range(5), path)
    (tmp_path / "t" / "version=2" / "_SUCCESS").unlink()
    assert V.read_latest(spark, path).count() == 3 and V.next_number(spark, path) == 3
