from quire.sources.catalog import book_catalog, first_files


def test_catalog_case_sensitive_and_recursive(spark, tmp_path):
    root = tmp_path / "epub"
    (root / "sub").mkdir(parents=True)
    for name in ["x.epub", "sub/z.epub", "sub/y.EPUB"]:
        (root / name).write_bytes(b"data")
    pdf = tmp_path / "pdf"
    pdf.mkdir()
    (pdf / "a.pdf").write_bytes(b"p")
    cat = book_catalog(spark, {"epub": str(root), "pdf": str(pdf)})
    got = sorted((r.format, r.path.rsplit("/", 1)[-1]) for r in cat.collect())
    assert got == [("epub", "x.epub"), ("epub", "z.epub"), ("pdf", "a.pdf")]
    in_order = [r.path.rsplit("/", 1)[-1] for r in cat.orderBy("discovery_no").collect()]
    assert in_order == ["z.epub", "x.epub", "a.pdf"]
    assert [r.path.rsplit("/", 1)[-1] for r in first_files(cat, 2).collect()] == ["z.epub", "x.epub"]


def test_missing_root_is_empty(spark, tmp_path):
    assert book_catalog(spark, {"epub": str(tmp_path / "nope")}).count() == 0
