import numpy as np
from pyspark.sql import functions as F

from quire.llm import urlfilter as uf
from quire.llm.registry import op7_url_filter


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = spark.range(0, 20_000, 37).select(F.concat(F.lit("k"), "id").alias("key"))
    levels = uf.build_cascade(listed, universe)
    assert len(levels) >= 2
    h1, h2 = uf.hashes(F.col("key"))
    pdf = universe.select("key", h1.alias("a"), h2.alias("b")).toPandas()
    got = uf.is_listed(levels, uf._u64(pdf.a), uf._u64(pdf.b))
    assert (got == np.array([int(k[1:]) % 37 == 0 for k in pdf.key])).all()
    assert sum(level.words.nbytes for level in levels) < 20_000
    joined = uf.listed_by_join(universe, "key", listed).where("listed").count()
    assert joined == got.sum()


def test_size_is_checked_before_fetching(spark):
    universe = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    try:
        uf.build_cascade(universe.limit(1000), universe, max_bytes=64)
    except ValueError as e:
        assert "max_bytes" in str(e)
    else:
        raise AssertionError("a cascade of over 64 bytes was built")


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in uf.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_query_against_brute_force(spark, tmp_path):
    urls = ["http://example.org/es/1", "https://A.Example.ORG/en/12?x", "http://org", "http://org/", "http://x.org/q#f",
            "http://x.com/fr/9", "http://notcom/fr/", "http://com/de/", "https://a.b.com/de/1", "x", None, "", "://",
            "://org/a", "http://éx.org/é", "http://org?/x", "http://example.org.org/es/", "a://b://c.org/d",
            "http://.org/", "http://example.org/en/1", "http://EXAMPLE.ORG/EN/1", "http://x\ny.org/\nes"]
    rows = [(i, u, "c") for i, u in enumerate(urls)] + [(0, urls[0], "c"), (None, urls[0], "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, rule string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = [(r.page_id, r.host, r.path, r.rule, r.verdict) for r in op7_url_filter(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted([(i, *brute(u)) for i, u, _ in rows], key=str)
    df.limit(0).write.parquet(f"{tmp_path}/empty/pages.parquet")
    assert op7_url_filter(spark, f"{tmp_path}/empty").count() == 0
