import corpus_pipeline
from quire.llm import pii, quality
from quire.llm.common import table
from tests.llm.test_minhash import brute
from tests.llm.test_packing import check_layout

SF = "/root/testdata/sf0.01"


def test_stages_take_effect_in_order(spark):
    docs = {r.doc_id: r for r in table(spark, SF, "documents").collect()}
    scores = {r.doc_id: r.score for r in quality.quality_scores(
        table(spark, SF, "documents"), table(spark, SF, "labels")).collect()}
    good = [d for d in sorted(docs) if scores[d] >= quality.THRESHOLD]
    kept = [r[0] for r in brute([(d, docs[d].text) for d in good], words=5) if r[3]]
    texts = {d: pii.redact(docs[d].text, pii.find(docs[d].text)) for d in kept}
    want = {d: len((t or "").encode().split()) + 1 for d, t in texts.items()}
    check_layout(corpus_pipeline.run(spark, SF).collect(), want)
    assert 0 < len(kept) < len(good) < len(docs)


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
    assert "doc_id" in corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns


def test_an_empty_corpus(spark, tmp_path):
    table(spark, SF, "documents").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    table(spark, SF, "labels").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
