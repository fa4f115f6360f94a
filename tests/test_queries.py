"""Registered queries: entry smoke test, plan checks and the DuckDB oracle
comparison on the smallest data."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from quire.plans import oracle as O
from quire.plans import queries as Q
from quire.sources.tables import TABLES

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["book_id", "chapters", "words", "suitable_chapters", "flashcards"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(Q.queries()) == set(O.oracle_sql())


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_plan_has_no_python_udf_or_nested_loop(spark, name):
    plan = Q.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op}"
    # Column pruning reaches the scans: columns no operator uses are never read.
    schemas = [line.split("ReadSchema: ", 1)[1] for line in plan.splitlines() if "ReadSchema: " in line]
    assert schemas, name
    for unused in ("lang:", "n_chars:", "embedding:"):
        assert all(unused not in s for s in schemas), f"{name} reads {unused}"


def _plan(spark, name):
    return Q.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["strategy_usage", "numbering_audit", "chapter_cap", "book_totals"])
def test_counting_chapters_assembles_no_text(spark, name):
    assert "listagg(ptext" not in _plan(spark, name)


def test_title_rule_reads_no_text(spark):
    assert "text:" not in _plan(spark, "suit_title")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(rows):
    def cell(v):
        if isinstance(v, float):
            return round(v, 9)
        if isinstance(v, (list, tuple)):
            return tuple(v)
        return v
    return sorted((tuple(cell(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(Q.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = Q.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _norm([[r[c] for c in cols] for r in df.collect()])
    rel = duck.execute(O.oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = _norm([[r[i] for i in idx] for r in rel.fetchall()])
    assert got == want


@pytest.mark.parametrize("name", ["toc_chapters", "range_text", "heading_like", "font_candidates", "modal_font_size", "font_chapters"])
def test_standalone_queries_judge_every_book(spark, name):
    part, every = (Q.queries()[n](spark, SF_SMALL).select("book_id").distinct().collect() for n in (name, f"{name}_every"))
    assert {r[0] % 5 for r in every} == set(range(5)) and {r[0] for r in part} < {r[0] for r in every}


def test_lines_are_cleaned_once_for_the_cascade(spark):
    """The page table is written once: what is left of the lines in the plan is the outline
    and the spans (read twice), and no page is put together again."""
    df = Q.queries()["corpus_cards"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode(") <= 3
    assert plan.count("listagg") == 1
