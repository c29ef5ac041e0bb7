"""The contract queries against their SQL, and the pipeline against its stages."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from orderlake.llm import registry
from orderlake.sources.tables import read_table
from tests.conftest import SF_SMALL
from tests.harness import compare, duck
from tests.llm.conftest import rows


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_all_are_registered():
    names = set(registry.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert names <= set(entry.queries()) and set(registry.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(registry.queries()[name](spark, SF_SMALL), registry.oracle_sql()[name], con)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.oracle_sql()) - {"op12_bm25_packing"}))
def test_query_returns_every_row(spark, name):
    df = registry.queries()[name](spark, SF_SMALL)
    key = df.columns[0]
    whole = read_table(spark, SF_SMALL, "pages" if key == "page_id" else "documents").select(key)
    assert rows(df.select(key)) == rows(whole)


def test_packing_covers_every_document(spark):
    pieces = registry.queries()["op12_bm25_packing"](spark, SF_SMALL).collect()
    tokens, got = {}, {}
    for p in pieces:
        got[p.doc_id] = got.get(p.doc_id, 0) + p.length
        tokens[p.doc_id] = p.doc_tokens
    assert got == tokens
    assert sorted(got) == sorted(r.doc_id for r in read_table(spark, SF_SMALL, "documents").select("doc_id").collect())


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    docs = read_table(spark, SF_SMALL, "documents")
    assert out.columns == [*docs.columns, "shard", "slot"]
    got = out.collect()
    assert {r.shard for r in got} <= set(range(40))
    assert {tuple(r)[:len(docs.columns)] for r in got} <= {tuple(r) for r in docs.collect()}
    by_id = {}
    for r in got:
        by_id[r.doc_id] = by_id.get(r.doc_id, 0) + 1
    assert max(by_id.values()) <= 2


def test_stages_keep_columns_and_take_odd_rows(spark, clashing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing, SF_SMALL).columns == clashing.columns, name
    assert [c for c in corpus_pipeline.shard(spark, clashing, SF_SMALL).columns][-2:] == ["_shard", "_slot"]


def test_stages_take_an_empty_table(spark, no_docs):
    docs = no_docs
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0, name
