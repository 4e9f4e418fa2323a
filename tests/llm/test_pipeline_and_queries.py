"""The registered queries, their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF001, SF01
from datescore.llm.catalog import QUERIES, SQL
from tools.check_oracle import canon, duck, type_differences


def test_all_queries_are_registered():
    assert sorted(QUERIES, key=lambda q: int(q[2:].split("_")[0])) == list(QUERIES) and len(QUERIES) == 13
    assert set(entry.queries()) >= {*QUERIES, "pipeline"} and set(entry.oracle_sql()) >= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    df = QUERIES[name](spark, SF01)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    r = duck(SF01).sql(SQL[name])
    assert type_differences(df.dtypes, r.columns, r.types) == {}
    assert got == canon(r.columns, r.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_covers_its_table(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op5_") else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(f"{SF001}/{table}.parquet").select(key).collect()}
    assert {r[0] for r in QUERIES[name](spark, SF001).select(key).collect()} == ids


def test_stages_work_on_what_their_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns, size = docs.columns, docs.count()
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "pii", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.written(stage(spark, docs, SF001), f"test-{name}")
        assert docs.columns == columns
        kept = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept <= ids and (name != "pii" or kept == ids)
        if name == "exact_dedup":
            texts = [r.text for r in docs.select("text").collect()]
            assert len({"".join(t.split()) for t in texts}) == len(texts)
        if name == "pii":
            from datescore.llm.pii import base_spans

            assert not any(base_spans(r.text) for r in docs.select("text").collect())
    assert 0 < docs.count() < size
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF001)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_take_awkward_rows_and_empty_tables(spark, monkeypatch):
    """Nulls, repeated rows and ids, very long texts; then no rows at all: every stage runs, and keeps the columns."""
    from llm_corpus import empty, frame

    docs = frame(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for start in (docs, empty(spark).select(*docs.columns)):
        table, size = start, start.count()
        for name, stage in corpus_pipeline.STAGES:
            table = corpus_pipeline.written(stage(spark, table, SF001), f"odd-{name}")
            if name != "packing":
                assert table.columns == docs.columns
            if name == "near_dedup":
                texts = [r.text for r in table.select("text").collect()]
                assert len({"".join((t or "").split()) for t in texts}) == len(texts)
        assert bool(table.count()) == bool(size)
