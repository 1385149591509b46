"""The corpus pipeline and the registered queries."""

import os
import sys

import duckdb
import pytest
from llm_fixtures import SF001

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from revlens.llm import common, decontam, exact_dedup, ngram_join, packing, quality_crf  # noqa: E402
from revlens.llm import queries as llm_queries  # noqa: E402


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    benchmark, labels = (spark.read.parquet(f"{SF001}/{t}.parquet") for t in ("benchmark", "labels"))
    scored = quality_crf.quality(docs, labels)
    kept = ids(scored.where("predicted = 1"))
    assert 0 < len(kept) < docs.count()
    stage, columns = docs, docs.columns
    wanted = [
        lambda d: kept,
        lambda d: ids(exact_dedup.exact_groups(d, keep="smallest").where("kept")),
        lambda d: ids(ngram_join.near_duplicates(d).where("doc_id = component_id")),
        lambda d: sorted(set(ids(d)) - {r.doc_id for r in decontam.contaminated(d, benchmark).collect()})]
    for (name, fn), expect in zip(corpus_pipeline.STAGES, wanted, strict=False):
        out = common.scratch(fn(spark, stage, SF001), "test-stage")
        assert ids(out) == expect(stage), name
        assert out.columns == columns
        stage = out
    final = corpus_pipeline.STAGES[-1][1](spark, stage, SF001).toPandas()
    assert sorted(final.doc_id.unique()) == ids(stage)
    assert sorted(corpus_pipeline.run(spark, SF001).toPandas().doc_id.unique()) == ids(stage)
    assert packing.WINDOW == 2048


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, fn in corpus_pipeline.STAGES:
        docs = common.scratch(fn(spark, docs, SF001), "test-empty")
        assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(llm_queries.all_oracles()))
def test_query_equals_its_sql(spark, name):
    got = llm_queries.all_queries()[name](spark, SF001).toPandas()
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    expected = con.execute(llm_queries.all_oracles()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(expected.columns)
    rows = lambda df: sorted(df[columns].astype(str).values.tolist())
    assert rows(got) == rows(expected)
