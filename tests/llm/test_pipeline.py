"""Registered queries with SQL, and the pipeline's stages and result."""

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from assay.llm import queries
from checks.compare import connect, differences


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, name):
    found = queries.QUERIES[name](spark, sf_dir)
    assert differences(found, connect(sf_dir), queries.SQL[name]) == []


def test_one_query_per_operator_and_the_pipeline():
    names = entry_points.queries()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_columns_and_rows_of_their_input(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = []
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "ngram_join", "mixing", "packing"]
    for name in ("toxicity", "line_dedup", "ngram_join", "mixing"):
        known = {r["doc_id"] for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.stored(stages[name](spark, docs, sf_dir), f"test-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert {r["doc_id"] for r in docs.select("doc_id").collect()} <= known
        counts.append(docs.count())
    clean, deduped, distinct, mixed = counts
    assert clean == deduped > distinct > 0.5 * clean and mixed > distinct
    packed = stages["packing"](spark, docs, sf_dir)
    ends = packed.where("start + length = doc_tokens").count()
    assert ends == mixed


def test_run_goes_from_documents_to_sequences(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(rows.columns)
    assert rows.groupBy("sequence_id").agg({"length": "sum"}).where("`sum(length)` > 2048").isEmpty()
