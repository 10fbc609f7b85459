"""The last, partial pass over a source, and the order of the mixture."""

import corpus_pipeline
from assay.llm import mixing

SCHEMA = "doc_id long, text string, source string"


def test_documents_that_do_not_fit_shut_out_no_others(spark):
    """Wherever the long ones come in hash order, less than a small document is missing."""
    sizes = [4, 5, 6] * 40 + [900, 500, 130]
    total = sum(sizes)
    rows = [(i, " ".join([f"w{i}"] * n), "s") for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for budget in (140.0, 450.0, 700.0):
        found = mixing.mix_sources(docs, max_passes=1.0, budget_tokens=budget).collect()
        taken = sum(r["mix_tokens"] for r in found)
        assert budget - 6 < taken <= budget < total
        assert len({r["doc_id"] for r in found}) == len(found)


def test_the_pipeline_s_mixture_is_in_order(spark):
    rows = [(i, " ".join([f"w{i}"] * 9), "abc"[i % 11 % 3]) for i in range(150)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    mixed = mixing.mix_sources(docs, max_passes=2.0).collect()
    places = sorted(
        (r["mix_position"], r["mix_pass"], r["source"]) for r in mixed
    )
    found = corpus_pipeline.mixing(spark, docs, "")
    assert found.columns == docs.columns
    sources = [r["source"] for r in found.collect()]
    assert len(sources) == len(places)
    seen = {}
    for position, mix_pass, source in places:
        seen.setdefault((position, mix_pass), []).append(source)
    at = 0
    for stretch in seen.values():
        assert sorted(sources[at: at + len(stretch)]) == sorted(stretch)
        at += len(stretch)
