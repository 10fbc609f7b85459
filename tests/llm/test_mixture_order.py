"""Every part of the mixture holds the sources in their weights."""

import pytest
from pyspark.sql import functions as F

from assay.llm.mixing import BLOCK_TOKENS, mix_sources
from assay.llm.queries import op2_mixing
from assay.llm.shared import ship_package


def shares_of_fifths(rows):
    fifth = F.floor(F.col("mix_position") * 5).cast("int").alias("fifth")
    found = {}
    for row in rows.groupBy("source", fifth).agg(F.sum("mix_tokens").alias("tokens")).collect():
        found.setdefault(row["fifth"], {})[row["source"]] = row["tokens"]
    whole = {}
    for sources in found.values():
        for source, tokens in sources.items():
            whole[source] = whole.get(source, 0) + tokens
    return found, whole


def check(rows, points):
    found, whole = shares_of_fifths(rows)
    assert sorted(found) == [0, 1, 2, 3, 4]
    total = sum(whole.values())
    for fifth, sources in found.items():
        size = sum(sources.values())
        assert abs(size / total - 0.2) < points
        for source, tokens in whole.items():
            assert abs(sources.get(source, 0) / size - tokens / total) < points, (fifth, source)


@pytest.mark.parametrize("block_tokens", [BLOCK_TOKENS, 2000])
def test_fifths_hold_the_weights(spark, block_tokens):
    ship_package(spark)
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 20 == 0, "small").when(F.col("id") % 4 == 0, "middle")
        .otherwise("large").alias("source"),
        F.repeat(F.lit("word "), (F.col("id") % 7 + 1).cast("int")).alias("text"),
    )
    mixed = mix_sources(rows, max_passes=2.0, block_tokens=block_tokens)
    check(mixed, 0.02)
    low, high = mixed.agg(F.min("mix_position"), F.max("mix_position")).first()
    assert 0 <= low and high < 1


def test_fifths_of_the_query_hold_the_weights(spark):
    """At sf0.01, where a few long documents make up much of a source."""
    check(op2_mixing(spark, "/root/testdata/sf0.01"), 0.06)
