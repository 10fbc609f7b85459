"""Filtering stages lose no document that they have no reason to reject."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assay.llm import line_dedup, mixing, ngram_join, packing, toxicity
from assay.llm.shared import ship_package, stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = "doc_id long, text string, lang string, score string, own_id string, `a.b` string, own_key int"


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def texts_with_key_order():
    """Two texts without common words, the one with the smaller key first."""
    texts = ["alpha beta gamma delta epsilon zeta", "one two three four five six seven"]
    return sorted(texts, key=lambda text: hashlib.md5(f"={text}".encode()).hexdigest())


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("swap", [False, True])
def test_every_text_of_an_id_is_judged(spark, swap):
    a, b = texts_with_key_order()[:: -1 if swap else 1]
    kept = ngram_join.keep_one_of_each(documents(spark, [(1, b), (2, b), (2, a)])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, b), (2, a)]
    kept = ngram_join.keep_one_of_each(documents(spark, [(1, a), (2, a), (2, b)])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(1, a), (2, b)]


def test_copies_among_further_texts_go(spark):
    a, b = texts_with_key_order()
    rows = [(7, a), (7, b), (7, b), (8, a), (8, b), (9, b), (None, a), (7, None), (8, "")]
    kept = ngram_join.keep_one_of_each(documents(spark, rows)).collect()
    texts = sorted(r["text"] or "" for r in kept if r["doc_id"] is not None)
    assert texts == sorted(["", a, b])
    assert sum(r["doc_id"] is None for r in kept) == 1


def test_stage_and_columns_of_any_name(spark):
    a, b = texts_with_key_order()
    rows = [(1, a, "en", "mine", "x", "y", 3), (2, b, None, None, None, None, None),
            (3, a, "en", "other", "x", "y", 4)]
    table = spark.createDataFrame(rows, ODD)
    kept = ngram_join.keep_one_of_each(table)
    assert kept.schema == table.schema and sorted(map(tuple, kept.collect())) == rows[:2]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    clean = toxicity.keep_clean(table, labels)
    assert clean.columns == table.columns and sorted(map(tuple, clean.collect())) == rows


@pytest.mark.parametrize("marks", [[], [1], [0], [1] * 9, [0] * 9, [None, None]])
def test_without_labels_of_both_kinds_nothing_is_rejected(spark, sf_dir, tmp_path, marks):
    rows = [(i, f"quiet words about garden number {i} and nothing else") for i in range(10)]
    labels = [(i, 1, mark) for i, mark in enumerate(marks)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    docs = documents(spark, rows)
    kept = corpus_pipeline.toxicity(spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in kept.collect()} == set(range(10))
    scores = toxicity.score_toxicity(
        docs, spark.read.parquet(str(tmp_path / "labels.parquet"))
    ).collect()
    assert not any(r["rejected"] for r in scores)


CLASHING = (
    "doc_id long, text string, source string, lang string, n_chars long, removed_lines string, "
    "mix_pass string, Mix_Block int, mix_tokens int, mix_position int, `a.b` string, `c``d` int"
)


def test_columns_with_the_names_of_results_stay(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    line = " ".join(f"word{i}" for i in range(60))
    mine = ("mine", "mine", 5, 6, 7, "dot", 8)
    rows = [(1, line, "s", "en", 1, *mine), (2, f"{line}\nnew", "s", "en", 1, *mine), (3, None, None, None, 1, *mine)]
    table = spark.createDataFrame(rows, CLASHING)
    deduplicated = line_dedup.dedup_lines(table)
    assert deduplicated.columns == [*table.columns, "removed_lines_"]
    assert {r["doc_id"]: r["removed_lines_"] for r in deduplicated.collect()} == {
        1: [], 2: [0], 3: [],
    }
    mixed = mixing.mix_sources(table)
    assert mixed.columns == [
        *table.columns, "mix_pass_", "mix_block_", "mix_tokens_", "mix_position_",
    ]
    assert {(r["mix_pass"], r["Mix_Block"], r["a.b"]) for r in mixed.collect()} == {
        ("mine", 5, "dot"),
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, table, str(tmp_path))
        assert found.columns == table.columns, name
        assert {tuple(r)[5:] for r in found.collect()} == {mine}, name
    assert corpus_pipeline.packing(spark, table, str(tmp_path)).count() == 3


def test_more_pieces_have_more_buckets_and_the_same_fill(spark, monkeypatch):
    """A bin is ranked whole whatever the buckets."""
    pieces = stored(spark.range(3000).selectExpr(
        "id AS doc_id", "0L AS start", "1 + id % 7 * 100 AS length", "id AS ids_crc32",
        "1 + id % 7 * 100 AS doc_tokens",
    ), "pieces")
    monkeypatch.setattr(packing, "PIECES_A_BUCKET", 5)
    found = packing.pack_pieces(pieces)
    few = packing.pack_pieces(pieces, rank_buckets=2)
    assert found.count() == few.count() == 3000
    sizes = [
        sorted(r["size"] for r in df.groupBy("sequence_id").agg(
            F.sum("length").alias("size"), F.max(F.col("offset") + F.col("length")).alias("end")
        ).where("size = end").collect())
        for df in (found, few)
    ]
    assert sizes[0] == sizes[1] and max(sizes[0]) <= 2048 and sum(sizes[0]) == sum(
        1 + i % 7 * 100 for i in range(3000)
    )


def test_empty_tables_through_the_stages(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet")
    )
    docs = documents(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, str(tmp_path))
        assert found.count() == 0, name
