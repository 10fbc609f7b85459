"""From documents to packed training sequences: five of the operators, one after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm.line_dedup import dedup_lines
from assay.llm.mixing import mix_sources
from assay.llm.ngram_join import keep_one_of_each
from assay.llm.packing import pack_documents
from assay.llm.queries import table, tokenizer_file
from assay.llm.shared import all_columns, stored
from assay.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return keep_clean(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier run go; every document stays, with its length anew."""
    return dedup_lines(docs).withColumn(
        "n_chars", F.length("text").cast("long")
    ).select(*all_columns(docs))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; documents of small sources up to twice. In the mixture's
    order."""
    mixed = mix_sources(docs, max_passes=2.0)
    mix_pass, *_, position = mixed.columns[len(docs.columns):]
    ordered = mixed.orderBy(position, mix_pass, F.xxhash64("doc_id", "text"))
    return ordered.select(*all_columns(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 token ids, a row per piece."""
    return pack_documents(docs, tokenizer_file())


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("mixing", mixing),
    ("packing", packing),
]

# A classifier and a tokenizer have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread by the next."""
    docs = table(spark, sf_dir, "documents")
    *others, (_, last) = STAGES
    for name, stage in others:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return last(spark, docs, sf_dir)
