"""Rows that stand for files, blocks or queries are spread over tasks."""

import public_tokenizers
from pyspark.sql import functions as F

from assay.llm import token_scan, warc
from assay.llm.shared import ship_package, tasks_for
from assay.session import new_run_root

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_numbers_of_tasks(spark):
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert tasks_for(spark, 0, 8) == 1
    assert tasks_for(spark, 3, 8) == min(3, usual)
    assert tasks_for(spark, 8 * 1000, 8) == max(usual, 1000)


def tasks_with_rows(df):
    return df.select(F.spark_partition_id().alias("task")).distinct().count()


def test_many_small_files_are_read_by_many_tasks(spark, monkeypatch):
    """More tasks than cores, though the rows to shuffle are a few names."""
    monkeypatch.setattr(token_scan, "BLOCKS_A_TASK", 4)
    monkeypatch.setattr(warc, "FILES_A_TASK", 1)
    ship_package(spark)
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("some words here "), 60).alias("text")
    )
    files = token_scan.write_token_files(docs.repartition(8), new_run_root(spark, "t"), PATH)
    blocks = token_scan.scan_blocks(
        files.where("ordinal IS NULL"), token_scan.END_OF_DOCUMENT, 1024
    )
    assert blocks.count() > 64 and tasks_with_rows(blocks) > 8
    pages = spark.range(600).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://a.b/"), "id").alias("url"),
        F.sha2(F.col("id").cast("string"), 256).alias("html"),
    )
    folder = new_run_root(spark, "w")
    written = warc.write_archives(pages, folder, shard_bytes=2000, file_bytes=3000)
    assert written.count() > 16
    records = warc.read_archives(spark, folder)
    assert records.count() == 600 and tasks_with_rows(records) > 8
