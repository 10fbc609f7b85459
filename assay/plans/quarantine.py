"""Cells of landed files that are not what the schema says, kept with their text.

A number that cannot be read becomes NULL in bronze, and NULL passes most rules. The scan that
appends a batch also counts the records that do not fit the schema; only a batch that has some is
read once more, and its bad cells go to a table beside bronze, in a folder of the batch that is
written as a whole however often.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from assay.plans.clock import NOW, Clock
from assay.sources.folders import exists
from assay.sources.specs import SOURCES, SourceSpec
from assay.sources.tables import RECORD_TEXT, read_csv

CELLS = (
    "column_name STRING, cell_text STRING, first_cell STRING, record_text STRING, "
    "_ingestion_timestamp TIMESTAMP, "
    "_source_file STRING, _batch_id STRING"
)


def quarantine_path(bronze: str, feed: str) -> str:
    return f"{bronze}_quarantine/{feed}"


def malformed_cells(feed: DataFrame, schema: StructType, clock: Clock = NOW) -> DataFrame:
    """One row per cell of ``feed`` that has text but no value of its type, with the record's text
    and its first cell, which is the key in most feeds.

    A record with too few or too many cells and no other fault gives one row without a column.
    """
    typed = [column.name for column in schema if not isinstance(column.dataType, StringType)]
    texts = ", ".join(f"`{column.name}` STRING" for column in schema)
    raw = F.from_csv(F.col(RECORD_TEXT), texts)
    bad = F.filter(
        F.array(*[
            F.when(
                raw[name].isNotNull() & F.col(name).isNull(),
                F.struct(F.lit(name).alias("column_name"), raw[name].alias("cell_text")),
            ) for name in typed
        ]) if typed else F.array().cast("array<struct<column_name:string,cell_text:string>>"),
        lambda cell: cell.isNotNull(),
    )
    none = F.array(F.struct(
        F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("cell_text")
    ))
    return feed.where(F.col(RECORD_TEXT).isNotNull()).select(
        F.explode(F.when(F.size(bad) > 0, bad).otherwise(none)).alias("cell"),
        F.col(schema.fieldNames()[0]).alias("first_cell"), F.col(RECORD_TEXT).alias("record_text"),
        clock.now().alias("_ingestion_timestamp"),
        F.col("_metadata.file_path").alias("_source_file"),
    ).select("cell.*", "first_cell", "record_text", "_ingestion_timestamp", "_source_file")


def quarantine_batch(
    spark: SparkSession, spec: SourceSpec, paths: str | list[str], bronze: str, batch_id: str,
    clock: Clock = NOW,
) -> None:
    """Read the files of a batch for its malformed cells, and write those."""
    feed = read_csv(spark, paths, spec.schema, with_text=True)
    path = f"{quarantine_path(bronze, spec.feed)}/_batch_id={batch_id}"
    malformed_cells(feed, spec.schema, clock).write.mode("overwrite").parquet(path)


def read_quarantine(spark: SparkSession, bronze: str, feed: str) -> DataFrame:
    """The malformed cells of a feed; none if there never was one."""
    path = quarantine_path(bronze, feed)
    if not exists(spark, path):
        return spark.createDataFrame([], CELLS)
    return spark.read.schema(CELLS).parquet(path)


def malformed_counts(
    spark: SparkSession, bronze: str, specs: Sequence[SourceSpec] = SOURCES
) -> DataFrame:
    """``source_name, column_name, malformed_cells`` of all batches."""
    parts = [
        read_quarantine(spark, bronze, spec.feed).select(
            F.lit(spec.name).alias("source_name"), "column_name"
        )
        for spec in specs
    ]
    return reduce(DataFrame.union, parts).groupBy("source_name", "column_name").agg(
        F.count(F.lit(1)).alias("malformed_cells")
    )
