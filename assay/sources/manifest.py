"""Which landed files of a feed have been ingested.

A batch first lists the files it is going to read (``planned``) and, once its rows are in bronze,
marks itself finished (``finished``). Files of finished batches are not new. A batch that was
planned but not marked is looked up in bronze: its rows are appended by one job, all or none, so
they are there if and only if the job had finished.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.sources.tables import (
    append_packed, feed_glob, read_if_present, read_log, rows_of_batches,
)

FILE_KEYS = ("path", "length", "modificationTime")
PLANNED = "path STRING, length BIGINT, modificationTime TIMESTAMP, batch_id STRING"
FINISHED = "batch_id STRING"


def landed_files(spark: SparkSession, landing: str, feed: str) -> DataFrame:
    """Path, size and time of every landed file of a feed; lists files, opens none."""
    return spark.read.format("binaryFile").load(feed_glob(landing, feed)).select(*FILE_KEYS)


class Manifest:
    """The list of one feed's ingested files, below a folder of its own."""

    def __init__(self, spark: SparkSession, root: str, feed: str):
        self.spark = spark
        self.planned = f"{root}/{feed}/planned"
        self.finished = f"{root}/{feed}/finished"

    def recover(
        self, bronze_table: str, complete: Callable[[str], None] = lambda batch_id: None
    ) -> None:
        """Mark the batches finished whose rows reached bronze before their run died; ``complete``
        does before what else the run owed for a batch."""
        open_batches = self._planned().select("batch_id").distinct().join(
            self._finished(), "batch_id", "left_anti"
        ).collect()  # one name for each run that died since the last recovery
        rows = read_if_present(self.spark, bronze_table)
        if rows is None or not open_batches:
            return
        arrived = rows_of_batches(rows, [row["batch_id"] for row in open_batches]).select(
            F.col("_batch_id").alias("batch_id")
        ).distinct()
        for row in arrived.collect():
            complete(row["batch_id"])
            self.finish(row["batch_id"])

    def _planned(self) -> DataFrame:
        return read_log(self.spark, self.planned, PLANNED)

    def _finished(self) -> DataFrame:
        return read_log(self.spark, self.finished, FINISHED)

    def new_files(self, landed: DataFrame) -> DataFrame:
        """The landed files that no finished batch has read, whatever their age."""
        done = self._planned().join(self._finished(), "batch_id", "left_semi")
        return landed.join(done.select(*FILE_KEYS).distinct(), list(FILE_KEYS), "left_anti")

    def plan(self, files: DataFrame, batch_id: str) -> None:
        append_packed(files.withColumn("batch_id", F.lit(batch_id)), self.planned)

    def batch_files(self, batch_id: str) -> DataFrame:
        return self._planned().where(F.col("batch_id") == batch_id)

    def finished_batches(self) -> DataFrame:
        """Batches whose rows are in bronze, as far as they were marked."""
        return self._finished().select("batch_id").distinct()

    def finish(self, batch_id: str) -> None:
        row = self.spark.range(0, 1, 1, 1).select(F.lit(batch_id).alias("batch_id"))
        append_packed(row, self.finished)
