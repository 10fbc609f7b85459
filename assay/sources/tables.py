"""Scans and sinks of the landing, bronze, silver and gold layers."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from assay.operators.quality import rejected, valid
from assay.sources.folders import (
    data_files, move, publish, remove, require_committed, restore,
)
from assay.sources.sinks import releasing_shuffles, save
from assay.sources.versions import current, is_versioned, present, publish_version

CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
FILE_BYTES = 128 << 20
RECORD_TEXT = "_record_text"
MOST_FILES_PER_NEEDED = 16


# --- landing ---------------------------------------------------------------------------------

def feed_glob(landing: str, feed: str) -> str:
    return f"{landing}/{feed}/*.csv"


def literal_path(path: str) -> str:
    """A path in which no character is a wildcard."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType, with_text: bool = False
) -> DataFrame:
    """Headered CSV with a declared schema: columns by position, bad numbers become NULL.

    ``with_text`` adds the text of records that do not fit the schema as ``RECORD_TEXT``.
    """
    reader = spark.read.option("header", True)
    if with_text:
        # A pruned scan does not see records with too few or too many cells.
        reader = reader.option("columnNameOfCorruptRecord", RECORD_TEXT).option(
            "columnPruning", False
        )
        schema = StructType([*schema.fields]).add(RECORD_TEXT, StringType())
    return reader.schema(schema).csv(path)


def read_feed(
    spark: SparkSession, landing: str, feed: str, schema: StructType, with_text: bool = False
) -> DataFrame:
    """Every drop of a feed. A drop is a CSV file or a ``.csv`` folder of part files."""
    return read_csv(spark, feed_glob(landing, feed), schema, with_text)


def write_drop(df: DataFrame, landing: str, feed: str, stamp: datetime) -> str:
    """Write one timestamped drop of a feed and return its path; texts keep their blanks.

    Part files are compressed. Each is read by one task, and holds what one task wrote.
    """
    path = f"{landing}/{feed}/{feed}_{stamp:%Y%m%d_%H%M%S}.csv"
    with releasing_shuffles(df.sparkSession):
        (
            df.write.mode("errorifexists")
            .option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .option("compression", "gzip")
            .csv(path)
        )
    return path


def drop_path(feed: str, file_path: Column) -> Column:
    """Drop that a file belongs to: the path up to the ``.csv`` entry below the feed folder."""
    return F.regexp_extract(file_path, rf"^(.*/{feed}/[^/]+\.csv)(/.*)?$", 1)


def latest_drop(spark: SparkSession, landing: str, feed: str) -> str:
    """Path of the drop whose name sorts last. Lists files, opens none."""
    files = spark.read.format("binaryFile").load(feed_glob(landing, feed)).select("path")
    newest = files.agg(F.max(drop_path(feed, F.col("path"))).alias("path")).first()
    if newest is None or newest["path"] is None:
        raise FileNotFoundError(f"no drop of {feed} under {landing}")
    return newest["path"]


def read_latest_drop(
    spark: SparkSession, landing: str, feed: str, schema: StructType
) -> DataFrame:
    return read_csv(spark, latest_drop(spark, landing, feed), schema)


# --- bronze ----------------------------------------------------------------------------------

def rows_of_batches(bronze: DataFrame, batches: Iterable[str]) -> DataFrame:
    """The rows of some batches. A bronze file holds rows of one batch, so the scan skips the files
    of all others by their statistics, without reading a row of them."""
    return bronze.where(F.col("_batch_id").isin(list(batches)))


# --- publishing ------------------------------------------------------------------------------

def publish_table(
    spark: SparkSession, path: str, write: Callable[[str], None], versioned: bool
) -> None:
    """Replace the table at ``path`` in its place, or as a new version if ``versioned``.

    A table that has versions gets a further one in any case.
    """
    if versioned or is_versioned(spark, path):
        publish_version(spark, path, write)
    else:
        publish(spark, path, write)


# --- silver ----------------------------------------------------------------------------------

def write_graded(
    graded: DataFrame | Sequence[DataFrame], path: str, versioned: bool = False
) -> None:
    """Write valid and rejected rows in one pass, as two partitions, and publish them together.

    The rows are computed once; parts of a table are written one after the other. The table at ``path`` is replaced as a whole when both sides are
    written, so a failed run leaves the old table, and a run without rejects the old rejects not.
    """
    parts = [graded] if isinstance(graded, DataFrame) else graded
    spark = parts[0].sparkSession
    # With as many writers as there are sides, a task writes both at once instead of sorting
    # all its wide rows by side first.
    if int(spark.conf.get(CONCURRENT_WRITERS, "0")) < 2:
        spark.conf.set(CONCURRENT_WRITERS, "2")

    def write(staged: str) -> None:
        for part in parts:
            save(part, staged, "append", by=["_is_valid"])
        compact(spark, f"{staged}/_is_valid=false")

    publish_table(spark, path, write, versioned)


def compact(spark: SparkSession, path: str) -> None:
    """Write a folder of many small files anew if it has far more than its size needs."""
    files, size = data_files(spark, path)
    needed = max(1, -(-size // FILE_BYTES))
    if files > MOST_FILES_PER_NEEDED * needed:
        packed = f"{path.rpartition('/')[0]}/_packed"
        save(spark.read.parquet(path).coalesce(needed), packed)
        remove(spark, path)
        move(spark, packed, path)


def append_packed(rows: DataFrame, path: str) -> None:
    """Append the few rows of one event to a log that one run writes at a time.

    A log whose files are far more than its bytes need is written anew as a whole, so that the
    number of its files follows its bytes and not the number of runs.
    """
    spark = rows.sparkSession
    restore(spark, path)
    rows.write.mode("append").parquet(path)
    files, size = data_files(spark, path)
    needed = max(1, -(-size // FILE_BYTES))
    if files > MOST_FILES_PER_NEEDED * needed:
        publish(
            spark, path,
            lambda staged: spark.read.parquet(path).coalesce(needed).write.parquet(staged),
        )


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of such a log; none before its first event."""
    restore(spark, path)
    rows = read_if_present(spark, path, StructType.fromDDL(schema))
    return spark.createDataFrame([], schema) if rows is None else rows


def read_graded(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Both sides, columns in the order they were graded in."""
    path = current(spark, path)
    require_committed(spark, path)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_valid(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Valid side; only its files are listed into the scan."""
    return valid(read_graded(spark, path, schema))


def read_rejected(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return rejected(read_graded(spark, path, schema))


# --- gold and inspection ---------------------------------------------------------------------

def write_table(df: DataFrame, path: str, versioned: bool = False) -> None:
    """Replace the table at ``path`` once its rows are written; a failed run leaves the old one."""
    publish_table(df.sparkSession, path, lambda staged: save(df, staged), versioned)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at ``path``, whether in place or in versions."""
    path = current(spark, path)
    require_committed(spark, path)
    return spark.read.parquet(path)


def read_if_present(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """The Parquet table at ``path``, None when there is no such path.

    A folder that no finished job has written is an error, not an empty table.
    """
    path = present(spark, path)
    if path is None:
        return None
    require_committed(spark, path)
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def table_profile(tables: Iterable[tuple[str, DataFrame]]) -> DataFrame:
    """Schema and row count of several tables: one row per column, one job for all."""
    profiles = []
    for name, df in tables:
        columns = F.array(*[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(column.name).alias("column_name"),
                F.lit(column.dataType.simpleString()).alias("data_type"),
            )
            for position, column in enumerate(df.schema)
        ])
        profiles.append(
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), F.inline(columns), "row_count"
            )
        )
    result = profiles[0]
    for profile in profiles[1:]:
        result = result.unionByName(profile)
    return result


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """A few rows to look at, in no order."""
    return df.limit(rows)
