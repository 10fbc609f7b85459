"""Tables in hash shards of their key, of which single shards are replaced; bucketed tables.

A shard is a folder ``_shard=<number>``. New shards are written in full beside the table, then the
folder is renamed to ``_ready-<table>``, and only then is shard after shard moved to its place. A
driver that dies before that rename has changed nothing; one that dies after it leaves the rest of
the shards in the ready folder, and ``roll_forward`` moves them, however often it is called. Readers
that list the table during the moves may miss a shard; they read again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Collection, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from assay.sources.folders import (
    exists, make_folder, move, publish, remove, require_committed, subfolders,
)
from assay.sources.sinks import COMPRESSION, releasing_shuffles, save

SHARD = "_shard"
SIDE = "_is_valid"


def shard_of(key: str, shards: int) -> Column:
    """Shard of a row; rows without key share one. A table holds each key once, so shards are even."""
    return F.pmod(F.hash(key), F.lit(shards))


def in_shards(rows: DataFrame, key: str, shards: int) -> DataFrame:
    return rows.withColumn(SHARD, shard_of(key, shards))


def shard_groups(numbers: Sequence[int], groups: int) -> list[list[int]]:
    """The shard numbers in so many groups of nearly equal size, none of them empty."""
    return [list(numbers[i::groups]) for i in range(min(groups, len(numbers)))]


def laid_by_shard(rows: DataFrame) -> DataFrame:
    """A task holds whole shards, or of a large shard a part."""
    return rows.hint("rebalance", SHARD)


def write_shards(rows: DataFrame, path: str) -> None:
    save(rows, path, "append", by=[SHARD, SIDE])


def create_shards(rows: DataFrame, path: str, shards: int) -> None:
    """Put a whole table in the place of ``path``."""
    create_in_parts(rows.sparkSession, [rows], path)


def create_in_parts(
    spark: SparkSession, parts: Iterable[DataFrame], path: str,
    staged_table: Callable[[str], None] = lambda staged: None,
) -> None:
    """Put a whole table in the place of ``path``, written part after part. ``staged_table`` gets the
    folder of the written table before that."""

    def write(staged: str) -> None:
        for rows in parts:
            write_shards(laid_by_shard(rows), staged)
        staged_table(staged)

    publish(spark, path, write)


def ready_folder(path: str) -> str:
    parent, _, name = path.rpartition("/")
    return f"{parent}/_ready-{name}"


def replace_shards(rows: DataFrame, path: str, touched: Collection[int]) -> None:
    """Put ``rows`` in the place of the touched shards; one without rows becomes empty."""
    spark = rows.sparkSession
    parent, _, name = path.rpartition("/")
    staged = f"{parent}/_staged-{name}-{uuid.uuid4().hex}"
    try:
        write_shards(rows, staged)
        written = set(subfolders(spark, staged))
        for number in touched:
            if f"{SHARD}={number}" not in written:
                make_folder(spark, f"{staged}/{SHARD}={number}")
        move(spark, staged, ready_folder(path))
    except BaseException:
        remove(spark, staged)
        raise
    roll_forward(spark, path)


def roll_forward(spark: SparkSession, path: str) -> bool:
    """Finish a replacement that has begun; False if there is none."""
    ready = ready_folder(path)
    if not exists(spark, ready):
        return False
    for shard in subfolders(spark, ready):
        remove(spark, f"{path}/{shard}")
        move(spark, f"{ready}/{shard}", f"{path}/{shard}")
    remove(spark, ready)
    return True


def read_shards(
    spark: SparkSession, path: str, schema: StructType, touched: Collection[int] | None = None
) -> DataFrame:
    """The table with its ``_shard``; with ``touched`` only the files of these shards."""
    require_committed(spark, path)
    rows = spark.read.schema(StructType([*schema.fields]).add(SHARD, IntegerType())).parquet(path)
    if touched is not None:
        rows = rows.where(F.col(SHARD).isin(sorted(touched)))
    return rows.select(*schema.fieldNames(), SHARD)


# --- bucketed tables -------------------------------------------------------------------------

def table_name(path: str, purpose: str) -> str:
    """Name in the session's catalog for a bucketed folder."""
    return f"assay_{purpose}_{hashlib.md5(path.encode()).hexdigest()}"


def write_bucketed(rows: DataFrame, path: str, key: str, buckets: int) -> None:
    """Put ``rows`` in the place of ``path``, in buckets of the key. Rows that already lie in one
    task per bucket give one file per bucket."""
    spark = rows.sparkSession

    def write(staged: str) -> None:
        name = table_name(staged, "staged")
        writer = rows.write.format("parquet").bucketBy(buckets, key).option("path", staged)
        try:
            with releasing_shuffles(spark):
                writer.option("compression", COMPRESSION).saveAsTable(name)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")

    publish(spark, path, write)


def read_bucketed(
    spark: SparkSession, path: str, schema: StructType, key: str, buckets: int
) -> DataFrame:
    """The bucketed folder, known to Spark as partitioned by the key."""
    require_committed(spark, path)
    name = table_name(path, "bucketed")
    columns = ", ".join(f"`{column.name}` {column.dataType.simpleString()}" for column in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    spark.catalog.refreshTable(name)
    return spark.table(name)
