"""Foreign-key checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """The non-NULL keys, each once; repeats are dropped on the map side first."""
    return df.where(F.col(key).isNotNull()).select(key).distinct()


def flag_existing(
    child: DataFrame, parent: DataFrame, key: str, flag: str, parent_is_unique: bool = False
) -> DataFrame:
    """Left-join a TRUE marker for child rows whose key is in ``parent``; the key moves first.

    Pass ``parent_is_unique`` for a table that holds each key once, such as the valid side of a
    deduplicated table. The join then reads bare exchanges on both sides, the form in which
    adaptive execution splits a skewed child partition: a parent key, or NULL, that owns a third
    of the child rows is spread over many tasks.
    """
    keys = parent.select(key) if parent_is_unique else distinct_keys(parent, key)
    return child.join(keys.withColumn(flag, F.lit(True)), on=key, how="left")


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose non-NULL key is missing from ``parent``."""
    return child.where(F.col(key).isNotNull()).join(parent.select(key), on=key, how="left_anti")
