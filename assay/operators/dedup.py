"""Latest-version and one-per-key selection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def descending(columns: Iterable[str]) -> list[Column]:
    return [F.col(name).desc_nulls_last() for name in columns]


def first_per_key(df: DataFrame, keys: Sequence[str], ordering: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``ordering``; NULL keys form one group.

    ``row_number() = 1`` is planned as a partial group limit before the shuffle, so each map
    task sends at most one row per key. A key that holds a third of the rows therefore costs
    its reducer one row per map task, not a third of the table.
    """
    rank = "_rank_in_key"
    window = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) == 1).drop(rank)


def latest_per_key(
    df: DataFrame, key: str, order_column: str, tie_break: Sequence[str]
) -> DataFrame:
    """Newest row per key. ``tie_break`` makes the order total, so reruns keep the same row.

    The key's hash leads the partitioning columns: keys like ``ORD000000001`` share their first
    bytes, and sorting on a number first settles nearly every comparison without reading them.
    """
    digest = "_key_hash"
    rest = [name for name in tie_break if name not in (key, order_column)]
    hashed = df.withColumn(digest, F.xxhash64(key))
    ordering = descending([order_column, *rest])
    return first_per_key(hashed, [digest, key], ordering).drop(digest)
