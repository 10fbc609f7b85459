"""Order-free comparison of a query's rows with its SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def differences(
    df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str
) -> list[str]:
    """What differs, empty when both sides hold the same rows."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    order = sorted(names)
    theirs = Counter(
        tuple(row[names.index(name)] for name in order) for row in expected.fetchall()
    )
    ours = Counter(tuple(row) for row in df.select(*order).collect())
    if ours == theirs:
        return []
    return [
        f"rows {sum(ours.values())} != {sum(theirs.values())}",
        f"only ours {list((ours - theirs).items())[:3]}",
        f"only theirs {list((theirs - ours).items())[:3]}",
    ]
