"""Writers of the layers' tables: small files, and no shuffle files left behind."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

# Record hashes are hexadecimal digits, which only an entropy coder halves.
COMPRESSION = "zstd"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
PART_BYTES = 64 << 20
MOST_PARTS = 8

_lock = Lock()
_writing: dict[int, tuple[int, str | None]] = {}


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Commands run within remove their shuffle files when they end, not when the driver happens to
    collect its garbage. Sinks may run side by side; the setting is put back when the last ends."""
    session = id(spark)
    with _lock:
        running, before = _writing.get(session, (0, spark.conf.get(CLEANUP, None)))
        _writing[session] = running + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            running, before = _writing.pop(session)
            if running > 1:
                _writing[session] = running - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


def save(
    rows: DataFrame, path: str, mode: str = "errorifexists", by: Sequence[str] = ()
) -> None:
    """Write ``rows`` as Parquet, in folders of the columns ``by``."""
    writer = rows.write.mode(mode).option("compression", COMPRESSION)
    with releasing_shuffles(rows.sparkSession):
        (writer.partitionBy(*by) if by else writer).parquet(path)


def parts_for(size: int) -> int:
    """In how many parts a table of ``size`` bytes is best worked on: a job's shuffles lie on disk
    together until it ends, so a large table goes part after part. Each part reads the table again,
    so their number is bounded."""
    return max(1, min(MOST_PARTS, -(-size // PART_BYTES)))
