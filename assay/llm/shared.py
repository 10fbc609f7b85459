"""What several of the operators need: written steps, usable vectors, shared files, integer columns."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import assay
from assay.session import new_run_root, written

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
DEFAULT_BATCH_ROWS = "10000"

_shipped: set[str] = set()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written below the shared folder and read back: it is computed once, and a lost
    executor costs a read."""
    return written(df, f"{new_run_root(df.sparkSession, purpose)}/table")


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {name.lower() for name in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def all_columns(df: DataFrame) -> list[Column]:
    """The columns of ``df``, whatever characters are in their names."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path or URI and the path in it, on the driver or in a task."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def words_of(text: Column) -> Column:
    """Number of runs of non-blank characters; 0 for NULL."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\S+")).cast("long")


def finite(vector: Column) -> Column:
    """True for a vector with components, none of them NULL, NaN or infinite."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(whole, F.lit(False))


def blocks_for(rows: int, block_rows: int) -> int:
    return max(1, -(-rows // block_rows))


def tasks_for(spark: SparkSession, items: int, items_a_task: int) -> int:
    """Number of tasks for rows that stand for far more work than their bytes, such as names of
    files. A stated number keeps adaptive execution from merging them into one."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(items, max(usual, blocks_for(items, items_a_task))))


def block_numbers(blocks: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package, also where it is only on the driver's path, and send
    them whole texts in batches that fit beside the heap, unless the session says otherwise."""
    context = spark.sparkContext
    if spark.conf.get(BATCH_ROWS) == DEFAULT_BATCH_ROWS:
        spark.conf.set(BATCH_ROWS, "1000")
    if context.applicationId not in _shipped:
        package = Path(assay.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="assay-code-")) / "assay_code.zip"
        with zipfile.ZipFile(archive, "w") as packed:
            for path in sorted(package.rglob("*.py")):
                packed.write(path, path.relative_to(package.parent))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
