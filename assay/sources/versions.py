"""Tables published as immutable versions, so that readers never meet a moment without a table.

A version is a folder below ``_versions``. An empty file of the same name below ``_published``
makes it the one that readers see; the largest name counts. Nothing is renamed, and an empty file
is there or not on any file system, so a driver that dies at any step leaves the version before it
readable. A table is published by one run at a time.

Only ``current`` knows which folder holds the rows. Both folders are hidden from Spark, so reading
the path itself fails instead of giving the rows of several versions.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import SparkSession

from assay.sources.folders import COMMITTED, create_empty, entries, exists, remove

VERSIONS = "_versions"
PUBLISHED = "_published"
RETAINED = timedelta(days=1)


def is_versioned(spark: SparkSession, path: str) -> bool:
    return bool(entries(spark, f"{path}/{PUBLISHED}"))


def current(spark: SparkSession, path: str) -> str:
    """Folder of the version that counts now; ``path`` itself for a table written in place."""
    marks = entries(spark, f"{path}/{PUBLISHED}")
    return f"{path}/{VERSIONS}/{max(marks)}" if marks else path


def present(spark: SparkSession, path: str) -> str | None:
    """The same, None if there is no table: no such path, or only a first version that a run died
    over."""
    where = current(spark, path)
    if where == path and exists(spark, f"{path}/{VERSIONS}"):
        return path if exists(spark, f"{path}/{COMMITTED}") else None
    return where if exists(spark, where) else None


def publish_version(
    spark: SparkSession, path: str, write: Callable[[str], None], retained: timedelta = RETAINED
) -> None:
    """Make what ``write`` writes the version of ``path`` that counts.

    ``write`` gets the new version's folder. If it fails, the version before stays. Readers that
    have resolved an older version may go on for ``retained`` after it was replaced; then a later
    publishing removes it, and likewise a table written in place before.
    """
    marks = entries(spark, f"{path}/{PUBLISHED}")
    number = int(max(marks).partition("-")[0]) + 1 if marks else 1
    name = f"{number:012d}-{uuid.uuid4().hex}"
    try:
        write(f"{path}/{VERSIONS}/{name}")
    except BaseException:
        remove(spark, f"{path}/{VERSIONS}/{name}")
        raise
    create_empty(spark, f"{path}/{PUBLISHED}/{name}")
    remove_replaced(spark, path, retained)


def remove_replaced(spark: SparkSession, path: str, retained: timedelta) -> None:
    """Remove what no reader can be reading: versions replaced longer than ``retained`` ago, those
    of runs that died as long ago, and a table in place that versions replaced as long ago.

    All times are the file system's own, counted back from the newest version.
    """
    marks = dict(sorted(entries(spark, f"{path}/{PUBLISHED}").items()))
    names, times = list(marks), list(marks.values())
    last_use = times[-1] - int(retained.total_seconds() * 1000)
    for name, replaced_at in zip(names, times[1:]):
        if replaced_at <= last_use:
            remove(spark, f"{path}/{PUBLISHED}/{name}")
            remove(spark, f"{path}/{VERSIONS}/{name}")
    for name, changed_at in entries(spark, f"{path}/{VERSIONS}").items():
        if name not in marks and changed_at <= last_use:
            remove(spark, f"{path}/{VERSIONS}/{name}")
    if times[0] <= last_use:
        for name in entries(spark, path):
            if name not in (VERSIONS, PUBLISHED):
                remove(spark, f"{path}/{name}")
