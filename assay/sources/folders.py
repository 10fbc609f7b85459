"""Folders on the file system that Spark writes to: published as a whole, sized, removed."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import SparkSession

COMMITTED = "_SUCCESS"


def located(spark: SparkSession, path: str):
    """Hadoop's file system for a path, and the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = located(spark, path)
    return system.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder if it is there."""
    system, target = located(spark, path)
    system.delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder to a path that is free."""
    system, old = located(spark, source)
    new = located(spark, target)[1]
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"cannot rename {source} to {target}")


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = located(spark, path)
    system.mkdirs(target)


def create_empty(spark: SparkSession, path: str) -> None:
    """Create an empty file, and the folders above it; it must not be there."""
    system, target = located(spark, path)
    system.mkdirs(target.getParent())
    if not system.createNewFile(target):
        raise FileExistsError(path)


def entries(spark: SparkSession, path: str) -> dict[str, int]:
    """Names directly in a folder, with the milliseconds of their last change; none without it."""
    system, target = located(spark, path)
    if not system.exists(target):
        return {}
    return {
        entry.getPath().getName(): entry.getModificationTime()
        for entry in system.listStatus(target)
    }


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly in a folder."""
    system, target = located(spark, path)
    return sorted(
        entry.getPath().getName() for entry in system.listStatus(target) if entry.isDirectory()
    )


def data_files(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the files directly in a folder, markers and check sums left out."""
    system, target = located(spark, path)
    if not system.exists(target):
        return 0, 0
    sizes = [
        entry.getLen() for entry in system.listStatus(target)
        if entry.isFile() and not entry.getPath().getName().startswith(("_", "."))
    ]
    return len(sizes), sum(sizes)


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, 0 without it."""
    system, target = located(spark, path)
    return system.getContentSummary(target).getLength() if system.exists(target) else 0


def set_file_times(spark: SparkSession, path: str, moment: datetime) -> None:
    """Give the files of a folder a modification time, as copies that keep times have it."""
    system, target = located(spark, path)
    for entry in system.listStatus(target):
        system.setTimes(entry.getPath(), int(moment.timestamp() * 1000), -1)


def require_committed(spark: SparkSession, path: str) -> None:
    """Raise unless a finished job has written the folder; an empty one is not an empty table."""
    if not exists(spark, f"{path}/{COMMITTED}"):
        raise FileNotFoundError(f"{path} holds no committed table")


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Put what ``write`` writes in the place of ``path``.

    ``write`` gets a folder beside ``path``. Only when it has returned is the old table set aside,
    the new one renamed to ``path``, and the old one removed. If it fails, ``path`` stays as it
    was. A driver that dies between the two renames leaves no table at ``path``, which readers
    refuse, and the old one beside it under a name that starts with ``_old-``; ``restore`` puts it
    back.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    mark = uuid.uuid4().hex
    staged, old = f"{parent}/_staged-{name}-{mark}", f"{parent}/_old-{name}-{mark}"
    try:
        write(staged)
    except BaseException:
        remove(spark, staged)
        raise
    replaced = exists(spark, path)
    if replaced:
        move(spark, path, old)
    try:
        move(spark, staged, path)
    except BaseException:
        if replaced:
            move(spark, old, path)
        raise
    if replaced:
        remove(spark, old)


def restore(spark: SparkSession, path: str) -> bool:
    """Put the old table back that a driver had set aside when it died; False if there is none.

    Only for a table that one run writes at a time.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    if exists(spark, path) or not exists(spark, parent):
        return False
    old = [folder for folder in subfolders(spark, parent) if folder.startswith(f"_old-{name}-")]
    if old:
        move(spark, f"{parent}/{old[0]}", path)
    return bool(old)
