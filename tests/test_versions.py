"""Versions: a reader always finds a table, whenever it comes and wherever a run died."""

import threading
from datetime import timedelta

import pytest

from assay.sources import versions
from assay.sources.folders import entries, exists
from assay.sources.tables import (
    read_graded, read_if_present, read_table, write_graded, write_table,
)
from assay.sources.versions import current, publish_version


def rows_of(spark, number, rows=20):
    return spark.range(rows, numPartitions=2).selectExpr("id", f"{number} AS version")


def seen(table):
    return {row["version"] for row in table.select("version").distinct().collect()}


def test_a_reader_in_a_loop_never_fails(spark, folder):
    """Every read finds all rows of one version, and never one older than the read before."""
    path, stop, reads, errors = f"{folder}/table", threading.Event(), [], []
    write_table(rows_of(spark, 0), path, versioned=True)

    def read():
        while not stop.is_set():
            try:
                found = read_table(spark, path).groupBy("version").count().collect()
                reads.append([tuple(row) for row in found])
            except Exception as error:  # noqa: BLE001
                errors.append(error)
                return

    reader = threading.Thread(target=read)
    reader.start()
    for number in range(1, 11):
        write_table(rows_of(spark, number), path)
    stop.set()
    reader.join()
    assert not errors and reads
    assert all(len(found) == 1 and found[0][1] == 20 for found in reads)
    assert reads == sorted(reads)
    assert seen(read_table(spark, path)) == {10}


@pytest.mark.parametrize("step", ["create_empty", "remove_replaced"])
def test_a_run_that_dies_leaves_a_whole_version(spark, folder, monkeypatch, step):
    path = f"{folder}/table"
    write_table(rows_of(spark, 1), path, versioned=True)

    def die(*_):
        raise SystemExit

    with monkeypatch.context() as broken:
        broken.setattr(versions, step, die)
        with pytest.raises(SystemExit):
            write_table(rows_of(spark, 2), path)
    assert seen(read_table(spark, path)) == ({1} if step == "create_empty" else {2})
    write_table(rows_of(spark, 3), path)
    assert seen(read_table(spark, path)) == {3}


def test_a_failed_write_leaves_the_version_before(spark, folder):
    path = f"{folder}/table"
    bad = rows_of(spark, 1).selectExpr("raise_error('no') AS id")
    with pytest.raises(Exception, match="no"):
        write_table(bad, path, versioned=True)
    assert read_if_present(spark, path) is None
    write_table(rows_of(spark, 2), path, versioned=True)
    with pytest.raises(Exception, match="no"):
        write_table(bad, path)
    assert seen(read_if_present(spark, path)) == {2}
    assert len(entries(spark, f"{path}/_versions")) == 1


def test_a_table_in_place_becomes_versioned_and_stays_so(spark, folder):
    path = f"{folder}/table"
    write_table(rows_of(spark, 1), path)
    old = read_table(spark, path)
    write_table(rows_of(spark, 2), path, versioned=True)
    assert (seen(old), seen(read_table(spark, path))) == ({1}, {2})
    write_table(rows_of(spark, 3), path)
    assert seen(read_table(spark, path)) == {3}
    publish_version(spark, path, rows_of(spark, 4).write.parquet, timedelta(0))
    assert set(entries(spark, path)) == {"_versions", "_published"}
    assert seen(read_table(spark, path)) == {4}


def test_only_what_was_replaced_long_ago_is_removed(spark, folder):
    path = f"{folder}/table"
    for number in (1, 2, 3):
        publish_version(spark, path, rows_of(spark, number).write.parquet)
    assert len(entries(spark, f"{path}/_versions")) == 3
    third = current(spark, path)
    # A run that died long ago has left a version that was never published.
    rows_of(spark, 9).write.parquet(f"{path}/_versions/000000000004-died")
    publish_version(spark, path, rows_of(spark, 4).write.parquet, timedelta(0))
    assert list(entries(spark, f"{path}/_published")) == [current(spark, path).rpartition("/")[2]]
    assert len(entries(spark, f"{path}/_versions")) == 1 and not exists(spark, third)


def test_the_path_itself_gives_no_rows_of_several_versions(spark, folder):
    for number in (1, 2):
        write_table(rows_of(spark, number), f"{folder}/table", versioned=True)
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        spark.read.parquet(f"{folder}/table")


def test_both_sides_of_a_graded_table_are_of_one_version(spark, folder):
    rows = rows_of(spark, 1).selectExpr(
        "id", "version", "id % 3 > 0 AS _is_valid", "'why' AS _rejection_reason"
    )
    write_graded(rows, f"{folder}/table", versioned=True)
    pinned = read_graded(spark, f"{folder}/table", rows.schema)
    write_graded(rows.limit(0), f"{folder}/table")
    assert pinned.groupBy("_is_valid").count().count() == 2
    assert read_graded(spark, f"{folder}/table", rows.schema).count() == 0
