"""What large tables leave on disk: compressed files, no shuffles of earlier steps, one part at a time."""

import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_refresh import CLOCK, FIRST, SECOND, check_equal_to_whole, land

from assay.plans import gold, refresh as refreshing
from assay.plans.medallion import Layout, refine_bronze, refresh
from assay.plans.silver import refine
from assay.sources import shards as sharding, sinks, tables
from assay.sources.specs import BY_NAME
from assay.sources.tables import read_csv, write_drop
from checks import queries as registered
from checks.feeds import landing_feed

SHORT = ["customers", "orders"]


@pytest.fixture
def layout(folder):
    return Layout(folder)


@pytest.fixture
def small_parts(monkeypatch):
    """Every table counts as large."""
    monkeypatch.setattr(sinks, "PART_BYTES", 1)


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager()
    found = blocks.diskBlockManager().getAllBlocks()
    return {name for i in range(found.size()) if (name := str(found.apply(i))).startswith("shuffle_")}


def test_drops_are_compressed_and_read_back(spark, folder):
    spec = BY_NAME["customers"]
    rows = spark.range(500).select(*[
        F.when(F.col("id") % 7 > 0, F.concat(F.lit(" x,\""), "id")).alias(c) for c in spec.columns
    ])
    path = write_drop(rows, folder, spec.feed, datetime(2024, 1, 1))
    files = [p for p in Path(path).iterdir() if p.name.startswith("part-")]
    assert files and all(p.name.endswith(".csv.gz") for p in files)
    read = read_csv(spark, path, spec.schema)
    assert sorted(map(repr, read.collect())) == sorted(map(repr, rows.collect()))


def test_writing_leaves_no_shuffle_files(spark, folder):
    before = shuffle_files(spark)
    rows = spark.range(0, 20000, 1, 4).select(F.col("id"), (F.col("id") % 99).alias("k"))
    sinks.save(rows.groupBy("k").agg(F.count("id")).repartition(3), f"{folder}/table")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(sinks.CLEANUP, "false") == "false"
    assert spark.read.parquet(f"{folder}/table").count() == 99


def test_a_large_table_is_refreshed_in_groups(spark, layout, small_parts, monkeypatch):
    written, write = [], sharding.write_shards

    def noted(rows, path):
        write(rows, path)
        name = path.rpartition("/_staged-")[2].partition("-")[0]
        written.append((name, {r["_shard"] for r in spark.read.parquet(path).select("_shard").collect()}))

    monkeypatch.setattr(sharding, "write_shards", noted)
    land(spark, layout, 1, FIRST, SHORT)
    check_equal_to_whole(spark, layout, *refresh(spark, layout, CLOCK, shards=3), SHORT)
    assert [name for name, _ in written] == ["customers"] * 3 + ["orders"] * 3
    written.clear()
    land(spark, layout, 2, SECOND, SHORT)
    silver, facts = refresh(spark, layout, CLOCK)
    check_equal_to_whole(spark, layout, silver, facts, SHORT)
    assert len(written) > 2 and all(len(shards) <= 1 for _, shards in written)
    log = refreshing.RefreshLog(spark, layout.refreshes)
    assert log._events("orders", "changed").count() > 2 and not log.pending("orders", "facts-orders")


def noted_sizes(spark, monkeypatch):
    """Rows of every silver write, in the order written."""
    sizes, save = [], tables.save

    def noted(rows, path, *args, **named):
        save(rows, path, *args, **named)
        if named.get("by") == ["_is_valid"]:
            sizes.append(spark.read.schema("_is_valid BOOLEAN").parquet(path).count())

    monkeypatch.setattr(tables, "save", noted)
    return sizes


def test_a_large_table_is_refined_in_parts(spark, layout, small_parts, monkeypatch):
    """Versions of a key, and rows without one, stay together; an unpinned run has one time."""
    names = [None, *(f"C{i}" for i in range(40))]
    feed = {"customers": [(n, n, f"2023-01-0{day}", {}) for n in names for day in (1, 2)] * 2}
    land(spark, layout, 1, feed, ["customers"])
    sizes = noted_sizes(spark, monkeypatch)
    rows = refine_bronze(spark, layout, names=["customers"]).graded("customers").collect()
    assert len(sizes) == sinks.MOST_PARTS and sizes == sorted(sizes) and sizes[0] < sizes[-1] == 41
    assert {(r["customer_id"], str(r["updated_at"]), r["_is_valid"]) for r in rows} == {
        (n, "2023-01-02", n is not None) for n in names
    }
    assert len({r["_silver_processed_at"] for r in rows}) == 1


def test_quality_counts_a_table_written_in_parts(spark, sf_dir, small_parts, monkeypatch):
    sizes = noted_sizes(spark, monkeypatch)
    layout, silver = registered._landed(spark, sf_dir, ["customers"])
    assert len(sizes) == sinks.MOST_PARTS
    spec = BY_NAME["customers"]
    counts = gold.quality_counts(spark, gold.dq_tables(spark, layout.bronze, silver, [spec]))
    whole = refine(landing_feed(spark, sf_dir, "customers"), spec, {}, registered.DAY)
    sides = {r["_is_valid"]: r["count"] for r in whole.groupBy("_is_valid").count().collect()}
    read = landing_feed(spark, sf_dir, "customers").count()
    assert tuple(counts.first()) == ("customers", read, sides[True], sides[False])
