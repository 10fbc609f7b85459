"""Silver over changed keys only.

The whole refinement reduces all of bronze on every run. Here a run reads the batches that silver
has not seen, and silver lies in hash shards of each table's key:

1. The new rows are cleaned and reduced to the latest version of each key.
2. Affected are their keys, and the keys of rows whose parent has become valid or invalid in this
   or an earlier run. The shards of affected keys are touched, no others are read or written.
3. The affected rows of silver compete with the new versions. A silver row has all that the choice
   between versions looks at, so bronze history is not needed. The winners are checked against
   their parents and graded; all other rows of a touched shard are copied as they are.
4. Which rows changed is written for the children and for gold, and then the shards are replaced.

The shards of a large table go through steps 3 and 4 group after group, as does its first build, so
that the shuffles and copies of one group are gone before the next one's are made.

Steps are logged, so a run that died is made good by the next: new batches are merged again, which
changes nothing if they had been merged, and changes that were written but not consumed still are.

A row keeps its future-date flag and ``_silver_processed_at`` from the run that graded it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.operators.quality import grade
from assay.plans.bronze import AUDIT_COLUMNS
from assay.plans.clock import NOW, Clock
from assay.plans.silver import (
    WAVES, SilverTables, latest, planned_schema, refine, standardise, with_parents, with_warning,
)
from assay.sources.folders import exists, folder_bytes, remove
from assay.sources.manifest import Manifest
from assay.sources.shards import (
    SHARD, create_in_parts, in_shards, laid_by_shard, read_shards, replace_shards, roll_forward,
    shard_groups, shard_of,
)
from assay.sources.sinks import parts_for, save
from assay.sources.specs import BY_NAME, SourceSpec
from assay.sources.tables import append_packed, read_if_present, read_log, rows_of_batches

SHARDS = 64
LOG = "event STRING, source STRING, id STRING"
CHANGES = "key STRING, customer_id STRING, valid_before BOOLEAN, valid_after BOOLEAN"


class RefreshLog:
    """What has been refined, what has changed, and who has consumed the changes. Every table and
    every other consumer has a log of its own, so they can be refreshed side by side."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def _events(self, owner: str, event: str) -> DataFrame:
        rows = read_log(self.spark, f"{self.root}/log/{owner}", LOG)
        return rows.where(F.col("event") == event).drop("event")

    def append(self, owner: str, events: Iterable[tuple[str, str, str]]) -> None:
        rows = self.spark.createDataFrame(list(events), LOG).coalesce(1)
        append_packed(rows, f"{self.root}/log/{owner}")

    def new_batches(self, spec: SourceSpec, manifests: str) -> list[str]:
        """Finished batches of a feed that its table has not seen; one name a run of ingestion."""
        finished = Manifest(self.spark, manifests, spec.feed).finished_batches()
        seen = self._events(spec.name, "refined").select(F.col("id").alias("batch_id"))
        rows = finished.join(seen, "batch_id", "left_anti")
        return sorted(row["batch_id"] for row in rows.distinct().collect())

    def pending(self, table: str, consumer: str) -> list[str]:
        """Refreshes of a table whose changes the consumer has not had."""
        had = self._events(consumer, "consumed").where(F.col("source") == table)
        changed = self._events(table, "changed")
        rows = changed.select("id").join(had.select("id"), "id", "left_anti")
        return sorted(row["id"] for row in rows.distinct().collect())

    def write_changes(self, changes: DataFrame, table: str, refresh: str) -> None:
        save(changes, self._changes(table, refresh))
        self.append(table, [("changed", table, refresh)])

    def changes(self, table: str, refreshes: Sequence[str]) -> DataFrame:
        """Old and new versions of the rows that the refreshes graded anew."""
        if not refreshes:
            return self.spark.createDataFrame([], CHANGES)
        paths = [self._changes(table, refresh) for refresh in refreshes]
        return self.spark.read.schema(CHANGES).parquet(*paths)

    def _changes(self, table: str, refresh: str) -> str:
        return f"{self.root}/changes/{table}/{refresh}"


class ShardedSilver(SilverTables):
    """The silver tables below one folder, each in hash shards of its key."""

    def __init__(self, spark: SparkSession, root: str, shards: int = SHARDS):
        super().__init__(spark, root)
        self.shards = self._settled(shards)

    def _settled(self, shards: int) -> int:
        """The number of shards the tables were made with."""
        path = f"{self.root}/layout"
        kept = read_if_present(self.spark, path)
        if kept is None:
            self.spark.range(0, 1, 1, 1).select(F.lit(shards).alias("shards")).write.parquet(path)
            return shards
        return kept.first()["shards"]

    def _schema(self, name: str) -> StructType:
        if name not in self._schemas:
            self._schemas[name] = planned_schema(self.spark, BY_NAME[name])
        return self._schemas[name]

    def present(self, name: str) -> bool:
        return exists(self.spark, self.path(name))

    def sharded(self, name: str, touched: Sequence[int] | None = None) -> DataFrame:
        return read_shards(self.spark, self.path(name), self._schema(name), touched)

    def graded(self, name: str) -> DataFrame:
        return self.sharded(name).drop(SHARD)

    def valid(self, name: str) -> DataFrame:
        return self.graded(name).where("_is_valid")

    def rejected(self, name: str) -> DataFrame:
        return self.graded(name).where("NOT _is_valid")

    def groups(self, numbers: Sequence[int], size: int) -> list[list[int]]:
        """Shards to be worked on together, of a table of ``size`` bytes."""
        return shard_groups(numbers, parts_for(size))

    def write(
        self, graded: DataFrame | Sequence[DataFrame], name: str,
        staged_rows: Callable[[DataFrame], None] = lambda rows: None,
    ) -> None:
        """Put a table in its place, given as a whole or in parts that share no shard.
        ``staged_rows`` gets its written rows before."""
        parts = [graded] if isinstance(graded, DataFrame) else graded
        names, key = self._schema(name).fieldNames(), BY_NAME[name].key
        create_in_parts(
            self.spark, (in_shards(rows.select(*names), key, self.shards) for rows in parts),
            self.path(name),
            lambda staged: staged_rows(read_shards(self.spark, staged, self._schema(name))),
        )


@dataclass(frozen=True)
class Refresh:
    """One run: where the layers lie, the run's name and its folder for steps in between."""

    spark: SparkSession
    bronze: str
    manifests: str
    silver: ShardedSilver
    log: RefreshLog
    name: str
    work: str

    def step(self, rows: DataFrame, table: str, purpose: str) -> DataFrame:
        path = f"{self.work}/{table}/{purpose}"
        save(rows, path, "overwrite")
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop_steps(self, table: str, *purposes: str) -> None:
        """Remove steps that nothing reads any more."""
        for purpose in purposes:
            remove(self.spark, f"{self.work}/{table}/{purpose}")


def new_rows(run: Refresh, spec: SourceSpec, batches: Sequence[str]) -> DataFrame:
    """The rows of the batches, as ingested."""
    return rows_of_batches(run.spark.read.parquet(f"{run.bronze}/{spec.feed}"), batches)


def turned_keys(changes: DataFrame) -> DataFrame:
    """Keys that have become valid or invalid in one refresh."""
    ends = changes.groupBy("key").agg(
        F.max("valid_before").alias("before"), F.max("valid_after").alias("after")
    )
    return ends.where("key IS NOT NULL AND before <> after").select("key")


def with_turned_parents(run: Refresh, spec: SourceSpec, pending: Mapping[str, list[str]]) -> DataFrame:
    """Keys of silver rows whose parent has turned; two columns of the table are read."""
    found = []
    for parent in spec.parents:
        if pending[parent.table]:
            turned = reduce(DataFrame.union, [
                turned_keys(run.log.changes(parent.table, [name])) for name in pending[parent.table]
            ]).distinct()
            rows = run.silver.graded(spec.name).select(
                F.col(spec.key).alias("key"), F.col(parent.key).alias("parent")
            )
            found.append(rows.join(turned.toDF("parent"), "parent", "left_semi").select("key"))
    return reduce(DataFrame.union, found) if found else run.spark.createDataFrame([], "key STRING")


def same_key(rows: DataFrame, spec: SourceSpec, keys: DataFrame, how: str) -> DataFrame:
    """Join with a table of keys in which NULL is a key."""
    return rows.join(keys, F.col(spec.key).eqNullSafe(F.col("affected_key")), how)


def graded_again(
    run: Refresh, spec: SourceSpec, rows: DataFrame, clock: Clock
) -> DataFrame:
    """Check a few rows against the parents they name, and grade them."""
    parents = {}
    for parent in spec.parents:
        named = rows.select(parent.key).where(F.col(parent.key).isNotNull()).distinct()
        parents[parent.table] = run.silver.valid(parent.table).select(parent.key).join(
            named, parent.key, "left_semi"
        )
    return grade(with_warning(with_parents(rows, spec, parents), spec, clock), spec.rules)


def refresh_table(run: Refresh, spec: SourceSpec, clock: Clock) -> bool:
    """Bring one silver table up to date; False if nothing was due."""
    silver, log = run.silver, run.log
    roll_forward(run.spark, silver.path(spec.name))
    batches = log.new_batches(spec, run.manifests)
    present = silver.present(spec.name)
    pending = {parent.table: log.pending(parent.table, spec.name) for parent in spec.parents}
    if not batches and not (present and any(pending.values())):
        return False
    clock = clock.held(run.spark)
    if present:
        replaced = refresh_shards(run, spec, batches, pending, clock)
    else:
        build_shards(run, spec, batches, clock)
        replaced = True
    log.append(spec.name, [
        *[("refined", spec.feed, batch) for batch in batches],
        *[("consumed", table, name) for table, ids in pending.items() for name in ids],
    ])
    return replaced


def build_shards(run: Refresh, spec: SourceSpec, batches: Sequence[str], clock: Clock) -> None:
    """Make a table from all its batches, group after group of its shards. Each group is refined from
    a scan of its own, so only one group's shuffles lie on disk at a time."""
    silver, rows = run.silver, new_rows(run, spec, batches)
    parents = {parent.table: silver.valid(parent.table) for parent in spec.parents}
    size = folder_bytes(run.spark, f"{run.bronze}/{spec.feed}")
    groups = silver.groups(range(silver.shards), size)
    parts = [rows] if len(groups) == 1 else [
        rows.where(shard_of(spec.key, silver.shards).isin(numbers)) for numbers in groups
    ]
    silver.write(
        [refine(part, spec, parents, clock) for part in parts], spec.name,
        lambda graded: run.log.write_changes(changed(spec, None, graded), spec.name, run.name),
    )


def refresh_shards(
    run: Refresh, spec: SourceSpec, batches: Sequence[str], pending: Mapping[str, list[str]],
    clock: Clock,
) -> bool:
    """Merge new versions and turned parents into the touched shards of a table.

    The shards of a large table are merged group after group. A key lies in one shard, so every group
    is a refresh for itself, with changes of its own name; a run that dies leaves whole groups, for
    which merging again changes nothing.
    """
    silver = run.silver
    due = with_turned_parents(run, spec, pending)
    fresh = standardise(new_rows(run, spec, batches), spec, clock) if batches else None
    if fresh is not None:
        due = due.union(fresh.select(spec.key))
    affected = run.step(
        due.toDF("affected_key").distinct().withColumn(
            SHARD, shard_of("affected_key", silver.shards)
        ),
        spec.name, "affected",
    )
    # At most as many numbers as there are shards.
    touched = sorted(row[SHARD] for row in affected.select(SHARD).distinct().collect())
    size = folder_bytes(run.spark, silver.path(spec.name))
    for number, shards in enumerate(silver.groups(touched, size)):
        in_group = F.col(SHARD).isin(shards)
        keys = affected.where(in_group).select("affected_key")
        rows = None if fresh is None else in_shards(fresh, spec.key, silver.shards).where(in_group)
        refresh_group(run, spec, shards, keys, rows, f"{run.name}-{number}", clock)
    run.drop_steps(spec.name, "affected")
    return bool(touched)


def refresh_group(
    run: Refresh, spec: SourceSpec, shards: Sequence[int], keys: DataFrame,
    fresh: DataFrame | None, name: str, clock: Clock,
) -> None:
    """Merge the affected keys of some shards, write what changed, and replace the shards."""
    silver = run.silver
    stamped = [*spec.columns, *AUDIT_COLUMNS, "_silver_processed_at"]
    current = silver.sharded(spec.name, shards)
    old = same_key(current, spec, keys, "left_semi")
    versions = old.select(*stamped)
    if fresh is not None:
        versions = latest(versions.unionByName(fresh.select(*stamped)), spec)
    versions = run.step(versions, spec.name, "versions")
    names = silver._schema(spec.name).fieldNames()
    graded = run.step(
        graded_again(run, spec, versions, clock).select(*names), spec.name, "graded"
    )
    run.drop_steps(spec.name, "versions")
    run.log.write_changes(changed(spec, old, graded), spec.name, name)
    kept = same_key(current, spec, keys, "left_anti")
    # The rows that were graded are laid together by shard; those that stay are not moved.
    joined = laid_by_shard(in_shards(graded, spec.key, silver.shards))
    replace_shards(kept.unionByName(joined), silver.path(spec.name), shards)
    run.drop_steps(spec.name, "graded")


def changed(spec: SourceSpec, old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Old and new versions as ``CHANGES``."""
    no, is_valid = F.lit(False), F.col("_is_valid")

    def side(rows: DataFrame, before, after) -> DataFrame:
        return rows.select(
            F.col(spec.key).alias("key"), F.col("customer_id").alias("customer_id"),
            before.alias("valid_before"), after.alias("valid_after"),
        )

    rows = side(new, no, is_valid)
    return rows if old is None else rows.union(side(old, is_valid, no))


def refresh_silver(
    spark: SparkSession,
    bronze: str,
    manifests: str,
    silver: str,
    metadata: str,
    clocks: Mapping[str, Clock] | None = None,
    shards: int = SHARDS,
) -> ShardedSilver:
    """Bring the silver tables of all landed feeds up to date, parents before children.

    The tables of one wave are refreshed side by side. The first run of a table builds it.
    """
    tables, clocks = ShardedSilver(spark, silver, shards), clocks or {}
    name = uuid.uuid4().hex
    run = Refresh(
        spark, bronze, manifests, tables, RefreshLog(spark, metadata), name,
        f"{metadata}/work/{name}",
    )

    def bring(spec: SourceSpec) -> None:
        refresh_table(run, spec, clocks.get(spec.name, NOW))

    try:
        for wave in WAVES:
            landed = [spec for spec in wave if exists(spark, f"{bronze}/{spec.feed}")]
            if landed:
                with ThreadPoolExecutor(len(landed)) as pool:
                    list(pool.map(bring, landed))
    finally:
        remove(spark, run.work)
    return tables
