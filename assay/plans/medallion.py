"""The whole run: ingest, refine, summarise."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from assay.plans.bronze import ingest_all
from assay.plans.clock import NOW, Clock
from assay.plans.customer_facts import CustomerFacts, refresh_facts, snapshot_from_facts
from assay.plans.gold import write_gold, write_summaries
from assay.plans.refresh import SHARDS, ShardedSilver, refresh_silver
from assay.plans.silver import SilverTables, refine_all
from assay.sources.folders import folder_bytes
from assay.sources.sinks import parts_for
from assay.sources.specs import BY_NAME, SOURCES
from assay.streaming.ingest import ingest_new

ALL = tuple(BY_NAME)


@dataclass(frozen=True)
class Layout:
    """Where the layers live. All paths may be on any file system the cluster shares.

    ``versioned`` publishes silver and gold as versions, to be read with ``SilverTables`` and
    ``read_table``. Tables once published so stay so.
    """

    root: str
    versioned: bool = False

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def sharded_silver(self) -> str:
        return f"{self.root}/silver_sharded"

    @property
    def customer_facts(self) -> str:
        return f"{self.root}/customer_facts"

    @property
    def refreshes(self) -> str:
        return f"{self.root}/metadata/refreshes"

    @property
    def manifests(self) -> str:
        return f"{self.root}/metadata/ingested_files"

    @property
    def ingestion_log(self) -> str:
        return f"{self.root}/metadata/ingestion_log"


def bronze_tables(
    spark: SparkSession, layout: Layout, names: Iterable[str]
) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{layout.bronze}/{BY_NAME[name].feed}") for name in names}


def refine_bronze(
    spark: SparkSession, layout: Layout, clock: Clock = NOW, names: Sequence[str] = ALL
) -> SilverTables:
    """Silver tables from bronze tables; parents left out of ``names`` must be written already."""
    clocks = {name: clock for name in names}
    tables = SilverTables(spark, layout.silver, layout.versioned)
    parts = {
        name: parts_for(folder_bytes(spark, f"{layout.bronze}/{BY_NAME[name].feed}"))
        for name in names
    }
    return refine_all(bronze_tables(spark, layout, names), tables, clocks, parts)


def ingest_landed(
    spark: SparkSession, layout: Layout, clock: Clock = NOW, new_files_only: bool = False
) -> dict[str, int]:
    """Append the landed feeds to bronze: all their files again, or those not ingested yet."""
    if not new_files_only:
        return ingest_all(
            spark, layout.landing, layout.bronze, layout.ingestion_log, clock=clock,
            manifests=layout.manifests,
        )
    return {
        spec.feed: ingest_new(
            spark, spec, layout.landing, layout.bronze, layout.manifests, layout.ingestion_log,
            clock,
        )
        for spec in SOURCES
    }


def run(
    spark: SparkSession, layout: Layout, clock: Clock = NOW, new_files_only: bool = False
) -> None:
    """Landing to gold."""
    ingest_landed(spark, layout, clock, new_files_only)
    silver = refine_bronze(spark, layout, clock)
    write_gold(spark, layout.bronze, silver, layout.gold, clock, layout.versioned)


def refresh(
    spark: SparkSession,
    layout: Layout,
    clock: Clock = NOW,
    clocks: Mapping[str, Clock] | None = None,
    shards: int = SHARDS,
) -> tuple[ShardedSilver, CustomerFacts]:
    """Bring sharded silver and the customer facts up to date with the ingested batches.

    Work follows the new batches and what they touch. ``clocks`` pins the days of single tables.
    ``shards`` counts for the first run; later ones keep it.
    """
    clocks = {name: clock for name in ALL} | dict(clocks or {})
    silver = refresh_silver(
        spark, layout.bronze, layout.manifests, layout.sharded_silver, layout.refreshes, clocks,
        shards,
    )
    facts = CustomerFacts(spark, layout.customer_facts, shards)
    refresh_facts(silver, facts, layout.refreshes)
    return silver, facts


def run_refresh(
    spark: SparkSession, layout: Layout, clock: Clock = NOW, shards: int = SHARDS
) -> None:
    """Landing to gold over new files and changed keys only."""
    ingest_landed(spark, layout, clock, new_files_only=True)
    silver, facts = refresh(spark, layout, clock, shards=shards)
    snapshot = snapshot_from_facts(facts, clock)
    write_summaries(
        spark, snapshot, layout.bronze, silver, layout.gold, clock, layout.versioned
    )
