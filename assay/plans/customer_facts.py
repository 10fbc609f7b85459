"""What the snapshot takes from each silver table, kept per customer and in buckets of the customer.

Each table of facts holds one row per customer, so no bucket is large because of a customer with
many orders. They share one bucketing: Spark joins them into the snapshot without a shuffle. After a
refresh of silver only the facts of customers with changed rows are summarised anew, from all their
valid rows; sums, counts, latest dates and latest versions all come out as over the whole table,
also when a row was replaced or has become invalid.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.plans.clock import NOW, Clock
from assay.plans.gold import SIDES, assembled
from assay.plans.refresh import RefreshLog, ShardedSilver
from assay.plans.silver import planned_schema
from assay.sources.folders import exists
from assay.sources.shards import read_bucketed, write_bucketed
from assay.sources.specs import BY_NAME
from assay.sources.tables import read_if_present

BUCKETS = 64
KEY = "customer_id"


class CustomerFacts:
    """The tables of facts below one folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root
        path = f"{root}/layout"
        kept = read_if_present(spark, path)
        if kept is None:
            spark.range(0, 1, 1, 1).select(F.lit(buckets).alias("buckets")).write.parquet(path)
        self.buckets = buckets if kept is None else kept.first()["buckets"]

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def present(self, name: str) -> bool:
        return exists(self.spark, self.path(name))

    def schema(self, name: str) -> StructType:
        rows = self.spark.createDataFrame([], planned_schema(self.spark, BY_NAME[name]))
        return SIDES[name](rows).schema

    def read(self, name: str) -> DataFrame:
        """One table of facts; of a feed that has not landed, none."""
        if not self.present(name):
            return self.spark.createDataFrame([], self.schema(name))
        return read_bucketed(self.spark, self.path(name), self.schema(name), KEY, self.buckets)

    def write(self, facts: DataFrame, name: str) -> None:
        write_bucketed(facts, self.path(name), KEY, self.buckets)


def refresh_facts(silver: ShardedSilver, facts: CustomerFacts, metadata: str) -> None:
    """Bring the facts up to date with the changes that ``refresh_silver`` has written. The tables
    do not depend on each other and are submitted side by side."""
    log = RefreshLog(silver.spark, metadata)

    def bring(name: str) -> None:
        consumer = f"facts-{name}"
        due = log.pending(name, consumer)
        if not facts.present(name):
            rows = SIDES[name](silver.valid(name))
            facts.write(rows.repartition(facts.buckets, KEY), name)
        elif due:
            changes = log.changes(name, due).where("valid_before OR valid_after")
            customers = changes.select("customer_id").distinct()
            facts.write(merged(silver, facts, name, customers), name)
        if due:
            log.append(consumer, [("consumed", name, refresh) for refresh in due])

    present = [name for name in SIDES if silver.present(name)]
    if present:
        with ThreadPoolExecutor(len(present)) as pool:
            list(pool.map(bring, present))


def merged(
    silver: ShardedSilver, facts: CustomerFacts, name: str, customers: DataFrame
) -> DataFrame:
    """The facts with those of some customers summarised anew. Old facts stay in their buckets;
    only the new ones are shuffled to them."""
    old = facts.read(name)
    rest = [column for column in old.columns if column != KEY]
    rows = SIDES[name](silver.valid(name).join(customers, KEY, "left_semi"))
    fresh = customers.join(rows.withColumn("_has_rows", F.lit(True)), KEY, "left").select(
        KEY, F.struct("_has_rows", *rest).alias("_fresh")
    )
    both = old.join(fresh.repartition(facts.buckets, KEY), KEY, "full")
    kept = F.col("_fresh").isNull() | F.col("_fresh._has_rows")
    return both.where(kept).select(KEY, *[
        F.when(F.col("_fresh").isNull(), F.col(column)).otherwise(F.col(f"_fresh.{column}"))
        .alias(column) for column in rest
    ])


def snapshot_from_facts(facts: CustomerFacts, clock: Clock = NOW) -> DataFrame:
    """The customer snapshot. The facts are joined bucket by bucket, or broadcast where small."""
    return assembled({name: facts.read(name) for name in SIDES}, clock)
