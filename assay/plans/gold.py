"""Silver to gold: customer snapshot, KPI row, data-quality summary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assay.operators import summaries
from assay.operators.summaries import exact_sum, sum_flag
from assay.plans.clock import NOW, Clock
from assay.plans.silver import SilverTables
from assay.sources.specs import REPORTED, SourceSpec
from assay.sources.tables import read_if_present, read_table, write_table

ZERO_WHEN_ABSENT = {
    "total_orders": 0,
    "total_revenue": 0.0,
    "successful_payment_count": 0,
    "successful_payment_amount": 0.0,
    "support_ticket_count": 0,
    "open_ticket_count": 0,
    "points_balance": 0,
}


def customer_base(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", "first_name", "last_name", "email", "gender", "status", "signup_date"
    )


# What the snapshot takes from each silver table, one row per customer, in the order of its columns.
SIDES = MappingProxyType({
    "customers": customer_base,
    "addresses": summaries.primary_address,
    "orders": summaries.order_summary,
    "payments": summaries.payment_summary,
    "support_tickets": summaries.support_summary,
    "loyalty_accounts": summaries.loyalty_per_customer,
})


def customer_snapshot(silver: Mapping[str, DataFrame], clock: Clock = NOW) -> DataFrame:
    """One row per valid customer with address, order, payment, ticket and loyalty facts.

    Every right side is reduced to one row per customer before it is joined, with partial
    aggregation on the map side. All six inputs then meet on one hash partitioning of
    ``customer_id``: each is shuffled once, and no join sees a skewed key.
    """
    sides = {name: summarise(silver[name]) for name, summarise in SIDES.items()}
    return assembled(sides, clock)


def assembled(sides: Mapping[str, DataFrame], clock: Clock = NOW) -> DataFrame:
    """The snapshot from tables of one row per customer; the customers' own decides who is in it."""
    snapshot = sides["customers"]
    for name in list(SIDES)[1:]:
        snapshot = snapshot.join(sides[name], on="customer_id", how="left")
    filled = {
        name: F.coalesce(F.col(name), F.lit(zero)) for name, zero in ZERO_WHEN_ABSENT.items()
    }
    return snapshot.withColumns({**filled, "_gold_processed_at": clock.now()})


def kpi_summary(snapshot: DataFrame, clock: Clock = NOW) -> DataFrame:
    """Business KPIs over the whole snapshot, one row."""
    return snapshot.agg(
        F.count(F.lit(1)).alias("total_customers"),
        sum_flag(F.col("status") == "active").alias("active_customers"),
        sum_flag(F.col("status") == "blocked").alias("blocked_customers"),
        sum_flag(F.col("total_orders") > 0).alias("customers_with_orders"),
        exact_sum(F.col("total_revenue")).alias("total_revenue"),
        F.try_divide(
            exact_sum(F.col("total_revenue")), F.count("total_revenue")
        ).alias("avg_customer_revenue"),
        sum_flag(F.col("loyalty_tier").isNotNull()).alias("customers_with_loyalty"),
        F.sum("points_balance").alias("total_points_balance"),
        sum_flag(F.col("support_ticket_count") > 0).alias("customers_with_support_tickets"),
        F.sum("open_ticket_count").alias("open_support_tickets"),
    ).withColumn("_gold_processed_at", clock.now())


def percent(part: str, whole: str) -> Column:
    """Share in percent to two places, NULL over nothing."""
    return F.round(F.try_divide(F.col(part), F.col(whole)) * 100, 2)


def quality_counts(
    spark: SparkSession,
    tables: Sequence[tuple[str, DataFrame | None, DataFrame | None]],
    warnings: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows per source in (source, bronze, graded silver), in no order.

    A table that does not exist is None and counts 0. With ``warnings``, the warning flag of each
    source, its valid rows with the flag are counted as ``future_date_rows`` too. One job counts
    everything: no data column but the flags is read, and partial aggregation leaves one row per
    task and source to shuffle, however unequal the sources are.
    """
    layers = ["bronze_rows", "silver_valid_rows", "silver_rejected_rows"]
    layers += ["future_date_rows"] if warnings else []
    one, is_valid = F.lit(1).cast("bigint"), F.col("_is_valid").cast("bigint")
    names = [source for source, _, _ in tables]

    def counted(rows: DataFrame, position: Column, *numbers: Column | None) -> DataFrame:
        given = dict(zip(layers, numbers))
        return rows.select(position.cast("int").alias("position"), *[
            (F.lit(0).cast("bigint") if given.get(layer) is None else given[layer]).alias(layer)
            for layer in layers
        ])

    sources = spark.range(0, len(names), 1, 1)
    parts = [counted(sources, F.col("id"))]
    for position, (name, bronze, graded) in enumerate(tables):
        if bronze is not None:
            parts.append(counted(bronze, F.lit(position), one))
        if graded is not None:
            late = (F.col("_is_valid") & F.col(warnings[name])).cast("bigint") if warnings else None
            parts.append(counted(
                graded, F.lit(position), None, is_valid, one - is_valid,
                None if late is None else F.coalesce(late, F.lit(0).cast("bigint")),
            ))
    return (
        reduce(DataFrame.unionByName, parts)
        .groupBy("position")
        .agg(*[F.sum(name).alias(name) for name in layers])
        .select(
            F.element_at(F.array(*map(F.lit, names)), F.col("position") + 1).alias("source_name"),
            *layers,
        )
    )


def dq_summary(counts: DataFrame, clock: Clock = NOW) -> DataFrame:
    """Processed rows and rejection rate per source. Rows lost to dedup are not counted."""
    return counts.withColumn(
        "total_processed_rows", F.col("silver_valid_rows") + F.col("silver_rejected_rows")
    ).withColumns({
        "rejection_rate_percent": percent("silver_rejected_rows", "total_processed_rows"),
        "_gold_processed_at": clock.now(),
    })


def dq_tables(
    spark: SparkSession,
    bronze: str,
    silver: SilverTables,
    specs: Iterable[SourceSpec] = REPORTED,
) -> list[tuple[str, DataFrame | None, DataFrame | None]]:
    """The tables counted for each source; None where a path does not exist."""
    flag = StructType.fromDDL("_is_valid BOOLEAN")
    return [
        (
            spec.name,
            read_if_present(spark, f"{bronze}/{spec.feed}", spec.schema),
            read_if_present(spark, silver.path(spec.name), flag),
        )
        for spec in specs
    ]


def rejection_counts(silver: SilverTables, specs: Iterable[SourceSpec] = REPORTED) -> DataFrame:
    """Rejected rows per source and reason."""
    rejected = [
        silver.rejected(spec.name).select(
            F.lit(spec.name).alias("source_name"), F.col("_rejection_reason").alias("reason")
        )
        for spec in specs
    ]
    return (
        reduce(DataFrame.unionByName, rejected)
        .groupBy("source_name", "reason")
        .agg(F.count(F.lit(1)).alias("rejected_rows"))
    )


def run_report(
    spark: SparkSession,
    bronze: Mapping[str, DataFrame],
    silver: SilverTables,
    specs: Sequence[SourceSpec] = REPORTED,
    malformed: DataFrame | None = None,
) -> DataFrame:
    """Rows read, kept after dedup, valid, rejected, and valid rows with a future date.

    With ``malformed`` (source_name, malformed_cells), the cells that could not be read too.
    """
    tables = [(spec.name, bronze[spec.name], silver.graded(spec.name)) for spec in specs]
    warnings = {spec.name: spec.warning.flag for spec in specs}
    report = quality_counts(spark, tables, warnings).select(
        "source_name",
        "bronze_rows",
        (F.col("silver_valid_rows") + F.col("silver_rejected_rows")).alias("deduplicated_rows"),
        F.col("silver_valid_rows").alias("valid_rows"),
        F.col("silver_rejected_rows").alias("rejected_rows"),
        "future_date_rows",
    )
    if malformed is None:
        return report
    cells = malformed.groupBy("source_name").agg(F.sum("malformed_cells").alias("malformed_cells"))
    return report.join(cells, "source_name", "left").fillna(0, ["malformed_cells"])


def write_gold(
    spark: SparkSession, bronze: str, silver: SilverTables, gold: str, clock: Clock = NOW,
    versioned: bool = False,
) -> None:
    """Write the three gold tables from silver."""
    valid = {spec.name: silver.valid(spec.name) for spec in REPORTED}
    write_summaries(spark, customer_snapshot(valid, clock), bronze, silver, gold, clock, versioned)


def write_summaries(
    spark: SparkSession, snapshot: DataFrame, bronze: str, silver: SilverTables, gold: str,
    clock: Clock = NOW, versioned: bool = False,
) -> None:
    """Write the three gold tables. The KPIs read the written snapshot, not its plan."""
    write_table(snapshot, f"{gold}/customer_snapshot", versioned)
    snapshot = read_table(spark, f"{gold}/customer_snapshot")
    write_table(kpi_summary(snapshot, clock), f"{gold}/kpi_summary", versioned)
    counts = quality_counts(spark, dq_tables(spark, bronze, silver))
    write_table(dq_summary(counts, clock), f"{gold}/dq_summary", versioned)
