"""Every registered query: (spark, sf_dir) -> DataFrame over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, TimestampNTZType, TimestampType

from assay.functions.hashing import chance, pick_number, pick_one, pick_weighted
from assay.operators import faults, summaries
from assay.operators.quality import rejected, valid
from assay.operators.references import distinct_keys, orphans
from assay.plans import bronze as bronze_plans
from assay.plans import generate, gold, silver as silver_plans
from assay.plans.clock import Clock
from assay.plans.customer_facts import CustomerFacts, snapshot_from_facts
from assay.plans.medallion import Layout, refine_bronze, refresh, run
from assay.plans.quarantine import read_quarantine
from assay.plans.refresh import ShardedSilver
from assay.plans.silver import SilverTables
from assay.session import new_run_root, written
from assay.sources import fixed_values as fixed
from assay.sources.folders import set_file_times
from assay.sources.specs import BY_NAME, CUSTOMERS, ORDERS, SOURCES, SourceSpec
from assay.sources.tables import read_latest_drop, write_drop, write_table
from assay.streaming.ingest import ingest_new
from checks.feeds import landing_feed, table

Query = Callable[[SparkSession, str], DataFrame]

NAMES = [spec.name for spec in SOURCES]
DAY = Clock(date(2001, 6, 1))
EARLIER_DAY = Clock(date(1996, 6, 1))
TICKET_DAY = Clock(date(2024, 1, 25))
CLOCKS = {name: TICKET_DAY if name == "support_tickets" else DAY for name in NAMES}
INSTANT = Clock(instant=datetime(2024, 1, 25, 9, 30))
DROP_STAMP = datetime(2001, 6, 1)
BATCH = "batch-1"
UPDATES_SINCE = "1998-01-01"


def comparable(df: DataFrame) -> DataFrame:
    """Dates, timestamps and flags as text, so that every client shows them alike."""
    texts = (DateType, TimestampType, TimestampNTZType, BooleanType)
    return df.select(*[
        F.col(c.name).cast("string").alias(c.name) if isinstance(c.dataType, texts)
        else F.col(c.name)
        for c in df.schema
    ])


def money(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 2) for name in names})


# --- bronze ----------------------------------------------------------------------------------

def _land(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """Write one CSV drop per feed and return the run's root folder."""
    root = new_run_root(spark, "landing")
    for name in names:
        feed = landing_feed(spark, sf_dir, name)
        write_drop(feed, f"{root}/landing", BY_NAME[name].feed, DROP_STAMP)
    return root


def bronze_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """CSV drop, ingested; the source file is reduced to its drop, which is the same anywhere."""
    spec, root = BY_NAME[name], _land(spark, sf_dir, [name])
    bronze_plans.ingest(
        spark, spec, f"{root}/landing", f"{root}/bronze", f"{root}/log", DAY, batch_id=BATCH
    )
    rows = spark.read.parquet(f"{root}/bronze/{spec.feed}")
    drop = F.regexp_extract("_source_file", rf"/({spec.feed}_[0-9_]+\.csv)/", 1)
    return comparable(rows.withColumn("_source_file", drop))


def bronze_latest_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of one feed; only the later one is read."""
    landing = f"{new_run_root(spark, 'landing')}/landing"
    feed = landing_feed(spark, sf_dir, "customers")
    write_drop(feed, landing, CUSTOMERS.feed, DROP_STAMP)
    updates = feed.where(F.col("updated_at") >= UPDATES_SINCE)
    write_drop(updates, landing, CUSTOMERS.feed, datetime(2001, 6, 2))
    return read_latest_drop(spark, landing, CUSTOMERS.feed, CUSTOMERS.schema)


def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops, ingested one after the other and then once more: every file is read once."""
    return _two_drops(spark, sf_dir, (_new, _new, _new))


def bronze_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second drop carries a file time thirty days before the first one's."""
    return _two_drops(spark, sf_dir, (_new, _new, _new), second_is_older=True)


def bronze_batch_then_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first drop by the batch mode, the second by the new-files mode, over one folder."""
    return _two_drops(spark, sf_dir, (_batch, _new, _new))


def bronze_new_then_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other way round; the batch mode reads the first drop again, so its rows of the first
    drop are left out here."""
    rows = _two_drops(spark, sf_dir, (_new, _batch, _new), keep_file=True)
    again = (F.col("_batch_id") == "second") & F.col("_source_file").contains("_20010601_")
    return rows.where(~again).drop("_source_file")


def _new(
    spark: SparkSession, root: str, batch_id: str, spec: SourceSpec = CUSTOMERS
) -> None:
    ingest_new(
        spark, spec, f"{root}/landing", f"{root}/bronze", f"{root}/manifests", f"{root}/log",
        DAY, batch_id=batch_id,
    )


def _batch(spark: SparkSession, root: str, batch_id: str) -> None:
    bronze_plans.ingest(
        spark, CUSTOMERS, f"{root}/landing", f"{root}/bronze", f"{root}/log", DAY,
        batch_id=batch_id, manifests=f"{root}/manifests",
    )


def _two_drops(
    spark: SparkSession, sf_dir: str, runs: tuple[Callable, ...], second_is_older: bool = False,
    keep_file: bool = False,
) -> DataFrame:
    """Bronze customers after a first drop and run, a second drop and run, and a third run."""
    root = new_run_root(spark, "landing")
    feed = landing_feed(spark, sf_dir, "customers")
    write_drop(feed, f"{root}/landing", CUSTOMERS.feed, DROP_STAMP)
    runs[0](spark, root, "first")
    updates = feed.where(F.col("updated_at") >= UPDATES_SINCE)
    drop = write_drop(updates, f"{root}/landing", CUSTOMERS.feed, datetime(2001, 6, 2))
    if second_is_older:
        set_file_times(spark, drop, datetime.now() - timedelta(days=30))
    runs[1](spark, root, "second")
    runs[2](spark, root, "third")
    rows = spark.read.parquet(f"{root}/bronze/{CUSTOMERS.feed}")
    more = ["_source_file"] if keep_file else []
    return rows.select(*CUSTOMERS.columns, "_batch_id", "_record_hash", *more)


def bronze_new_feed_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only orders have landed: the new-files mode ingests them and logs customers as failed."""
    root = _land(spark, sf_dir, ["orders"])
    _new(spark, root, "first", ORDERS)
    try:
        _new(spark, root, "first")
    except Exception:
        return _log(spark, f"{root}/log")
    raise AssertionError("ingesting a feed that has not landed must fail")


def _log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(
        "source_name", "rows_read", "rows_written", "status",
        F.col("error_message").isNotNull().cast("string").alias("has_error"),
        (F.col("duration_seconds") >= 0).cast("string").alias("timed"),
    )


def bronze_ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _land(spark, sf_dir, NAMES)
    bronze_plans.ingest_all(spark, f"{root}/landing", f"{root}/bronze", f"{root}/log")
    return _log(spark, f"{root}/log")


def bronze_ingest_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only customers have landed: orders fail, are logged as failed, and end the run."""
    root = _land(spark, sf_dir, ["customers"])
    try:
        bronze_plans.ingest_all(spark, f"{root}/landing", f"{root}/bronze", f"{root}/log")
    except Exception:
        return _log(spark, f"{root}/log")
    raise AssertionError("ingesting a feed that has not landed must fail")


def _bronze_customers_orders(spark: SparkSession, sf_dir: str) -> str:
    root = _land(spark, sf_dir, ["customers", "orders"])
    bronze_plans.ingest_all(
        spark, f"{root}/landing", f"{root}/bronze", f"{root}/log", (CUSTOMERS, ORDERS)
    )
    return f"{root}/bronze"


def bronze_inspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_plans.inspect_bronze(spark, _bronze_customers_orders(spark, sf_dir))[0]


def preview5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows the preview shows, and how many of them the bronze table holds."""
    bronze = _bronze_customers_orders(spark, sf_dir)
    shown = written(
        bronze_plans.inspect_bronze(spark, bronze)[1], new_run_root(spark, "preview")
    )
    stored = spark.read.parquet(f"{bronze}/{CUSTOMERS.feed}").select(
        F.col("_record_hash").alias("stored")
    ).distinct()
    return shown.join(stored, F.col("_record_hash") == F.col("stored"), "left").agg(
        F.count(F.lit(1)).alias("rows_shown"), F.count("stored").alias("rows_found")
    )


def bronze_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose amount lands as text, and what bronze and the quarantine hold of them."""
    root = new_run_root(spark, "landing")
    amount = F.when(F.right("order_id", F.lit(2)) == "05", "n/a").otherwise(
        F.col("order_amount").cast("string")
    )
    feed = landing_feed(spark, sf_dir, "orders").withColumn("order_amount", amount)
    write_drop(feed, f"{root}/landing", ORDERS.feed, DROP_STAMP)
    bronze_plans.ingest(
        spark, ORDERS, f"{root}/landing", f"{root}/bronze", f"{root}/log", DAY, batch_id=BATCH
    )
    cells = read_quarantine(spark, f"{root}/bronze", ORDERS.feed)
    rows = spark.read.parquet(f"{root}/bronze/{ORDERS.feed}")
    return cells.select(
        "column_name", "cell_text", F.col("first_cell").alias("order_id")
    ).unionByName(
        rows.where("order_amount IS NULL").select(
            F.lit("bronze").alias("column_name"), F.lit(None).cast("string").alias("cell_text"),
            "order_id",
        )
    )


# --- silver, step by step --------------------------------------------------------------------

def _standardised(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    feed = landing_feed(spark, sf_dir, name)
    return silver_plans.standardise(feed, BY_NAME[name], CLOCKS[name])


def _latest(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return silver_plans.latest(_standardised(spark, sf_dir, name), BY_NAME[name])


def _parents(spark: SparkSession, sf_dir: str, spec: SourceSpec) -> dict[str, DataFrame]:
    """Keys of the valid parent rows, written once and read back.

    Written keys have a known size, so Spark broadcasts them only when they are small, and a
    plain scan under the join, so adaptive execution can split a skewed child.
    """
    keys: dict[str, DataFrame] = {}
    for parent in spec.parents:
        path = new_run_root(spark, f"valid-{parent.table}")
        keys[parent.table] = written(
            valid(_graded(spark, sf_dir, parent.table, keys)).select(parent.key), path
        )
    return keys


def _graded(
    spark: SparkSession, sf_dir: str, name: str, keys: dict[str, DataFrame] | None = None
) -> DataFrame:
    spec = BY_NAME[name]
    keys = keys or _parents(spark, sf_dir, spec)
    return silver_plans.refine(landing_feed(spark, sf_dir, name), spec, keys, CLOCKS[name])


def standardised(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return comparable(_standardised(spark, sf_dir, name))


def deduplicated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return comparable(_latest(spark, sf_dir, name))


def fk_checked(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spec = BY_NAME[name]
    checked = silver_plans.with_parents(
        _latest(spark, sf_dir, name), spec, _parents(spark, sf_dir, spec)
    )
    columns = [c for p in spec.parents for c in (p.key, p.flag)]
    return comparable(checked.select(spec.key, *columns))


def orphaned(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Rows whose last declared parent is missing."""
    spec = BY_NAME[name]
    parent = spec.parents[-1]
    keys = _parents(spark, sf_dir, spec)[parent.table]
    return orphans(_latest(spark, sf_dir, name), keys, parent.key).select(spec.key, parent.key)


def future_flagged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spec = BY_NAME[name]
    flagged = silver_plans.with_warning(_latest(spark, sf_dir, name), spec, CLOCKS[name])
    return comparable(
        flagged.select(spec.key, F.col(spec.warning.flag).alias("is_future"))
    )


def silver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return comparable(valid(_graded(spark, sf_dir, name)))


def rejected_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return comparable(rejected(_graded(spark, sf_dir, name)))


# --- gold ------------------------------------------------------------------------------------

def _feeds(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    return {name: landing_feed(spark, sf_dir, name) for name in names}


def _silver(spark: SparkSession, sf_dir: str, names: list[str] = NAMES) -> SilverTables:
    """The silver layer, written as the production job writes it."""
    tables = SilverTables(spark, new_run_root(spark, "silver"))
    return silver_plans.refine_all(_feeds(spark, sf_dir, names), tables, CLOCKS)


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _silver(spark, sf_dir)
    return gold.customer_snapshot({name: tables.valid(name) for name in NAMES}, DAY)


def _summary(spark: SparkSession, sf_dir: str, name: str, summarise: Callable) -> DataFrame:
    return comparable(summarise(valid(_graded(spark, sf_dir, name))))


def order_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money(_summary(spark, sf_dir, "orders", summaries.order_summary), "total_revenue")


def payment_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _summary(spark, sf_dir, "payments", summaries.payment_summary)
    return money(rows, "successful_payment_amount")


def customer_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = comparable(_snapshot(spark, sf_dir))
    return money(rows, "total_revenue", "successful_payment_amount")


def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.kpi_summary(_snapshot(spark, sf_dir), DAY)
    return comparable(money(rows, "total_revenue", "avg_customer_revenue"))


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed feeds stand in for the bronze tables, row for row."""
    tables, feeds = _silver(spark, sf_dir), _feeds(spark, sf_dir, NAMES)
    counted = [(name, feeds[name], tables.graded(name)) for name in NAMES]
    return comparable(gold.dq_summary(gold.quality_counts(spark, counted), DAY))


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.rejection_counts(_silver(spark, sf_dir))


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.run_report(spark, _feeds(spark, sf_dir, NAMES), _silver(spark, sf_dir))


# --- changed keys only ----------------------------------------------------------------------

# From these days on, rows of a feed land in the second drop.
SECOND_DROP = {
    "customers": "1995-06-01", "addresses": "1995-06-01", "orders": "2000-01-01",
    "payments": "2000-06-01", "support_tickets": "2024-01-20", "loyalty_accounts": "1997-06-01",
}


def _refreshed(
    spark: SparkSession, sf_dir: str, names: list[str]
) -> tuple[ShardedSilver, CustomerFacts]:
    """Two drops of every feed, each ingested and then merged into silver and the facts."""
    layout = Layout(new_run_root(spark, "refreshed"))
    for day in (1, 2):
        for name in names:
            spec, feed = BY_NAME[name], landing_feed(spark, sf_dir, name)
            late = F.coalesce(F.col(spec.order_column) >= SECOND_DROP[name], F.lit(False))
            stamp = datetime(2001, 6, day)
            write_drop(feed.where(late == (day == 2)), layout.landing, spec.feed, stamp)
            ingest_new(
                spark, spec, layout.landing, layout.bronze, layout.manifests,
                layout.ingestion_log, DAY,
            )
        tables = refresh(spark, layout, clocks=CLOCKS, shards=8)
    return tables


def refreshed_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Both sides of a silver table after a refresh with the second drop."""
    spec = BY_NAME[name]
    parents = [parent.table for parent in spec.parents]
    names = [n for n in NAMES if n in (*parents, name)]
    silver, _ = _refreshed(spark, sf_dir, names)
    rows = silver.graded(name)
    return comparable(rows.drop(*bronze_plans.AUDIT_COLUMNS))


def refreshed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot from facts that were brought up to date with the second drop."""
    _, facts = _refreshed(spark, sf_dir, NAMES)
    rows = comparable(snapshot_from_facts(facts, DAY))
    return money(rows, "total_revenue", "successful_payment_amount")


# --- landing to gold -------------------------------------------------------------------------

def _landed(spark: SparkSession, sf_dir: str, names: list[str]) -> tuple[Layout, SilverTables]:
    """CSV drops, ingested, and refined from bronze Parquet."""
    layout = Layout(_land(spark, sf_dir, names))
    for name in names:
        bronze_plans.ingest(
            spark, BY_NAME[name], layout.landing, layout.bronze, layout.ingestion_log, DAY,
            batch_id=BATCH,
        )
    return layout, refine_bronze(spark, layout, DAY, names)


def landed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid silver orders with the audit columns that bronze gave them."""
    _, tables = _landed(spark, sf_dir, ["customers", "orders"])
    drop = F.regexp_extract("_source_file", r"/(orders_[0-9_]+\.csv)/", 1)
    return comparable(
        tables.valid("orders").withColumn("_source_file", drop).select(
            *ORDERS.columns, *bronze_plans.AUDIT_COLUMNS
        )
    )


def landed_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs as the whole run writes them, from the written snapshot."""
    layout = Layout(_land(spark, sf_dir, NAMES))
    run(spark, layout, DAY)
    rows = spark.read.parquet(f"{layout.gold}/kpi_summary")
    return comparable(money(rows, "total_revenue", "avg_customer_revenue"))


def published_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid customers by a reader from before a second publishing, and by one from after it.

    The two versions were refined on different days, so their future-date flags differ.
    """
    feed = {CUSTOMERS.name: landing_feed(spark, sf_dir, CUSTOMERS.name)}
    tables = SilverTables(spark, new_run_root(spark, "silver"), versioned=True)
    seen = []
    for reader, clock in (("before", EARLIER_DAY), ("after", DAY)):
        silver_plans.refine_all(feed, tables, {CUSTOMERS.name: clock})
        seen.append(tables.valid(CUSTOMERS.name).withColumn("reader", F.lit(reader)))
    return comparable(seen[0].unionByName(seen[1]).select(
        "reader", *CUSTOMERS.columns, CUSTOMERS.warning.flag, "_silver_processed_at"
    ))


def landed_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality summary through the table mapping; loyalty accounts have never landed."""
    present = [name for name in NAMES if name != "loyalty_accounts"]
    layout, tables = _landed(spark, sf_dir, present)
    counts = gold.quality_counts(spark, gold.dq_tables(spark, layout.bronze, tables))
    path = f"{layout.gold}/dq_summary"
    write_table(gold.dq_summary(counts, DAY), path)
    return comparable(spark.read.parquet(path))


# --- feed generation -------------------------------------------------------------------------

def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.split("c_name", "#")
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("number"),
        names[0].alias("first_name"),
        names[1].alias("last_name"),
    )


def generated(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    customers = generate.generate_customers(people(spark, sf_dir), INSTANT)
    if name == "customers":
        return customers
    if name == "addresses":
        return generate.generate_addresses(customers)
    if name == "payments":
        return generate.generate_payments(generate.generate_orders(customers, INSTANT), INSTANT)
    make = {
        "orders": generate.generate_orders,
        "support_tickets": generate.generate_support_tickets,
        "loyalty_accounts": generate.generate_loyalty_accounts,
    }[name]
    return make(customers, INSTANT)


def gen_keys_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 to 15 numbered child keys per customer."""
    k = F.col("c_custkey")
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    children = faults.fan_out(customers, pick_number(k, "children", 1, 15), "position")
    return children.select(
        faults.format_key(k, fixed.CUSTOMER_KEY).alias("customer_id"),
        faults.format_key(k * 15 + F.col("position"), fixed.ORDER_KEY).alias("order_id"),
    )


def gen_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of customers that buys."""
    orders = table(spark, sf_dir, "orders")
    buyers = distinct_keys(orders, "o_custkey")
    return faults.sample_keys(buyers, "o_custkey", "buyers", fixed.RATES["orders"]["customers"])


def gen_categorical(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        pick_one(k, "channel", fixed.SALES_CHANNELS).alias("channel"),
        pick_weighted(
            k, "tier", fixed.LOYALTY_TIERS, fixed.TIER_WEIGHTS
        ).alias("tier"),
    )


def gen_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    lost = chance(k, "null_name", fixed.RATES["customers"]["null_phone"])
    return table(spark, sf_dir, "customer").select(
        "c_custkey", faults.null_where(lost, F.col("c_name")).alias("c_name")
    )


def gen_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    copied = chance(F.col("o_orderkey"), "copy", fixed.RATES["orders"]["duplicate"])
    return faults.with_copies(rows, copied)


def gen_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order references, plus some to orders that do not exist and have no customer."""
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    real = rows.select(
        faults.format_key(k, fixed.ORDER_KEY).alias("order_id"), F.col("o_custkey")
    )
    stray = faults.sample_keys(rows, "o_orderkey", "orphan", fixed.RATES["payments"]["orphan"])
    return real.unionByName(stray.select(
        faults.format_key(k, fixed.MISSING_ORDER_KEY).alias("order_id"),
        F.lit(None).cast("bigint").alias("o_custkey"),
    ))


def gen_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    bad = chance(k, "bad_status", fixed.RATES["orders"]["bad_status"])
    wrong = pick_one(k, "which_status", fixed.BAD_ORDER_STATUSES)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        faults.replace_where(bad, wrong, F.col("o_orderstatus")).alias("o_orderstatus"),
    )


def gen_signflip(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    flipped = chance(k, "negative", fixed.RATES["orders"]["negative"])
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        faults.flip_sign_where(flipped, F.col("o_totalprice")).alias("o_totalprice"),
    )


def gen_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    late = chance(k, "future", fixed.RATES["orders"]["future"])
    ahead = faults.shift(INSTANT.wall(), "days", pick_number(k, "ahead", 1, 365))
    moment = faults.replace_where(late, ahead, F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", faults.moment_text(moment).alias("order_date")
    )


def gen_negative_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events end after they start, except for the injected ones; others have no end."""
    k, start = F.col("event_id"), F.col("ts")
    after = faults.shift(start, "hours", pick_number(k, "hours", 1, 240))
    before = faults.shift(start, "hours", -pick_number(k, "hours_back", 1, 48))
    wrong = chance(k, "negative", fixed.RATES["support_tickets"]["negative_interval"])
    end = faults.replace_where(wrong, before, after)
    return table(spark, sf_dir, "events").select(
        "event_id",
        faults.moment_text(start).alias("started"),
        F.when(F.col("event_type") == "error", faults.moment_text(end)).alias("ended"),
    )


# --- register --------------------------------------------------------------------------------

def _per_table(prefix: str, query: Callable, names: list[str]) -> dict[str, Query]:
    return {f"{prefix}_{name}": partial(query, name=name) for name in names}


def all_queries() -> dict[str, Query]:
    children = [spec.name for spec in SOURCES if spec.parents]
    return {
        **_per_table("feed", landing_feed, NAMES),
        **_per_table("bronze", bronze_table, NAMES),
        "bronze_latest_drop": bronze_latest_drop,
        "bronze_incremental": bronze_incremental,
        "bronze_late_drop": bronze_late_drop,
        "bronze_batch_then_new": bronze_batch_then_new,
        "bronze_new_then_batch": bronze_new_then_batch,
        "bronze_new_feed_missing": bronze_new_feed_missing,
        "bronze_ingest_log": bronze_ingest_log,
        "bronze_ingest_failure": bronze_ingest_failure,
        "bronze_inspect": bronze_inspect,
        "bronze_malformed": bronze_malformed,
        "preview5": preview5,
        **_per_table("std", standardised, NAMES),
        **_per_table("dedup", deduplicated, NAMES),
        **_per_table("fk", fk_checked, children),
        **_per_table("orphan", orphaned, children),
        **_per_table("future", future_flagged, NAMES),
        **_per_table("silver", silver_table, NAMES),
        **_per_table("rejected", rejected_table, NAMES),
        **_per_table("refreshed", refreshed_table, NAMES),
        "refreshed_snapshot": refreshed_snapshot,
        "reject_reasons": reject_reasons,
        "run_report": run_report,
        "primary_address": partial(
            _summary, name="addresses", summarise=summaries.primary_address
        ),
        "loyalty_per_customer": partial(
            _summary, name="loyalty_accounts", summarise=summaries.loyalty_per_customer
        ),
        "order_summary": order_summary,
        "payment_summary": payment_summary,
        "support_summary": partial(
            _summary, name="support_tickets", summarise=summaries.support_summary
        ),
        "customer_snapshot": customer_snapshot,
        "kpi_summary": kpi_summary,
        "dq_summary": dq_summary,
        "landed_orders": landed_orders,
        "landed_kpis": landed_kpis,
        "landed_quality": landed_quality,
        "published_customers": published_customers,
        **_per_table("gen", generated, NAMES),
        "gen_keys_fanout": gen_keys_fanout,
        "gen_sample": gen_sample,
        "gen_categorical": gen_categorical,
        "gen_nulls": gen_nulls,
        "gen_duplicates": gen_duplicates,
        "gen_orphans": gen_orphans,
        "gen_invalid": gen_invalid,
        "gen_signflip": gen_signflip,
        "gen_future": gen_future,
        "gen_negative_interval": gen_negative_interval,
    }
