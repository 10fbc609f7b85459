"""Generated feeds: fault shares, keys, and a full run over them."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from assay.operators.faults import format_key, key_number
from assay.plans import generate
from assay.plans.clock import Clock
from assay.plans.medallion import Layout, run
from assay.sources import fixed_values as fixed
from assay.sources.specs import BY_NAME, SOURCES

PEOPLE = 4000
CLOCK = Clock(instant=datetime(2024, 1, 25, 9, 30))


@pytest.fixture(scope="module")
def feeds(spark):
    customers = generate.generate_customers(
        generate.people_from_range(spark, PEOPLE), CLOCK
    ).cache()
    orders = generate.generate_orders(customers, CLOCK).cache()
    made = {
        "customers": customers,
        "orders": orders,
        "addresses": generate.generate_addresses(customers).cache(),
        "payments": generate.generate_payments(orders, CLOCK).cache(),
        "support_tickets": generate.generate_support_tickets(customers, CLOCK).cache(),
        "loyalty_accounts": generate.generate_loyalty_accounts(customers, CLOCK).cache(),
    }
    yield made
    for feed in made.values():
        feed.unpersist()


def share(feed, condition):
    return feed.agg(F.avg(F.when(condition, 1.0).otherwise(0.0))).first()[0]


def test_schemas(feeds):
    for name, feed in feeds.items():
        wanted = [(c.name, c.dataType) for c in BY_NAME[name].schema]
        assert [(c.name, c.dataType) for c in feed.schema] == wanted


def test_keys_are_formatted_and_long_numbers_kept(spark):
    rows = spark.createDataFrame([(7,), (123456789,)], "n BIGINT")
    keys = rows.select(format_key(F.col("n"), fixed.CUSTOMER_KEY).alias("k"))
    assert [r[0] for r in keys.collect()] == ["CRM0000007", "CRM123456789"]
    assert [r[0] for r in keys.select(key_number(F.col("k"))).collect()] == [7, 123456789]


def test_copies_are_exact_and_keys_unique_otherwise(feeds):
    for name, rate in (("customers", 0.02), ("orders", 0.01), ("payments", 0.008)):
        feed, key = feeds[name], BY_NAME[name].key
        distinct = feed.distinct()
        assert distinct.count() == distinct.select(key).distinct().count()
        extra = feed.count() - distinct.count()
        assert extra / distinct.count() == pytest.approx(rate, abs=0.01) and extra > 0


def test_fault_shares(feeds):
    customers, orders, payments = feeds["customers"], feeds["orders"], feeds["payments"]
    bad_email = F.col("email").isin(*fixed.BAD_EMAILS)
    assert share(customers, bad_email) == pytest.approx(0.01, abs=0.006)
    assert share(customers, F.col("phone").isNull()) == pytest.approx(0.01, abs=0.006)
    assert share(orders, F.col("customer_id").isNull()) == pytest.approx(0.005, abs=0.003)
    assert share(orders, F.col("order_amount") < 0) == pytest.approx(0.002, abs=0.002)
    assert share(orders, F.col("order_date") > "2024-01-26") == pytest.approx(0.005, abs=0.003)
    assert share(payments, F.col("order_id").startswith("ORD_MISSING_")) == pytest.approx(
        0.003, abs=0.002
    )
    assert share(payments, F.col("payment_status") == "SUCCESS") == pytest.approx(0.82, abs=0.03)
    gold = share(feeds["loyalty_accounts"], F.col("tier") == "GOLD")
    assert gold == pytest.approx(0.18, abs=0.04)


def test_parents_and_fan_out(feeds):
    orders, tickets = feeds["orders"], feeds["support_tickets"]
    known = feeds["customers"].select("customer_id").distinct()
    linked = orders.where("customer_id IS NOT NULL")
    assert linked.join(known, "customer_id", "left_anti").count() == 0
    per_buyer = linked.distinct().groupBy("customer_id").count()
    assert per_buyer.agg(F.max("count")).first()[0] <= fixed.MAX_ORDERS_PER_CUSTOMER
    assert per_buyer.count() / PEOPLE == pytest.approx(0.60, abs=0.04)
    per_caller = tickets.where("customer_id IS NOT NULL").distinct().groupBy("customer_id").count()
    assert per_caller.agg(F.max("count")).first()[0] <= fixed.MAX_TICKETS_PER_CUSTOMER
    assert feeds["addresses"].select("customer_id").distinct().count() == PEOPLE


def test_only_settled_tickets_have_an_end(feeds):
    tickets = feeds["support_tickets"]
    settled = F.col("ticket_status").isin("RESOLVED", "CLOSED")
    assert tickets.where(settled != F.col("ticket_resolved_at").isNotNull()).count() == 0


def test_same_keys_make_the_same_feed(spark, feeds):
    again = generate.generate_customers(
        generate.people_from_range(spark, PEOPLE).repartition(7), CLOCK
    )
    assert again.exceptAll(feeds["customers"]).count() == 0
    assert again.count() == feeds["customers"].count()


def test_landing_to_gold(spark, folder):
    layout = Layout(folder)
    generate.land_generated(
        generate.people_from_range(spark, 500), layout.landing, datetime(2024, 1, 25), CLOCK
    )
    run(spark, layout, CLOCK)
    log = spark.read.parquet(layout.ingestion_log)
    assert log.where("status = 'SUCCESS' AND rows_read > 0").count() == len(SOURCES)
    quality = spark.read.parquet(f"{layout.gold}/dq_summary")
    assert quality.count() == len(SOURCES)
    for row in quality.collect():
        assert 0 < row["silver_valid_rows"] <= row["total_processed_rows"] <= row["bronze_rows"]
    customers = quality.where("source_name = 'customers'").first()["silver_valid_rows"]
    assert spark.read.parquet(f"{layout.gold}/customer_snapshot").count() == customers
    assert spark.read.parquet(f"{layout.gold}/kpi_summary").first()["total_customers"] == customers
