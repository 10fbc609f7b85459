"""Dirty feeds for trial runs, at any size: every value is a function of the row's key."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.functions.hashing import chance, pick_number, pick_one, pick_weighted
from assay.operators.dedup import descending, first_per_key
from assay.operators.faults import (
    fan_out, flip_sign_where, format_key, key_number, moment_text, null_where,
    replace_where, sample_keys, shift, with_copies,
)
from assay.operators.references import distinct_keys
from assay.plans.clock import NOW, Clock
from assay.sources import fixed_values as fixed
from assay.sources.specs import BY_NAME
from assay.sources.tables import write_drop


def _amount(key: Column, purpose: str) -> Column:
    """Money from 10.00 to 5000.00."""
    return pick_number(key, purpose, 1000, 500000) / F.lit(100)


def _finish(rows: DataFrame, name: str, rate: float) -> DataFrame:
    """Feed columns in order and type, plus exact copies of some rows."""
    spec = BY_NAME[name]
    feed = rows.select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in spec.schema])
    return with_copies(feed, chance(F.col(spec.key), f"{name}.duplicate", rate))


def people_from_range(spark: SparkSession, count: int) -> DataFrame:
    """``count`` numbered people with made-up names."""
    number = F.col("id") + 1
    return spark.range(count).select(
        number.alias("number"), F.lit("Customer").alias("first_name"),
        F.concat(F.lit("No"), number).alias("last_name"),
    )


def generate_customers(people: DataFrame, clock: Clock = NOW) -> DataFrame:
    """Customers from ``people`` (number, first_name, last_name)."""
    rates, k = fixed.RATES["customers"], F.col("number")
    signup = F.date_sub(clock.today(), pick_number(k, "customers.signup", 0, 1826).cast("int"))
    update = F.date_add(signup, pick_number(k, "customers.update", 0, 1200).cast("int"))
    birth = F.date_sub(
        clock.today(), pick_number(k, "customers.birth", 18 * 366, 80 * 365).cast("int")
    )
    email = F.concat(
        F.lower("first_name"), F.lit("."), F.lower("last_name"), k, F.lit("@example.com")
    )
    rows = people.select(
        format_key(k, fixed.CUSTOMER_KEY).alias("customer_id"),
        "first_name",
        "last_name",
        replace_where(
            chance(k, "customers.bad_email", rates["bad_email"]),
            pick_one(k, "customers.which_email", fixed.BAD_EMAILS), email,
        ).alias("email"),
        null_where(
            chance(k, "customers.null_phone", rates["null_phone"]),
            format_key(pick_number(k, "customers.phone", 0, 99_999_999), ("04", 8)),
        ).alias("phone"),
        null_where(chance(k, "customers.null_birth", rates["null_birth"]), birth)
        .alias("date_of_birth"),
        pick_one(k, "customers.gender", fixed.GENDERS).alias("gender"),
        signup.alias("signup_date"),
        pick_one(k, "customers.status", fixed.CUSTOMER_STATUSES).alias("status"),
        signup.alias("created_at"),
        update.alias("updated_at"),
        F.lit("crm").alias("source_system"),
    )
    return _finish(rows, "customers", rates["duplicate"])


def generate_addresses(customers: DataFrame) -> DataFrame:
    """One primary address per distinct customer of the feed."""
    rates, k = fixed.RATES["addresses"], F.col("customer_id")
    parents = first_per_key(
        customers.where(k.isNotNull()).select("customer_id", "created_at"),
        ["customer_id"], descending(["created_at"]),
    )
    created = F.col("created_at").cast("date")
    number = key_number(k)
    rows = parents.select(
        format_key(number, fixed.ADDRESS_KEY).alias("address_id"),
        "customer_id",
        F.concat(pick_number(k, "addresses.number", 1, 999), F.lit(" Main St"))
        .alias("address_line_1"),
        F.concat(F.lit("Suburb "), pick_number(k, "addresses.suburb", 1, 500)).alias("suburb"),
        replace_where(
            chance(k, "addresses.bad_state", rates["bad_state"]),
            pick_one(k, "addresses.which_state", fixed.BAD_STATES),
            pick_one(k, "addresses.state", fixed.STATES),
        ).alias("state"),
        null_where(
            chance(k, "addresses.null_postcode", rates["null_postcode"]),
            format_key(pick_number(k, "addresses.postcode", 200, 9999), ("", 4)),
        ).alias("postcode"),
        F.lit("Australia").alias("country"),
        F.lit("True").alias("is_primary"),
        created.alias("created_at"),
        F.date_add(created, pick_number(k, "addresses.update", 0, 1200).cast("int"))
        .alias("updated_at"),
        F.lit("crm").alias("source_system"),
    )
    return _finish(rows, "addresses", rates["duplicate"])


def generate_orders(customers: DataFrame, clock: Clock = NOW) -> DataFrame:
    """1 to 15 orders for each of the sampled customers."""
    rates = fixed.RATES["orders"]
    buyers = sample_keys(
        distinct_keys(customers, "customer_id"), "customer_id", "orders.customers",
        rates["customers"],
    )
    most = fixed.MAX_ORDERS_PER_CUSTOMER
    many = fan_out(
        buyers, pick_number(F.col("customer_id"), "orders.count", 1, most), "position"
    )
    number = key_number(F.col("customer_id")) * most + F.col("position")
    keyed = many.select("customer_id", format_key(number, fixed.ORDER_KEY).alias("order_id"))

    k = F.col("order_id")
    past = shift(clock.wall(), "days", -pick_number(k, "orders.age", 0, 1825))
    future = shift(clock.wall(), "days", pick_number(k, "orders.ahead", 1, 365))
    placed = replace_where(chance(k, "orders.future", rates["future"]), future, past)
    dated = keyed.select("*", placed.alias("placed"))
    rows = dated.select(
        "order_id",
        null_where(
            chance(k, "orders.null_customer", rates["null_customer"]), F.col("customer_id")
        ).alias("customer_id"),
        moment_text(F.col("placed")).alias("order_date"),
        replace_where(
            chance(k, "orders.bad_status", rates["bad_status"]),
            pick_one(k, "orders.which_status", fixed.BAD_ORDER_STATUSES),
            pick_one(k, "orders.status", fixed.ORDER_STATUSES),
        ).alias("order_status"),
        flip_sign_where(
            chance(k, "orders.negative", rates["negative"]), _amount(k, "orders.amount")
        ).alias("order_amount"),
        F.lit("AUD").alias("currency"),
        pick_one(k, "orders.channel", fixed.SALES_CHANNELS).alias("sales_channel"),
        moment_text(F.col("placed")).alias("created_at"),
        moment_text(shift(F.col("placed"), "days", pick_number(k, "orders.update", 0, 30)))
        .alias("updated_at"),
        F.lit("ecommerce").alias("source_system"),
    )
    return _finish(rows, "orders", rates["duplicate"])


def generate_payments(orders: DataFrame, clock: Clock = NOW) -> DataFrame:
    """A payment for most distinct orders, plus some that refer to no order."""
    rates, k = fixed.RATES["payments"], F.col("order_id")
    wanted = ["order_id", "customer_id", "order_date", "order_amount"]
    distinct_orders = first_per_key(
        orders.where(k.isNotNull()).select(*wanted), ["order_id"], descending(wanted[1:])
    )
    paid = sample_keys(distinct_orders, "order_id", "payments.orders", rates["orders"])
    number = key_number(k)
    moment = shift(
        F.col("order_date").cast("timestamp_ntz"), "mins",
        pick_number(k, "payments.delay", 1, 180),
    )
    status = replace_where(
        chance(k, "payments.bad_status", rates["bad_status"]),
        pick_one(k, "payments.which_status", fixed.BAD_PAYMENT_STATUSES),
        pick_weighted(
            k, "payments.status", fixed.PAYMENT_STATUSES, fixed.PAYMENT_STATUS_WEIGHTS
        ),
    )
    method = pick_one(k, "payments.method", fixed.PAYMENT_METHODS).alias("payment_method")
    regular = paid.select(
        format_key(number * 2, fixed.PAYMENT_KEY).alias("payment_id"),
        "order_id",
        "customer_id",
        moment.alias("moment"),
        status.alias("payment_status"),
        method,
        flip_sign_where(
            chance(k, "payments.negative", rates["negative"]), F.col("order_amount")
        ).alias("payment_amount"),
        shift(moment, "days", pick_number(k, "payments.update", 0, 10)).alias("update"),
    )
    stray = shift(clock.wall(), "days", -pick_number(k, "payments.stray_age", 0, 365))
    orphaned = sample_keys(paid, "order_id", "payments.orphan", rates["orphan"]).select(
        format_key(number * 2 + 1, fixed.PAYMENT_KEY).alias("payment_id"),
        format_key(number, fixed.MISSING_ORDER_KEY).alias("order_id"),
        F.lit(None).cast("string").alias("customer_id"),
        stray.alias("moment"),
        F.lit(fixed.SUCCESSFUL_PAYMENT).alias("payment_status"),
        method,
        _amount(k, "payments.stray_amount").alias("payment_amount"),
        stray.alias("update"),
    )
    rows = regular.unionByName(orphaned).select(
        "*",
        moment_text(F.col("moment")).alias("payment_date"),
        moment_text(F.col("moment")).alias("created_at"),
        moment_text(F.col("update")).alias("updated_at"),
        F.lit("AUD").alias("currency"),
        F.lit("payment_gateway").alias("source_system"),
    )
    return _finish(rows, "payments", rates["duplicate"])


def generate_support_tickets(customers: DataFrame, clock: Clock = NOW) -> DataFrame:
    """1 to 5 tickets for each of the sampled customers."""
    rates = fixed.RATES["support_tickets"]
    callers = sample_keys(
        distinct_keys(customers, "customer_id"), "customer_id", "tickets.customers",
        rates["customers"],
    )
    most = fixed.MAX_TICKETS_PER_CUSTOMER
    many = fan_out(
        callers, pick_number(F.col("customer_id"), "tickets.count", 1, most), "position"
    )
    number = key_number(F.col("customer_id")) * most + F.col("position")
    k = F.col("ticket_id")
    past = shift(clock.wall(), "days", -pick_number(k, "tickets.age", 0, 1095))
    future = shift(clock.wall(), "days", pick_number(k, "tickets.ahead", 1, 180))
    status = replace_where(
        chance(k, "tickets.bad_status", rates["bad_status"]),
        pick_one(k, "tickets.which_status", fixed.BAD_TICKET_STATUSES),
        pick_one(k, "tickets.status", fixed.TICKET_STATUSES),
    )
    opened = many.select(
        "customer_id", format_key(number, fixed.TICKET_KEY).alias("ticket_id")
    ).select(
        "*",
        replace_where(chance(k, "tickets.future", rates["future"]), future, past).alias("opened"),
        status.alias("ticket_status"),
    )
    after = shift(F.col("opened"), "hours", pick_number(k, "tickets.hours", 1, 240))
    before = shift(F.col("opened"), "hours", -pick_number(k, "tickets.hours_back", 1, 48))
    resolved = replace_where(
        chance(k, "tickets.negative_interval", rates["negative_interval"]), before, after
    )
    settled = F.col("ticket_status").isin(*fixed.SETTLED_TICKET_STATUSES)
    rows = opened.select(
        "ticket_id",
        null_where(
            chance(k, "tickets.null_customer", rates["null_customer"]), F.col("customer_id")
        ).alias("customer_id"),
        moment_text(F.col("opened")).alias("ticket_created_at"),
        F.when(settled, moment_text(resolved)).alias("ticket_resolved_at"),
        "ticket_status",
        pick_one(k, "tickets.priority", fixed.PRIORITIES).alias("priority"),
        pick_one(k, "tickets.channel", fixed.TICKET_CHANNELS).alias("channel"),
        pick_one(k, "tickets.category", fixed.TICKET_CATEGORIES).alias("category"),
        format_key(pick_number(k, "tickets.agent", 1, 500), fixed.AGENT_KEY).alias("agent_id"),
        F.lit("zendesk").alias("source_system"),
    )
    return _finish(rows, "support_tickets", rates["duplicate"])


def generate_loyalty_accounts(customers: DataFrame, clock: Clock = NOW) -> DataFrame:
    """An account for each of the sampled customers."""
    rates, k = fixed.RATES["loyalty_accounts"], F.col("customer_id")
    members = sample_keys(
        distinct_keys(customers, "customer_id"), "customer_id", "loyalty.customers",
        rates["customers"],
    )
    past = shift(clock.wall(), "days", -pick_number(k, "loyalty.age", 0, 1825))
    future = shift(clock.wall(), "days", pick_number(k, "loyalty.ahead", 1, 365))
    joined = members.select(
        "customer_id",
        replace_where(chance(k, "loyalty.future", rates["future"]), future, past).alias("joined"),
    )
    rows = joined.select(
        format_key(key_number(k), fixed.LOYALTY_KEY).alias("loyalty_account_id"),
        null_where(
            chance(k, "loyalty.null_customer", rates["null_customer"]), k
        ).alias("customer_id"),
        moment_text(F.col("joined")).alias("join_date"),
        replace_where(
            chance(k, "loyalty.bad_tier", rates["bad_tier"]),
            pick_one(k, "loyalty.which_tier", fixed.BAD_TIERS),
            pick_weighted(k, "loyalty.tier", fixed.LOYALTY_TIERS, fixed.TIER_WEIGHTS),
        ).alias("tier"),
        flip_sign_where(
            chance(k, "loyalty.negative", rates["negative"]),
            pick_number(k, "loyalty.points", 0, 250_000),
        ).alias("points_balance"),
        replace_where(
            chance(k, "loyalty.bad_status", rates["bad_status"]),
            pick_one(k, "loyalty.which_status", fixed.BAD_LOYALTY_STATUSES),
            pick_weighted(
                k, "loyalty.status", fixed.LOYALTY_STATUSES, fixed.LOYALTY_STATUS_WEIGHTS
            ),
        ).alias("loyalty_status"),
        moment_text(F.col("joined")).alias("created_at"),
        moment_text(shift(F.col("joined"), "days", pick_number(k, "loyalty.update", 0, 365)))
        .alias("updated_at"),
        F.lit("loyalty_platform").alias("source_system"),
    )
    return _finish(rows, "loyalty_accounts", rates["duplicate"])


def land_generated(people: DataFrame, landing: str, stamp: datetime, clock: Clock = NOW) -> None:
    """Write one drop of each feed. Children are generated from the latest written parents."""
    spark = people.sparkSession

    def land(rows: DataFrame, name: str) -> DataFrame:
        spec = BY_NAME[name]
        path = write_drop(rows, landing, spec.feed, stamp)
        return spark.read.option("header", True).schema(spec.schema).csv(path)

    customers = land(generate_customers(people, clock), "customers")
    land(generate_addresses(customers), "addresses")
    orders = land(generate_orders(customers, clock), "orders")
    land(generate_payments(orders, clock), "payments")
    land(generate_support_tickets(customers, clock), "support_tickets")
    land(generate_loyalty_accounts(customers, clock), "loyalty_accounts")
