"""Per-customer and whole-table summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators.dedup import descending, first_per_key
from assay.sources.fixed_values import (
    OPEN_TICKET_STATUSES, PRIMARY_FLAG, REVENUE_STATUSES, SUCCESSFUL_PAYMENT,
)


def exact_sum(amount: Column) -> Column:
    """Sum of doubles that is the same in whatever order tasks add them up.

    They are added as decimals of ten places. Where one does not fit (28 digits before the point,
    not a number, infinite), all are added as doubles.
    """
    decimal = amount.try_cast("decimal(38,10)")
    exact = F.when(F.count(amount) == F.count(decimal), F.try_sum(decimal).cast("double"))
    return F.coalesce(exact, F.sum(amount))


def sum_where(condition: Column, amount: str) -> Column:
    """Sum of the amounts that satisfy the condition, 0 for rows that do not."""
    return exact_sum(F.when(condition, F.col(amount)).otherwise(F.lit(0.0)))


def count_where(condition: Column, column: str) -> Column:
    """Number of non-NULL ``column`` values that satisfy the condition."""
    return F.count(F.when(condition, F.col(column)))


def sum_flag(condition: Column) -> Column:
    """Number of true rows; NULL over no rows, like any sum."""
    return F.sum(condition.cast("int"))


def primary_address(addresses: DataFrame) -> DataFrame:
    """The latest primary address of each customer."""
    primary = addresses.where(F.col("is_primary") == PRIMARY_FLAG)
    ordering = descending(["updated_at", "address_id"])
    return first_per_key(primary, ["customer_id"], ordering).select(
        "customer_id", "state", "postcode", "country"
    )


def loyalty_per_customer(accounts: DataFrame) -> DataFrame:
    """The latest loyalty account of each customer."""
    ordering = descending(["updated_at", "loyalty_account_id"])
    return first_per_key(accounts, ["customer_id"], ordering).select(
        "customer_id", F.col("tier").alias("loyalty_tier"), "points_balance", "loyalty_status"
    )


def order_summary(orders: DataFrame) -> DataFrame:
    earning = F.col("order_status").isin(*REVENUE_STATUSES)
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        sum_where(earning, "order_amount").alias("total_revenue"),
        F.max("order_date").alias("last_order_date"),
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    successful = F.col("payment_status") == SUCCESSFUL_PAYMENT
    return payments.groupBy("customer_id").agg(
        count_where(successful, "payment_id").alias("successful_payment_count"),
        sum_where(successful, "payment_amount").alias("successful_payment_amount"),
        F.max("payment_date").alias("last_payment_date"),
    )


def support_summary(tickets: DataFrame) -> DataFrame:
    unsettled = F.col("ticket_status").isin(*OPEN_TICKET_STATUSES)
    return tickets.groupBy("customer_id").agg(
        F.count("ticket_id").alias("support_ticket_count"),
        count_where(unsettled, "ticket_id").alias("open_ticket_count"),
        F.max("ticket_created_at").alias("last_support_ticket_date"),
    )
