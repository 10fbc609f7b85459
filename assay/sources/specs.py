"""One declaration per feed: schema, cleaning, key, parents, warnings and rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import Column
from pyspark.sql.types import StructType

from assay.functions.cleaning import dated, lowered, trimmed, uppered
from assay.operators.quality import (
    HasParent, Matches, NotBefore, NotNegative, OneOf, Positive, Required, Rule,
)
from assay.sources import fixed_values as fixed


@dataclass(frozen=True)
class Parent:
    """A foreign key into another silver table."""

    table: str
    key: str
    flag: str


@dataclass(frozen=True)
class LateDates:
    """Warn-only flag: some date lies after the processing day."""

    flag: str
    columns: tuple[str, ...]
    optional: tuple[str, ...] = ()


@dataclass(frozen=True)
class SourceSpec:
    name: str
    feed: str
    schema_ddl: str
    key: str
    order_column: str
    cleaning: Mapping[str, Callable[[str], Column]]
    warning: LateDates
    rules: tuple[Rule, ...]
    parents: tuple[Parent, ...] = field(default=())

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.schema_ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _cleaning(*groups: tuple[Callable[[str], Column], tuple[str, ...]]) -> Mapping[str, Callable]:
    return MappingProxyType({name: function for function, names in groups for name in names})


CUSTOMER = Parent("customers", "customer_id", "customer_exists")
ORDER = Parent("orders", "order_id", "order_exists")
LATE_UPDATE = LateDates("_has_future_updated_at", ("updated_at",))

CUSTOMERS = SourceSpec(
    name="customers",
    feed="crm_customers",
    schema_ddl=fixed.CRM_CUSTOMERS_SCHEMA,
    key="customer_id",
    order_column="updated_at",
    cleaning=_cleaning(
        (trimmed, ("first_name", "last_name")),
        (lowered, ("email", "gender", "status")),
        (dated, ("date_of_birth", "signup_date", "created_at", "updated_at")),
    ),
    warning=LATE_UPDATE,
    rules=(
        Required("customer_id"),
        Matches("email", fixed.EMAIL_PATTERN),
        OneOf("status", fixed.CUSTOMER_STATUSES),
    ),
)

ADDRESSES = SourceSpec(
    name="addresses",
    feed="crm_addresses",
    schema_ddl=fixed.CRM_ADDRESSES_SCHEMA,
    key="address_id",
    order_column="updated_at",
    cleaning=_cleaning(
        (trimmed, ("postcode",)),
        (lowered, ("address_line_1", "suburb", "country", "is_primary")),
        (uppered, ("state",)),
        (dated, ("created_at", "updated_at")),
    ),
    parents=(CUSTOMER,),
    warning=LATE_UPDATE,
    rules=(
        Required("address_id"),
        Required("customer_id"),
        HasParent("customer_id", "customers", "customer_exists"),
        OneOf("state", fixed.STATES),
        Required("postcode"),
        Matches("postcode", fixed.POSTCODE_PATTERN),
    ),
)

ORDERS = SourceSpec(
    name="orders",
    feed="orders",
    schema_ddl=fixed.ORDERS_SCHEMA,
    key="order_id",
    order_column="updated_at",
    cleaning=_cleaning(
        (uppered, ("order_status", "currency", "sales_channel")),
        (dated, ("order_date", "created_at", "updated_at")),
    ),
    parents=(CUSTOMER,),
    warning=LATE_UPDATE,
    rules=(
        Required("order_id"),
        Required("customer_id"),
        HasParent("customer_id", "customers", "customer_exists"),
        OneOf("order_status", fixed.ORDER_STATUSES, label="status"),
        Required("sales_channel"),
        OneOf("sales_channel", fixed.SALES_CHANNELS),
        Positive("order_amount"),
    ),
)

PAYMENTS = SourceSpec(
    name="payments",
    feed="payments",
    schema_ddl=fixed.PAYMENTS_SCHEMA,
    key="payment_id",
    order_column="updated_at",
    cleaning=_cleaning(
        (uppered, ("payment_status", "payment_method", "currency")),
        (dated, ("payment_date", "created_at", "updated_at")),
    ),
    parents=(CUSTOMER, ORDER),
    warning=LATE_UPDATE,
    rules=(
        Required("payment_id"),
        Required("order_id"),
        HasParent("order_id", "orders", "order_exists"),
        Required("customer_id"),
        HasParent("customer_id", "customers", "customer_exists"),
        Required("payment_date"),
        Required("payment_status"),
        OneOf("payment_status", fixed.PAYMENT_STATUSES),
        Required("payment_method"),
        OneOf("payment_method", fixed.PAYMENT_METHODS),
        Positive("payment_amount"),
    ),
)

SUPPORT_TICKETS = SourceSpec(
    name="support_tickets",
    feed="support_tickets",
    schema_ddl=fixed.SUPPORT_TICKETS_SCHEMA,
    key="ticket_id",
    order_column="ticket_created_at",
    cleaning=_cleaning(
        (uppered, ("ticket_status", "priority", "channel", "category")),
        (dated, ("ticket_created_at", "ticket_resolved_at")),
    ),
    parents=(CUSTOMER,),
    warning=LateDates(
        "_has_future_ticket_date", ("ticket_created_at",), optional=("ticket_resolved_at",)
    ),
    rules=(
        Required("ticket_id"),
        Required("customer_id"),
        HasParent("customer_id", "customers", "customer_exists"),
        Required("ticket_created_at"),
        NotBefore("ticket_resolved_at", "ticket_created_at"),
        Required("ticket_status"),
        OneOf("ticket_status", fixed.TICKET_STATUSES),
        Required("priority"),
        OneOf("priority", fixed.PRIORITIES),
        Required("channel"),
        OneOf("channel", fixed.TICKET_CHANNELS),
        Required("category"),
        OneOf("category", fixed.TICKET_CATEGORIES),
    ),
)

LOYALTY_ACCOUNTS = SourceSpec(
    name="loyalty_accounts",
    feed="loyalty_accounts",
    schema_ddl=fixed.LOYALTY_ACCOUNTS_SCHEMA,
    key="loyalty_account_id",
    order_column="updated_at",
    cleaning=_cleaning(
        (uppered, ("tier", "loyalty_status")),
        (dated, ("join_date", "created_at", "updated_at")),
    ),
    parents=(CUSTOMER,),
    warning=LateDates("_has_future_date", ("join_date", "updated_at")),
    rules=(
        Required("loyalty_account_id"),
        Required("customer_id"),
        HasParent("customer_id", "customers", "customer_exists"),
        Required("join_date"),
        Required("tier"),
        OneOf("tier", fixed.LOYALTY_TIERS),
        Required("loyalty_status"),
        OneOf("loyalty_status", fixed.LOYALTY_STATUSES),
        Required("points_balance"),
        NotNegative("points_balance"),
    ),
)

# Ingestion order.
SOURCES = (CUSTOMERS, ORDERS, ADDRESSES, PAYMENTS, SUPPORT_TICKETS, LOYALTY_ACCOUNTS)
BY_NAME = MappingProxyType({spec.name: spec for spec in SOURCES})

# Report order of the data-quality summary.
REPORTED = (CUSTOMERS, ADDRESSES, ORDERS, PAYMENTS, SUPPORT_TICKETS, LOYALTY_ACCOUNTS)
