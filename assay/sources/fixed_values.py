"""Schemas, domains, patterns, texts and rates that results depend on."""

# --- feed schemas, in file order (CSV columns are matched by position) ---------------------

CRM_CUSTOMERS_SCHEMA = """
    customer_id STRING, first_name STRING, last_name STRING, email STRING, phone STRING,
    date_of_birth STRING, gender STRING, signup_date STRING, status STRING,
    created_at STRING, updated_at STRING, source_system STRING
"""

ORDERS_SCHEMA = """
    order_id STRING, customer_id STRING, order_date STRING, order_status STRING,
    order_amount DOUBLE, currency STRING, sales_channel STRING,
    created_at STRING, updated_at STRING, source_system STRING
"""

CRM_ADDRESSES_SCHEMA = """
    address_id STRING, customer_id STRING, address_line_1 STRING, suburb STRING, state STRING,
    postcode STRING, country STRING, is_primary STRING,
    created_at STRING, updated_at STRING, source_system STRING
"""

PAYMENTS_SCHEMA = """
    payment_id STRING, order_id STRING, customer_id STRING, payment_date STRING,
    payment_status STRING, payment_method STRING, payment_amount DOUBLE, currency STRING,
    created_at STRING, updated_at STRING, source_system STRING
"""

SUPPORT_TICKETS_SCHEMA = """
    ticket_id STRING, customer_id STRING, ticket_created_at STRING, ticket_resolved_at STRING,
    ticket_status STRING, priority STRING, channel STRING, category STRING,
    agent_id STRING, source_system STRING
"""

LOYALTY_ACCOUNTS_SCHEMA = """
    loyalty_account_id STRING, customer_id STRING, join_date STRING, tier STRING,
    points_balance INT, loyalty_status STRING,
    created_at STRING, updated_at STRING, source_system STRING
"""

INGESTION_LOG_SCHEMA = """
    run_id STRING NOT NULL, source_name STRING NOT NULL, batch_id STRING NOT NULL,
    rows_read BIGINT, rows_written BIGINT, start_time TIMESTAMP, end_time TIMESTAMP,
    duration_seconds DOUBLE, status STRING, error_message STRING
"""

# --- value domains ---------------------------------------------------------------------------

CUSTOMER_STATUSES = ("active", "inactive", "blocked", "pending")
GENDERS = ("male", "female", "other", "unknown")
STATES = ("NSW", "VIC", "QLD", "WA", "SA", "TAS", "ACT", "NT")
ORDER_STATUSES = ("PLACED", "PAID", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED")
REVENUE_STATUSES = ("PAID", "SHIPPED", "DELIVERED")
SALES_CHANNELS = ("WEB", "MOBILE", "STORE")
PAYMENT_STATUSES = ("SUCCESS", "FAILED", "PENDING", "REFUNDED")
PAYMENT_METHODS = ("CARD", "PAYPAL", "APPLE_PAY", "GOOGLE_PAY", "BANK_TRANSFER")
TICKET_STATUSES = ("OPEN", "IN_PROGRESS", "RESOLVED", "CLOSED")
OPEN_TICKET_STATUSES = ("OPEN", "IN_PROGRESS")
SETTLED_TICKET_STATUSES = ("RESOLVED", "CLOSED")
PRIORITIES = ("LOW", "MEDIUM", "HIGH", "URGENT")
TICKET_CHANNELS = ("EMAIL", "PHONE", "CHAT", "WEB")
TICKET_CATEGORIES = (
    "PAYMENT_ISSUE", "DELIVERY_DELAY", "ACCOUNT_ACCESS", "REFUND_REQUEST",
    "PRODUCT_QUERY", "LOYALTY_QUERY", "COMPLAINT",
)
LOYALTY_TIERS = ("BRONZE", "SILVER", "GOLD", "PLATINUM")
LOYALTY_STATUSES = ("ACTIVE", "INACTIVE", "SUSPENDED")

# --- patterns and formats --------------------------------------------------------------------

EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
POSTCODE_PATTERN = r"^[0-9]{4}$"
HASH_SEPARATOR = "||"
PRIMARY_FLAG = "true"
SUCCESSFUL_PAYMENT = "SUCCESS"

# --- rejection texts -------------------------------------------------------------------------

IS_NULL_TEXT = "{column} is null"
NO_PARENT_TEXT = "{column} does not exist in silver {parent}"
INVALID_TEXT = "invalid {column}"
NOT_POSITIVE_TEXT = "{column} must be greater than zero"
NEGATIVE_TEXT = "{column} must be greater than or equal to zero"
NEGATIVE_INTERVAL_TEXT = "negative resolution time"

# --- feed generation: key formats (prefix, digits) -------------------------------------------

CUSTOMER_KEY = ("CRM", 7)
ADDRESS_KEY = ("ADDR", 7)
ORDER_KEY = ("ORD", 9)
PAYMENT_KEY = ("PAY", 9)
TICKET_KEY = ("TCK", 9)
LOYALTY_KEY = ("LOY", 9)
AGENT_KEY = ("AGT", 5)
MISSING_ORDER_KEY = ("ORD_MISSING_", 6)

# --- feed generation: invalid values ---------------------------------------------------------

BAD_EMAILS = ("invalid-email", "missing_at_symbol.com", "abc@")
BAD_STATES = ("XX", "UNKNOWN", "N/A")
BAD_ORDER_STATUSES = ("UNKNOWN", "INVALID")
BAD_PAYMENT_STATUSES = ("UNKNOWN", "ERROR")
BAD_TICKET_STATUSES = ("UNKNOWN", "INVALID")
BAD_TIERS = ("UNKNOWN", "INVALID")
BAD_LOYALTY_STATUSES = ("ERROR", "UNKNOWN")

# --- feed generation: shares and fault rates -------------------------------------------------

RATES = {
    "customers": {"duplicate": 0.02, "bad_email": 0.01, "null_phone": 0.01, "null_birth": 0.005},
    "addresses": {"duplicate": 0.01, "bad_state": 0.005, "null_postcode": 0.01},
    "orders": {
        "customers": 0.60, "duplicate": 0.01, "bad_status": 0.005, "null_customer": 0.005,
        "negative": 0.002, "future": 0.005,
    },
    "payments": {
        "orders": 0.92, "duplicate": 0.008, "bad_status": 0.004, "negative": 0.001,
        "orphan": 0.003,
    },
    "support_tickets": {
        "customers": 0.25, "duplicate": 0.01, "bad_status": 0.005, "null_customer": 0.005,
        "future": 0.003, "negative_interval": 0.002,
    },
    "loyalty_accounts": {
        "customers": 0.55, "duplicate": 0.01, "bad_tier": 0.004, "bad_status": 0.003,
        "negative": 0.002, "null_customer": 0.004, "future": 0.003,
    },
}

PAYMENT_STATUS_WEIGHTS = (0.82, 0.08, 0.05, 0.05)
TIER_WEIGHTS = (0.45, 0.30, 0.18, 0.07)
LOYALTY_STATUS_WEIGHTS = (0.85, 0.12, 0.03)

MAX_ORDERS_PER_CUSTOMER = 15
MAX_TICKETS_PER_CUSTOMER = 5
