"""SQL for the checking engine, written out apart from the library's declarations."""

from __future__ import annotations

from checks.feeds import landing_sql

NAMES = ["customers", "orders", "addresses", "payments", "support_tickets", "loyalty_accounts"]
FEED_NAMES = {"customers": "crm_customers", "addresses": "crm_addresses"}
KEYS = {
    "customers": "customer_id", "orders": "order_id", "addresses": "address_id",
    "payments": "payment_id", "support_tickets": "ticket_id",
    "loyalty_accounts": "loyalty_account_id",
}
CHILDREN = NAMES[1:]

DAY, TICKET_DAY = "2001-06-01", "2024-01-25"
DAYS = {name: TICKET_DAY if name == "support_tickets" else DAY for name in NAMES}

COLUMNS = {
    "customers": (
        "customer_id", "first_name", "last_name", "email", "phone", "date_of_birth", "gender",
        "signup_date", "status", "created_at", "updated_at", "source_system",
    ),
    "orders": (
        "order_id", "customer_id", "order_date", "order_status", "order_amount", "currency",
        "sales_channel", "created_at", "updated_at", "source_system",
    ),
    "addresses": (
        "address_id", "customer_id", "address_line_1", "suburb", "state", "postcode", "country",
        "is_primary", "created_at", "updated_at", "source_system",
    ),
    "payments": (
        "payment_id", "order_id", "customer_id", "payment_date", "payment_status",
        "payment_method", "payment_amount", "currency", "created_at", "updated_at",
        "source_system",
    ),
    "support_tickets": (
        "ticket_id", "customer_id", "ticket_created_at", "ticket_resolved_at", "ticket_status",
        "priority", "channel", "category", "agent_id", "source_system",
    ),
    "loyalty_accounts": (
        "loyalty_account_id", "customer_id", "join_date", "tier", "points_balance",
        "loyalty_status", "created_at", "updated_at", "source_system",
    ),
}

STANDARDISED = {
    "customers": """SELECT customer_id, trim(first_name) AS first_name,
        trim(last_name) AS last_name, lower(trim(email)) AS email, phone,
        TRY_CAST(date_of_birth AS DATE) AS date_of_birth, lower(trim(gender)) AS gender,
        TRY_CAST(signup_date AS DATE) AS signup_date, lower(trim(status)) AS status,
        TRY_CAST(created_at AS DATE) AS created_at, TRY_CAST(updated_at AS DATE) AS updated_at,
        source_system""",
    "orders": """SELECT order_id, customer_id, TRY_CAST(order_date AS DATE) AS order_date,
        upper(trim(order_status)) AS order_status, order_amount,
        upper(trim(currency)) AS currency, upper(trim(sales_channel)) AS sales_channel,
        TRY_CAST(created_at AS DATE) AS created_at, TRY_CAST(updated_at AS DATE) AS updated_at,
        source_system""",
    "addresses": """SELECT address_id, customer_id,
        lower(trim(address_line_1)) AS address_line_1, lower(trim(suburb)) AS suburb,
        upper(trim(state)) AS state, trim(postcode) AS postcode, lower(trim(country)) AS country,
        lower(trim(is_primary)) AS is_primary, TRY_CAST(created_at AS DATE) AS created_at,
        TRY_CAST(updated_at AS DATE) AS updated_at, source_system""",
    "payments": """SELECT payment_id, order_id, customer_id,
        TRY_CAST(payment_date AS DATE) AS payment_date,
        upper(trim(payment_status)) AS payment_status,
        upper(trim(payment_method)) AS payment_method, payment_amount,
        upper(trim(currency)) AS currency, TRY_CAST(created_at AS DATE) AS created_at,
        TRY_CAST(updated_at AS DATE) AS updated_at, source_system""",
    "support_tickets": """SELECT ticket_id, customer_id,
        TRY_CAST(ticket_created_at AS DATE) AS ticket_created_at,
        TRY_CAST(ticket_resolved_at AS DATE) AS ticket_resolved_at,
        upper(trim(ticket_status)) AS ticket_status, upper(trim(priority)) AS priority,
        upper(trim(channel)) AS channel, upper(trim(category)) AS category, agent_id,
        source_system""",
    "loyalty_accounts": """SELECT loyalty_account_id, customer_id,
        TRY_CAST(join_date AS DATE) AS join_date, upper(trim(tier)) AS tier, points_balance,
        upper(trim(loyalty_status)) AS loyalty_status,
        TRY_CAST(created_at AS DATE) AS created_at, TRY_CAST(updated_at AS DATE) AS updated_at,
        source_system""",
}

REASONS = {
    "customers": r"""CASE WHEN customer_id IS NULL THEN 'customer_id is null'
        WHEN NOT regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')
            THEN 'invalid email'
        WHEN status NOT IN ('active', 'inactive', 'blocked', 'pending')
            THEN 'invalid status' END""",
    "orders": """CASE WHEN order_id IS NULL THEN 'order_id is null'
        WHEN customer_id IS NULL THEN 'customer_id is null'
        WHEN customer_exists IS NULL THEN 'customer_id does not exist in silver customers'
        WHEN order_status NOT IN ('PLACED', 'PAID', 'SHIPPED', 'DELIVERED', 'CANCELLED',
            'RETURNED') THEN 'invalid status'
        WHEN sales_channel IS NULL THEN 'sales_channel is null'
        WHEN sales_channel NOT IN ('WEB', 'MOBILE', 'STORE') THEN 'invalid sales_channel'
        WHEN order_amount <= 0 THEN 'order_amount must be greater than zero' END""",
    "addresses": """CASE WHEN address_id IS NULL THEN 'address_id is null'
        WHEN customer_id IS NULL THEN 'customer_id is null'
        WHEN customer_exists IS NULL THEN 'customer_id does not exist in silver customers'
        WHEN state NOT IN ('NSW', 'VIC', 'QLD', 'WA', 'SA', 'TAS', 'ACT', 'NT')
            THEN 'invalid state'
        WHEN postcode IS NULL THEN 'postcode is null'
        WHEN NOT regexp_matches(postcode, '^[0-9]{4}$') THEN 'invalid postcode' END""",
    "payments": """CASE WHEN payment_id IS NULL THEN 'payment_id is null'
        WHEN order_id IS NULL THEN 'order_id is null'
        WHEN order_exists IS NULL THEN 'order_id does not exist in silver orders'
        WHEN customer_id IS NULL THEN 'customer_id is null'
        WHEN customer_exists IS NULL THEN 'customer_id does not exist in silver customers'
        WHEN payment_date IS NULL THEN 'payment_date is null'
        WHEN payment_status IS NULL THEN 'payment_status is null'
        WHEN payment_status NOT IN ('SUCCESS', 'FAILED', 'PENDING', 'REFUNDED')
            THEN 'invalid payment_status'
        WHEN payment_method IS NULL THEN 'payment_method is null'
        WHEN payment_method NOT IN ('CARD', 'PAYPAL', 'APPLE_PAY', 'GOOGLE_PAY',
            'BANK_TRANSFER') THEN 'invalid payment_method'
        WHEN payment_amount <= 0 THEN 'payment_amount must be greater than zero' END""",
    "support_tickets": """CASE WHEN ticket_id IS NULL THEN 'ticket_id is null'
        WHEN customer_id IS NULL THEN 'customer_id is null'
        WHEN customer_exists IS NULL THEN 'customer_id does not exist in silver customers'
        WHEN ticket_created_at IS NULL THEN 'ticket_created_at is null'
        WHEN ticket_resolved_at IS NOT NULL AND ticket_resolved_at < ticket_created_at
            THEN 'negative resolution time'
        WHEN ticket_status IS NULL THEN 'ticket_status is null'
        WHEN ticket_status NOT IN ('OPEN', 'IN_PROGRESS', 'RESOLVED', 'CLOSED')
            THEN 'invalid ticket_status'
        WHEN priority IS NULL THEN 'priority is null'
        WHEN priority NOT IN ('LOW', 'MEDIUM', 'HIGH', 'URGENT') THEN 'invalid priority'
        WHEN channel IS NULL THEN 'channel is null'
        WHEN channel NOT IN ('EMAIL', 'PHONE', 'CHAT', 'WEB') THEN 'invalid channel'
        WHEN category IS NULL THEN 'category is null'
        WHEN category NOT IN ('PAYMENT_ISSUE', 'DELIVERY_DELAY', 'ACCOUNT_ACCESS',
            'REFUND_REQUEST', 'PRODUCT_QUERY', 'LOYALTY_QUERY', 'COMPLAINT')
            THEN 'invalid category' END""",
    "loyalty_accounts": """CASE WHEN loyalty_account_id IS NULL THEN 'loyalty_account_id is null'
        WHEN customer_id IS NULL THEN 'customer_id is null'
        WHEN customer_exists IS NULL THEN 'customer_id does not exist in silver customers'
        WHEN join_date IS NULL THEN 'join_date is null'
        WHEN tier IS NULL THEN 'tier is null'
        WHEN tier NOT IN ('BRONZE', 'SILVER', 'GOLD', 'PLATINUM') THEN 'invalid tier'
        WHEN loyalty_status IS NULL THEN 'loyalty_status is null'
        WHEN loyalty_status NOT IN ('ACTIVE', 'INACTIVE', 'SUSPENDED')
            THEN 'invalid loyalty_status'
        WHEN points_balance IS NULL THEN 'points_balance is null'
        WHEN points_balance < 0 THEN 'points_balance must be greater than or equal to zero'
        END""",
}

FUTURE = {
    "customers": ("_has_future_updated_at", f"updated_at > DATE '{DAY}'"),
    "orders": ("_has_future_updated_at", f"updated_at > DATE '{DAY}'"),
    "addresses": ("_has_future_updated_at", f"updated_at > DATE '{DAY}'"),
    "payments": ("_has_future_updated_at", f"updated_at > DATE '{DAY}'"),
    "support_tickets": (
        "_has_future_ticket_date",
        f"(ticket_created_at > DATE '{TICKET_DAY}' OR (ticket_resolved_at IS NOT NULL "
        f"AND ticket_resolved_at > DATE '{TICKET_DAY}'))",
    ),
    "loyalty_accounts": (
        "_has_future_date", f"(join_date > DATE '{DAY}' OR updated_at > DATE '{DAY}')",
    ),
}

DATES = {
    "date_of_birth", "signup_date", "created_at", "updated_at", "order_date", "payment_date",
    "ticket_created_at", "ticket_resolved_at", "join_date",
}


# --- silver ----------------------------------------------------------------------------------

def order_column(name: str) -> str:
    return "ticket_created_at" if name == "support_tickets" else "updated_at"


def hash_of_landed(name: str) -> str:
    texts = ", ".join(f"CAST({c} AS VARCHAR)" for c in COLUMNS[name])
    return f"sha256(concat_ws('||', {texts})) AS _record_hash"


def std_cte(name: str, hashed: bool = False) -> str:
    more = f", {hash_of_landed(name)}" if hashed else ""
    return f"std_{name} AS ({STANDARDISED[name]}{more} FROM ({landing_sql(name)}))"


def dedup_cte(name: str, hashed: bool = False) -> str:
    key, first = KEYS[name], order_column(name)
    kept = [*COLUMNS[name], "_record_hash"] if hashed else COLUMNS[name]
    ties = [c for c in kept if c not in (key, first)]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [first, *ties])
    return f"""dedup_{name} AS (SELECT {', '.join(kept)} FROM
        (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
         FROM std_{name}) WHERE rn = 1)"""


def fk_cte(name: str) -> str:
    rows, flags, joins = f"dedup_{name} d", "", ""
    if name != "customers":
        flags += ", CASE WHEN c.customer_id IS NOT NULL THEN true END AS customer_exists"
        joins += """ LEFT JOIN (SELECT customer_id FROM graded_customers WHERE _is_valid) c
            ON d.customer_id = c.customer_id"""
    if name == "payments":
        flags += ", CASE WHEN o.order_id IS NOT NULL THEN true END AS order_exists"
        joins += """ LEFT JOIN (SELECT order_id FROM graded_orders WHERE _is_valid) o
            ON d.order_id = o.order_id"""
    return f"fk_{name} AS (SELECT d.*{flags} FROM {rows}{joins})"


def graded_cte(name: str) -> str:
    flag, test = FUTURE[name]
    return f"""graded_{name} AS (SELECT *, _rejection_reason IS NULL AS _is_valid FROM
        (SELECT *, TIMESTAMP '{DAYS[name]} 00:00:00' AS _silver_processed_at, {test} AS {flag},
         {REASONS[name]} AS _rejection_reason FROM fk_{name}))"""


def ctes(names: list[str], graded: bool = True) -> str:
    """CTEs up to the graded tables (or, for the last name, the deduplicated one)."""
    parts = []
    for name in names:
        parts += [std_cte(name), dedup_cte(name)]
        if graded or name != names[-1]:
            parts += [fk_cte(name), graded_cte(name)]
    return "WITH " + ", ".join(parts)


def lineage(name: str) -> list[str]:
    if name == "customers":
        return ["customers"]
    return ["customers", "orders", "payments"] if name == "payments" else ["customers", name]


def shown(column: str) -> str:
    return f"CAST({column} AS VARCHAR) AS {column}" if column in DATES else column


def as_text(column: str) -> str:
    return f"CAST({column} AS VARCHAR) AS {column}"


def business(name: str) -> str:
    return ", ".join(shown(c) for c in COLUMNS[name])


def processed(name: str) -> str:
    return f"'{DAYS[name]} 00:00:00' AS _silver_processed_at"


def side(name: str, valid: bool | None) -> str:
    """Graded rows: the valid, the rejected, or with None both."""
    flags = [FUTURE[name][0], "_is_valid"]
    if name != "customers":
        flags.append("customer_exists")
    if name == "payments":
        flags.append("order_exists")
    keep = {True: "_is_valid", False: "NOT _is_valid", None: "TRUE"}[valid]
    return f"""{ctes(lineage(name))}
        SELECT {business(name)}, {processed(name)}, {', '.join(map(as_text, flags))},
        _rejection_reason FROM graded_{name} WHERE {keep}"""


def orphan(name: str) -> str:
    table, key = ("orders", "order_id") if name == "payments" else ("customers", "customer_id")
    names = [n for n in lineage(name) if n != name]
    return f"""{ctes(names)}, {std_cte(name)}, {dedup_cte(name)}
        SELECT {KEYS[name]}, {key} FROM dedup_{name} WHERE {key} IS NOT NULL
        AND {key} NOT IN (SELECT {key} FROM graded_{table} WHERE _is_valid)"""


def silver_queries() -> dict[str, str]:
    queries = {}
    for name in NAMES:
        head = f"WITH {std_cte(name)}"
        queries[f"std_{name}"] = f"""{head} SELECT {business(name)}, {processed(name)}
            FROM std_{name}"""
        queries[f"dedup_{name}"] = f"""{head}, {dedup_cte(name)}
            SELECT {business(name)}, {processed(name)} FROM dedup_{name}"""
        queries[f"future_{name}"] = f"""{head}, {dedup_cte(name)}
            SELECT {KEYS[name]}, CAST({FUTURE[name][1]} AS VARCHAR) AS is_future
            FROM dedup_{name}"""
        queries[f"silver_{name}"] = side(name, True)
        queries[f"rejected_{name}"] = side(name, False)
        queries[f"refreshed_{name}"] = side(name, None)
    for name in CHILDREN:
        columns = ["customer_id", as_text("customer_exists")]
        if name == "payments":
            columns += ["order_id", as_text("order_exists")]
        queries[f"fk_{name}"] = f"""{ctes(lineage(name))}
            SELECT {', '.join([KEYS[name], *columns])} FROM fk_{name}"""
        queries[f"orphan_{name}"] = orphan(name)
    return queries


# --- gold ------------------------------------------------------------------------------------

ADDRESS = """SELECT customer_id, state, postcode, country FROM
    (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY updated_at DESC NULLS LAST, address_id DESC NULLS LAST) AS rn
     FROM graded_addresses WHERE _is_valid AND is_primary = 'true') WHERE rn = 1"""

LOYALTY = """SELECT customer_id, tier AS loyalty_tier, points_balance, loyalty_status FROM
    (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY updated_at DESC NULLS LAST, loyalty_account_id DESC NULLS LAST) AS rn
     FROM graded_loyalty_accounts WHERE _is_valid) WHERE rn = 1"""

ORDER_SUMMARY = """SELECT customer_id, count(order_id) AS total_orders,
    round(sum(CASE WHEN order_status IN ('PAID', 'SHIPPED', 'DELIVERED') THEN order_amount
        ELSE 0 END), 2) AS total_revenue,
    CAST(max(order_date) AS VARCHAR) AS last_order_date
    FROM graded_orders WHERE _is_valid GROUP BY customer_id"""

PAYMENT_SUMMARY = """SELECT customer_id,
    count(CASE WHEN payment_status = 'SUCCESS' THEN payment_id END) AS successful_payment_count,
    round(sum(CASE WHEN payment_status = 'SUCCESS' THEN payment_amount ELSE 0 END), 2)
        AS successful_payment_amount,
    CAST(max(payment_date) AS VARCHAR) AS last_payment_date
    FROM graded_payments WHERE _is_valid GROUP BY customer_id"""

SUPPORT_SUMMARY = """SELECT customer_id, count(ticket_id) AS support_ticket_count,
    count(CASE WHEN ticket_status IN ('OPEN', 'IN_PROGRESS') THEN ticket_id END)
        AS open_ticket_count,
    CAST(max(ticket_created_at) AS VARCHAR) AS last_support_ticket_date
    FROM graded_support_tickets WHERE _is_valid GROUP BY customer_id"""

SNAPSHOT = f"""SELECT b.customer_id, first_name, last_name, email, gender, status,
    CAST(signup_date AS VARCHAR) AS signup_date, state, postcode, country,
    coalesce(total_orders, 0) AS total_orders, coalesce(total_revenue, 0.0) AS total_revenue,
    last_order_date, coalesce(successful_payment_count, 0) AS successful_payment_count,
    coalesce(successful_payment_amount, 0.0) AS successful_payment_amount, last_payment_date,
    coalesce(support_ticket_count, 0) AS support_ticket_count,
    coalesce(open_ticket_count, 0) AS open_ticket_count, last_support_ticket_date, loyalty_tier,
    coalesce(points_balance, 0) AS points_balance, loyalty_status,
    '{DAY} 00:00:00' AS _gold_processed_at
    FROM (SELECT * FROM graded_customers WHERE _is_valid) b
    LEFT JOIN ({ADDRESS}) a ON b.customer_id = a.customer_id
    LEFT JOIN ({ORDER_SUMMARY}) o ON b.customer_id = o.customer_id
    LEFT JOIN ({PAYMENT_SUMMARY}) p ON b.customer_id = p.customer_id
    LEFT JOIN ({SUPPORT_SUMMARY}) t ON b.customer_id = t.customer_id
    LEFT JOIN ({LOYALTY}) l ON b.customer_id = l.customer_id"""


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(f"({part})" for part in parts)


def quality(names: list[str]) -> str:
    """Data-quality rows; sources that are not named have no tables."""
    counted = [
        f"""SELECT '{name}' AS source_name,
        (SELECT count(*) FROM ({landing_sql(name)})) AS bronze_rows,
        count(*) FILTER (WHERE _is_valid) AS silver_valid_rows,
        count(*) FILTER (WHERE NOT _is_valid) AS silver_rejected_rows,
        count(*) AS total_processed_rows FROM graded_{name}"""
        for name in names
    ]
    absent = [
        f"""SELECT '{name}' AS source_name, CAST(0 AS BIGINT) AS bronze_rows,
        CAST(0 AS BIGINT) AS silver_valid_rows, CAST(0 AS BIGINT) AS silver_rejected_rows,
        CAST(0 AS BIGINT) AS total_processed_rows"""
        for name in NAMES if name not in names
    ]
    return f"""SELECT *, round(silver_rejected_rows / nullif(total_processed_rows, 0) * 100, 2)
        AS rejection_rate_percent, '{DAY} 00:00:00' AS _gold_processed_at
        FROM ({union(counted + absent)})"""


def gold_queries() -> dict[str, str]:
    everything = ctes(NAMES)
    kpis = f"""{everything} SELECT count(*) AS total_customers,
        CAST(sum(CAST(status = 'active' AS INT)) AS BIGINT) AS active_customers,
        CAST(sum(CAST(status = 'blocked' AS INT)) AS BIGINT) AS blocked_customers,
        CAST(sum(CAST(total_orders > 0 AS INT)) AS BIGINT) AS customers_with_orders,
        round(sum(total_revenue), 2) AS total_revenue,
        round(avg(total_revenue), 2) AS avg_customer_revenue,
        CAST(sum(CAST(loyalty_tier IS NOT NULL AS INT)) AS BIGINT) AS customers_with_loyalty,
        CAST(sum(points_balance) AS BIGINT) AS total_points_balance,
        CAST(sum(CAST(support_ticket_count > 0 AS INT)) AS BIGINT)
            AS customers_with_support_tickets,
        CAST(sum(open_ticket_count) AS BIGINT) AS open_support_tickets,
        '{DAY} 00:00:00' AS _gold_processed_at FROM ({SNAPSHOT})"""
    landed = {name: f"(SELECT count(*) FROM ({landing_sql(name)}))" for name in NAMES}
    return {
        "primary_address": f"{ctes(lineage('addresses'))} {ADDRESS}",
        "loyalty_per_customer": f"{ctes(lineage('loyalty_accounts'))} {LOYALTY}",
        "order_summary": f"{ctes(lineage('orders'))} {ORDER_SUMMARY}",
        "payment_summary": f"{ctes(lineage('payments'))} {PAYMENT_SUMMARY}",
        "support_summary": f"{ctes(lineage('support_tickets'))} {SUPPORT_SUMMARY}",
        "customer_snapshot": f"{everything} {SNAPSHOT}",
        "refreshed_snapshot": f"{everything} {SNAPSHOT}",
        "kpi_summary": kpis,
        "landed_kpis": kpis,
        "dq_summary": f"{everything} {quality(NAMES)}",
        "landed_orders": landed_orders(),
        "published_customers": f"""{ctes(['customers'])} {union([
            f"""SELECT '{reader}' AS reader, {business('customers')},
            CAST(updated_at > DATE '{day}' AS VARCHAR) AS _has_future_updated_at,
            '{day} 00:00:00' AS _silver_processed_at FROM graded_customers WHERE _is_valid"""
            for reader, day in (('before', '1996-06-01'), ('after', DAY))])}""",
        "landed_quality": f"{everything} {quality([n for n in NAMES if n != 'loyalty_accounts'])}",
        "reject_reasons": f"""{everything} {union([
            f'''SELECT '{name}' AS source_name, _rejection_reason AS reason,
            count(*) AS rejected_rows FROM graded_{name} WHERE NOT _is_valid
            GROUP BY _rejection_reason''' for name in NAMES])}""",
        "run_report": f"""{everything} {union([
            f'''SELECT '{name}' AS source_name, {landed[name]} AS bronze_rows,
            count(*) AS deduplicated_rows, count(*) FILTER (WHERE _is_valid) AS valid_rows,
            count(*) FILTER (WHERE NOT _is_valid) AS rejected_rows,
            count(*) FILTER (WHERE _is_valid AND {FUTURE[name][0]}) AS future_date_rows
            FROM graded_{name}''' for name in NAMES])}""",
    }


# --- bronze ----------------------------------------------------------------------------------

TYPES = {"order_amount": "double", "payment_amount": "double", "points_balance": "int"}
AUDIT = [
    ("_ingestion_timestamp", "timestamp"), ("_source_file", "string"), ("_batch_id", "string"),
    ("_record_hash", "string"),
]


def audit_values(name: str) -> str:
    return f"""'{DAY} 00:00:00' AS _ingestion_timestamp,
        '{FEED_NAMES.get(name, name)}_20010601_000000.csv' AS _source_file,
        'batch-1' AS _batch_id"""


def bronze_table(name: str) -> str:
    return f"""SELECT {', '.join(COLUMNS[name])}, {audit_values(name)}, {hash_of_landed(name)}
        FROM ({landing_sql(name)})"""


def incremental() -> str:
    head = f"SELECT {', '.join(COLUMNS['customers'])}, {hash_of_landed('customers')}"
    rows = f"FROM ({landing_sql('customers')})"
    return union([
        f"{head}, 'first' AS _batch_id {rows}",
        f"{head}, 'second' AS _batch_id {rows} WHERE updated_at >= '1998-01-01'",
    ])


def landed_orders() -> str:
    parents = [cte("customers") for cte in (std_cte, dedup_cte, fk_cte, graded_cte)]
    rows = [std_cte("orders", True), dedup_cte("orders", True), fk_cte("orders"),
            graded_cte("orders")]
    return f"""WITH {', '.join(parents + rows)} SELECT {business('orders')},
        {audit_values('orders')}, _record_hash FROM graded_orders WHERE _is_valid"""


def profile(name: str) -> str:
    columns = [(c, TYPES.get(c, "string")) for c in COLUMNS[name]] + AUDIT
    count = f"(SELECT count(*) FROM ({landing_sql(name)}))"
    return union([
        f"""SELECT '{FEED_NAMES.get(name, name)}' AS table_name, {position} AS position,
        '{column}' AS column_name, '{kind}' AS data_type, {count} AS row_count"""
        for position, (column, kind) in enumerate(columns)
    ])


def bronze_queries() -> dict[str, str]:
    def logged(name: str) -> str:
        return f"""SELECT '{FEED_NAMES.get(name, name)}' AS source_name, count(*) AS rows_read,
            count(*) AS rows_written, 'SUCCESS' AS status, 'false' AS has_error, 'true' AS timed
            FROM ({landing_sql(name)})"""

    failed = """SELECT 'orders' AS source_name, CAST(0 AS BIGINT) AS rows_read,
        CAST(0 AS BIGINT) AS rows_written, 'FAILED' AS status, 'true' AS has_error,
        'true' AS timed"""
    return {
        **{f"feed_{name}": landing_sql(name) for name in NAMES},
        **{f"bronze_{name}": bronze_table(name) for name in NAMES},
        "bronze_latest_drop": f"""SELECT * FROM ({landing_sql('customers')})
            WHERE updated_at >= '1998-01-01'""",
        "bronze_incremental": incremental(),
        "bronze_ingest_log": union([logged(name) for name in NAMES]),
        "bronze_ingest_failure": union([logged("customers"), failed]),
        "bronze_new_feed_missing": union(
            [logged("orders"), failed.replace("'orders'", "'crm_customers'", 1)]
        ),
        **{name: incremental() for name in (
            "bronze_late_drop", "bronze_batch_then_new", "bronze_new_then_batch")},
        "bronze_malformed": f"""SELECT 'order_amount' AS column_name, 'n/a' AS cell_text, order_id
            FROM ({landing_sql('orders')}) WHERE right(order_id, 2) = '05'
            UNION ALL SELECT 'bronze', NULL, order_id FROM ({landing_sql('orders')})
            WHERE right(order_id, 2) = '05' OR order_amount IS NULL""",
        "bronze_inspect": union([profile("customers"), profile("orders")]),
        "preview5": f"""SELECT least(5, count(*)) AS rows_shown, least(5, count(*)) AS rows_found
            FROM ({landing_sql('customers')})""",
    }


# --- feed generation -------------------------------------------------------------------------

def draw(key: str, purpose: str) -> str:
    return f"CAST('0x' || substr(md5('{purpose}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


def threshold(rate: float) -> int:
    return round(rate * 2**32)


def chance(key: str, purpose: str, rate: float) -> str:
    return f"({draw(key, purpose)} < {threshold(rate)})"


def number(key: str, purpose: str, low: int, high: int) -> str:
    return f"({draw(key, purpose)} % {high - low + 1} + {low})"


def one(key: str, purpose: str, *values: str) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"([{listed}])[{draw(key, purpose)} % {len(values)} + 1]"


def weighted(key: str, purpose: str, *choices: tuple[str, float]) -> str:
    cases, ceiling = "", 0.0
    for value, weight in choices[:-1]:
        ceiling += weight
        cases += f" WHEN {draw(key, purpose)} < {threshold(ceiling)} THEN '{value}'"
    return f"CASE{cases} ELSE '{choices[-1][0]}' END"


def padded(prefix: str, expression: str, digits: int) -> str:
    text = f"CAST({expression} AS VARCHAR)"
    width = f"CAST(greatest({digits}, length({text})) AS INT)"
    return f"('{prefix}' || lpad({text}, {width}, '0'))"


def digits_of(key: str) -> str:
    return f"CAST(regexp_extract({key}, '([0-9]+)$', 1) AS BIGINT)"


def when(condition: str, then: str, otherwise: str) -> str:
    return f"CASE WHEN {condition} THEN {then} ELSE {otherwise} END"


def days(moment: str, count: str) -> str:
    return f"({moment} + to_days(CAST({count} AS INT)))"


def hours(moment: str, count: str) -> str:
    return f"({moment} + to_hours({count}))"


def minutes(moment: str, count: str) -> str:
    return f"({moment} + to_minutes({count}))"


def text(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def twice(rows: str, key: str, purpose: str, rate: float) -> str:
    return f"""WITH made AS MATERIALIZED ({rows}) SELECT * FROM made
        UNION ALL SELECT * FROM made WHERE {chance(key, purpose, rate)}"""


INSTANT = "TIMESTAMP '2024-01-25 09:30:00'"
TODAY = "DATE '2024-01-25'"

PEOPLE = """SELECT c_custkey + 1 AS number, split_part(c_name, '#', 1) AS first_name,
    split_part(c_name, '#', 2) AS last_name FROM customer"""


def gen_customers() -> str:
    k = "number"
    signup = f"CAST({TODAY} - CAST({number(k, 'customers.signup', 0, 1826)} AS INT) AS DATE)"
    update = f"{signup} + CAST({number(k, 'customers.update', 0, 1200)} AS INT)"
    birth = f"{TODAY} - CAST({number(k, 'customers.birth', 18 * 366, 80 * 365)} AS INT)"
    bad = one(k, "customers.which_email", "invalid-email", "missing_at_symbol.com", "abc@")
    email = "lower(first_name) || '.' || lower(last_name) || number || '@example.com'"
    phone = padded("04", number(k, "customers.phone", 0, 99999999), 8)
    return twice(
        f"""SELECT {padded('CRM', k, 7)} AS customer_id, first_name, last_name,
        {when(chance(k, 'customers.bad_email', 0.01), bad, email)} AS email,
        {when(chance(k, 'customers.null_phone', 0.01), 'NULL', phone)} AS phone,
        CAST({when(chance(k, 'customers.null_birth', 0.005), 'NULL', birth)} AS VARCHAR)
            AS date_of_birth,
        {one(k, 'customers.gender', 'male', 'female', 'other', 'unknown')} AS gender,
        CAST({signup} AS VARCHAR) AS signup_date,
        {one(k, 'customers.status', 'active', 'inactive', 'blocked', 'pending')} AS status,
        CAST({signup} AS VARCHAR) AS created_at, CAST({update} AS VARCHAR) AS updated_at,
        'crm' AS source_system FROM ({PEOPLE})""",
        "customer_id", "customers.duplicate", 0.02,
    )


def gen_addresses() -> str:
    k = "customer_id"
    state = one(k, "addresses.state", "NSW", "VIC", "QLD", "WA", "SA", "TAS", "ACT", "NT")
    bad = one(k, "addresses.which_state", "XX", "UNKNOWN", "N/A")
    postcode = padded("", number(k, "addresses.postcode", 200, 9999), 4)
    created = "CAST(created_at AS DATE)"
    return twice(
        f"""SELECT {padded('ADDR', digits_of(k), 7)} AS address_id, customer_id,
        {number(k, 'addresses.number', 1, 999)} || ' Main St' AS address_line_1,
        'Suburb ' || {number(k, 'addresses.suburb', 1, 500)} AS suburb,
        {when(chance(k, 'addresses.bad_state', 0.005), bad, state)} AS state,
        {when(chance(k, 'addresses.null_postcode', 0.01), 'NULL', postcode)} AS postcode,
        'Australia' AS country, 'True' AS is_primary, created_at,
        CAST({created} + CAST({number(k, 'addresses.update', 0, 1200)} AS INT) AS VARCHAR)
            AS updated_at, 'crm' AS source_system
        FROM (SELECT DISTINCT customer_id, created_at FROM ({gen_customers()}))""",
        "address_id", "addresses.duplicate", 0.01,
    )


def sampled_customers(purpose: str, share: float) -> str:
    return f"""SELECT DISTINCT customer_id FROM ({gen_customers()})
        WHERE {chance('customer_id', purpose, share)}"""


def children(purpose: str, share: float, count: str, most: int) -> str:
    k = "customer_id"
    return f"""SELECT customer_id, position, {digits_of(k)} * {most} + position AS n FROM
        (SELECT customer_id, unnest(generate_series(1, {number(k, count, 1, most)})) AS position
         FROM ({sampled_customers(purpose, share)}))"""


def gen_orders() -> str:
    k = "order_id"
    past = days(INSTANT, f"-{number(k, 'orders.age', 0, 1825)}")
    future = days(INSTANT, number(k, "orders.ahead", 1, 365))
    status = one(
        k, "orders.status", "PLACED", "PAID", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED"
    )
    bad = one(k, "orders.which_status", "UNKNOWN", "INVALID")
    amount = f"(CAST({number(k, 'orders.amount', 1000, 500000)} AS DOUBLE) / 100)"
    return twice(
        f"""SELECT order_id,
        {when(chance(k, 'orders.null_customer', 0.005), 'NULL', 'customer_id')} AS customer_id,
        {text('placed')} AS order_date,
        {when(chance(k, 'orders.bad_status', 0.005), bad, status)} AS order_status,
        {when(chance(k, 'orders.negative', 0.002), '-' + amount, amount)} AS order_amount,
        'AUD' AS currency, {one(k, 'orders.channel', 'WEB', 'MOBILE', 'STORE')} AS sales_channel,
        {text('placed')} AS created_at,
        {text(days('placed', number(k, 'orders.update', 0, 30)))} AS updated_at,
        'ecommerce' AS source_system
        FROM (SELECT *, {when(chance(k, 'orders.future', 0.005), future, past)} AS placed FROM
            (SELECT customer_id, {padded('ORD', 'n', 9)} AS order_id
             FROM ({children('orders.customers', 0.60, 'orders.count', 15)})))""",
        "order_id", "orders.duplicate", 0.01,
    )


def gen_payments() -> str:
    k = "order_id"
    moment = minutes("CAST(order_date AS TIMESTAMP)", number(k, "payments.delay", 1, 180))
    stray = days(INSTANT, f"-{number(k, 'payments.stray_age', 0, 365)}")
    status = weighted(
        k, "payments.status", ("SUCCESS", 0.82), ("FAILED", 0.08), ("PENDING", 0.05),
        ("REFUNDED", 0.05),
    )
    bad = one(k, "payments.which_status", "UNKNOWN", "ERROR")
    method = one(
        k, "payments.method", "CARD", "PAYPAL", "APPLE_PAY", "GOOGLE_PAY", "BANK_TRANSFER"
    )
    stray_amount = f"CAST({number(k, 'payments.stray_amount', 1000, 500000)} AS DOUBLE) / 100"
    paid = f"""SELECT *, {digits_of(k)} AS n FROM
        (SELECT DISTINCT order_id, customer_id, order_date, order_amount FROM ({gen_orders()}))
        WHERE {chance(k, 'payments.orders', 0.92)}"""
    return twice(
        f"""SELECT payment_id, order_id, customer_id, {text('moment')} AS payment_date,
        payment_status, payment_method, payment_amount, 'AUD' AS currency,
        {text('moment')} AS created_at, {text('latest')} AS updated_at,
        'payment_gateway' AS source_system FROM (
            SELECT {padded('PAY', 'n * 2', 9)} AS payment_id, order_id, customer_id,
            {moment} AS moment,
            {when(chance(k, 'payments.bad_status', 0.004), bad, status)} AS payment_status,
            {method} AS payment_method,
            {when(chance(k, 'payments.negative', 0.001), '-abs(order_amount)', 'order_amount')}
                AS payment_amount,
            {days(moment, number(k, 'payments.update', 0, 10))} AS latest FROM ({paid})
            UNION ALL
            SELECT {padded('PAY', 'n * 2 + 1', 9)}, {padded('ORD_MISSING_', 'n', 6)}, NULL,
            {stray}, 'SUCCESS', {method}, {stray_amount}, {stray} FROM ({paid})
            WHERE {chance(k, 'payments.orphan', 0.003)})""",
        "payment_id", "payments.duplicate", 0.008,
    )


def gen_tickets() -> str:
    k = "ticket_id"
    past = days(INSTANT, f"-{number(k, 'tickets.age', 0, 1095)}")
    future = days(INSTANT, number(k, "tickets.ahead", 1, 180))
    status = one(k, "tickets.status", "OPEN", "IN_PROGRESS", "RESOLVED", "CLOSED")
    bad = one(k, "tickets.which_status", "UNKNOWN", "INVALID")
    after = hours("opened", number(k, "tickets.hours", 1, 240))
    before = hours("opened", f"-{number(k, 'tickets.hours_back', 1, 48)}")
    resolved = when(chance(k, "tickets.negative_interval", 0.002), before, after)
    category = one(
        k, "tickets.category", "PAYMENT_ISSUE", "DELIVERY_DELAY", "ACCOUNT_ACCESS",
        "REFUND_REQUEST", "PRODUCT_QUERY", "LOYALTY_QUERY", "COMPLAINT",
    )
    return twice(
        f"""SELECT ticket_id,
        {when(chance(k, 'tickets.null_customer', 0.005), 'NULL', 'customer_id')} AS customer_id,
        {text('opened')} AS ticket_created_at,
        CASE WHEN ticket_status IN ('RESOLVED', 'CLOSED') THEN {text(resolved)} END
            AS ticket_resolved_at, ticket_status,
        {one(k, 'tickets.priority', 'LOW', 'MEDIUM', 'HIGH', 'URGENT')} AS priority,
        {one(k, 'tickets.channel', 'EMAIL', 'PHONE', 'CHAT', 'WEB')} AS channel,
        {category} AS category, {padded('AGT', number(k, 'tickets.agent', 1, 500), 5)} AS agent_id,
        'zendesk' AS source_system
        FROM (SELECT *, {when(chance(k, 'tickets.future', 0.003), future, past)} AS opened,
            {when(chance(k, 'tickets.bad_status', 0.005), bad, status)} AS ticket_status
            FROM (SELECT customer_id, {padded('TCK', 'n', 9)} AS ticket_id
                FROM ({children('tickets.customers', 0.25, 'tickets.count', 5)})))""",
        "ticket_id", "support_tickets.duplicate", 0.01,
    )


def gen_loyalty() -> str:
    k = "customer_id"
    past = days(INSTANT, f"-{number(k, 'loyalty.age', 0, 1825)}")
    future = days(INSTANT, number(k, "loyalty.ahead", 1, 365))
    tier = weighted(
        k, "loyalty.tier", ("BRONZE", 0.45), ("SILVER", 0.30), ("GOLD", 0.18), ("PLATINUM", 0.07)
    )
    status = weighted(
        k, "loyalty.status", ("ACTIVE", 0.85), ("INACTIVE", 0.12), ("SUSPENDED", 0.03)
    )
    points = number(k, "loyalty.points", 0, 250000)
    bad_tier = one(k, "loyalty.which_tier", "UNKNOWN", "INVALID")
    bad_status = one(k, "loyalty.which_status", "ERROR", "UNKNOWN")
    return twice(
        f"""SELECT {padded('LOY', digits_of(k), 9)} AS loyalty_account_id,
        {when(chance(k, 'loyalty.null_customer', 0.004), 'NULL', 'customer_id')} AS customer_id,
        {text('joined')} AS join_date,
        {when(chance(k, 'loyalty.bad_tier', 0.004), bad_tier, tier)} AS tier,
        CAST({when(chance(k, 'loyalty.negative', 0.002), '-' + points, points)} AS INT)
            AS points_balance,
        {when(chance(k, 'loyalty.bad_status', 0.003), bad_status, status)} AS loyalty_status,
        {text('joined')} AS created_at,
        {text(days('joined', number(k, 'loyalty.update', 0, 365)))} AS updated_at,
        'loyalty_platform' AS source_system
        FROM (SELECT customer_id,
            {when(chance(k, 'loyalty.future', 0.003), future, past)} AS joined
            FROM ({sampled_customers('loyalty.customers', 0.55)}))""",
        "loyalty_account_id", "loyalty_accounts.duplicate", 0.01,
    )


def generation_queries() -> dict[str, str]:
    k = "o_orderkey"
    later = days(INSTANT, number(k, "ahead", 1, 365))
    after = hours("ts", number("event_id", "hours", 1, 240))
    before = hours("ts", f"-{number('event_id', 'hours_back', 1, 48)}")
    end = when(chance("event_id", "negative", 0.002), before, after)
    wrong = one(k, "which_status", "UNKNOWN", "INVALID")
    flipped = when(chance(k, "negative", 0.002), "-abs(o_totalprice)", "o_totalprice")
    tiers = weighted(
        k, "tier", ("BRONZE", 0.45), ("SILVER", 0.30), ("GOLD", 0.18), ("PLATINUM", 0.07)
    )
    return {
        "gen_customers": gen_customers(),
        "gen_addresses": gen_addresses(),
        "gen_orders": gen_orders(),
        "gen_payments": gen_payments(),
        "gen_support_tickets": gen_tickets(),
        "gen_loyalty_accounts": gen_loyalty(),
        "gen_keys_fanout": f"""SELECT {padded('CRM', 'c_custkey', 7)} AS customer_id,
            {padded('ORD', 'c_custkey * 15 + position', 9)} AS order_id FROM
            (SELECT c_custkey, unnest(generate_series(1, {number('c_custkey', 'children', 1, 15)}))
             AS position FROM customer)""",
        "gen_sample": f"""SELECT DISTINCT o_custkey FROM orders
            WHERE {chance('o_custkey', 'buyers', 0.60)}""",
        "gen_categorical": f"""SELECT o_orderkey,
            {one(k, 'channel', 'WEB', 'MOBILE', 'STORE')} AS channel, {tiers} AS tier
            FROM orders""",
        "gen_nulls": f"""SELECT c_custkey,
            {when(chance('c_custkey', 'null_name', 0.01), 'NULL', 'c_name')} AS c_name
            FROM customer""",
        "gen_duplicates": f"""SELECT o_orderkey, o_custkey, o_totalprice FROM orders
            UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders
            WHERE {chance(k, 'copy', 0.01)}""",
        "gen_orphans": f"""SELECT {padded('ORD', k, 9)} AS order_id, o_custkey FROM orders
            UNION ALL SELECT {padded('ORD_MISSING_', k, 6)}, NULL FROM orders
            WHERE {chance(k, 'orphan', 0.003)}""",
        "gen_invalid": f"""SELECT o_orderkey,
            {when(chance(k, 'bad_status', 0.005), wrong, 'o_orderstatus')} AS o_orderstatus
            FROM orders""",
        "gen_signflip": f"SELECT o_orderkey, {flipped} AS o_totalprice FROM orders",
        "gen_future": f"""SELECT o_orderkey,
            {text(when(chance(k, 'future', 0.005), later, 'o_orderdate'))} AS order_date
            FROM orders""",
        "gen_negative_interval": f"""SELECT event_id, {text('ts')} AS started,
            CASE WHEN event_type = 'error' THEN {text(end)} END AS ended FROM events""",
    }


def all_sql() -> dict[str, str]:
    return {
        **bronze_queries(), **silver_queries(), **gold_queries(), **generation_queries(),
    }
