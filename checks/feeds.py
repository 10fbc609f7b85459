"""Six dirty landing feeds derived from the given tables.

Both engines run the same expressions; only the way a row is repeated differs. Faults are a
function of the row's key, so every rule fires at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.operators.faults import with_versions
from assay.sources.specs import BY_NAME


def key(prefix: str, number: str, digits: int) -> str:
    text = f"CAST({number} AS STRING)"
    width = f"CAST(greatest({digits}, length({text})) AS INT)"
    return f"concat('{prefix}', lpad({text}, {width}, '0'))"


# Per feed: tables, columns taken from them, further versions (condition -> version) and the
# feed's columns over those.
FEEDS: dict[str, dict] = {
    "customers": {
        "from": "customer",
        "base": {
            "k": "c_custkey",
            "n": "c_name",
            "m": "c_mktsegment",
            "d": "DATE '1995-01-01' + CAST(c_custkey % 1800 AS INT)",
        },
        "versions": {"k % 100 = 0": 1, "k % 100 = 50": 2},
        "columns": {
            "customer_id": f"CASE WHEN k % 250 = 13 THEN NULL ELSE {key('CRM', 'k', 7)} END",
            "first_name": "concat('  ', n, ' ')",
            "last_name": "concat(m, '  ')",
            "email": """CASE WHEN k % 100 = 7 THEN 'invalid-email' WHEN k % 100 = 57 THEN 'abc@'
                WHEN k % 100 = 31 THEN NULL
                ELSE concat(' User.', CAST(k AS STRING), '@Example.COM ') END""",
            "phone": f"CASE WHEN k % 100 = 3 THEN NULL ELSE {key('04', 'k', 8)} END",
            "date_of_birth": """CASE WHEN k % 200 = 19 THEN NULL
                WHEN k % 200 = 119 THEN 'not-a-date' ELSE CAST(d - 9000 AS STRING) END""",
            "gender": """CASE k % 4 WHEN 0 THEN 'male' WHEN 1 THEN ' Female' WHEN 2 THEN 'OTHER'
                ELSE 'unknown' END""",
            "signup_date": "CAST(d AS STRING)",
            "status": """CASE WHEN k % 140 = 11 THEN 'vip' WHEN k % 140 = 111 THEN NULL
                WHEN version = 2 THEN 'blocked'
                ELSE CASE k % 4 WHEN 0 THEN 'active' WHEN 1 THEN ' Inactive ' WHEN 2 THEN 'BLOCKED'
                ELSE 'pending' END END""",
            "created_at": "CAST(d AS STRING)",
            "updated_at": """CAST(d + CAST(k % 1200 AS INT)
                + CASE WHEN version = 2 THEN 30 ELSE 0 END AS STRING)""",
            "source_system": "'crm'",
        },
    },
    "addresses": {
        "from": "customer",
        "base": {
            "k": "c_custkey",
            "nk": "c_nationkey",
            "d0": "DATE '1995-01-01' + CAST(c_custkey % 1800 AS INT)",
        },
        "versions": {"k % 100 = 20": 1},
        "columns": {
            "address_id": f"CASE WHEN k % 140 = 43 THEN NULL ELSE {key('ADDR', 'k', 7)} END",
            "customer_id": f"""CASE WHEN k % 140 = 45 THEN NULL
                WHEN k % 140 = 47 THEN 'CRM_MISSING' ELSE {key('CRM', 'k', 7)} END""",
            "address_line_1": "concat(' ', CAST(k AS STRING), ' Main ST ')",
            "suburb": "' Suburbia'",
            "state": """CASE WHEN k % 140 = 51 THEN 'XX' WHEN k % 140 = 53 THEN NULL
                ELSE CASE nk % 8 WHEN 0 THEN 'NSW' WHEN 1 THEN 'vic ' WHEN 2 THEN 'QLD'
                WHEN 3 THEN ' wa' WHEN 4 THEN 'SA' WHEN 5 THEN 'TAS' WHEN 6 THEN 'ACT'
                ELSE 'NT' END END""",
            "postcode": """CASE WHEN k % 140 = 59 THEN NULL WHEN k % 140 = 61 THEN '20A0'
                ELSE lpad(CAST(k % 10000 AS STRING), 4, '0') END""",
            "country": "'Australia'",
            "is_primary": "CASE WHEN k % 10 = 9 THEN 'False' ELSE 'True' END",
            "created_at": "CAST(d0 + CASE WHEN version = 1 THEN 10 ELSE 0 END AS STRING)",
            "updated_at": """CAST(d0 + CASE WHEN version = 1 THEN 10 ELSE 0 END
                + CAST(k % 1200 AS INT) AS STRING)""",
            "source_system": "'crm'",
        },
    },
    "orders": {
        "from": "orders",
        "base": {
            "k": "o_orderkey",
            "ck": "o_custkey",
            "p": "o_totalprice",
            "d": "CAST(o_orderdate AS DATE)",
        },
        "versions": {"k % 100 = 0": 1, "k % 100 = 50": 2},
        "columns": {
            "order_id": f"CASE WHEN k % 500 = 3 THEN NULL ELSE {key('ORD', 'k', 9)} END",
            "customer_id": f"""CASE WHEN k % 200 = 17 THEN NULL
                WHEN k % 200 = 37 THEN 'CRM_MISSING' ELSE {key('CRM', 'ck', 7)} END""",
            "order_date": """CASE WHEN k % 500 = 401 THEN 'not-a-date'
                ELSE concat(CAST(d AS STRING), ' 10:30:00') END""",
            "order_status": """CASE WHEN k % 200 = 5 THEN 'UNKNOWN' WHEN k % 200 = 105 THEN NULL
                WHEN version = 2 THEN 'RETURNED'
                ELSE CASE k % 6 WHEN 0 THEN 'PLACED' WHEN 1 THEN ' paid' WHEN 2 THEN 'SHIPPED'
                WHEN 3 THEN 'Delivered' WHEN 4 THEN 'CANCELLED' ELSE 'RETURNED' END END""",
            "order_amount": """CASE WHEN k % 500 = 21 THEN -p WHEN k % 500 = 121 THEN 0.0
                WHEN k % 500 = 221 THEN NULL ELSE p END""",
            "currency": "'aud'",
            "sales_channel": """CASE WHEN k % 200 = 9 THEN 'KIOSK' WHEN k % 200 = 109 THEN NULL
                ELSE CASE k % 3 WHEN 0 THEN 'WEB' WHEN 1 THEN 'mobile ' ELSE 'STORE' END END""",
            "created_at": "CAST(d AS STRING)",
            "updated_at": "CAST(d + CAST(k % 30 AS INT) + version AS STRING)",
            "source_system": "'ecommerce'",
        },
    },
    "payments": {
        "from": "lineitem JOIN orders ON l_orderkey = o_orderkey",
        "base": {
            "k": "l_orderkey",
            "ln": "l_linenumber",
            "p": "l_extendedprice",
            "d": "CAST(l_shipdate AS DATE)",
            "pk": "l_partkey",
            "x": "l_orderkey * 7 + l_linenumber",
            "ck": "o_custkey",
        },
        "versions": {},
        "columns": {
            "payment_id": f"""CASE WHEN x % 1000 = 3 THEN NULL
                ELSE concat({key('PAY', 'k', 9)}, '-', CAST(ln AS STRING)) END""",
            "order_id": f"""CASE WHEN x % 1000 = 5 THEN NULL
                WHEN x % 1000 = 15 THEN concat('ORD_MISSING_', CAST(x AS STRING))
                ELSE {key('ORD', 'k', 9)} END""",
            "customer_id": f"""CASE WHEN x % 1000 = 25 THEN NULL
                WHEN x % 1000 = 35 THEN 'CRM_MISSING' ELSE {key('CRM', 'ck', 7)} END""",
            "payment_date": """CASE WHEN x % 1000 = 45 THEN 'not-a-date'
                ELSE concat(CAST(d AS STRING), ' 08:00:00') END""",
            "payment_status": """CASE WHEN x % 1000 = 55 THEN 'ERROR' WHEN x % 1000 = 65 THEN NULL
                ELSE CASE x % 4 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'pending' WHEN 2 THEN ' REFUNDED'
                ELSE 'SUCCESS' END END""",
            "payment_method": """CASE WHEN x % 1000 = 75 THEN 'CHEQUE' WHEN x % 1000 = 85 THEN NULL
                ELSE CASE x % 5 WHEN 0 THEN 'card' WHEN 1 THEN 'PAYPAL' WHEN 2 THEN 'APPLE_PAY'
                WHEN 3 THEN 'GOOGLE_PAY' ELSE 'BANK_TRANSFER ' END END""",
            "payment_amount": """CASE WHEN x % 1000 = 95 THEN -p WHEN x % 1000 = 96 THEN NULL
                ELSE p END""",
            "currency": "'AUD'",
            "created_at": "CAST(d AS STRING)",
            "updated_at": "CAST(d + CAST(pk % 10 AS INT) AS STRING)",
            "source_system": "'payment_gateway'",
        },
    },
    "support_tickets": {
        "from": "events",
        "base": {
            "k": "event_id",
            "uk": "user_id",
            "t": "event_type",
            "d": "CAST(ts AS DATE)",
        },
        "versions": {"k % 100 = 0": 1},
        "columns": {
            "ticket_id": f"CASE WHEN k % 500 = 3 THEN NULL ELSE {key('TCK', 'k', 9)} END",
            "customer_id": f"""CASE WHEN k % 500 = 17 THEN NULL
                WHEN k % 500 = 37 THEN 'CRM_MISSING' ELSE {key('CRM', 'uk', 7)} END""",
            "ticket_created_at": """CASE WHEN k % 500 = 41 THEN 'not-a-date'
                ELSE CAST(d + version AS STRING) END""",
            "ticket_resolved_at": """CASE WHEN k % 500 = 43 THEN CAST(d - 2 AS STRING)
                WHEN k % 4 >= 2 THEN CAST(d + CAST(k % 10 AS INT) + version AS STRING)
                ELSE NULL END""",
            "ticket_status": """CASE WHEN k % 500 = 51 THEN 'INVALID' WHEN k % 500 = 53 THEN NULL
                ELSE CASE k % 4 WHEN 0 THEN 'OPEN' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'RESOLVED'
                ELSE ' CLOSED' END END""",
            "priority": """CASE WHEN k % 500 = 61 THEN 'P0' WHEN k % 500 = 63 THEN NULL
                ELSE CASE k % 4 WHEN 0 THEN 'LOW' WHEN 1 THEN 'MEDIUM' WHEN 2 THEN 'HIGH'
                ELSE 'URGENT' END END""",
            "channel": """CASE WHEN k % 500 = 71 THEN 'FAX' WHEN k % 500 = 73 THEN NULL
                ELSE CASE k % 4 WHEN 0 THEN 'EMAIL' WHEN 1 THEN 'PHONE' WHEN 2 THEN 'CHAT'
                ELSE 'web' END END""",
            "category": """CASE WHEN k % 500 = 81 THEN 'OTHER' WHEN k % 500 = 83 THEN NULL
                ELSE CASE t WHEN 'error' THEN 'ACCOUNT_ACCESS' WHEN 'purchase' THEN 'PAYMENT_ISSUE'
                WHEN 'signup' THEN 'LOYALTY_QUERY' WHEN 'view' THEN 'PRODUCT_QUERY'
                ELSE 'complaint' END END""",
            "agent_id": "concat('AGT', lpad(CAST(k % 500 AS STRING), 5, '0'))",
            "source_system": "'zendesk'",
        },
    },
    "loyalty_accounts": {
        "from": "customer",
        # Eleven of twenty customers hold an account.
        "where": "c_custkey % 20 < 11",
        "base": {
            "k": "c_custkey",
            "a": "c_acctbal",
            "d": "DATE '1997-01-01' + CAST(c_custkey % 1800 AS INT)",
        },
        "versions": {"k % 100 = 0": 1},
        "columns": {
            "loyalty_account_id": f"CASE WHEN k % 150 = 22 THEN NULL ELSE {key('LOY', 'k', 9)} END",
            "customer_id": f"""CASE WHEN k % 150 = 24 THEN NULL
                WHEN k % 150 = 26 THEN 'CRM_MISSING' ELSE {key('CRM', 'k', 7)} END""",
            "join_date": "CASE WHEN k % 150 = 28 THEN 'not-a-date' ELSE CAST(d AS STRING) END",
            "tier": """CASE WHEN k % 150 = 41 THEN 'UNKNOWN' WHEN k % 150 = 43 THEN NULL
                ELSE CASE k % 4 WHEN 0 THEN 'BRONZE' WHEN 1 THEN 'silver' WHEN 2 THEN ' GOLD'
                ELSE 'PLATINUM' END END""",
            "points_balance": "CASE WHEN k % 150 = 45 THEN NULL ELSE CAST(floor(a) AS INT) END",
            "loyalty_status": """CASE WHEN k % 150 = 47 THEN 'ERROR' WHEN k % 150 = 49 THEN NULL
                ELSE CASE k % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'inactive'
                ELSE 'SUSPENDED' END END""",
            "created_at": "CAST(d AS STRING)",
            "updated_at": "CAST(d + CAST(k % 365 AS INT) + version AS STRING)",
            "source_system": "'loyalty_platform'",
        },
    },
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "payments":
        lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return table(spark, sf_dir, FEEDS[name]["from"])


def landing_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One landing feed, with the columns and types of its schema."""
    feed = FEEDS[name]
    rows = _base(spark, sf_dir, name)
    if "where" in feed:
        rows = rows.where(feed["where"])
    rows = rows.select(*[F.expr(text).alias(column) for column, text in feed["base"].items()])
    if feed["versions"]:
        versions = F.array(F.lit(0))
        for condition, number in feed["versions"].items():
            versions = F.when(F.expr(condition), F.array(F.lit(0), F.lit(number))).otherwise(
                versions
            )
        rows = with_versions(rows, versions, "version")
    schema = BY_NAME[name].schema
    return rows.select(
        *[F.expr(feed["columns"][c.name]).cast(c.dataType).alias(c.name) for c in schema]
    )


def landing_sql(name: str) -> str:
    """The same feed as SQL for the checking engine."""
    feed = FEEDS[name]
    base = ", ".join(f"{text} AS {column}" for column, text in feed["base"].items())
    where = f" WHERE {feed['where']}" if "where" in feed else ""
    rows = f"SELECT {base} FROM {feed['from']}{where}"
    parts = [f"SELECT *, 0 AS version FROM ({rows})"] + [
        f"SELECT *, {number} AS version FROM ({rows}) WHERE {condition}"
        for condition, number in feed["versions"].items()
    ]
    columns = ", ".join(f"{text} AS {column}" for column, text in feed["columns"].items())
    return f"SELECT {columns} FROM ({' UNION ALL '.join(parts)})"
