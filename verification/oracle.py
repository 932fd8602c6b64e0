"""DuckDB SQL for the registered queries, stated with the joins and windows of
the plain definition rather than the shapes the Spark plans take."""

from __future__ import annotations

from shopledger.schemas import EVENT_TYPES, ORDER_STATUSES, PAYMENT_METHODS
from verification.queries import RUN_ID, SALT, SEEK_AFTER, WATERMARKS


def _id(prefix: str, key: str) -> str:
    return f"'{prefix}' || lpad(CAST({key} AS VARCHAR), 9, '0')"


def _key(column: str) -> str:
    return f"md5({column})"


def _day_key(time: str) -> str:
    return f"CAST(strftime({time}, '%Y%m%d') AS INTEGER)"


def _events(other: str) -> str:
    return f"""
    SELECT {_id('EVT', 'event_id')} AS event_id,
           'camp-' || CAST(CAST(props->>'$.k' AS INTEGER) % 10 AS VARCHAR) AS campaign_id,
           CASE event_id % 4 WHEN 0 THEN ' Email ' WHEN 1 THEN 'SOCIAL'
                WHEN 2 THEN 'search' ELSE 'Affiliate' END AS channel,
           {_id('CUST', 'user_id')} AS customer_id,
           CASE WHEN event_type = 'purchase' THEN 'Conversion' ELSE {other} END AS event_type,
           value AS revenue,
           ts AS event_timestamp,
           ts + INTERVAL 5 MINUTE AS updated_at
    FROM events"""


def _silver_events(source: str) -> str:
    return f"""
    SELECT event_id, campaign_id, lower(trim(channel)) AS channel, customer_id,
           lower(trim(event_type)) AS event_type,
           CAST(revenue AS DECIMAL(12,2)) AS revenue, event_timestamp, updated_at
    FROM {source}
    QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY updated_at DESC) = 1"""


_LATEST_ITEMS = """
    SELECT * FROM src_order_items
    QUALIFY row_number() OVER (
        PARTITION BY order_item_id
        ORDER BY updated_at DESC, order_id DESC, product_id DESC, quantity DESC, unit_price DESC) = 1"""

_SOLD_TOTALS = """SUM(gross_amount) AS revenue, SUM(quantity) AS units,
           COUNT(DISTINCT order_id) AS orders"""

# In dependency order.
_VIEWS = {
    "src_customers": f"""
    SELECT {_id('CUST', 'c_custkey')} AS customer_id, c_name AS full_name,
           lower(c_name) || '@example.com' AS email,
           '+66-02-555-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS phone,
           CAST(c_custkey AS VARCHAR) || ' Demo Road' AS address,
           n_name AS city, lower(c_mktsegment) AS customer_segment,
           TIMESTAMP '1995-01-01 00:00:00' + to_hours(c_custkey) AS created_at,
           TIMESTAMP '1995-01-01 00:00:00' + to_hours(c_custkey) AS updated_at
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "src_products": f"""
    SELECT {_id('PROD', 'p_partkey')} AS product_id, p_name AS product_name, p_type AS category,
           CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price, p_size % 13 <> 0 AS is_active,
           TIMESTAMP '1995-01-01 00:00:00' AS created_at,
           TIMESTAMP '1995-01-01 00:00:00' AS updated_at
    FROM part""",
    "src_orders": f"""
    SELECT {_id('ORD', 'o_orderkey')} AS order_id, {_id('CUST', 'o_custkey')} AS customer_id,
           CASE o_orderstatus WHEN 'F' THEN ' COMPLETED' WHEN 'O' THEN 'Shipped '
                ELSE 'cancelled' END AS order_status,
           o_orderdate AS order_timestamp,
           o_orderdate + to_hours(o_orderkey % 24 + 1) AS updated_at
    FROM orders""",
    "src_order_items": f"""
    SELECT {_id('ITEM', 'l_orderkey')} || '-' || CAST(l_linenumber AS VARCHAR) AS order_item_id,
           {_id('ORD', 'l_orderkey')} AS order_id, {_id('PROD', 'l_partkey')} AS product_id,
           CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price,
           l_shipdate AS updated_at
    FROM lineitem""",
    "latest_items": _LATEST_ITEMS,
    "src_payments": f"""
    SELECT 'PAY' || substr({_id('ORD', 'o_orderkey')}, 4) AS payment_id,
           {_id('ORD', 'o_orderkey')} AS order_id,
           CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Card' WHEN '2' THEN ' promptpay'
                WHEN '3' THEN 'BANK_TRANSFER' ELSE 'wallet' END AS payment_method,
           CAST(coalesce(item_total, CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(12,2))
               AS payment_amount,
           o_orderdate + to_minutes(o_orderkey % 90 + 1) AS payment_timestamp,
           o_orderdate + to_minutes(o_orderkey % 90 + 1) AS updated_at
    FROM orders LEFT JOIN (
        SELECT order_id, SUM(CAST(quantity * unit_price AS DECIMAL(12,2))) AS item_total
        FROM latest_items GROUP BY order_id) t ON t.order_id = {_id('ORD', 'o_orderkey')}""",
    "src_campaign_events": _events("'click'"),
    "src_all_events": _events("event_type"),
    "later": f"""
    SELECT * FROM src_campaign_events
    WHERE (updated_at, event_id) > (TIMESTAMP '{SEEK_AFTER[0]}', '{SEEK_AFTER[1]}')""",
    "s_customers": f"""
    SELECT customer_id, sha256(email || ':{SALT}') AS email_hash,
           '***-***-' || right(phone, 4) AS phone_masked, city AS customer_city,
           customer_segment, created_at, updated_at
    FROM src_customers
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1""",
    "s_products": """
    SELECT * FROM src_products
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY updated_at DESC) = 1""",
    "s_orders": """
    SELECT order_id, customer_id, lower(trim(order_status)) AS order_status,
           order_timestamp, updated_at
    FROM src_orders
    QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) = 1""",
    "s_order_items": """
    SELECT *, CAST(quantity * unit_price AS DECIMAL(12,2)) AS line_amount FROM latest_items""",
    "s_payments": """
    SELECT payment_id, order_id, lower(trim(payment_method)) AS payment_method, payment_amount,
           payment_timestamp, updated_at
    FROM src_payments
    QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY updated_at DESC) = 1""",
    "s_campaign_events": _silver_events("src_campaign_events"),
    "dim_customer": f"""
    SELECT {_key('customer_id')} AS customer_key, * FROM s_customers""",
    "dim_product": f"""
    SELECT {_key('product_id')} AS product_key, product_id, product_name, category,
           unit_price AS current_unit_price, is_active, created_at, updated_at
    FROM s_products""",
    "active_days": """
    SELECT DISTINCT CAST(happened AS DATE) AS calendar_date
    FROM (SELECT order_timestamp AS happened FROM s_orders
          UNION ALL SELECT event_timestamp FROM s_campaign_events)""",
    "dim_date": f"""
    SELECT calendar_date, {_day_key('calendar_date')} AS date_key, {', '.join(
        f"CAST(date_part('{part}', calendar_date) AS INTEGER) AS {name}" for part, name in (
            ("year", "year"), ("quarter", "quarter"), ("month", "month"),
            ("day", "day"), ("dow", "day_of_week")))},
        strftime(calendar_date, '%B') AS month_name, strftime(calendar_date, '%A') AS day_name,
        date_part('isodow', calendar_date) > 5 AS is_weekend
    FROM active_days""",
    "dim_channel": f"""
    SELECT DISTINCT channel, {_key('channel')} AS channel_key FROM s_campaign_events""",
    # A fact has the keys of its parents, and a row only where all of them exist.
    "fact_sales": f"""
    WITH paid AS (
        SELECT * EXCLUDE (updated_at)
        FROM s_orders JOIN (SELECT order_id, payment_method, payment_timestamp FROM s_payments)
        USING (order_id)
        WHERE customer_id IN (SELECT customer_id FROM s_customers))
    SELECT order_item_id, order_item_id AS sales_key, order_id,
           quantity, unit_price, line_amount AS gross_amount,
           order_status, order_timestamp, payment_method, payment_timestamp,
           {_key('customer_id')} AS customer_key, {_key('product_id')} AS product_key,
           {_day_key('order_timestamp')} AS date_key
    FROM s_order_items JOIN paid USING (order_id)
    WHERE product_id IN (SELECT product_id FROM s_products)""",
    "fact_campaign_events": f"""
    SELECT event_id, event_id AS campaign_event_key, campaign_id, event_type, revenue,
           event_timestamp, {_day_key('event_timestamp')} AS date_key,
           {_key('customer_id')} AS customer_key, {_key('channel')} AS channel_key
    FROM s_campaign_events
    WHERE channel IS NOT NULL AND event_timestamp IS NOT NULL
      AND customer_id IN (SELECT customer_id FROM s_customers)""",
    "sold": """
    SELECT order_id, customer_key, product_key, quantity, gross_amount,
           CAST(order_timestamp AS DATE) AS calendar_date
    FROM fact_sales WHERE NOT order_status = 'cancelled'""",
    "vw_executive_summary": f"SELECT {_SOLD_TOTALS} FROM sold",
    "vw_daily_sales": f"SELECT calendar_date, {_SOLD_TOTALS} FROM sold GROUP BY ALL",
    "vw_product_performance": f"""
    SELECT category, product_name, {_SOLD_TOTALS}
    FROM sold JOIN dim_product USING (product_key) GROUP BY ALL""",
    "vw_customer_segments": f"""
    SELECT customer_segment, COUNT(DISTINCT customer_id) AS customers, {_SOLD_TOTALS}
    FROM sold JOIN dim_customer USING (customer_key) GROUP BY ALL""",
    "vw_campaign_performance": """
    SELECT campaign_id, channel, COUNT(*) AS n, SUM(revenue) AS attributed_revenue,
           COUNT(CASE event_type WHEN 'click' THEN 1 END) AS clicks,
           COUNT(CASE event_type WHEN 'conversion' THEN 1 END) AS conversions
    FROM fact_campaign_events JOIN dim_channel USING (channel_key) GROUP BY campaign_id, channel""",
    "f_customers": "SELECT * FROM s_customers WHERE customer_segment <> 'machinery'",
    "f_products": """
    SELECT * REPLACE (CASE WHEN is_active THEN unit_price ELSE -unit_price END AS unit_price)
    FROM s_products""",
    "f_orders": """
    SELECT * REPLACE (
        CASE WHEN order_timestamp < TIMESTAMP '1996-01-01 00:00:00' THEN 'returned'
             ELSE order_status END AS order_status,
        CASE WHEN hour(updated_at) <> 7 THEN customer_id END AS customer_id)
    FROM s_orders""",
    "f_order_items": """
    SELECT * REPLACE (
        CASE WHEN quantity <> 1 THEN product_id END AS product_id,
        CASE WHEN quantity = 2 THEN 'ORD-UNKNOWN' ELSE order_id END AS order_id,
        CASE WHEN quantity = 3 THEN -line_amount ELSE line_amount END AS line_amount)
    FROM (SELECT * FROM s_order_items
          UNION ALL SELECT * FROM s_order_items WHERE quantity = 50)""",
    "f_payments": """
    SELECT * REPLACE (
        CASE WHEN payment_method = 'bank_transfer' THEN 'cheque' ELSE payment_method END
            AS payment_method,
        CASE WHEN payment_method = 'card' THEN payment_amount + 1 ELSE payment_amount END
            AS payment_amount,
        CASE WHEN minute(payment_timestamp) <> 11 THEN order_id END AS order_id)
    FROM s_payments""",
    "s_all_events": _silver_events("src_all_events"),
    "f_campaign_events": """
    SELECT * REPLACE (CASE WHEN channel = 'affiliate' THEN -revenue ELSE revenue END AS revenue)
    FROM s_all_events""",
    "b_order_items": """
    SELECT * FROM s_order_items
    UNION ALL BY NAME
    SELECT 'BADITEM0001' AS order_item_id, 'ORD000000001' AS order_id,
           'PROD999999999' AS product_id, CAST(-2 AS INTEGER) AS quantity,
           CAST(100 AS DECIMAL(12,2)) AS unit_price,
           TIMESTAMP '2026-06-01 00:00:00' AS updated_at,
           CAST(-200 AS DECIMAL(12,2)) AS line_amount""",
    "item_runs": """
    SELECT 'RUN-' || CAST(year(updated_at) AS VARCHAR) AS run_id, MAX(updated_at) AS loaded_at,
           COUNT(*) AS fact_sales_rows, CAST(0 AS BIGINT) AS fact_campaign_rows,
           'success' AS status
    FROM src_order_items GROUP BY 1""",
    "order_runs": """
    SELECT 'RUN-' || CAST(year(order_timestamp) AS VARCHAR) AS run_id,
           MAX(order_timestamp) AS loaded_at, COUNT(*) AS fact_sales_rows,
           CAST(0 AS BIGINT) AS fact_campaign_rows, 'success' AS status
    FROM s_orders GROUP BY 1""",
}

# A second load, from sources in which every row came twice.
for _name in ("customers", "products", "orders", "order_items", "payments"):
    _VIEWS[f"twice_{_name}"] = f"SELECT * FROM src_{_name} UNION ALL SELECT * FROM src_{_name}"
_VIEWS["again_latest_items"] = _LATEST_ITEMS.replace("src_", "twice_")
for _name in ("customers", "products", "orders", "order_items", "payments"):
    _VIEWS[f"again_{_name}"] = (
        _VIEWS[f"s_{_name}"].replace("src_", "twice_").replace("latest_items", "again_latest_items")
    )
_VIEWS["again_fact_sales"] = _VIEWS["fact_sales"].replace(" s_", " again_")

_SOURCES = ("customers", "products", "orders", "order_items", "payments", "campaign_events")
_KEYS = ("customer_id", "product_id", "order_id", "order_item_id", "payment_id", "event_id")


def _with(select: str) -> str:
    """The query with the views it needs, directly or through others."""
    needed: set[str] = set()
    texts = [select]
    while texts:
        text = texts.pop()
        words = set(text.replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
        for name in (words & _VIEWS.keys()) - needed:
            needed.add(name)
            texts.append(_VIEWS[name])
    views = [f"{name} AS MATERIALIZED ({_VIEWS[name]})" for name in _VIEWS if name in needed]
    return f"WITH {', '.join(views)} {select}" if views else select


def _double(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def _rounded(expression: str) -> str:
    return f"CAST(ROUND({expression}, 2) AS DOUBLE)"


def _mean_cents(amount: str, count: str) -> str:
    """Half-up mean to the cent in integer arithmetic."""
    cents = f"CAST({amount} * 100 AS HUGEINT)"
    return f"((2 * {cents} + {count}) // (2 * {count})) / 100.0"


def _long(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _counts(label: str, value: str, prefix: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS {label}, COUNT(*) AS {value} FROM {prefix}{name}" for name in _SOURCES
    )


def _summaries() -> str:
    parts = []
    for name in _SOURCES:
        mark = WATERMARKS.get(name, "1970-01-01T00:00:00+00:00")[:19].replace("T", " ")
        parts.append(
            f"""SELECT '{name}' AS source, COUNT(*) AS rows,
                TIMESTAMP '{mark}' AS watermark_before,
                coalesce(MAX(updated_at), TIMESTAMP '{mark}') AS watermark_after
                FROM src_{name} WHERE updated_at > TIMESTAMP '{mark}'"""
        )
    return " UNION ALL ".join(parts)


def _after(name: str) -> str:
    return WATERMARKS[name][:19].replace("T", " ")


def _tables(prefix: str, items: str | None = None) -> dict[str, str]:
    tables = {name: f"{prefix}{name}" for name in _SOURCES}
    if items:
        tables["order_items"] = items
    return tables


_PARENTS = {"customer_id": "customers", "order_id": "orders", "product_id": "products"}
_LINKS = {
    "orders": ("customer_id",),
    "order_items": ("order_id", "product_id"),
    "payments": ("order_id",),
    "campaign_events": ("customer_id",),
}


def _orphans(t: dict[str, str]) -> str:
    """Rows without a parent; a row that names none has none."""
    return " UNION ALL ".join(
        f"""SELECT '{child}.{key} -> {_PARENTS[key]}' AS relationship, COUNT(*) AS failures
            FROM {t[child]} AS child WHERE NOT EXISTS (
                FROM {t[_PARENTS[key]]} AS parent WHERE parent.{key} = child.{key})"""
        for child, keys in _LINKS.items()
        for key in keys
    )


def _outside(t: dict[str, str], allowed: dict[tuple[str, str], str]) -> str:
    """Rows of each table of which some value is known and not in its range."""
    conditions: dict[str, list[str]] = {}
    for (table, column), allows in allowed.items():
        conditions.setdefault(table, []).append(f"coalesce({column} {allows}, TRUE)")
    return " + ".join(
        f"(SELECT COUNT(*) FROM {t[table]} WHERE NOT ({' AND '.join(fine)}))"
        for table, fine in conditions.items()
    )


def _failures(t: dict[str, str], limits: tuple[int, int, int] = (100, 50, 500)) -> dict[str, str]:
    own = dict(zip(_SOURCES, _KEYS))
    required = {(n, own[n]): "" for n in _SOURCES[:-1]} | {
        (child, key): "" for child, keys in _LINKS.items() if child != "campaign_events" for key in keys
    }
    domains = {
        ("orders", "order_status"): f"IN {ORDER_STATUSES}",
        ("payments", "payment_method"): f"IN {PAYMENT_METHODS}",
        ("campaign_events", "event_type"): f"IN {EVENT_TYPES}",
    }
    amounts = {
        ("products", "unit_price"): "> 0",
        ("order_items", "quantity"): "> 0",
        ("order_items", "unit_price"): "> 0",
        ("order_items", "line_amount"): "> 0",
        ("payments", "payment_amount"): "> 0",
        ("campaign_events", "revenue"): ">= 0",
    }
    return {
        "required_keys_not_null": _outside(t, {key: "IS NOT NULL" for key in required}),
        "primary_keys_unique": " + ".join(
            f"(SELECT COUNT(*) - COUNT(DISTINCT {key}) FROM {t[name]})" for name, key in own.items()
        ),
        "valid_business_statuses": _outside(t, domains),
        "positive_amounts": _outside(t, amounts),
        "referential_integrity": f"(SELECT SUM(failures) FROM ({_orphans(t)}))",
        "payment_reconciles_to_items": f"""(SELECT COUNT(*) FROM (
            SELECT payment_amount - due AS gap FROM {t['payments']} JOIN (
                SELECT order_id, SUM(line_amount) AS due FROM {t['order_items']} GROUP BY ALL)
            USING (order_id)) WHERE gap NOT BETWEEN -0.01 AND 0.01)""",
        "minimum_expected_volume": " + ".join(
            f"(SELECT CAST(COUNT(*) < {limit} AS INTEGER) FROM {t[name]})"
            for name, limit in zip(("customers", "products", "orders"), limits)
        ),
        "raw_pii_absent_from_silver": "0",
    }


def _check_rows(failures: dict[str, str]) -> str:
    return f"""SELECT check_name, failures, failures = 0 AS passed, TRUE AS blocking, '' AS detail
        FROM ({' UNION ALL '.join(
            f"SELECT '{name}' AS check_name, {_long(sql)} AS failures"
            for name, sql in failures.items())})"""


def _faulty(check: str) -> str:
    return _check_rows({check: _failures(_tables("f_"))[check]})


def _verdict(checks: str) -> str:
    return f"""SELECT CASE WHEN COUNT(*) FILTER (WHERE NOT passed) > 0 THEN 'failed'
            ELSE 'passed' END AS status, COUNT(*) AS checks,
        COUNT(*) FILTER (WHERE NOT passed) AS blocking_failures FROM ({checks})"""


_CLEAN = _check_rows(_failures(_tables("s_")))
_BAD = _check_rows(_failures(_tables("s_", "b_order_items")))

_SALES = f"""SELECT * REPLACE ({_double('unit_price', 'gross_amount')}) FROM fact_sales"""
_EVENTS = f"""SELECT * REPLACE ({_double('revenue')}) FROM fact_campaign_events"""

_TOTALS = f"""SELECT {_rounded('revenue')} AS revenue, {_long('orders')} AS orders,
    {_mean_cents('revenue', 'orders')} AS average_order_value, {_long('units')} AS units"""

_OBJECT_NAMES = {
    "BASE TABLE": (
        "dim_customer",
        "dim_product",
        "dim_date",
        "dim_channel",
        "fact_sales",
        "fact_campaign_events",
    ),
    "VIEW": (
        "vw_executive_summary",
        "vw_daily_sales",
        "vw_product_performance",
        "vw_customer_segments",
        "vw_campaign_performance",
    ),
}
_OBJECTS = " UNION ALL ".join(
    f"SELECT '{name}' AS object_name, '{kind}' AS object_type, COUNT(*) AS row_count FROM {name}"
    for kind, names in _OBJECT_NAMES.items()
    for name in names
)

_ASSERTIONS = """SELECT *, fact_sales_rows = distinct_sales_keys AS sales_keys_unique,
        ABS(silver_revenue - warehouse_revenue) <= 0.01 AS revenue_reconciles
    FROM (SELECT (SELECT COUNT(*) FROM fact_sales) AS fact_sales_rows,
        (SELECT COUNT(DISTINCT sales_key) FROM fact_sales) AS distinct_sales_keys,
        (SELECT COUNT(*) FROM fact_campaign_events) AS fact_campaign_rows,
        (SELECT SUM(line_amount) FROM s_order_items) AS silver_revenue,
        (SELECT SUM(gross_amount) FROM fact_sales) AS warehouse_revenue,
        (SELECT COUNT(*) - COUNT(DISTINCT customer_key) FROM dim_customer)
        + (SELECT COUNT(*) - COUNT(DISTINCT product_key) FROM dim_product) AS key_collisions)"""

_IDEMPOTENT = """SELECT *, first_fact_rows = second_fact_rows
        AND second_fact_rows = distinct_sales_keys
        AND keys_only_in_first + keys_only_in_second = 0 AS passed
    FROM (SELECT (SELECT COUNT(*) FROM fact_sales) AS first_fact_rows,
        (SELECT COUNT(*) FROM again_fact_sales) AS second_fact_rows,
        (SELECT COUNT(DISTINCT sales_key) FROM again_fact_sales) AS distinct_sales_keys,
        (SELECT COUNT(*) FROM (SELECT sales_key FROM fact_sales
            EXCEPT SELECT sales_key FROM again_fact_sales)) AS keys_only_in_first,
        (SELECT COUNT(*) FROM (SELECT sales_key FROM again_fact_sales
            EXCEPT SELECT sales_key FROM fact_sales)) AS keys_only_in_second)"""


def _rows_of(section: str, select: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '{c}' AS metric, CAST({c} AS VARCHAR) AS value FROM ({select})"
        for c in columns
    )


_EVIDENCE = " UNION ALL ".join(
    [
        f"""SELECT 'executive' AS section, metric, value FROM (
            SELECT 'revenue' AS metric, CAST(revenue AS VARCHAR) AS value FROM vw_executive_summary
            UNION ALL SELECT 'orders', CAST(orders AS VARCHAR) FROM vw_executive_summary
            UNION ALL SELECT 'units', CAST(units AS VARCHAR) FROM vw_executive_summary
            UNION ALL SELECT 'average_order_value',
                CAST(CAST({_mean_cents('revenue', 'orders')} AS DECIMAL(18,2)) AS VARCHAR)
                FROM vw_executive_summary)""",
        f"""SELECT 'quality', check_name, CASE WHEN passed THEN 'passed' ELSE 'failed' END
            FROM ({_CLEAN})""",
        """SELECT 'privacy', metric, value FROM (
            SELECT 'protected_columns' AS metric, 'email_hash, phone_masked' AS value
            UNION ALL SELECT 'raw_columns', ''
            UNION ALL SELECT 'removed_columns', 'address, email, full_name, phone'
            UNION ALL SELECT 'customers', CAST(COUNT(*) AS VARCHAR) FROM dim_customer)""",
        _rows_of(
            "reconciliation",
            _ASSERTIONS,
            (
                "fact_sales_rows",
                "distinct_sales_keys",
                "fact_campaign_rows",
                "silver_revenue",
                "warehouse_revenue",
                "key_collisions",
                "sales_keys_unique",
                "revenue_reconciles",
            ),
        ),
        _rows_of(
            "idempotency",
            _IDEMPOTENT,
            (
                "first_fact_rows",
                "second_fact_rows",
                "distinct_sales_keys",
                "keys_only_in_first",
                "keys_only_in_second",
                "passed",
            ),
        ),
        _rows_of("bad_fixture", _verdict(_BAD), ("status", "checks", "blocking_failures")),
        f"SELECT 'bronze_rows', dataset, CAST(n AS VARCHAR) FROM ({_counts('dataset', 'n', 'src_')})",
        f"SELECT 'silver_rows', dataset, CAST(n AS VARCHAR) FROM ({_counts('dataset', 'n', 's_')})",
        f"SELECT 'objects', object_name, CAST(row_count AS VARCHAR) FROM ({_OBJECTS})",
    ]
)

_PRODUCTS = f"""SELECT category, product_name, {_rounded('revenue')} AS revenue,
    {_long('units')} AS units, orders FROM vw_product_performance"""

_LOW, _HIGH = (f"(SELECT {end}(sales_key) FROM fact_sales)" for end in ("MIN", "MAX"))
_LOADS = {
    "reloaded": "SELECT * FROM fact_sales",
    "amount": f"""SELECT * REPLACE (CAST(CASE WHEN sales_key = {_LOW} THEN gross_amount + 0.01
        ELSE gross_amount END AS DECIMAL(12,2)) AS gross_amount) FROM fact_sales""",
    "doubled": f"""SELECT * FROM fact_sales WHERE sales_key <> {_LOW}
        UNION ALL SELECT * FROM fact_sales WHERE sales_key = {_HIGH}""",
}

_SELECTS = {
    "extract_incremental": f"""SELECT * FROM src_orders
        WHERE updated_at > TIMESTAMP '{_after('orders')}'""",
    "extract_watermarks": f"SELECT source, watermark_before, watermark_after FROM ({_summaries()})",
    "extract_events_incremental": f"""SELECT * FROM src_campaign_events
        WHERE updated_at > TIMESTAMP '{_after('campaign_events')}'""",
    "extract_manifest": f"""SELECT '{RUN_ID}' AS run_id, source, rows,
        {_long('SUM(rows) OVER ()')} AS total_rows FROM ({_summaries()})""",
    "bronze_utc_normalise": """SELECT event_id, event_timestamp - INTERVAL 7 HOUR
        AS event_timestamp, updated_at FROM src_campaign_events""",
    "events_ordered_page": """SELECT *, (SELECT COUNT(*) FROM src_campaign_events) AS total,
        (SELECT COUNT(*) FROM src_campaign_events) > 200 AS has_more
        FROM src_campaign_events ORDER BY updated_at, event_id LIMIT 100 OFFSET 100""",
    "events_seek_page": f"""SELECT *, (SELECT COUNT(*) FROM later) > 200 AS has_more
        FROM later ORDER BY updated_at, event_id LIMIT 200""",
    "events_readable": """SELECT *, (SELECT COUNT(*) FROM src_campaign_events
            WHERE CAST(substr(event_id, 4) AS INTEGER) % 97 = 0) AS set_aside
        FROM src_campaign_events WHERE CAST(substr(event_id, 4) AS INTEGER) % 97 <> 0""",
    "bronze_append_read": f"""SELECT *,
        CASE WHEN updated_at > TIMESTAMP '{_after('orders')}' THEN DATE '2026-01-02' ELSE DATE '2026-01-01' END AS ingested_date,
        CASE WHEN updated_at > TIMESTAMP '{_after('orders')}' THEN 'r2' ELSE 'r1' END AS run_id FROM src_orders""",
    "fixture_csv_read": f"""SELECT * REPLACE ({_double('unit_price', 'line_amount')})
        FROM s_order_items""",
    "silver_published_copy": f"""SELECT table_name, first_rows, first_rows AS second_rows, TRUE AS same
        FROM ({_counts("table_name", "first_rows", "s_")})""",
    "silver_publish_plan": f"""SELECT table_name, n > 0 AS has_files, n > 0 AS has_bytes
        FROM ({_counts("table_name", "n", "s_")})""",
    "incremental_silver_orders": "SELECT * FROM s_orders",
    "incremental_silver_order_items": f"""SELECT * REPLACE ({_double('unit_price', 'line_amount')})
        FROM s_order_items""",
    "incremental_fact_sales": _SALES,
    "incremental_daily_sales": f"SELECT calendar_date, * EXCLUDE (calendar_date) FROM "
    f"({_TOTALS}, calendar_date FROM vw_daily_sales)",
    "incremental_product_performance": _PRODUCTS,
    "incremental_customer_segments": f"""SELECT customer_segment, customers, orders,
        {_rounded('revenue')} AS revenue FROM vw_customer_segments""",
    "load_fingerprint": " UNION ALL ".join(
        f"""SELECT '{load}' AS load, (SELECT COUNT(*) FROM fact_sales) AS first_rows,
            (SELECT COUNT(*) FROM ({other})) AS second_rows,
            NOT EXISTS (SELECT * FROM fact_sales EXCEPT ALL ({other}))
            AND NOT EXISTS (({other}) EXCEPT ALL SELECT * FROM fact_sales) AS same"""
        for load, other in _LOADS.items()
    ),
    "source_counts": _counts("source", "rows", "src_"),
    "silver_customers": "SELECT * FROM s_customers",
    "silver_products": f"SELECT * REPLACE ({_double('unit_price')}) FROM s_products",
    "silver_orders": "SELECT * FROM s_orders",
    "silver_order_items": f"""SELECT * REPLACE ({_double('unit_price', 'line_amount')})
        FROM s_order_items""",
    "silver_order_items_latest": f"SELECT * REPLACE ({_double('unit_price')}) FROM latest_items",
    "silver_payments": f"SELECT * REPLACE ({_double('payment_amount')}) FROM s_payments",
    "silver_campaign_events": f"SELECT * REPLACE ({_double('revenue')}) FROM s_campaign_events",
    "silver_row_counts": _counts("dataset", "rows", "s_"),
    "check_required_keys": _faulty("required_keys_not_null"),
    "check_primary_keys_unique": _faulty("primary_keys_unique"),
    "check_valid_business_statuses": _faulty("valid_business_statuses"),
    "check_positive_amounts": _faulty("positive_amounts"),
    "check_referential_integrity": _faulty("referential_integrity"),
    "orphans_by_relationship": _orphans(_tables("f_")),
    "check_payment_reconciles": _faulty("payment_reconciles_to_items"),
    "check_minimum_volume": _check_rows(
        {
            "minimum_expected_volume": _failures(
                _tables("s_"), (100, 1_000_000_000, 1_000_000_000)
            )["minimum_expected_volume"]
        }
    ),
    "check_raw_pii_absent": f"""
        SELECT 'silver' AS layer, 'raw_pii_absent_from_silver' AS check_name,
               {_long('0')} AS failures, TRUE AS passed, '' AS columns_found, COUNT(*) AS rows
        FROM s_customers
        UNION ALL SELECT 'source', 'raw_pii_absent_from_silver', {_long('4')}, FALSE,
               'address, email, full_name, phone', COUNT(*) FROM src_customers""",
    "quality_report": _CLEAN,
    "quality_report_bad_fixture": _BAD,
    "gate_verdict_bad_fixture": _verdict(_BAD),
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_product": f"SELECT * REPLACE ({_double('current_unit_price')}) FROM dim_product",
    "dim_date": "SELECT * FROM dim_date",
    "dim_channel": "SELECT * FROM dim_channel",
    "fact_sales": _SALES,
    "fact_sales_hot_keys": _SALES,
    "fact_sales_verified": _SALES,
    "fact_campaign_events": _EVENTS,
    "fact_campaign_events_hot_keys": _EVENTS,
    "fact_campaign_events_verified": _EVENTS,
    "load_assertions": f"SELECT * REPLACE ({_double('silver_revenue', 'warehouse_revenue')}) FROM ({_ASSERTIONS})",
    "warehouse_metrics": """SELECT COUNT(*) AS fact_sales_rows,
        COUNT(DISTINCT sales_key) AS distinct_sales_keys,
        (SELECT COUNT(*) FROM fact_campaign_events) AS fact_campaign_rows,
        (SELECT COUNT(*) FROM item_runs) AS pipeline_runs FROM fact_sales""",
    "warehouse_object_counts": _OBJECTS,
    "vw_executive_summary": f"{_TOTALS} FROM vw_executive_summary",
    "vw_daily_sales": f"SELECT calendar_date, * EXCLUDE (calendar_date) FROM "
    f"({_TOTALS}, calendar_date FROM vw_daily_sales)",
    "vw_product_performance": _PRODUCTS,
    "vw_product_performance_hot_keys": _PRODUCTS,
    "vw_customer_segments": f"""SELECT customer_segment, customers, orders,
        {_rounded('revenue')} AS revenue FROM vw_customer_segments""",
    "vw_campaign_performance": f"""SELECT campaign_id, channel, clicks, conversions,
        {_rounded('attributed_revenue')} AS attributed_revenue,
        {_mean_cents('100 * conversions', 'n')} AS conversion_rate_percent
        FROM vw_campaign_performance""",
    "executive_from_daily": f"""{_TOTALS} FROM (SELECT SUM(revenue) AS revenue,
        SUM(orders) AS orders, SUM(units) AS units FROM vw_daily_sales)""",
    "daily_sales_coverage": f"""SELECT COUNT(*) AS daily_points, MIN(calendar_date) AS start_date,
        MAX(calendar_date) AS end_date, {_rounded('SUM(revenue)')} AS revenue,
        {_long('SUM(orders)')} AS orders, {_long('SUM(units)')} AS units FROM vw_daily_sales""",
    "daily_sales_first_days": f"{_TOTALS}, calendar_date FROM vw_daily_sales "
    "ORDER BY calendar_date LIMIT 5",
    "run_ledger_upsert": """SELECT * FROM item_runs
        UNION ALL SELECT * FROM order_runs o
        WHERE NOT EXISTS (SELECT 1 FROM item_runs i WHERE i.run_id = o.run_id)""",
    "idempotency_check": _IDEMPOTENT,
    "publishable_run": """SELECT run_id, loaded_at, fact_sales_rows, 'passed' AS status
        FROM (SELECT * FROM item_runs ORDER BY loaded_at DESC, run_id DESC LIMIT 1) r
        WHERE NOT EXISTS (SELECT 1 FROM src_order_items i WHERE i.quantity <= 0
            AND 'RUN-' || CAST(year(i.updated_at) AS VARCHAR) = r.run_id)""",
    "evidence_metrics": _EVIDENCE,
    "layer_row_counts": f"""SELECT b.dataset, 2 * b.n AS bronze_rows, s.n AS silver_rows
        FROM ({_counts('dataset', 'n', 'src_')}) b
        JOIN ({_counts('dataset', 'n', 's_')}) s ON s.dataset = b.dataset""",
}


def oracle() -> dict[str, str]:
    return {name: _with(select) for name, select in _SELECTS.items()}
