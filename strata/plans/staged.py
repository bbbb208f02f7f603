"""Staged inputs over the driver tables.

The driver tables carry no NULLs, orphans or duplicate customer ids, so
these views inject them with fixed arithmetic.  Each statement is plain SQL
accepted by Spark and DuckDB alike, with ``{table}`` placeholders: Spark binds
DataFrames to them, a DuckDB oracle fills in the view names and prefixes the
statements as CTEs.  They read whole
tables: the modulo terms only decide which rows get another key, a NULL, a
change or an earlier time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

STAGED_SQL = {
    "raw_customer": """
SELECT CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '  c' || lpad(CAST(c_custkey % 1200 AS STRING), 5, '0') || ' ' END AS customer_id,
       CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE ' ' || c_name || '   X ' END AS first_name,
       CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 'Nation  ' || CAST(c_nationkey AS STRING) END AS last_name,
       CASE WHEN c_custkey % 11 = 0 THEN 'invalid-email' WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN 'a@b@c.co'
            ELSE ' User' || CAST(c_custkey AS STRING) || '@Example.COM ' END AS email,
       CASE c_mktsegment WHEN 'BUILDING' THEN ' active ' WHEN 'AUTOMOBILE' THEN 'inactive' WHEN 'MACHINERY' THEN 'Pending' WHEN 'HOUSEHOLD' THEN 'new'
            ELSE CASE WHEN c_custkey % 2 = 0 THEN 'BLOCKED' ELSE NULL END END AS status,
       CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 43 = 0 THEN 'not-a-date' WHEN c_custkey % 47 = 0 THEN '2024-13-45'
            ELSE CAST(make_date(CAST(1995 + c_custkey % 7 AS INT), CAST(1 + c_custkey % 12 AS INT), CAST(1 + c_custkey % 28 AS INT)) AS STRING) END AS signup_date,
       CASE WHEN c_custkey % 31 = 0 THEN NULL WHEN c_custkey % 53 = 0 THEN '12abc' WHEN c_custkey % 59 = 0 THEN 'NaN'
            ELSE CAST(CASE WHEN c_custkey % 3 = 0 THEN CAST(floor(c_acctbal / 8) AS DOUBLE) + 0.003 ELSE c_acctbal END AS STRING) END AS amount,
       CASE WHEN c_custkey % 37 = 0 THEN 'yesterday' ELSE CAST(make_date(CAST(2002 + c_custkey % 3 AS INT), CAST(1 + c_custkey % 12 AS INT), 1) AS STRING)
            || CASE c_custkey % 4 WHEN 1 THEN ' 00:30:00+02:00' WHEN 2 THEN 'T23:30:00Z' WHEN 3 THEN ' 22:15:00-05:30' ELSE ' 10:00:00' END END AS updated_at,
       ' north ' AS region, 'erp' AS source_system
FROM {customer}""",
    "customer_text": """
SELECT ' c' || CAST(c_custkey AS STRING) AS customer_id, ' ' || c_name || '   X ' AS first_name, CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 'Nation' END AS last_name,
       CASE WHEN c_custkey % 2 = 0 THEN ' active ' ELSE 'Pending' END AS status, CASE WHEN c_custkey % 53 = 0 THEN '12abc' ELSE CAST(c_acctbal AS STRING) END AS amount,
       lower(c_name) || '@x.io' AS email, '2001-05-06' AS signup_date
FROM {customer}""",
    "cdc_current": """
SELECT CASE WHEN user_id % 5 = 0 THEN -1 - user_id ELSE user_id END AS customer_id,
       max(CASE WHEN event_id % 2 = 0 THEN ts ELSE ts - INTERVAL 30 DAY END) AS updated_at FROM {events} GROUP BY user_id""",
    "cdc_incoming": """
SELECT CASE WHEN event_id % 997 = 0 THEN NULL WHEN event_id % 2 = 0 THEN 1000000 + user_id ELSE user_id END AS customer_id,
       CASE WHEN event_id % 991 = 0 THEN NULL ELSE ts END AS updated_at, event_type AS status, value AS amount
FROM {events}
UNION ALL
SELECT customer_id, updated_at, 'tie', 0.0 FROM {cdc_current} WHERE customer_id % 3 = 0""",
    "dim_customer": """
SELECT CASE WHEN c_custkey = 5 THEN NULL WHEN c_custkey % 10 = 0 THEN -c_custkey ELSE c_custkey END AS customer_id, c_mktsegment AS status,
       CASE WHEN c_custkey % 50 = 7 THEN DATE '2024-01-15' ELSE DATE '2023-01-01' END AS valid_from, CAST(NULL AS DATE) AS valid_to, TRUE AS is_current,
       CASE WHEN c_custkey % 10 = 1 THEN 2 WHEN c_custkey % 10 = 3 THEN NULL ELSE 1 END AS version_no
FROM {customer}
UNION ALL
SELECT c_custkey, 'OLD', DATE '2022-01-01', DATE '2023-01-01', FALSE, 1 FROM {customer} WHERE c_custkey % 10 = 1""",
    "scd_incoming": """
SELECT CASE WHEN c_custkey % 40 = 5 THEN NULL WHEN c_custkey % 4 = 0 THEN -c_custkey ELSE c_custkey END AS customer_id,
       CASE WHEN c_custkey % 3 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS status, DATE '2024-01-01' AS updated_at FROM {customer}
UNION ALL
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 6 = 0 THEN 'CHANGED' ELSE c_mktsegment END, DATE '2024-02-01' FROM {customer} WHERE c_custkey % 2 = 0
UNION ALL
SELECT c_custkey, 'LATE', DATE '2024-03-01' FROM {customer} WHERE c_custkey % 6 = 0""",
    "scd_late": """
SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 14 = 0 THEN NULL ELSE 'EARLY' END AS status, DATE '2022-06-15' AS updated_at FROM {customer} WHERE c_custkey % 7 = 0
UNION ALL
SELECT c_custkey, c_mktsegment, DATE '2023-06-01' FROM {customer} WHERE c_custkey % 3 = 1
UNION ALL
SELECT c_custkey, 'BETWEEN', DATE '2024-01-20' FROM {customer} WHERE c_custkey % 11 = 0""",
    "dim_intervals": """
SELECT CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE o_custkey END AS customer_id, CASE WHEN o_orderkey % 501 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS valid_from,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 200 AS INT) END AS valid_to
FROM {orders}""",
    "dim_keys": """
SELECT CASE WHEN c_custkey % 10 = 0 THEN -c_custkey ELSE c_custkey END AS customer_id FROM {customer}""",
    "fact_orders": """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_custkey END AS customer_id, o_orderkey AS order_id, o_totalprice AS amount FROM {orders}""",
    "orders_in": """
SELECT ' o' || CAST(o_orderkey AS STRING) AS order_id, ' c' || CAST(o_custkey AS STRING) || ' ' AS customer_id, CASE WHEN o_orderkey % 43 = 0 THEN 'soon' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'delivered' WHEN '2-HIGH' THEN ' Shipped' WHEN '3-MEDIUM' THEN 'pending' WHEN '5-LOW' THEN 'PROCESSING'
            ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'RETURNED' ELSE NULL END END AS order_status,
       CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 47 = 0 THEN 'n/a' ELSE CAST(CAST(o_orderkey % 900 AS DOUBLE) - 100.25 AS STRING) END AS gross_amount,
       CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(CAST(o_orderkey % 40 AS DOUBLE) * 5 AS STRING) END AS discount_amount
FROM {orders}""",
    "event_amounts": """
SELECT user_id AS customer_id,
       CASE WHEN user_id % 97 = 0 AND event_id % 3 = 0 THEN CAST('NaN' AS DOUBLE) WHEN user_id % 89 = 0 AND event_id % 3 = 0 THEN CAST('Infinity' AS DOUBLE)
            WHEN event_id % 5 = 0 THEN CAST(event_id % 100 AS DOUBLE) / 10000 ELSE value END AS amount, CAST(ts AS DATE) AS signup_date, event_type <> 'error' AS is_active, value >= 100 AS is_high_value,
       event_type = 'error' AS needs_review, CASE WHEN value >= 200 THEN 'HIGH' ELSE 'LOW' END AS risk_flag, 'BRONZE' AS customer_tier
FROM {events}""",
    "customer_lines": """
SELECT CAST(c_custkey AS STRING) || ',"' || c_name || ', x",' || CAST(c_nationkey AS STRING) || ',' || CASE WHEN c_custkey % 19 = 0 THEN 'abc' ELSE '12.5' END
       || CASE WHEN c_custkey % 13 = 0 THEN '' ELSE ',' || c_mktsegment END || CASE WHEN c_custkey % 17 = 0 THEN ',more' ELSE '' END AS line, c_custkey, c_name, c_nationkey, c_mktsegment
FROM {customer}""",
    "orders_copy": """
SELECT o_orderkey, CASE WHEN o_orderkey % 3001 = 5 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 2503 = 9 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM {orders} WHERE o_orderkey % 4001 <> 7
UNION ALL
SELECT -1 - o_orderkey, o_totalprice, o_orderstatus FROM {orders} WHERE o_orderkey % 5003 = 11""",
    "event_changes": """
SELECT 1 AS batch, 1 AS change, user_id AS customer_id,
       CASE WHEN user_id % 97 = 0 AND event_id % 3 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 5 = 0 THEN CAST(event_id % 100 AS DOUBLE) / 10000 ELSE value END AS amount,
       CAST(ts AS DATE) AS signup_date, event_type <> 'error' AS is_active, value >= 100 AS is_high_value, event_type = 'error' AS needs_review FROM {events} WHERE event_id % 4 <> 0
UNION ALL
SELECT 2, 1, user_id AS customer_id,
       CASE WHEN user_id % 97 = 0 AND event_id % 3 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 5 = 0 THEN CAST(event_id % 100 AS DOUBLE) / 10000 ELSE value END AS amount,
       CAST(ts AS DATE) AS signup_date, event_type <> 'error' AS is_active, value >= 100 AS is_high_value, event_type = 'error' AS needs_review FROM {events} WHERE event_id % 4 = 0
UNION ALL
SELECT 2, -1, user_id AS customer_id,
       CASE WHEN user_id % 97 = 0 AND event_id % 3 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 5 = 0 THEN CAST(event_id % 100 AS DOUBLE) / 10000 ELSE value END AS amount,
       CAST(ts AS DATE) AS signup_date, event_type <> 'error' AS is_active, value >= 100 AS is_high_value, event_type = 'error' AS needs_review FROM {events} WHERE event_id % 4 <> 0 AND (event_id % 10 = 1 OR user_id % 17 = 0)
UNION ALL
SELECT 2, 1, CASE WHEN event_id % 30 = 1 THEN NULL ELSE user_id END AS customer_id, value * 2 AS amount, CAST(ts AS DATE) + CAST(event_id % 9 AS INT) AS signup_date,
       TRUE AS is_active, value >= 50 AS is_high_value, FALSE AS needs_review FROM {events} WHERE event_id % 4 <> 0 AND event_id % 10 = 1""",
    "event_rows": """
SELECT user_id AS customer_id,
       CASE WHEN user_id % 97 = 0 AND event_id % 3 = 0 THEN CAST('NaN' AS DOUBLE) WHEN event_id % 5 = 0 THEN CAST(event_id % 100 AS DOUBLE) / 10000 ELSE value END AS amount,
       CAST(ts AS DATE) AS signup_date, event_type <> 'error' AS is_active, value >= 100 AS is_high_value, event_type = 'error' AS needs_review FROM {events} WHERE event_id % 4 = 0 OR NOT (event_id % 10 = 1 OR user_id % 17 = 0)
UNION ALL
SELECT CASE WHEN event_id % 30 = 1 THEN NULL ELSE user_id END AS customer_id, value * 2 AS amount, CAST(ts AS DATE) + CAST(event_id % 9 AS INT) AS signup_date,
       TRUE AS is_active, value >= 50 AS is_high_value, FALSE AS needs_review FROM {events} WHERE event_id % 4 <> 0 AND event_id % 10 = 1""",
    "nation_lookup": """
SELECT CASE WHEN n_nationkey % 4 = 0 THEN -1 - n_nationkey ELSE n_nationkey END AS lookup_key, n_name AS customer_segment FROM {nation}""",
    "segment_lookup": """
SELECT CASE WHEN c_custkey % 10 = 0 THEN -c_custkey ELSE c_custkey END AS lookup_key, c_mktsegment FROM {customer}""",
    "repeated_users": """
SELECT user_id, user_id * 3 + 1 AS account, 'user ' || CAST(user_id AS STRING) AS name FROM {events}""",
}

# Which staged views each staged view reads (for CTE prefixes).
STAGED_DEPS = {"cdc_incoming": ("cdc_current",)}

# Fixed evaluation dates of the staged data.
CUSTOMER_AS_OF = "2002-01-01"


def _memo(spark: SparkSession) -> dict:
    """Per-session memo of lazily defined input frames (no data is cached)."""
    memo = getattr(spark, "_strata_inputs", None)
    if memo is None:
        memo = {}
        spark._strata_inputs = memo
    return memo


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name`` of ``sf_dir`` (read definition reused per session)."""
    memo = _memo(spark)
    key = ("base", sf_dir, name)
    if key not in memo:
        memo[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return memo[key]


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The staged view ``name`` over the tables of ``sf_dir``.

    The SQL is resolved once per (session, folder).  Tables are bound as
    DataFrame parameters of ``spark.sql`` (each gets a private, uniquely named
    view), so no session view is created or replaced and concurrent queries
    over different folders cannot see each other's inputs.
    """
    memo = _memo(spark)
    key = ("staged", sf_dir, name)
    if key not in memo:
        sql = STAGED_SQL[name]
        frames = {t: base(spark, sf_dir, t) for t in ("customer", "orders", "events", "nation") if f"{{{t}}}" in sql}
        for dep in STAGED_DEPS.get(name, ()):
            frames[dep] = staged(spark, sf_dir, dep)
        memo[key] = spark.sql(sql, **frames)
    return memo[key]


def plain_sql(name: str) -> str:
    """The staged SQL with plain table names (for engines reading registered views)."""
    sql = STAGED_SQL[name]
    return sql.format(**{t: t for t in ("customer", "orders", "events", "nation", "cdc_current")})


def cte(*names: str) -> str:
    """``WITH`` prefix defining the given staged views (dependencies first)."""
    order: list[str] = []
    for n in names:
        for dep in STAGED_DEPS.get(n, ()):
            if dep not in order:
                order.append(dep)
        if n not in order:
            order.append(n)
    return "WITH " + ",\n".join(f"{n} AS ({plain_sql(n).strip()})" for n in order) + "\n"
