"""DuckDB SQL oracles, one per registered query.

Written independently of the Spark operators, from the business rules:
plain SQL over the driver tables (pre-registered views) with the staged
views of :mod:`strata.plans.staged` as CTEs.  Money sums do not round: finite
amounts are summed as ``DECIMAL(38,10)``; a NaN or infinity makes the total.
"""

from __future__ import annotations

from strata.config import (
    SYNTH_DOMAINS,
    SYNTH_FIRST_NAMES,
    SYNTH_INVALID_STATUSES,
    SYNTH_LAST_NAMES,
    SYNTH_REGIONS,
    SYNTH_SOURCE_SYSTEMS,
    SYNTH_VALID_STATUSES,
)
from strata.plans.staged import cte

EMAIL_RE = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
AS_OF = "DATE '2002-01-01'"

RAW_COLS = "customer_id, first_name, last_name, email, status, signup_date, amount, updated_at, region, source_system"

B1 = r"""SELECT upper(trim(customer_id)) AS customer_id,
       trim(regexp_replace(first_name, '\s+', ' ', 'g')) AS first_name,
       trim(regexp_replace(last_name, '\s+', ' ', 'g')) AS last_name,
       lower(trim(email)) AS email, upper(trim(status)) AS status,
       signup_date, amount, updated_at, region, source_system
FROM raw_customer"""

# framework operational rules (B1 -> B2 -> B3 -> B4 -> B5 -> B6)
OPERATIONAL_CTES = cte("raw_customer") + f""", b1 AS ({B1}),
b2 AS (SELECT customer_id, coalesce(first_name, 'UNKNOWN') AS first_name, coalesce(last_name, 'UNKNOWN') AS last_name,
              coalesce(email, 'unknown@missing.com') AS email, coalesce(status, 'NEW') AS status,
              TRY_CAST(signup_date AS DATE) AS signup_date,
              CASE WHEN amount IS NULL THEN 0.0 ELSE round(abs(TRY_CAST(amount AS DOUBLE)), 2) END AS amount,
              updated_at, region FROM b1),
op AS (
SELECT customer_id, first_name, last_name, email, status, signup_date, amount, updated_at, region,
       'CRM' AS source_system, 'BATCH_001' AS batch_id, TIMESTAMP '2002-01-01 00:00:00' AS ingested_at,
       {AS_OF} AS ingestion_date,
       CAST(year(signup_date) AS INTEGER) AS signup_year,
       strftime(signup_date, '%Y-%m') AS signup_month,
       'Q' || CAST(quarter(signup_date) AS VARCHAR) AS signup_quarter,
       strftime(signup_date, '%A') AS signup_day_of_week,
       CAST(weekofyear(signup_date) AS INTEGER) AS signup_week_of_year,
       coalesce(isodow(signup_date) IN (6, 7), FALSE) AS is_weekend,
       trim(concat_ws(' ', first_name, last_name)) AS full_name,
       status IN ('ACTIVE', 'PENDING', 'NEW') AS is_active,
       CASE WHEN contains(email, '@') THEN string_split(email, '@')[2] END AS email_domain,
       regexp_matches(email, '{EMAIL_RE}') AS has_valid_email,
       CAST({AS_OF} - signup_date AS INTEGER) AS customer_age_days,
       CASE WHEN amount >= 500 THEN 'GOLD' WHEN amount >= 200 THEN 'SILVER' ELSE 'BRONZE' END AS customer_tier,
       CASE WHEN amount >= 1000 OR status = 'INACTIVE' THEN 'HIGH'
            WHEN amount >= 500 OR status = 'PENDING' THEN 'MEDIUM' ELSE 'LOW' END AS risk_flag,
       CASE WHEN amount >= 1000 THEN 'VIP' WHEN amount >= 500 THEN 'LOYAL' WHEN amount >= 100 THEN 'REGULAR' ELSE 'NEW' END
           AS customer_segment,
       amount >= 500 AS is_high_value,
       coalesce(signup_date >= {AS_OF} - 30, FALSE) AS is_recent_signup,
       coalesce((NOT regexp_matches(email, '{EMAIL_RE}')) OR status = 'PENDING', FALSE) AS needs_review
FROM b2)
"""

# loader operational rules (B10 -> B11)
LOADER_CTES = cte("raw_customer") + rf""", b10 AS (
SELECT trim(CAST(customer_id AS VARCHAR)) AS customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
       lower(trim(email)) AS email, upper(trim(status)) AS status, TRY_CAST(signup_date AS DATE) AS signup_date,
       round(abs(TRY_CAST(amount AS DOUBLE)), 2) AS amount, CASE WHEN regexp_matches(updated_at, ':\d{{2}}(Z|[+-]\d{{2}}:\d{{2}})$')
            THEN make_timestamp(epoch_us(TRY_CAST(updated_at AS TIMESTAMPTZ))) ELSE TRY_CAST(updated_at AS TIMESTAMP) END AS updated_at,
       upper(trim(region)) AS region, upper(trim(source_system)) AS source_system
FROM raw_customer),
lop AS (
SELECT customer_id, lower(trim(concat_ws(' ', first_name, last_name))) AS full_name, email,
       regexp_extract(email, '@(.+)$', 1) AS email_domain, regexp_matches(email, '{EMAIL_RE}') AS has_valid_email,
       status, signup_date, amount,
       CASE WHEN amount >= 500 THEN 'GOLD' WHEN amount >= 200 THEN 'SILVER' ELSE 'BRONZE' END AS customer_tier,
       CASE WHEN amount >= 1000 THEN 'HIGH' WHEN amount >= 500 THEN 'MEDIUM' ELSE 'LOW' END AS risk_flag,
       CASE WHEN amount >= 500 AND status IN ('ACTIVE', 'PENDING', 'NEW') THEN 'VIP'
            WHEN status IN ('ACTIVE', 'PENDING', 'NEW') THEN 'LOYAL'
            WHEN amount >= 100 THEN 'REGULAR' ELSE 'NEW' END AS customer_segment,
       status IN ('ACTIVE', 'PENDING', 'NEW') AS is_active, amount >= 500 AS is_high_value,
       strftime(signup_date, '%Y-%m') AS signup_month, CAST({AS_OF} - signup_date AS INTEGER) AS customer_age_days,
       updated_at
FROM b10)
"""


def total_of(amount: str) -> str:
    """Sum of a double column with NaN and infinities as in a double sum, else exact."""
    nan = f"(bool_or(isnan({amount})) OR (bool_or({amount} = 'inf'::DOUBLE) AND bool_or({amount} = '-inf'::DOUBLE)))"
    exact = f"CAST(sum(CAST(CASE WHEN isfinite({amount}) THEN {amount} END AS DECIMAL(38,10))) AS DOUBLE)"
    return (f"CASE WHEN {nan} THEN 'nan'::DOUBLE WHEN bool_or({amount} = 'inf'::DOUBLE) THEN 'inf'::DOUBLE "
            f"WHEN bool_or({amount} = '-inf'::DOUBLE) THEN '-inf'::DOUBLE ELSE {exact} END")


def curated_sql(source: str, review_expr: str) -> str:
    total = total_of("amount")
    return f"""SELECT customer_id, {total} AS total_amount, {total} / count(amount) AS avg_amount,
       max(signup_date) AS latest_signup_date, min(signup_date) AS first_signup_date,
       count(customer_id) AS total_records,
       CAST(sum(CASE WHEN is_active THEN 1 ELSE 0 END) AS BIGINT) AS active_record_count,
       CAST(sum(CASE WHEN is_high_value THEN 1 ELSE 0 END) AS BIGINT) AS high_value_record_count,
       CAST(max(CASE WHEN {review_expr} THEN 1 ELSE 0 END) AS INTEGER) AS review_flag,
       CASE WHEN {total} >= 500 THEN 'GOLD' WHEN {total} >= 200 THEN 'SILVER' ELSE 'BRONZE' END AS customer_tier
FROM {source} GROUP BY customer_id"""


SCD_CTES = cte("dim_customer", "scd_incoming") + """,
cur AS (SELECT * FROM dim_customer WHERE is_current),
inc AS (SELECT customer_id AS k, updated_at AS ts, max(status) AS val FROM scd_incoming GROUP BY ALL),
steps AS (
SELECT i.k, i.ts, i.val, c.is_current IS NOT NULL AS known, coalesce(c.version_no, 1) AS base,
       row_number() OVER w = 1 AS leads, CASE WHEN row_number() OVER w = 1 THEN c.status ELSE lag(i.val) OVER w END AS before
FROM inc i LEFT JOIN cur c ON i.k IS NOT DISTINCT FROM c.customer_id WINDOW w AS (PARTITION BY i.k ORDER BY i.ts)),
opened AS (
SELECT k, ts, val, lead(ts) OVER w AS until, lead(ts) OVER w IS NULL AS is_last,
       CASE WHEN known THEN base ELSE 0 END + row_number() OVER w AS version_no, row_number() OVER w = 1 AS leads
FROM steps WHERE (leads AND NOT known) OR val IS DISTINCT FROM before WINDOW w AS (PARTITION BY k ORDER BY ts)),
scd_current AS (
SELECT c.customer_id, c.status, c.valid_from, CAST(coalesce(o.ts, c.valid_to) AS DATE) AS valid_to, o.ts IS NULL AS is_current, c.version_no
FROM cur c LEFT JOIN opened o ON c.customer_id IS NOT DISTINCT FROM o.k AND o.leads
UNION ALL
SELECT k, val, CAST(ts AS DATE), CAST(until AS DATE), is_last, CAST(version_no AS INTEGER) FROM opened),
scd_full AS (SELECT * FROM scd_current UNION ALL
             SELECT customer_id, status, valid_from, valid_to, is_current, version_no FROM dim_customer
             WHERE is_current IS DISTINCT FROM TRUE)
"""


#: All observations of the touched keys folded at once, whatever the batches' order.
LATE_CTES = cte("dim_customer", "scd_incoming", "scd_late") + """,
batch AS (SELECT * FROM scd_incoming UNION ALL SELECT * FROM scd_late),
touched AS (SELECT DISTINCT customer_id AS k FROM batch),
own AS (SELECT d.* FROM dim_customer d JOIN touched t ON d.customer_id IS NOT DISTINCT FROM t.k),
seen AS (
SELECT customer_id AS k, valid_from AS ts, TRUE AS is_open, status AS val FROM own
UNION ALL SELECT customer_id, valid_to, FALSE, NULL FROM own WHERE valid_to IS NOT NULL
UNION ALL SELECT customer_id, updated_at, TRUE, status FROM batch),
states AS (SELECT k, ts, bool_or(is_open) AS is_open, max(val) FILTER (WHERE is_open) AS val FROM seen GROUP BY k, ts),
steps AS (SELECT *, lag(is_open) OVER w AS was_open, lag(val) OVER w AS was FROM states WINDOW w AS (PARTITION BY k ORDER BY ts NULLS FIRST)),
changes AS (
SELECT k, ts, is_open, val, lead(ts) OVER w AS until, lead(is_open) OVER w IS NULL AS is_last,
       sum(CASE WHEN is_open THEN 1 ELSE 0 END) OVER (PARTITION BY k ORDER BY ts NULLS FIRST ROWS UNBOUNDED PRECEDING) AS nth
FROM steps WHERE (was_open IS NULL AND is_open) OR (was_open IS NOT NULL AND (is_open IS DISTINCT FROM was_open OR val IS DISTINCT FROM was))
WINDOW w AS (PARTITION BY k ORDER BY ts NULLS FIRST)),
firsts AS (SELECT customer_id AS k, min(coalesce(version_no, 1)) AS base FROM own GROUP BY customer_id),
late_history AS (
SELECT d.* FROM dim_customer d WHERE NOT EXISTS (SELECT 1 FROM touched t WHERE t.k IS NOT DISTINCT FROM d.customer_id)
UNION ALL
SELECT c.k, c.val, c.ts, c.until, c.is_last, CAST(coalesce(f.base, 1) + c.nth - 1 AS INTEGER)
FROM changes c LEFT JOIN firsts f ON c.k IS NOT DISTINCT FROM f.k WHERE c.is_open)
"""


def _interval_checks(dimension: str, source: str) -> list[str]:
    seen = (f"(SELECT *, max(coalesce(valid_to, DATE '9999-12-31')) OVER (PARTITION BY customer_id ORDER BY valid_from NULLS FIRST, valid_to NULLS LAST "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM {source})")
    over = "count(*) FILTER (WHERE reached IS NOT NULL AND (valid_from IS NULL OR reached > valid_from))"
    parts = [_check("intervals_do_not_overlap", "valid_from", over, seen),
             _check("intervals_leave_no_gap", "valid_from", "count(*) FILTER (WHERE reached < valid_from)", seen)]
    return [f"SELECT '{dimension}' AS dimension, * FROM ({p})" for p in parts]


def _check(name: str, column: str | None, violations: str, source: str | None = None) -> str:
    col = "CAST(NULL AS VARCHAR)" if column is None else f"'{column}'"
    frm = f" FROM {source}" if source else ""
    return (f"SELECT '{name}' AS check_name, {col} AS column_name, CAST({violations} AS BIGINT) AS violations, "
            f"CAST({violations} AS BIGINT) = 0 AS passed{frm}")


QUALITY_CTES = OPERATIONAL_CTES + ", cur AS (" + curated_sql("op", "needs_review") + ")\n"


def _quality_report() -> str:
    return QUALITY_CTES + "\nUNION ALL\n".join(_quality_parts())


def _quality_parts() -> list[str]:
    parts = [
        _check("not_empty", None, "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END", "raw_customer"),
        _check("record_count", None, "abs((SELECT count(*) FROM raw_customer) - (SELECT count(*) FROM op))"),
    ]
    for c in ("customer_id", "first_name", "last_name", "email", "status"):
        parts.append(_check("not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)", "raw_customer"))
    parts.append(_check("allowed_values", "status",
                        "count(*) FILTER (WHERE status NOT IN ('ACTIVE', 'INACTIVE', 'PENDING', 'NEW'))", "raw_customer"))
    parts.append(_check("parse_failures", "signup_date",
                        "count(*) FILTER (WHERE signup_date IS NOT NULL AND TRY_CAST(signup_date AS DATE) IS NULL)",
                        "raw_customer"))
    parts.append(_check("parse_failures", "amount",
                        "count(*) FILTER (WHERE amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL)",
                        "raw_customer"))
    parts.append(_check("duplicates", "customer_id",
                        "(SELECT count(*) FROM (SELECT customer_id FROM raw_customer GROUP BY customer_id HAVING count(*) > 1))"))
    for c, v in (("customer_id", 0), ("first_name", 0), ("last_name", 0), ("email", 0), ("status", 0), ("full_name", 1)):
        parts.append(_check("columns_present", c, str(v)))
    for c, v in (("customer_id", 0), ("status", 0), ("signup_date", 0), ("amount", 1), ("updated_at", 1), ("region", 0)):
        parts.append(_check("expected_type", c, str(v)))
    parts.append(_check("allowed_values", "status",
                        "count(*) FILTER (WHERE status NOT IN ('ACTIVE', 'INACTIVE', 'PENDING', 'NEW'))", "op"))
    parts.append(_check("active_status_is_active", "is_active",
                        "count(*) FILTER (WHERE status IN ('ACTIVE', 'PENDING', 'NEW') AND is_active = FALSE)", "op"))
    parts.append(_check("tier_not_null", "customer_tier", "count(*) FILTER (WHERE customer_tier IS NULL)", "op"))
    parts.append(_check("allowed_values", "customer_tier",
                        "count(*) FILTER (WHERE customer_tier NOT IN ('BRONZE', 'SILVER', 'GOLD') OR customer_tier IS NULL)",
                        "op"))
    parts.append(_check("allowed_values", "customer_tier",
                        "count(*) FILTER (WHERE customer_tier NOT IN ('BRONZE', 'SILVER', 'GOLD'))", "cur"))
    parts.append(_check("curated_total_matches", "total_amount",
                        "(SELECT count(*) FROM (SELECT customer_id, " + total_of("amount") + " AS t, TRUE AS e "
                        "FROM op GROUP BY customer_id) e FULL OUTER JOIN (SELECT *, TRUE AS c FROM cur) c "
                        "ON e.customer_id IS NOT DISTINCT FROM c.customer_id "
                        "WHERE e.e IS NULL OR c.c IS NULL OR e.t IS DISTINCT FROM c.total_amount)"))
    return parts


def _dq_run_report() -> str:
    """The quality report twice (batches B1, B2) with the run columns."""
    return (QUALITY_CTES + ", report AS (" + "\nUNION ALL\n".join(_quality_parts()) + ")\n"
            + "\nUNION ALL\n".join(
                f"SELECT *, 'raw' AS layer, '{b}' AS batch_id, TIMESTAMP '2024-02-01 00:00:00' AS run_ts FROM report"
                for b in ("B1", "B2")))


#: Rules of the checked layers as (check, column, violation).
RAW_RULES = (("not_null", "customer_id", "customer_id IS NULL"),
             ("parse_failures", "signup_date", "signup_date IS NOT NULL AND TRY_CAST(signup_date AS DATE) IS NULL"),
             ("parse_failures", "amount", "amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL"))
OPERATIONAL_RULES = (("allowed_values", "status", "coalesce(status, '') NOT IN ('ACTIVE', 'INACTIVE', 'PENDING', 'NEW')"),
                     ("valid_email", "email", "NOT coalesce(has_valid_email, FALSE)"),
                     ("active_status_is_active", "is_active", "coalesce(status IN ('ACTIVE', 'PENDING', 'NEW') AND NOT is_active, FALSE)"),
                     ("allowed_values", "customer_tier", "coalesce(customer_tier, '') NOT IN ('BRONZE', 'SILVER', 'GOLD')"))
CURATED_RULES = (("not_null", "customer_id", "customer_id IS NULL"),
                 ("allowed_values", "customer_tier", "coalesce(customer_tier, '') NOT IN ('BRONZE', 'SILVER', 'GOLD')"),
                 ("active_within_total", "active_record_count", "active_record_count > total_records"),
                 ("total_is_a_number", "total_amount", "coalesce(isnan(total_amount), FALSE)"))


def _breaks(rules) -> str:
    return " OR ".join(f"({violation})" for _, _, violation in rules)


#: Loader rules over the source rows that break no raw rule; the good operational rows; their curation.
CHECKED_CTES = (LOADER_CTES.replace("b10 AS (", f"source_good AS (SELECT * FROM raw_customer WHERE NOT ({_breaks(RAW_RULES)})),\nb10 AS (", 1)
                .replace("AS updated_at,\n       upper(trim(region)) AS region, upper(trim(source_system)) AS source_system\nFROM raw_customer)",
                         "AS updated_at,\n       upper(trim(region)) AS region, upper(trim(source_system)) AS source_system\nFROM source_good)")
                + f", good AS (SELECT * FROM lop WHERE NOT ({_breaks(OPERATIONAL_RULES)})),\nsums AS ({curated_sql('good', 'risk_flag = ' + chr(39) + 'HIGH' + chr(39))})\n")


def _checked_report() -> str:
    def report(layer, source, rules, expected=None):
        checks = [("not_empty", None, "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END")]
        if expected:
            checks.append(("record_count", None, f"abs(count(*) - (SELECT count(*) FROM {expected}))"))
        checks += [(name, column, f"count(*) FILTER (WHERE {violation})") for name, column, violation in rules]
        return [f"SELECT '{layer}' AS layer, * FROM ({_check(name, column, n, source)})" for name, column, n in checks]
    return CHECKED_CTES + "\nUNION ALL\n".join(report("raw", "raw_customer", RAW_RULES) + report("operational", "lop", OPERATIONAL_RULES, "b10")
                                              + report("curated", "sums", CURATED_RULES))


def _synthetic() -> str:
    """The synthetic generator restated in SQL: integer hash per (record, field)."""
    fields = range(1, 5)
    seed = 42
    s0 = ", ".join(f"((c_custkey % 2147483648) * 1103515245 + {f * 12345 + seed}) % 4294967296 AS g{f}" for f in fields)
    rnd = ", ".join(f"xor(g{f}, g{f} >> 16) * 73244475 % 4294967296 AS g{f}" for f in fields)
    fin = ", ".join(f"xor(g{f}, g{f} >> 16) AS g{f}" for f in fields)
    drawn = ("g1 AS h1, g1 // 29 AS h2, g1 // 783 AS h5, g2 AS h3, g2 // 29 AS h4, g2 // 783 AS h6, g2 // 3132 AS h11, g2 // 12528 AS h12, "
             "g3 AS h7, g3 // 2192 AS h9, g3 // 4804864 AS h10, g4 AS h8")

    def lst(values):
        return "[" + ", ".join("'" + v + "'" for v in values) + "]"

    def pick(values, h):
        return f"{lst(values)}[CAST({h} % {len(values)} AS INTEGER) + 1]"

    def cents(h, lo, hi):
        return f"CAST({lo * 100} + {h} % {(hi - lo) * 100 + 1} AS DOUBLE) / 100.0"

    any_day = "DATE '2020-01-01' + CAST(h9 % 2192 AS INTEGER)"
    signup = ("CASE WHEN scenario = 'normal' THEN DATE '2021-01-01' + CAST(h7 % 1826 AS INTEGER) "
              "ELSE DATE '2020-01-01' + CAST(h7 % 2192 AS INTEGER) END")
    status = (f"CASE WHEN scenario IN ('blank_identity', 'invalid_status') THEN {pick(SYNTH_INVALID_STATUSES, 'h6')} "
              f"ELSE {pick(SYNTH_VALID_STATUSES, 'h6')} END")
    return f"""WITH s0 AS (SELECT c_custkey AS n, {s0} FROM customer),
s1 AS (SELECT n, {rnd} FROM s0),
s2 AS (SELECT n, {rnd} FROM s1),
s3 AS (SELECT n, {drawn} FROM (SELECT n, {fin} FROM s2)),
s AS (SELECT *, CASE WHEN n % 7 = 0 THEN 'blank_identity' WHEN n % 11 = 0 THEN 'invalid_email'
                     WHEN n % 13 = 0 THEN 'missing_email' WHEN n % 19 = 0 THEN 'invalid_status' ELSE 'normal' END AS scenario
      FROM s3),
t AS (SELECT *, {signup} AS signup_date, {status} AS status_raw FROM s)
SELECT n AS record_no, scenario,
       CASE WHEN scenario = 'blank_identity' THEN NULL
            WHEN scenario = 'invalid_email' THEN printf('C%05d', n % 12000 + 1)
            WHEN scenario = 'invalid_status' THEN printf('C%05d', n % 8000 + 1)
            ELSE printf('C%05d', n) END AS customer_id,
       CASE WHEN scenario = 'blank_identity' THEN NULL ELSE {pick(SYNTH_FIRST_NAMES, 'h1')} END AS first_name,
       CASE WHEN scenario = 'blank_identity' THEN 'Guest' ELSE {pick(SYNTH_LAST_NAMES, 'h2')} END AS last_name,
       CASE WHEN scenario IN ('blank_identity', 'missing_email') THEN NULL
            WHEN scenario = 'invalid_email' THEN 'invalid-email'
            WHEN scenario = 'invalid_status' THEN lower({pick(SYNTH_FIRST_NAMES, 'h3')}) || '.' || lower({pick(SYNTH_LAST_NAMES, 'h4')}) || '@' || {pick(SYNTH_DOMAINS, 'h5')}
            ELSE lower({pick(SYNTH_FIRST_NAMES, 'h1')}) || '.' || lower({pick(SYNTH_LAST_NAMES, 'h2')}) || '@' || {pick(SYNTH_DOMAINS, 'h5')} END AS email,
       nullif(status_raw, '') AS status,
       signup_date,
       CASE scenario WHEN 'blank_identity' THEN {cents('h8', -1500, 800)} WHEN 'invalid_email' THEN {cents('h8', -500, 3500)}
                     WHEN 'missing_email' THEN {cents('h8', -150, 2000)} WHEN 'invalid_status' THEN {cents('h8', 0, 9000)}
                     ELSE {cents('h8', -120, 4200)} END AS amount,
       CAST(CASE scenario WHEN 'blank_identity' THEN {any_day} + CAST(h10 % 365 + 1 AS INTEGER)
                          WHEN 'invalid_email' THEN {any_day} + CAST(h10 % 220 + 1 AS INTEGER)
                          WHEN 'missing_email' THEN {any_day} + CAST(h10 % 300 + 1 AS INTEGER)
                          WHEN 'invalid_status' THEN {any_day} + CAST(h10 % 45 + 1 AS INTEGER)
                          ELSE signup_date + CAST(h10 % 180 + 1 AS INTEGER) END AS TIMESTAMP) AS updated_at,
       {pick(SYNTH_REGIONS, 'h11')} AS region,
       {pick(SYNTH_SOURCE_SYSTEMS, 'h12')} AS source_system
FROM t"""


ORACLES = {
    "customer_curated": OPERATIONAL_CTES + curated_sql("op", "needs_review"),
    "standardize_customer": cte("raw_customer") + B1,
    "null_remediation": cte("raw_customer") + """SELECT customer_id, coalesce(first_name, 'UNKNOWN') AS first_name,
       coalesce(last_name, 'UNKNOWN') AS last_name, coalesce(email, 'unknown@missing.com') AS email,
       coalesce(status, 'NEW') AS status, signup_date, amount, updated_at, region, source_system FROM raw_customer""",
    "audit_columns": cte("raw_customer") + f"""SELECT customer_id, first_name, last_name, email, status, signup_date,
       amount, updated_at, region, 'CRM' AS source_system, 'BATCH_2024_09' AS batch_id,
       TIMESTAMP '2002-01-01 00:00:00' AS ingested_at, {AS_OF} AS ingestion_date
       FROM raw_customer""",
    "date_dimensions": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS signup_year, strftime(o_orderdate, '%Y-%m') AS signup_month,
       'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS signup_quarter, strftime(o_orderdate, '%A') AS signup_day_of_week,
       CAST(weekofyear(o_orderdate) AS INTEGER) AS signup_week_of_year,
       coalesce(isodow(o_orderdate) IN (6, 7), FALSE) AS is_weekend FROM orders""",
    "customer_operational": OPERATIONAL_CTES + "SELECT * FROM op",
    "customer_operational_loader": LOADER_CTES + "SELECT * FROM lop",
    "load_markers": cte("raw_customer") + f"SELECT {RAW_COLS}, '2024-09-25' AS load_date, TRUE AS is_latest_load FROM raw_customer",
    "sales_orders": cte("orders_in") + """, g AS (
SELECT upper(trim(order_id)) AS order_id, upper(trim(customer_id)) AS customer_id, TRY_CAST(order_date AS DATE) AS order_date,
       upper(trim(order_status)) AS order_status,
       CASE WHEN gross_amount IS NULL THEN 0.0 ELSE abs(TRY_CAST(gross_amount AS DOUBLE)) END AS gross_amount,
       CASE WHEN discount_amount IS NULL THEN 0.0 ELSE abs(TRY_CAST(discount_amount AS DOUBLE)) END AS discount_amount
FROM orders_in), n AS (SELECT *, round(gross_amount - discount_amount, 2) AS raw_net FROM g)
SELECT order_id, customer_id, order_date, order_status, gross_amount, discount_amount,
       CASE WHEN raw_net < 0 THEN 0.0 ELSE raw_net END AS net_amount, strftime(order_date, '%Y-%m') AS order_month,
       CASE WHEN order_status IN ('DELIVERED', 'SHIPPED') THEN 'COMPLETED'
            WHEN order_status IN ('PENDING', 'PROCESSING') THEN 'PENDING' ELSE 'REVIEW' END AS status_flag,
       CASE WHEN (CASE WHEN raw_net < 0 THEN 0.0 ELSE raw_net END) >= 500 THEN 'HIGH'
            WHEN (CASE WHEN raw_net < 0 THEN 0.0 ELSE raw_net END) >= 100 THEN 'MEDIUM' ELSE 'LOW' END AS order_value_bucket
FROM n""",
    "enrich_lookup": cte("nation_lookup") + """, lk AS (
SELECT lookup_key, max(customer_segment) AS v FROM nation_lookup WHERE lookup_key IS NOT NULL GROUP BY lookup_key)
SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment, coalesce(lk.v, 'UNKNOWN') AS customer_segment
FROM customer c LEFT JOIN lk ON c.c_nationkey = lk.lookup_key""",
    "enrich_orders_segment": cte("segment_lookup") + """
SELECT o.o_orderkey, o.o_custkey, o.o_totalprice, coalesce(lk.c_mktsegment, 'UNKNOWN') AS c_mktsegment
FROM orders o LEFT JOIN segment_lookup lk ON o.o_custkey = lk.lookup_key""",
    "cdc_delta": cte("cdc_incoming") + """, cur AS (
SELECT customer_id, max(updated_at) AS cts FROM cdc_current WHERE customer_id IS NOT NULL GROUP BY customer_id)
SELECT i.customer_id, i.updated_at, i.status, i.amount, 'UPSERT' AS row_action
FROM cdc_incoming i LEFT JOIN cur ON i.customer_id = cur.customer_id
WHERE cur.cts IS NULL OR i.updated_at > cur.cts""",
    "scd2_full": SCD_CTES + "SELECT * FROM scd_full",
    "scd2_current": SCD_CTES + "SELECT * FROM scd_current",
    "scd2_late_rows": LATE_CTES + "SELECT * FROM late_history",
    "scd2_interval_checks": LATE_CTES.replace("WITH ", cte("dim_intervals").rstrip() + ",\n", 1) + "\nUNION ALL\n".join(
        _interval_checks("spoiled", "dim_intervals") + _interval_checks("late_rows", "late_history")),
    "key_reconciliation": cte("fact_orders", "dim_keys") + """
SELECT 'missing_in_target' AS side, s.customer_id FROM (SELECT DISTINCT customer_id FROM fact_orders) s
WHERE NOT EXISTS (SELECT 1 FROM dim_keys t WHERE t.customer_id = s.customer_id)
UNION ALL
SELECT 'unexpected_in_target' AS side, t.customer_id FROM (SELECT DISTINCT customer_id FROM dim_keys) t
WHERE NOT EXISTS (SELECT 1 FROM fact_orders s WHERE s.customer_id = t.customer_id)""",
    "orphan_facts": cte("fact_orders", "dim_keys") + """
SELECT f.customer_id, f.order_id, f.amount FROM fact_orders f
WHERE NOT EXISTS (SELECT 1 FROM dim_keys d WHERE d.customer_id = f.customer_id)""",
    "compare_by_key": cte("cdc_current") + """, a AS (SELECT user_id AS customer_id, max(ts) AS updated_at FROM events GROUP BY user_id)
SELECT coalesce(e.customer_id, a.customer_id) AS customer_id, e.updated_at AS expected_updated_at,
       a.updated_at AS actual_updated_at,
       CASE WHEN a.customer_id IS NULL THEN 'missing_in_actual' WHEN e.customer_id IS NULL THEN 'missing_in_expected'
            ELSE 'value_mismatch' END AS issue
FROM cdc_current e FULL OUTER JOIN a ON e.customer_id = a.customer_id
WHERE a.customer_id IS NULL OR e.customer_id IS NULL OR e.updated_at IS DISTINCT FROM a.updated_at""",
    "bucket_reconciliation": cte("orders_copy") + """
SELECT coalesce(e.o_orderkey, a.o_orderkey) AS o_orderkey, e.o_totalprice AS expected_o_totalprice, a.o_totalprice AS actual_o_totalprice,
       e.o_orderstatus AS expected_o_orderstatus, a.o_orderstatus AS actual_o_orderstatus,
       CASE WHEN a.o_orderkey IS NULL THEN 'missing_in_actual' WHEN e.o_orderkey IS NULL THEN 'missing_in_expected' ELSE 'value_mismatch' END AS issue
FROM orders e FULL OUTER JOIN orders_copy a ON e.o_orderkey = a.o_orderkey
WHERE a.o_orderkey IS NULL OR e.o_orderkey IS NULL OR e.o_totalprice IS DISTINCT FROM a.o_totalprice OR e.o_orderstatus IS DISTINCT FROM a.o_orderstatus""",
    "curated_metrics": cte("event_amounts") + curated_sql("event_amounts", "needs_review"),
    "curated_metrics_loader": LOADER_CTES + curated_sql("lop", "risk_flag = 'HIGH'"),
    "curated_incremental": cte("event_rows") + curated_sql("event_rows", "needs_review"),
    "dedup_latest": """SELECT event_id, ts, user_id, event_type, value, props FROM (
SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST,
       event_type DESC NULLS LAST, value DESC NULLS LAST, props DESC NULLS LAST) AS rn FROM events) WHERE rn = 1""",
    "dedup_any_survivor": cte("repeated_users") + "SELECT DISTINCT user_id, account, name FROM repeated_users",
    "duplicate_keys": """SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "quality_report": _quality_report(),
    "dq_run_report": _dq_run_report(),
    "reconciliation_checks": cte("fact_orders", "dim_keys") + "\n" + "\nUNION ALL\n".join([
        _check("keys_missing_in_target", "customer_id",
               "(SELECT count(*) FROM (SELECT DISTINCT customer_id FROM fact_orders) s "
               "WHERE NOT EXISTS (SELECT 1 FROM dim_keys t WHERE t.customer_id = s.customer_id))"),
        _check("keys_unexpected_in_target", "customer_id",
               "(SELECT count(*) FROM (SELECT DISTINCT customer_id FROM dim_keys) t "
               "WHERE NOT EXISTS (SELECT 1 FROM fact_orders s WHERE s.customer_id = t.customer_id))"),
        _check("orphan_facts", "customer_id",
               "(SELECT count(*) FROM fact_orders f WHERE NOT EXISTS "
               "(SELECT 1 FROM dim_keys d WHERE d.customer_id = f.customer_id))"),
    ]),
    "scd2_invariants": SCD_CTES + "\n" + "\nUNION ALL\n".join([
        _check("one_current_row_per_key", "customer_id",
               "(SELECT count(*) FROM (SELECT customer_id FROM scd_full GROUP BY customer_id "
               "HAVING count(*) FILTER (WHERE is_current IS NOT DISTINCT FROM TRUE) <> 1))"),
        _check("unique_version_per_key", "version_no",
               "(SELECT count(*) FROM (SELECT customer_id, version_no FROM scd_full GROUP BY customer_id, version_no "
               "HAVING count(*) > 1))"),
        _check("closed_row_has_successor", "version_no",
               "(SELECT count(*) FROM (SELECT customer_id FROM scd_full GROUP BY customer_id "
               "HAVING bool_or(is_current IS DISTINCT FROM TRUE) AND (count(*) < 2 OR max(coalesce(version_no, 1)) < 2)))"),
        _check("interval_not_backwards", "valid_to", "(SELECT count(*) FROM scd_full WHERE valid_to < valid_from)"),
    ]),
    "csv_round_trip": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "txt_round_trip": "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "csv_quarantine": cte("customer_lines") + """, judged AS (
SELECT *, 5 - CASE WHEN c_custkey % 13 = 0 THEN 1 ELSE 0 END + CASE WHEN c_custkey % 17 = 0 THEN 1 ELSE 0 END AS n FROM customer_lines)
SELECT CASE WHEN n = 5 AND c_custkey % 19 <> 0 THEN CAST(c_custkey AS VARCHAR) ELSE line END AS record,
       CASE WHEN n < 5 THEN 'too few fields: ' || n WHEN n > 5 THEN 'too many fields: ' || n WHEN c_custkey % 19 = 0 THEN 'not a double: c_acctbal' ELSE 'good' END AS reason
FROM judged""",
    "multiline_csv_round_trip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "sql_source": """SELECT c_mktsegment, count(*) AS customers, min(c_acctbal) AS min_balance, max(c_acctbal) AS max_balance
FROM customer WHERE c_acctbal >= 0.0 GROUP BY c_mktsegment""",
    "table_source": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "synthetic_customers": _synthetic(),
    "medallion_raw": LOADER_CTES + "SELECT * FROM b10",
    "medallion_operational": LOADER_CTES + "SELECT * FROM lop",
    "medallion_checked": CHECKED_CTES + f"SELECT * FROM sums WHERE NOT ({_breaks(CURATED_RULES)})",
    "medallion_checked_quarantine": CHECKED_CTES + "SELECT *, concat_ws(',', " + ", ".join(
        f"CASE WHEN {violation} THEN '{name}({column})' END" for name, column, violation in OPERATIONAL_RULES)
        + f") AS failed_rules FROM lop WHERE {_breaks(OPERATIONAL_RULES)}",
    "medallion_checked_report": _checked_report(),
    "layer_copy_into": LOADER_CTES + "SELECT * FROM b10",
    "recompute_checks": "\nUNION ALL\n".join([
        _check("stored_columns_agree", "full_name,status,amount", "0", "(SELECT 1)"),
        _check("spoiled_columns_agree", "full_name,status,amount",
               "count(*) FILTER (WHERE c_custkey % 9 = 0 OR c_custkey % 11 = 0 AND c_custkey % 53 <> 0)", "customer")]),
    "medallion_load": LOADER_CTES + curated_sql("lop", "risk_flag = 'HIGH'"),
    "copy_into_once": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "incremental_file_load": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
}
