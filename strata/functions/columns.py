"""Column-expression building blocks shared by the operators.

All of them are built-in Spark expressions (no UDF), so any projection that
uses them stays inside whole-stage code generation. Casts are the ``try_``
variants: Spark runs with ANSI mode on, where a malformed number or date
would otherwise fail the whole job instead of yielding NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.config import (
    EMAIL_PATTERN,
    MONTH_FORMAT,
    WEEKDAY_FORMAT,
    WHITESPACE_RUN,
    Thresholds,
)

__all__ = [
    "col_of", "clean_upper", "clean_lower", "collapse_spaces", "as_date", "as_double",
    "as_timestamp", "abs_money", "month_of", "weekday_of", "email_domain", "is_valid_email",
    "tier_of", "risk_of", "segment_by_amount", "segment_by_activity", "flag",
    "money_sum", "money_avg", "count_true", "any_true", "null_safe_differs",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_upper(c) -> Column:
    return F.upper(F.trim(col_of(c)))


def clean_lower(c) -> Column:
    return F.lower(F.trim(col_of(c)))


def collapse_spaces(c) -> Column:
    """Collapse every whitespace run to one blank, then trim."""
    return F.trim(F.regexp_replace(col_of(c), WHITESPACE_RUN, " "))


def as_date(c) -> Column:
    """Date from a date, timestamp or ISO text; NULL when unparseable."""
    return col_of(c).try_cast("date")


#: Text timestamps that name a zone or an offset after the time of day.
_ZONED = r":\d{2}(\.\d+)?\s*(Z|UTC|[+-]\d{1,2}(:?\d{2})?)$"


def as_timestamp(c) -> Column:
    """Wall-clock timestamp from text, date or timestamp; NULL when unparseable.

    Text with an offset (``+02:00``, ``Z``) is an instant: its UTC wall clock counts, so that rows with different
    offsets order as they happened.  Text without one is taken as it is.
    """
    plain = col_of(c).try_cast("timestamp_ntz")
    text = F.trim(col_of(c).cast("string"))
    instant = F.to_utc_timestamp(text.try_cast("timestamp"), F.current_timezone()).cast("timestamp_ntz")
    return F.when(text.rlike(_ZONED), instant).otherwise(plain)


def as_double(c) -> Column:
    return col_of(c).try_cast("double")


def abs_money(c) -> Column:
    """round(abs(x), 2) over a safely cast double; NULL stays NULL."""
    return F.round(F.abs(as_double(c)), 2)


def month_of(c) -> Column:
    return F.date_format(col_of(c), MONTH_FORMAT)


def weekday_of(c) -> Column:
    return F.date_format(col_of(c), WEEKDAY_FORMAT)


def email_domain(email, mode: str = "second_part") -> Column:
    """Domain part of an e-mail.

    ``second_part``: text between the first and second ``@``; NULL without
    ``@``.  ``after_first_at``: everything after the first ``@``; ``''``
    without a match.
    """
    e = col_of(email)
    if mode == "second_part":
        return F.get(F.split(e, "@"), 1)
    if mode == "after_first_at":
        return F.regexp_extract(e, "@(.+)$", 1)
    raise ValueError(f"unknown email_domain mode {mode!r}")


def is_valid_email(email) -> Column:
    return col_of(email).rlike(EMAIL_PATTERN)


def tier_of(amount, th: Thresholds) -> Column:
    a = col_of(amount)
    return (F.when(a >= th.gold, F.lit("GOLD"))
            .when(a >= th.silver, F.lit("SILVER"))
            .otherwise(F.lit("BRONZE")))


def risk_of(amount, status, th: Thresholds, use_status: bool) -> Column:
    a = col_of(amount)
    s = col_of(status)
    high = a >= th.high_risk_amount
    medium = a >= th.medium_risk_amount
    if use_status:
        high = high | (s == "INACTIVE")
        medium = medium | (s == "PENDING")
    return F.when(high, F.lit("HIGH")).when(medium, F.lit("MEDIUM")).otherwise(F.lit("LOW"))


def segment_by_amount(amount, th: Thresholds) -> Column:
    a = col_of(amount)
    return (F.when(a >= th.vip_amount, F.lit("VIP"))
            .when(a >= th.loyal_amount, F.lit("LOYAL"))
            .when(a >= th.regular_amount, F.lit("REGULAR"))
            .otherwise(F.lit("NEW")))


def segment_by_activity(is_high_value, is_active, amount, th: Thresholds) -> Column:
    hv, act, a = col_of(is_high_value), col_of(is_active), col_of(amount)
    return (F.when(hv & act, F.lit("VIP"))
            .when(act, F.lit("LOYAL"))
            .when(a >= th.regular_amount, F.lit("REGULAR"))
            .otherwise(F.lit("NEW")))


def flag(cond: Column) -> Column:
    """Two-valued boolean: true when ``cond`` is true, false otherwise (incl. NULL)."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def money_sum(c) -> Column:
    """Sum of amounts as they are, as a double; NULL without any amount.

    Amounts that ten decimals write exactly are summed as decimals, so their total does not depend on partitioning
    or task order.  The rest (finer, huge, infinite or NaN) is summed as doubles and added: NaN and infinities
    carry through as they do in a double sum, and none fails the job.
    """
    x = as_double(c)
    decimal = F.when(F.abs(x) < 1e15, x).try_cast("decimal(38,10)")
    exact = decimal.cast("double") == x
    finer = F.sum(F.when(~F.coalesce(exact, F.lit(False)), x))
    total = F.try_sum(F.when(exact, decimal)).cast("double")
    return F.when(finer.isNull(), total).otherwise(F.coalesce(total, F.lit(0.0)) + finer)


def money_avg(c) -> Column:
    """:func:`money_sum` by the number of amounts; NULL without any."""
    return F.try_divide(money_sum(c), F.count(as_double(c)).cast("double"))


def count_true(cond: Column) -> Column:
    """Number of rows where ``cond`` is true (NULL counts as not true)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("long")


def any_true(cond: Column) -> Column:
    """1 if ``cond`` is true on any row of the group, else 0."""
    return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def null_safe_differs(a, b) -> Column:
    return ~col_of(a).eqNullSafe(col_of(b))
