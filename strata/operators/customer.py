"""Customer cleaning and enrichment (raw -> operational layer).

Two rule sets exist: the framework rules (B1-B7) and the table-loader rules
(B10-B11); they differ on several columns (see ``strata.config.RuleSet``).
Every operator is a projection: Catalyst collapses the stacked
``withColumns`` levels into one Project inside one code-generated stage,
and nothing here shuffles.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.config import (
    ACTIVE_STATUSES,
    DEFAULT_CONFIG,
    DEFAULT_FILLS,
    FRAMEWORK_RULES,
    LOADER_RULES,
    OPERATIONAL_CUSTOMER_SCHEMA,
    PipelineConfig,
    RuleSet,
    Thresholds,
)
from strata.functions.columns import (
    abs_money,
    as_date,
    as_double,
    as_timestamp,
    clean_lower,
    clean_upper,
    collapse_spaces,
    email_domain,
    flag,
    is_valid_email,
    month_of,
    risk_of,
    segment_by_activity,
    segment_by_amount,
    tier_of,
    weekday_of,
)


def today(as_of=None) -> Column:
    """The evaluation date: a fixed ``as_of`` (date or ISO text) or current_date()."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


def now(as_of=None) -> Column:
    """The evaluation instant as a wall-clock ``timestamp_ntz`` (like every layer timestamp)."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat()
    return F.lit(str(as_of)).cast("timestamp_ntz")


def _present(df: DataFrame, mapping: dict) -> dict:
    return {k: v for k, v in mapping.items() if k in df.columns}


# -- B1 ---------------------------------------------------------------------
def _id(rules: RuleSet) -> Column:
    return clean_upper("customer_id") if rules.upper_id else F.trim(F.col("customer_id").cast("string"))


def _name(column: str, rules: RuleSet) -> Column:
    return collapse_spaces(column) if rules.collapse_name_spaces else F.trim(F.col(column))


def _full_name(rules: RuleSet) -> Column:
    name = F.trim(F.concat_ws(" ", F.col("first_name"), F.col("last_name")))
    return F.lower(name) if rules.lower_full_name else name


def standardize_customer_columns(df: DataFrame, rules: RuleSet = FRAMEWORK_RULES) -> DataFrame:
    """Id and names by the rule set (framework: id upper-cased, name whitespace collapsed); e-mail lower(trim); status upper(trim)."""
    return df.withColumns(_present(df, {
        "customer_id": _id(rules),
        "first_name": _name("first_name", rules),
        "last_name": _name("last_name", rules),
        "email": clean_lower("email"),
        "status": clean_upper("status"),
    }))


# -- B2 ---------------------------------------------------------------------
def apply_null_remediation(df: DataFrame, fill_map: dict | None = None) -> DataFrame:
    """Replace NULL by a per-column default, only for columns that exist."""
    fill_map = fill_map or DEFAULT_FILLS
    return df.withColumns({
        c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill_map.items() if c in df.columns
    })


# -- B3 ---------------------------------------------------------------------
def add_audit_columns(df: DataFrame, batch_id: str = "batch_001", source_system: str = "unknown",
                      as_of=None) -> DataFrame:
    """batch_id, source_system (overwrites an existing one), ingested_at, ingestion_date."""
    return df.withColumns({
        "batch_id": F.lit(batch_id),
        "source_system": F.lit(source_system),
        "ingested_at": now(as_of),
        "ingestion_date": today(as_of),
    })


# -- B4 ---------------------------------------------------------------------
def add_date_dimensions(df: DataFrame, date_col: str = "signup_date", prefix: str = "signup") -> DataFrame:
    """Calendar fields of ``date_col``; a no-op when the column is absent."""
    if date_col not in df.columns:
        return df
    d = F.col(date_col)
    return (df.withColumn(date_col, as_date(date_col))
              .withColumns({
                  f"{prefix}_year": F.year(d),
                  f"{prefix}_month": month_of(d),
                  f"{prefix}_quarter": F.concat(F.lit("Q"), F.quarter(d)),
                  f"{prefix}_day_of_week": weekday_of(d),
                  f"{prefix}_week_of_year": F.weekofyear(d),
                  "is_weekend": flag(F.dayofweek(d).isin(1, 7)),
              }))


# -- B5 ---------------------------------------------------------------------
def apply_customer_transformations(raw_df: DataFrame, as_of=None, thresholds: Thresholds | None = None,
                                   rules: RuleSet = FRAMEWORK_RULES) -> DataFrame:
    """Core cleaning and enrichment: 17 column rules in three projection levels."""
    th = thresholds or Thresholds()
    df = standardize_customer_columns(raw_df, rules)
    amount = F.col("amount")
    if rules.null_amount_as_zero:
        clean_amount = F.when(amount.isNull(), F.lit(0.0)).otherwise(abs_money(amount))
    else:
        clean_amount = abs_money(amount)
    status_ok = F.col("status").isin(*ACTIVE_STATUSES)
    df = df.withColumns({
        "full_name": _full_name(rules),
        "signup_date": as_date("signup_date"),
        "amount": clean_amount,
        "is_active": flag(status_ok) if rules.null_status_inactive else status_ok,
        "email_domain": email_domain("email", rules.email_domain_mode),
        "has_valid_email": is_valid_email("email"),
    })
    sd = F.col("signup_date")
    return df.withColumns({
        "signup_month": month_of(sd),
        "customer_age_days": F.when(sd.isNotNull(), F.datediff(today(as_of), sd)),
        "customer_tier": tier_of("amount", th),
        "risk_flag": risk_of("amount", "status", th, rules.risk_uses_status),
        "customer_segment": (segment_by_activity(F.col("amount") >= th.high_value_amount, "is_active", "amount", th)
                             if rules.segment_by_activity else segment_by_amount("amount", th)),
        "is_high_value": F.col("amount") >= th.high_value_amount,
    })


# -- B6 ---------------------------------------------------------------------
def add_business_flags(df: DataFrame, as_of=None, thresholds: Thresholds | None = None,
                       rules: RuleSet = FRAMEWORK_RULES) -> DataFrame:
    """has_valid_email, is_recent_signup, is_high_value, needs_review (by e-mail and status, or by high risk)."""
    th = thresholds or Thresholds()
    valid = is_valid_email("email")
    # NULL validity is not a reason for review: (NULL OR false) -> otherwise(false)
    review = (F.col("risk_flag") == "HIGH") if rules.review_on == "high_risk" else (valid == F.lit(False)) | (F.col("status") == "PENDING")
    return df.withColumns({
        "has_valid_email": valid,
        "is_recent_signup": flag(as_date("signup_date") >= F.date_sub(today(as_of), th.recent_signup_days)),
        "is_high_value": as_double("amount") >= th.high_value_amount,
        "needs_review": flag(review),
    })


# -- B7 ---------------------------------------------------------------------
def apply_advanced_customer_transformations(raw_df: DataFrame, as_of=None,
                                            config: PipelineConfig | None = None) -> DataFrame:
    """Full operational pipeline: B1 -> B2 -> B3 -> B4 -> B5 -> B6."""
    cfg = config or DEFAULT_CONFIG
    return (raw_df
            .transform(standardize_customer_columns, cfg.rules)
            .transform(apply_null_remediation, cfg.fills)
            .transform(add_audit_columns, cfg.batch_id, cfg.source_system, as_of)
            .transform(add_date_dimensions, "signup_date")
            .transform(apply_customer_transformations, as_of, cfg.thresholds, cfg.rules)
            .transform(add_business_flags, as_of, cfg.thresholds, cfg.rules))


# -- B10 --------------------------------------------------------------------
def standardize_raw_df(raw_df: DataFrame) -> DataFrame:
    """Loader standardization of the raw layer (NULL amount kept)."""
    return raw_df.withColumns(_present(raw_df, {
        "customer_id": F.trim(F.col("customer_id").cast("string")),
        "first_name": F.trim(F.col("first_name")),
        "last_name": F.trim(F.col("last_name")),
        "email": clean_lower("email"),
        "status": clean_upper("status"),
        "signup_date": as_date("signup_date"),
        "amount": abs_money("amount"),
        "updated_at": as_timestamp("updated_at"),
        "region": clean_upper("region"),
        "source_system": clean_upper("source_system"),
    }))


# -- B11 --------------------------------------------------------------------
def create_operational_df(raw_df: DataFrame, as_of=None, thresholds: Thresholds | None = None,
                          rules: RuleSet = LOADER_RULES) -> DataFrame:
    """Loader operational projection: 16 columns of the operational layer schema.

    The e-mail validity uses the single-backslash pattern (the loader's
    doubled backslash never matches a normal address).
    """
    th = thresholds or Thresholds()
    status = clean_upper("status")
    amount = abs_money("amount")
    df = raw_df.withColumns({
        "customer_id": _id(rules),
        "full_name": _full_name(rules),
        "email_domain": email_domain("email", rules.email_domain_mode),
        "has_valid_email": is_valid_email("email"),
        "status": status,
        "amount": amount,
        "updated_at": as_timestamp("updated_at"),
    })
    status_ok = F.col("status").isin(*ACTIVE_STATUSES)
    signup = as_date("signup_date")   # safe even when called on raw text dates
    df = df.withColumns({
        "is_active": flag(status_ok) if rules.null_status_inactive else status_ok,
        "is_high_value": F.col("amount") >= th.high_value_amount,
        "signup_month": month_of(signup),
        "customer_age_days": F.datediff(today(as_of), signup),
    })
    df = df.withColumns({
        "customer_tier": tier_of("amount", th),
        "risk_flag": risk_of("amount", "status", th, rules.risk_uses_status),
        "customer_segment": (segment_by_activity("is_high_value", "is_active", "amount", th)
                             if rules.segment_by_activity else segment_by_amount("amount", th)),
    })
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in OPERATIONAL_CUSTOMER_SCHEMA])
