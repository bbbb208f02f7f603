"""Declarative pipeline configuration, layer schemas and fixed values.

The operators read their thresholds, keys and allowed values from these
dataclasses, so a pipeline is re-targeted by passing a different config
instead of editing code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must stay exactly as written for results to match the
# documented business rules (status domains, default fills, e-mail pattern,
# calendar formats, synthetic-data pools).
# ---------------------------------------------------------------------------
ALLOWED_STATUSES = ("ACTIVE", "INACTIVE", "PENDING", "NEW")
ACTIVE_STATUSES = ("ACTIVE", "PENDING", "NEW")
CUSTOMER_TIERS = ("BRONZE", "SILVER", "GOLD")
MANDATORY_COLUMNS = ("customer_id", "first_name", "last_name", "email", "status")
PRIMARY_KEY = ("customer_id",)
DEFAULT_FILLS = {
    "first_name": "UNKNOWN",
    "last_name": "UNKNOWN",
    "email": "unknown@missing.com",
    "status": "NEW",
}
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
WHITESPACE_RUN = r"\s+"
MONTH_FORMAT = "yyyy-MM"
WEEKDAY_FORMAT = "EEEE"
COMPLETED_ORDER_STATUSES = ("DELIVERED", "SHIPPED")
PENDING_ORDER_STATUSES = ("PENDING", "PROCESSING")
UNKNOWN = "UNKNOWN"
UPSERT = "UPSERT"

# Synthetic source pools (fixed values).
SYNTH_VALID_STATUSES = ("ACTIVE", "INACTIVE", "PENDING", "NEW")
SYNTH_INVALID_STATUSES = ("BLOCKED", "SUSPENDED", "", "UNKNOWN")
SYNTH_FIRST_NAMES = (
    "John", "Mary", "Alex", "Priya", "Daniel", "Olivia", "Noah", "Emma", "Liam", "Sophia",
    "Michael", "Isabella", "Ethan", "Charlotte", "Mason", "Ava", "Lucas", "Mia", "Benjamin",
    "Harper", "Jacob", "Ella", "James", "Amelia", "Henry", "Grace", "Leo", "Chloe", "Jack",
)
SYNTH_LAST_NAMES = (
    "Smith", "Jones", "Brown", "Johnson", "Williams", "Davis", "Miller", "Wilson", "Moore",
    "Taylor", "Anderson", "Thomas", "Jackson", "White", "Harris", "Martin", "Thompson", "Garcia",
    "Martinez", "Robinson", "Clark", "Rodriguez", "Lewis", "Lee", "Walker", "Hall", "Allen",
)
SYNTH_DOMAINS = ("company.com", "example.org", "delta.io", "northwind.ai", "retailgroup.net")
SYNTH_REGIONS = ("NORTH", "SOUTH", "EAST", "WEST")
SYNTH_SOURCE_SYSTEMS = ("CRM", "ERP", "WEB", "POS")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Thresholds:
    """Amount thresholds of the tier / risk / segment / value rules."""

    gold: float = 500.0
    silver: float = 200.0
    high_risk_amount: float = 1000.0
    medium_risk_amount: float = 500.0
    vip_amount: float = 1000.0
    loyal_amount: float = 500.0
    regular_amount: float = 100.0
    high_value_amount: float = 500.0
    high_order_value: float = 500.0
    medium_order_value: float = 100.0
    recent_signup_days: int = 30


@dataclass(frozen=True)
class RuleSet:
    """One coherent set of customer business rules.

    Two sets exist because the documented framework rules and the table
    loader rules disagree on several columns; both are supported and named.
    """

    name: str
    upper_id: bool                 # customer_id upper-cased (framework) or kept
    collapse_name_spaces: bool     # names: collapse whitespace runs to one blank
    lower_full_name: bool          # full_name lower-cased (loader)
    null_amount_as_zero: bool      # NULL amount -> 0.0 (framework) or kept NULL
    null_status_inactive: bool     # NULL status -> is_active false (framework) or NULL
    email_domain_mode: str         # "second_part" (framework) or "after_first_at"
    risk_uses_status: bool         # risk also by INACTIVE / PENDING status
    segment_by_activity: bool      # segment from activity+value (loader) or amount
    review_on: str                 # "needs_review" (framework) or "high_risk" (loader)


FRAMEWORK_RULES = RuleSet(
    name="framework",
    upper_id=True,
    collapse_name_spaces=True,
    lower_full_name=False,
    null_amount_as_zero=True,
    null_status_inactive=True,
    email_domain_mode="second_part",
    risk_uses_status=True,
    segment_by_activity=False,
    review_on="needs_review",
)

LOADER_RULES = RuleSet(
    name="loader",
    upper_id=False,
    collapse_name_spaces=False,
    lower_full_name=True,
    null_amount_as_zero=False,
    null_status_inactive=False,
    email_domain_mode="after_first_at",
    risk_uses_status=False,
    segment_by_activity=True,
    review_on="high_risk",
)


# Layer schemas: one StructType per layer drives both DDL and the final
# projection of each writer, so table and writer cannot drift apart.
RAW_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("updated_at", T.TimestampNTZType()),
    T.StructField("region", T.StringType()),
    T.StructField("source_system", T.StringType()),
])

OPERATIONAL_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("full_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("email_domain", T.StringType()),
    T.StructField("has_valid_email", T.BooleanType()),
    T.StructField("status", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("customer_tier", T.StringType()),
    T.StructField("risk_flag", T.StringType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("is_high_value", T.BooleanType()),
    T.StructField("signup_month", T.StringType()),
    T.StructField("customer_age_days", T.IntegerType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

CURATED_CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("avg_amount", T.DoubleType()),
    T.StructField("latest_signup_date", T.DateType()),
    T.StructField("first_signup_date", T.DateType()),
    T.StructField("total_records", T.LongType()),
    T.StructField("active_record_count", T.LongType()),
    T.StructField("high_value_record_count", T.LongType()),
    T.StructField("customer_tier", T.StringType()),
    T.StructField("review_flag", T.IntegerType()),
])

SCD2_DIM_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("valid_from", T.StringType()),
    T.StructField("valid_to", T.StringType()),
    T.StructField("is_current", T.BooleanType()),
    T.StructField("version_no", T.LongType()),
])

ORDER_SCHEMA = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_date", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("gross_amount", T.DoubleType()),
    T.StructField("discount_amount", T.DoubleType()),
])


@dataclass(frozen=True)
class LayerTables:
    raw: str = "bronze.raw_customer_data"
    operational: str = "silver.operational_customer_data"
    curated: str = "gold.curated_customer_metrics"


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a customer pipeline run needs besides the data."""

    fills: dict = field(default_factory=lambda: dict(DEFAULT_FILLS))
    thresholds: Thresholds = field(default_factory=Thresholds)
    rules: RuleSet = FRAMEWORK_RULES
    batch_id: str = "BATCH_001"
    source_system: str = "CRM"


DEFAULT_CONFIG = PipelineConfig()
