"""Curated customer KPIs (E1 framework variant, E2 loader variant).

One ``groupBy(customer_id).agg(...)``: a partial hash aggregate before the
shuffle and a final one after it, so even a key that holds a third of all
rows (the NULL id of dirty sources) reaches the reducers as one partial row
per map task.  Money is summed as decimals (see
:func:`strata.functions.columns.money_sum`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import CURATED_CUSTOMER_SCHEMA, Thresholds
from strata.functions.columns import any_true, count_true, money_avg, money_sum, tier_of


def build_curated_customer_metrics(operational_df: DataFrame, thresholds: Thresholds | None = None,
                                   review_rule: str = "needs_review", key: str = "customer_id") -> DataFrame:
    """KPIs per customer; ``review_rule`` is ``needs_review`` (E1) or ``high_risk`` (E2)."""
    th = thresholds or Thresholds()
    if review_rule == "needs_review":
        review = F.col("needs_review")
    elif review_rule == "high_risk":
        review = F.col("risk_flag") == "HIGH"
    else:
        raise ValueError(f"unknown review_rule {review_rule!r}")
    metrics = operational_df.groupBy(key).agg(
        money_sum("amount").alias("total_amount"),
        money_avg("amount").alias("avg_amount"),
        F.max("signup_date").alias("latest_signup_date"),
        F.min("signup_date").alias("first_signup_date"),
        F.count(key).alias("total_records"),
        count_true(F.col("is_active")).alias("active_record_count"),
        count_true(F.col("is_high_value")).alias("high_value_record_count"),
        any_true(review).alias("review_flag"),
    )
    metrics = metrics.withColumn("customer_tier", tier_of("total_amount", th))
    return metrics.select(F.col(key), *[F.col(f.name).cast(f.dataType).alias(f.name)
                                        for f in CURATED_CUSTOMER_SCHEMA if f.name != "customer_id"])


def create_curated_df(operational_df: DataFrame, thresholds: Thresholds | None = None) -> DataFrame:
    """Loader variant (E2): review flag = any HIGH risk record."""
    return build_curated_customer_metrics(operational_df, thresholds, review_rule="high_risk")
