"""Sales-order normalization (B9): one projection, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import COMPLETED_ORDER_STATUSES, PENDING_ORDER_STATUSES, Thresholds
from strata.functions.columns import as_date, as_double, clean_upper, month_of


def build_sales_order_transformations(order_df: DataFrame, thresholds: Thresholds | None = None) -> DataFrame:
    th = thresholds or Thresholds()

    def zero_if_null_abs(c: str):
        return F.when(F.col(c).isNull(), F.lit(0.0)).otherwise(F.abs(as_double(c)))

    df = order_df.withColumns({
        "order_id": clean_upper("order_id"),
        "customer_id": clean_upper("customer_id"),
        "order_date": as_date("order_date"),
        "order_status": clean_upper("order_status"),
        "gross_amount": zero_if_null_abs("gross_amount"),
        "discount_amount": zero_if_null_abs("discount_amount"),
    })
    net = F.round(F.col("gross_amount") - F.col("discount_amount"), 2)
    # floor at zero with a CASE, not greatest(): a NULL net must stay NULL
    df = df.withColumn("net_amount", F.when(net < 0, F.lit(0.0)).otherwise(net))
    st = F.col("order_status")
    return df.withColumns({
        "order_month": month_of("order_date"),
        "status_flag": (F.when(st.isin(*COMPLETED_ORDER_STATUSES), F.lit("COMPLETED"))
                        .when(st.isin(*PENDING_ORDER_STATUSES), F.lit("PENDING"))
                        .otherwise(F.lit("REVIEW"))),
        "order_value_bucket": (F.when(F.col("net_amount") >= th.high_order_value, F.lit("HIGH"))
                               .when(F.col("net_amount") >= th.medium_order_value, F.lit("MEDIUM"))
                               .otherwise(F.lit("LOW"))),
    })
