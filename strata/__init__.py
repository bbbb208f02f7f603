"""strata: layered (raw / operational / curated) customer pipelines and
data-quality checks written as plain Spark DataFrame operators.

Every operator takes and returns a DataFrame (or a small check-result
DataFrame), is built only from built-in Spark expressions, and never
collects data to the driver.  The classic operator names are importable
from the package root.
"""

from strata.config import FRAMEWORK_RULES, LOADER_RULES, PipelineConfig, RuleSet
from strata.operators.curated import build_curated_customer_metrics, create_curated_df
from strata.operators.customer import (
    add_audit_columns,
    add_business_flags,
    add_date_dimensions,
    apply_advanced_customer_transformations,
    apply_customer_transformations,
    apply_null_remediation,
    create_operational_df,
    standardize_customer_columns,
    standardize_raw_df,
)
from strata.operators.enrich import enrich_with_reference_data
from strata.operators.incremental import (
    create_cdc_incremental_load,
    create_incremental_load_markers,
    deduplicate_customer_records,
)
from strata.operators.orders import build_sales_order_transformations
from strata.operators.quality import DataValidator
from strata.operators.reconcile import Reconciliation, compare_by_key, reconcile_fact_dimension
from strata.operators.scd import apply_scd_type_2
from strata.sources.readers import DataReader

__all__ = [
    "PipelineConfig", "RuleSet", "FRAMEWORK_RULES", "LOADER_RULES",
    "add_audit_columns", "add_business_flags", "add_date_dimensions", "apply_advanced_customer_transformations",
    "apply_customer_transformations", "apply_null_remediation", "create_operational_df",
    "standardize_customer_columns", "standardize_raw_df", "enrich_with_reference_data",
    "create_cdc_incremental_load", "create_incremental_load_markers", "deduplicate_customer_records",
    "build_sales_order_transformations", "build_curated_customer_metrics", "create_curated_df",
    "apply_scd_type_2", "reconcile_fact_dimension", "compare_by_key",
    "DataValidator", "Reconciliation", "DataReader",
]
