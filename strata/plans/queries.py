"""Registered queries: one per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables (directly or through the staged views
of :mod:`strata.plans.staged`) and ends in library operators; the matching
DuckDB SQL lives in :mod:`strata.plans.oracles`.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import (
    ACTIVE_STATUSES,
    ALLOWED_STATUSES,
    CUSTOMER_TIERS,
    MANDATORY_COLUMNS,
    PRIMARY_KEY,
    RAW_CUSTOMER_SCHEMA,
    LayerTables,
)
from strata.functions.columns import money_sum
from strata.operators.curated import build_curated_customer_metrics, create_curated_df
from strata.operators.curated_state import apply_changes, curated_of, read_state
from strata.operators.customer import (
    add_audit_columns,
    add_date_dimensions,
    apply_advanced_customer_transformations,
    apply_null_remediation,
    create_operational_df,
    standardize_customer_columns,
    standardize_raw_df,
)
from strata.operators.enrich import enrich_with_reference_data
from strata.operators.history import apply_late_rows, check_scd2_intervals
from strata.operators.incremental import (
    create_cdc_incremental_load,
    create_incremental_load_markers,
    deduplicate_customer_records,
)
from strata.operators.orders import build_sales_order_transformations
from strata.operators import quality as Q
from strata.operators.reconcile import (
    check_compare_by_key,
    check_key_reconciliation,
    check_orphans,
    compare_by_bucket,
    compare_by_key,
    key_differences,
    reconcile_fact_dimension,
)
from strata.operators.scd import apply_scd_type_2
from strata.plans.job import checked_report, run_checked_medallion, run_medallion
from strata.plans.staged import CUSTOMER_AS_OF, _memo, base, staged
from strata.session import materialize, scratch_path
from strata.sources.ledger import copy_into_once, read_loaded
from strata.sources.malformed import read_csv_records
from strata.sources.readers import read_csv, read_raw_csv, read_sql, read_table, read_txt
from strata.sources.sinks import copy_into, create_layer_table, write_table
from strata.sources.synth import synthesize_customers
from strata.streaming.file_load import incremental_file_load


def _raw(spark, sf):
    return staged(spark, sf, "raw_customer")


def _operational(spark, sf):
    memo = _memo(spark)
    key = ("operational", sf)
    if key not in memo:
        memo[key] = apply_advanced_customer_transformations(_raw(spark, sf), as_of=CUSTOMER_AS_OF)
    return memo[key]


# -- projections -------------------------------------------------------------
def standardize_customer(spark, sf):
    return standardize_customer_columns(_raw(spark, sf))


def null_remediation(spark, sf):
    return apply_null_remediation(_raw(spark, sf))


def audit_columns(spark, sf):
    return add_audit_columns(_raw(spark, sf), batch_id="BATCH_2024_09", source_system="CRM", as_of=CUSTOMER_AS_OF)


def date_dimensions(spark, sf):
    return add_date_dimensions(base(spark, sf, "orders"), date_col="o_orderdate")


def customer_operational(spark, sf):
    return _operational(spark, sf)


def customer_operational_loader(spark, sf):
    return create_operational_df(standardize_raw_df(_raw(spark, sf)), as_of=CUSTOMER_AS_OF)


def load_markers(spark, sf):
    return create_incremental_load_markers(_raw(spark, sf), "2024-09-25")


def sales_orders(spark, sf):
    return build_sales_order_transformations(staged(spark, sf, "orders_in"))


# -- joins -------------------------------------------------------------------
def enrich_lookup(spark, sf):
    return enrich_with_reference_data(base(spark, sf, "customer"), staged(spark, sf, "nation_lookup"),
                                      join_key="c_nationkey", lookup_key="lookup_key",
                                      value_col="customer_segment")


def enrich_orders_segment(spark, sf):
    """Fact -> dimension lookup: every order gets its customer's segment (UNKNOWN for customers
    whose key the lookup lacks, here every tenth)."""
    customers = staged(spark, sf, "segment_lookup")
    return enrich_with_reference_data(base(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"),
                                      customers, join_key="o_custkey", lookup_key="lookup_key",
                                      value_col="c_mktsegment")


def cdc_delta(spark, sf):
    current = staged(spark, sf, "cdc_current")
    incoming = staged(spark, sf, "cdc_incoming")
    return create_cdc_incremental_load(current, incoming, "customer_id", "updated_at")


def _scd2(spark, sf, keep_history):
    return apply_scd_type_2(staged(spark, sf, "dim_customer"), staged(spark, sf, "scd_incoming"),
                            keep_history=keep_history)


def scd2_full(spark, sf):
    return _scd2(spark, sf, True)


def scd2_current(spark, sf):
    return _scd2(spark, sf, False)


def scd2_late_rows(spark, sf):
    """Batches that arrive out of order, one of them years late: the history is that of all rows in order."""
    incoming = staged(spark, sf, "scd_incoming")
    by_month = [incoming.where(F.col("updated_at") == F.lit(day).cast("date")) for day in ("2024-03-01", "2024-01-01", "2024-02-01")]
    dimension, hidden = staged(spark, sf, "dim_customer"), None
    for batch in (by_month[0], by_month[1], staged(spark, sf, "scd_late"), by_month[2]):
        dimension, hidden = apply_late_rows(dimension, batch, hidden)
    return dimension


def scd2_interval_checks(spark, sf):
    """V15 between neighbours: the intervals of a spoiled dimension, and those of a history with late rows."""
    spoiled = check_scd2_intervals(staged(spark, sf, "dim_intervals")).select(F.lit("spoiled").alias("dimension"), "*")
    late = check_scd2_intervals(scd2_late_rows(spark, sf)).select(F.lit("late_rows").alias("dimension"), "*")
    return spoiled.unionByName(late)


def key_reconciliation(spark, sf):
    return key_differences(staged(spark, sf, "fact_orders"), staged(spark, sf, "dim_keys"), ["customer_id"])


def orphan_facts(spark, sf):
    return reconcile_fact_dimension(staged(spark, sf, "fact_orders"), staged(spark, sf, "dim_keys"),
                                    "customer_id", "customer_id", "amount")


def compare_latest_activity(spark, sf):
    """Expected (the re-keyed current side, odd events 30 days early) vs actual (latest over all events)."""
    expected = staged(spark, sf, "cdc_current")
    actual = (base(spark, sf, "events").groupBy(F.col("user_id").alias("customer_id"))
              .agg(F.max("ts").alias("updated_at")))
    return compare_by_key(expected, actual, ["customer_id"], ["updated_at"])


def bucket_reconciliation(spark, sf):
    """A copy of the orders against the orders, row by row only where the buckets' fingerprints differ."""
    return compare_by_bucket(base(spark, sf, "orders"), staged(spark, sf, "orders_copy"), ["o_orderkey"], ["o_totalprice", "o_orderstatus"])


# -- aggregation / dedup -------------------------------------------------------
def customer_curated(spark, sf):
    return build_curated_customer_metrics(_operational(spark, sf))


def curated_metrics(spark, sf):
    return build_curated_customer_metrics(staged(spark, sf, "event_amounts"))


def curated_metrics_loader(spark, sf):
    return create_curated_df(customer_operational_loader(spark, sf))


def curated_incremental(spark, sf):
    """The curated layer after two batches, the second with corrections and deletions; the last one is run twice."""
    root, changes = scratch_path(spark, "curated-state"), staged(spark, sf, "event_changes")
    for number in (1, 2, 2):
        apply_changes(changes.where(F.col("batch") == number).drop("batch"), root, number, buckets=16)
    return curated_of(read_state(spark, root))


def dedup_latest(spark, sf):
    return deduplicate_customer_records(base(spark, sf, "events"), ["user_id"], order_by=["ts"])


def dedup_any_survivor(spark, sf):
    """F1 without an order (dropDuplicates): any of a key's rows survives whole; here they are all alike."""
    return deduplicate_customer_records(staged(spark, sf, "repeated_users"), ["user_id"])


def duplicate_keys(spark, sf):
    return Q.duplicate_keys(base(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


# -- quality -------------------------------------------------------------------
RAW_EXPECTED_TYPES = {"customer_id": "StringType()", "status": "string", "signup_date": "StringType()",
                      "amount": "DoubleType()", "updated_at": "TimestampType()", "region": "string"}


def quality_report(spark, sf):
    raw = _raw(spark, sf)
    operational = _operational(spark, sf)
    curated = build_curated_customer_metrics(operational)
    raw_rules = ([Q.not_null(c) for c in MANDATORY_COLUMNS] + [Q.allowed_values("status", ALLOWED_STATUSES)]
                 + [Q.parse_failures("signup_date", "date"), Q.parse_failures("amount", "double")])
    op_rules = [
        Q.allowed_values("status", ALLOWED_STATUSES),
        Q.predicate("active_status_is_active",
                    F.col("status").isin(*ACTIVE_STATUSES) & (F.col("is_active") == F.lit(False)),
                    "is_active"),
        Q.predicate("tier_not_null", "customer_tier IS NULL", "customer_tier"),
        Q.allowed_values("customer_tier", CUSTOMER_TIERS, null_is_violation=True),
    ]
    # one aggregation pass per frame for all row rules and its row count;
    # the record-count check reuses both profiles
    raw_profile, op_profile = Q.profile(raw, raw_rules), Q.profile(operational, op_rules)
    frames = [
        Q.profile_checks(raw_profile, raw_rules, include_not_empty=True),
        Q.record_count_from_profiles(raw_profile, op_profile),
        Q.check_duplicates(raw, PRIMARY_KEY),
        Q.check_columns(raw, MANDATORY_COLUMNS + ("full_name",)),
        Q.check_expected_schema(raw, RAW_EXPECTED_TYPES),
        Q.profile_checks(op_profile, op_rules),
        Q.check_allowed_values(curated, "customer_tier", CUSTOMER_TIERS),
        check_compare_by_key(operational.groupBy("customer_id").agg(money_sum("amount").alias("total_amount")),
                             curated, ["customer_id"], ["total_amount"], check_name="curated_total_matches"),
    ]
    return Q.union_checks(frames)


def dq_run_report(spark, sf):
    """V17: the quality report of two batches appended to a results table, read back."""
    name = f"dq_results_{uuid.uuid4().hex[:10]}"
    path = scratch_path(spark, name)
    report = materialize(quality_report(spark, sf))   # computed once, appended twice
    for batch in ("B1", "B2"):
        Q.record_check_results(report, name, batch, "2024-02-01 00:00:00", layer="raw", path=path)
    return read_table(spark, name)


def reconciliation_checks(spark, sf):
    fact, dim = staged(spark, sf, "fact_orders"), staged(spark, sf, "dim_keys")
    return Q.union_checks([check_key_reconciliation(fact, dim, ["customer_id"]),
                           check_orphans(fact, dim, "customer_id", "customer_id")])


def scd2_invariants(spark, sf):
    return Q.check_scd2(scd2_full(spark, sf))


# -- sources and sinks -----------------------------------------------------------
CUSTOMER_CSV_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])


def csv_round_trip(spark, sf):
    path = scratch_path(spark, "customer_csv")
    base(spark, sf, "customer").write.mode("overwrite").option("header", "true").csv(path)
    return read_csv(spark, path, schema=CUSTOMER_CSV_SCHEMA)


def txt_round_trip(spark, sf):
    path = scratch_path(spark, "customer_txt")
    base(spark, sf, "customer").write.mode("overwrite").option("header", "true").option("sep", "|").csv(path)
    return read_txt(spark, path)   # pipe-delimited, schema inferred


def csv_quarantine(spark, sf):
    """Customers as lines of text, some broken: the records that fit and those that do not, with the reason."""
    path = scratch_path(spark, "customer_lines")
    staged(spark, sf, "customer_lines").select("line").write.text(path)
    records = read_csv_records(spark, path, CUSTOMER_CSV_SCHEMA, header=False)
    return (records.good.select(F.col("c_custkey").cast("string").alias("record"), F.lit("good").alias("reason"))
            .unionByName(records.broken.select("record", "reason")))


DOCUMENT_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])
CSV_TEXT_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def multiline_csv_round_trip(spark, sf):
    """Whole documents (quoted values with embedded newlines) through CSV."""
    path = scratch_path(spark, "documents_csv")
    (base(spark, sf, "documents").write.mode("overwrite").option("header", "true")
     .options(**CSV_TEXT_OPTIONS).csv(path))
    return read_raw_csv(spark, path, schema=DOCUMENT_SCHEMA, **CSV_TEXT_OPTIONS)


def sql_source(spark, sf):
    return read_sql(spark, """
        SELECT c_mktsegment, count(*) AS customers, min(c_acctbal) AS min_balance, max(c_acctbal) AS max_balance
        FROM {customer} WHERE c_acctbal >= :min_balance GROUP BY c_mktsegment""", args={"min_balance": 0.0},
                    customer=base(spark, sf, "customer"))


def table_source(spark, sf):
    name = f"customer_copy_{uuid.uuid4().hex[:10]}"
    write_table(base(spark, sf, "customer"), name, schema=CUSTOMER_CSV_SCHEMA,
                path=scratch_path(spark, name))
    return read_table(spark, name)


def synthetic_customers(spark, sf):
    return synthesize_customers(base(spark, sf, "customer").select("c_custkey"), "c_custkey", seed=42)


RAW_CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _raw_csv(spark, sf) -> str:
    """The staged raw customers as CSV text, as a source system delivers them."""
    path = scratch_path(spark, "raw_csv")
    _raw(spark, sf).write.option("header", "true").options(**RAW_CSV_OPTIONS).csv(path)
    return path


def _medallion(spark, sf):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _raw(spark, sf).columns])
    source = read_csv(spark, _raw_csv(spark, sf), schema=schema, **RAW_CSV_OPTIONS)
    tag = uuid.uuid4().hex[:10]
    tables = LayerTables(raw=f"bronze.raw_customer_data_{tag}", operational=f"silver.operational_customer_data_{tag}",
                         curated=f"gold.curated_customer_metrics_{tag}")
    return run_medallion(spark, source, tables, as_of=CUSTOMER_AS_OF)


def medallion_load(spark, sf):
    """A12 from a CSV source; the curated layer as written."""
    return _medallion(spark, sf)["curated"]


def medallion_raw(spark, sf):
    return _medallion(spark, sf)["raw"]


def medallion_operational(spark, sf):
    return _medallion(spark, sf)["operational"]


def _checked_medallion(spark, sf):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in _raw(spark, sf).columns])
    source = read_csv(spark, _raw_csv(spark, sf), schema=schema, **RAW_CSV_OPTIONS)
    tag = uuid.uuid4().hex[:10]
    tables = LayerTables(raw=f"bronze.raw_checked_{tag}", operational=f"silver.operational_checked_{tag}", curated=f"gold.curated_checked_{tag}")
    return run_checked_medallion(spark, source, tables, as_of=CUSTOMER_AS_OF)


def medallion_checked(spark, sf):
    """A12 with every layer checked on the way in: the curated layer, built from the good rows alone."""
    return _checked_medallion(spark, sf)["curated"].good


def medallion_checked_quarantine(spark, sf):
    """The operational layer's quarantined rows with the rules that each breaks."""
    found = _checked_medallion(spark, sf)["operational"].quarantined
    return found.withColumn("failed_rules", F.array_join("failed_rules", ","))


def medallion_checked_report(spark, sf):
    return checked_report(_checked_medallion(spark, sf))


def layer_copy_into(spark, sf):
    """A7 and A9 in one: the raw layer's table by DDL, then a CSV file set appended to it."""
    name, path = f"raw_layer_{uuid.uuid4().hex[:10]}", scratch_path(spark, "raw_layer")
    landing = scratch_path(spark, "raw_landing")
    standardize_raw_df(_raw(spark, sf)).write.option("header", "true").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").options(
        **RAW_CSV_OPTIONS).csv(landing)
    create_layer_table(spark, name, RAW_CUSTOMER_SCHEMA, fmt="parquet", location=path)
    copy_into(spark, landing, name, RAW_CUSTOMER_SCHEMA, path=path, timestampNTZFormat="yyyy-MM-dd HH:mm:ss", **RAW_CSV_OPTIONS)
    return read_table(spark, name)


def recompute_checks(spark, sf):
    """V10: name, status and amount derived again from the source, against the layer and against a spoiled copy of it."""
    source = staged(spark, sf, "customer_text")
    layer = apply_advanced_customer_transformations(source, as_of=CUSTOMER_AS_OF)
    again = source.selectExpr(
        "upper(trim(customer_id)) AS customer_id", "upper(trim(status)) AS status",
        "trim(regexp_replace(first_name, '[ ]+', ' ')) || ' ' || coalesce(last_name, 'UNKNOWN') AS full_name",
        "round(abs(try_cast(amount AS double)), 2) AS amount")
    number = F.substring("customer_id", 2, 20).cast("long")
    spoiled = layer.withColumns({"status": F.when(number % 9 == 0, "LOST").otherwise(F.col("status")),
                                 "amount": F.when(number % 11 == 0, F.col("amount") + 0.01).otherwise(F.col("amount"))})
    columns = ["full_name", "status", "amount"]
    return Q.union_checks([check_compare_by_key(again, layer, ["customer_id"], columns, "stored_columns_agree"),
                           check_compare_by_key(again, spoiled, ["customer_id"], columns, "spoiled_columns_agree")])


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def incremental_file_load_events(spark, sf):
    """Events land as CSV files in two drops; the stream loads each file exactly once."""
    landing = scratch_path(spark, "landing")
    target = scratch_path(spark, "events_table")
    ckpt = scratch_path(spark, "events_ckpt")
    events = base(spark, sf, "events")
    opts = {"escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    events.where(F.col("event_id") % 2 == 0).write.mode("append").option("header", "true").options(**opts).csv(landing)
    incremental_file_load(spark, landing, target, ckpt, EVENT_SCHEMA, **opts)
    events.where(F.col("event_id") % 2 == 1).write.mode("append").option("header", "true").options(**opts).csv(landing)
    incremental_file_load(spark, landing, target, ckpt, EVENT_SCHEMA, **opts)
    incremental_file_load(spark, landing, target, ckpt, EVENT_SCHEMA, **opts)   # re-run: nothing new
    return spark.read.schema(EVENT_SCHEMA).parquet(target)


def copy_into_once_events(spark, sf):
    """Two drops of files, copied by three runs: each file's rows are there once."""
    landing, root = scratch_path(spark, "landing-once"), scratch_path(spark, "events-once")
    events, opts = base(spark, sf, "events"), {"escape": '"', "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    for drop in (0, 1):
        events.where(F.col("event_id") % 2 == drop).write.mode("append").option("header", "true").options(**opts).csv(landing)
        for _ in range(2 - drop):
            copy_into_once(spark, landing, root, EVENT_SCHEMA, pattern="*.csv", **opts)
    return read_loaded(spark, root, EVENT_SCHEMA)


QUERIES = {
    "customer_curated": customer_curated,
    "standardize_customer": standardize_customer,
    "null_remediation": null_remediation,
    "audit_columns": audit_columns,
    "date_dimensions": date_dimensions,
    "customer_operational": customer_operational,
    "customer_operational_loader": customer_operational_loader,
    "load_markers": load_markers,
    "sales_orders": sales_orders,
    "enrich_lookup": enrich_lookup,
    "enrich_orders_segment": enrich_orders_segment,
    "cdc_delta": cdc_delta,
    "scd2_full": scd2_full,
    "scd2_current": scd2_current,
    "scd2_late_rows": scd2_late_rows,
    "scd2_interval_checks": scd2_interval_checks,
    "key_reconciliation": key_reconciliation,
    "orphan_facts": orphan_facts,
    "compare_by_key": compare_latest_activity,
    "bucket_reconciliation": bucket_reconciliation,
    "curated_metrics": curated_metrics,
    "curated_metrics_loader": curated_metrics_loader,
    "curated_incremental": curated_incremental,
    "dedup_latest": dedup_latest,
    "dedup_any_survivor": dedup_any_survivor,
    "duplicate_keys": duplicate_keys,
    "quality_report": quality_report,
    "dq_run_report": dq_run_report,
    "reconciliation_checks": reconciliation_checks,
    "scd2_invariants": scd2_invariants,
    "csv_round_trip": csv_round_trip,
    "txt_round_trip": txt_round_trip,
    "multiline_csv_round_trip": multiline_csv_round_trip,
    "csv_quarantine": csv_quarantine,
    "sql_source": sql_source,
    "table_source": table_source,
    "synthetic_customers": synthetic_customers,
    "medallion_load": medallion_load,
    "medallion_raw": medallion_raw,
    "medallion_operational": medallion_operational,
    "medallion_checked": medallion_checked,
    "medallion_checked_quarantine": medallion_checked_quarantine,
    "medallion_checked_report": medallion_checked_report,
    "layer_copy_into": layer_copy_into,
    "recompute_checks": recompute_checks,
    "incremental_file_load": incremental_file_load_events,
    "copy_into_once": copy_into_once_events,
}
