from strata.operators.enrich import enrich_with_reference_data
from strata.operators.reconcile import (
    Reconciliation,
    check_key_reconciliation,
    compare_by_key,
    key_differences,
    reconcile_fact_dimension,
)

import pytest


def test_orphans_reference_case(spark):
    dim = spark.createDataFrame([("D1",), ("D2",), ("D2",)], "customer_id string")
    fact = spark.createDataFrame([("D1", 100.0), ("D3", 50.0), ("D2", 25.0), (None, 7.0)], "customer_id string, amount double")
    out = reconcile_fact_dimension(fact, dim, "customer_id", "customer_id", "amount").collect()
    assert [(r["customer_id"], r["amount"]) for r in out] == [(None, 7.0), ("D3", 50.0)]   # NULL first, sorted


def test_key_differences_both_directions(spark):
    src = spark.createDataFrame([("a", 1), ("b", 1), ("b", 1), (None, 1), ("c", None)], "k string, j int")
    tgt = spark.createDataFrame([("a", 1), ("d", 2), (None, 1)], "k string, j int")
    got = sorted((r["side"], r["k"] or "-", r["j"]) for r in key_differences(src, tgt, ["k", "j"]).collect())
    assert got == [("missing_in_target", "-", 1), ("missing_in_target", "b", 1), ("missing_in_target", "c", None),
                   ("unexpected_in_target", "-", 1), ("unexpected_in_target", "d", 2)]
    counts = {r["check_name"]: r["violations"] for r in check_key_reconciliation(src, tgt, ["k", "j"]).collect()}
    assert counts == {"keys_missing_in_target": 3, "keys_unexpected_in_target": 2}
    with pytest.raises(AssertionError, match="3 source keys"):
        Reconciliation.validate_key_reconciliation(src, tgt, ["k", "j"])


def test_reconciliation_passes_on_equal_keys(spark, source_customer_df):
    Reconciliation.validate_key_reconciliation(source_customer_df, source_customer_df, ["customer_id"])


def test_compare_by_key(spark):
    e = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", None), ("x", 1.0)], "k string, v double")
    a = spark.createDataFrame([("a", 1.0), ("b", 2.5), ("c", None), ("y", 1.0)], "k string, v double")
    got = sorted((r["k"], r["issue"]) for r in compare_by_key(e, a, ["k"], ["v"]).collect())
    assert got == [("b", "value_mismatch"), ("x", "missing_in_actual"), ("y", "missing_in_expected")]


@pytest.mark.parametrize("max_bytes", [1000, 0])
def test_enrichment_broadcast_and_shuffle_paths(spark, max_bytes):
    df = spark.createDataFrame([("c1", "seg?"), ("c2", None), (None, None), ("c3", "x")], "customer_id string, customer_segment string")
    lookup = spark.createDataFrame([("c1", "VIP"), ("c1", "LOYAL"), ("c3", None)], "customer_id string, customer_segment string")
    out = enrich_with_reference_data(df, lookup, broadcast_max_bytes=max_bytes)
    assert out.columns == ["customer_id", "customer_segment"]
    got = sorted((r["customer_id"] or "-", r["customer_segment"]) for r in out.collect())
    assert got == [("-", "UNKNOWN"), ("c1", "VIP"), ("c2", "UNKNOWN"), ("c3", "UNKNOWN")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    if max_bytes > 0:
        assert "BroadcastExchange" in plan
