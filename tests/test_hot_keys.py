"""Every keyed operator on data where ONE key holds a third of all rows.

The inputs derive from the driver's ``events`` table (a third of the rows
re-keyed onto user 1, a few NULL keys); each result is checked against a
brute-force DuckDB query over the same rows, and the plan is checked for
the map-side reduction that keeps the hot key from reaching one reducer
whole.
"""

import duckdb
import pytest
from pyspark.sql import functions as F

from strata.operators.curated import build_curated_customer_metrics
from strata.operators.enrich import enrich_with_reference_data
from strata.operators.incremental import create_cdc_incremental_load, deduplicate_customer_records
from strata.operators.reconcile import key_differences, reconcile_fact_dimension
from strata.operators.scd import apply_scd_type_2

SF = "/root/testdata/sf0.001"
HOT = """SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 101 = 0 THEN NULL ELSE user_id END AS user_id,
                event_type, value FROM read_parquet('{sf}/events.parquet')"""


@pytest.fixture(scope="module")
def hot(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    return ev.select("event_id", "ts",
                     F.when(F.col("event_id") % 3 == 0, F.lit(1)).when(F.col("event_id") % 101 == 0, F.lit(None))
                     .otherwise(F.col("user_id")).cast("long").alias("user_id"),
                     "event_type", "value")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("CREATE VIEW hot AS " + HOT.format(sf=SF))
    return con


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_really_holds_a_third(duck):
    n, hot_n = duck.sql("SELECT count(*), count(*) FILTER (WHERE user_id = 1) FROM hot").fetchall()[0]
    assert hot_n * 3 >= n - 3


def test_curated_with_hot_key(spark, hot, duck):
    df = hot.select(F.col("user_id").alias("customer_id"), F.col("value").alias("amount"),
                    F.col("ts").cast("date").alias("signup_date"), (F.col("event_type") != "error").alias("is_active"),
                    (F.col("value") >= 100).alias("is_high_value"), (F.col("event_type") == "error").alias("needs_review"))
    out = build_curated_customer_metrics(df)
    got = {r["customer_id"]: (r["total_records"], r["total_amount"]) for r in out.collect()}
    want = {k: (c, t) for k, c, t in duck.sql(
        "SELECT user_id, count(user_id), CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) FROM hot GROUP BY user_id").fetchall()}
    assert got == want
    assert "partial_sum" in plan_of(out)


def test_dedup_with_hot_key(spark, hot, duck):
    out = deduplicate_customer_records(hot, ["user_id"], ["ts"])
    got = {r["user_id"]: r["event_id"] for r in out.collect()}
    want = dict(duck.sql("""SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY ts DESC NULLS LAST, event_id DESC) rn FROM hot) WHERE rn = 1""").fetchall())
    assert got == want
    assert "partial_max" in plan_of(out)


def test_cdc_with_hot_key(spark, hot, duck):
    current = hot.where(F.col("event_id") % 2 == 0).select(F.col("user_id").alias("customer_id"),
                                                           F.col("ts").alias("updated_at"))
    incoming = hot.where(F.col("event_id") % 2 == 1).select(F.col("user_id").alias("customer_id"),
                                                            F.col("ts").alias("updated_at"), "event_id")
    got = sorted(r["event_id"] for r in create_cdc_incremental_load(current, incoming).collect())
    want = sorted(r[0] for r in duck.sql("""
        WITH cur AS (SELECT user_id, max(ts) m FROM hot WHERE event_id % 2 = 0 AND user_id IS NOT NULL GROUP BY user_id)
        SELECT i.event_id FROM hot i LEFT JOIN cur ON i.user_id = cur.user_id
        WHERE i.event_id % 2 = 1 AND (cur.m IS NULL OR i.ts > cur.m)""").fetchall())
    assert got == want
    # the incoming batch is joined against a broadcast key map, never shuffled by key
    assert "BroadcastHashJoin" in plan_of(create_cdc_incremental_load(current, incoming))


def test_orphans_and_key_differences_with_hot_key(spark, hot, duck):
    dim = hot.where(F.col("user_id") % 4 != 0).select(F.col("user_id").alias("customer_id")).distinct()
    fact = hot.select(F.col("user_id").alias("customer_id"), "event_id")
    got = sorted(r["event_id"] for r in reconcile_fact_dimension(fact, dim, sort=False).collect())
    want = sorted(r[0] for r in duck.sql(
        "SELECT event_id FROM hot WHERE user_id IS NULL OR user_id % 4 = 0").fetchall())
    assert got == want
    diff = key_differences(fact, dim, ["customer_id"])
    sides = sorted((r["side"], -1 if r["customer_id"] is None else r["customer_id"]) for r in diff.collect())
    want_sides = sorted([("missing_in_target", -1)] + [("missing_in_target", k) for (k,) in duck.sql(
        "SELECT DISTINCT user_id FROM hot WHERE user_id % 4 = 0").fetchall()])
    assert sides == want_sides
    assert "partial_max" in plan_of(diff)


def test_enrich_and_scd_with_hot_key(spark, hot, duck):
    lookup = hot.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.max("event_type").alias("seg"))
    out = enrich_with_reference_data(hot, lookup.where(F.col("user_id") != 1), join_key="user_id",
                                     lookup_key="user_id", value_col="seg", broadcast_max_bytes=0)
    assert out.count() == hot.count()
    assert out.where(F.col("user_id") == 1).where(F.col("seg") != "UNKNOWN").count() == 0
    dim = lookup.select(F.col("user_id").alias("customer_id"), F.col("seg").alias("status"),
                        F.lit("2023-01-01").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"),
                        F.lit(True).alias("is_current"), F.lit(1).cast("long").alias("version_no"))
    incoming = hot.select(F.col("user_id").alias("customer_id"), F.col("event_type").alias("status"),
                          F.col("ts").cast("string").alias("updated_at"))
    scd = apply_scd_type_2(dim, incoming, window_rows=1000)
    per_key = scd.groupBy("customer_id").agg(F.count_if("is_current").alias("c"))
    assert per_key.where(F.col("c") != 1).count() == 0


@pytest.mark.parametrize("how", ["left", "left_semi"])
def test_key_map_join_splits_hot_keys(spark, hot, duck, how):
    """Map too big to broadcast: the hot key goes map-side, the rest through a shuffle."""
    from strata.operators.keymap import join_key_map, key_map
    side = hot.where(F.col("event_id") % 2 == 0).select(F.col("user_id").alias("k"), F.col("ts").alias("t"))
    kmap = key_map(hot, "user_id", side, "k", {"t": F.max("t")})
    # as at scale: no size-based automatic broadcast of the (here tiny) cold map
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_key_map(hot, "user_id", kmap, how, broadcast_max_bytes=0, hot_key_rows=100)
        plan = plan_of(out)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan      # hot map-side, cold shuffled
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    if how == "left":
        got = sorted((r["event_id"], r["t"]) for r in rows)
        want = sorted(duck.sql("""WITH m AS (SELECT user_id, max(ts) t FROM hot WHERE event_id % 2 = 0 GROUP BY user_id)
            SELECT h.event_id, m.t FROM hot h LEFT JOIN m ON h.user_id = m.user_id""").fetchall())
    else:
        got = sorted(r["event_id"] for r in rows)
        want = sorted(r[0] for r in duck.sql("SELECT event_id FROM hot WHERE user_id IS NOT NULL").fetchall())
    assert got == want
