import datetime as dt

from pyspark.sql import functions as F

from strata.operators.curated import build_curated_customer_metrics, create_curated_df
from tests.conftest import by_key


def test_golden_curated(curated_customer_df):
    rows = by_key(curated_customer_df)
    assert (rows["C001"]["total_amount"], rows["C001"]["avg_amount"], rows["C001"]["total_records"],
            rows["C001"]["active_record_count"], rows["C001"]["high_value_record_count"],
            rows["C001"]["review_flag"], rows["C001"]["customer_tier"]) == (120.5, 120.5, 1, 1, 0, 0, "BRONZE")
    assert rows["C002"]["active_record_count"] == 0 and rows["C003"]["review_flag"] == 1
    assert rows["C001"]["latest_signup_date"] == rows["C001"]["first_signup_date"] == dt.date(2024, 1, 15)


def test_totals_reconcile_and_tier_domain(operational_customer_df, curated_customer_df):
    expected = operational_customer_df.groupBy("customer_id").agg(F.sum("amount").alias("e"))
    cmp = expected.join(curated_customer_df, "customer_id", "full_outer")
    assert cmp.filter(~F.col("e").eqNullSafe(F.col("total_amount"))).count() == 0
    assert curated_customer_df.filter(~F.col("customer_tier").isin("BRONZE", "SILVER", "GOLD")).count() == 0


def test_null_group_exact_sums_and_loader_review(spark):
    rows = [(None, 0.1, True, False, "LOW")] * 10 + [("k", 0.1, False, True, "HIGH")] * 3 + [("z", None, None, None, "LOW")]
    df = spark.createDataFrame(rows, "customer_id string, amount double, is_active boolean, needs_review boolean, risk_flag string")
    df = df.withColumns({"signup_date": F.lit(None).cast("date"), "is_high_value": F.col("amount") >= 500})
    e1 = {r["customer_id"]: r for r in build_curated_customer_metrics(df).collect()}
    assert e1[None]["total_records"] == 0 and e1[None]["total_amount"] == 1.0   # exact: not 0.9999999999999999
    assert e1[None]["active_record_count"] == 10 and e1["k"]["review_flag"] == 1
    assert e1["z"]["total_amount"] is None and e1["z"]["avg_amount"] is None and e1["z"]["customer_tier"] == "BRONZE"
    e2 = {r["customer_id"]: r for r in create_curated_df(df).collect()}
    assert e2["k"]["review_flag"] == 1 and e2[None]["review_flag"] == 0
    assert [f.simpleString() for f in create_curated_df(df).schema.fields] == [
        "customer_id:string", "total_amount:double", "avg_amount:double", "latest_signup_date:date",
        "first_signup_date:date", "total_records:bigint", "active_record_count:bigint",
        "high_value_record_count:bigint", "customer_tier:string", "review_flag:int"]


def test_totals_neither_round_nor_fail(spark):
    from pyspark.sql import functions as F

    from strata.functions.columns import money_avg, money_sum
    rows = ([("small", "0.004")] * 10 + [("nan", "NaN"), ("nan", "1"), ("inf", "Infinity"), ("inf", "5"), ("both", "Infinity"), ("both", "-Infinity"),
             ("tiny", "1e-14"), ("tiny", "2e-14"), ("huge", "1e30"), ("huge", "1"), ("tenth", "bad")] + [("tenth", "0.1")] * 10 + [("none", None)])
    df = spark.createDataFrame(rows, "k string, v string")
    got = {r.k: (r.s, r.a) for r in df.groupBy("k").agg(money_sum("v").alias("s"), money_avg("v").alias("a")).collect()}
    assert got["small"] == (0.04, 0.004) and got["tenth"] == (1.0, 0.1) and got["none"] == (None, None)
    assert got["inf"][0] == float("inf") and str(got["nan"][0]) == str(got["both"][0]) == "nan"
    assert abs(got["tiny"][0] - 3e-14) < 1e-20 and got["huge"][0] == 1e30
    assert df.where(F.col("k") == "x").agg(money_sum("v").alias("s")).first().s is None
