from strata.operators.orders import build_sales_order_transformations


def test_order_rules(spark):
    df = spark.createDataFrame(
        [("ORD001", "C001", "2024-09-10", "PENDING", 100.0, 15.0),
         ("ORD002", "C002", "2024-09-12", "shipped", -10.0, 5.0),
         ("ORD003", "C003", "2024-09-16", "DELIVERED", 200.0, 25.0),
         ("o4", "c4", "2024-10-01", None, None, 5.0),
         ("o5", "c5", "2024-10-01", "lost", 40.0, None),
         ("o6", "c6", "2024-10-01", "processing", 30.0, 80.0),
         ("o7", "c7", "2024-10-01", "returned", 900.0, 100.0)],
        "order_id string, customer_id string, order_date string, order_status string, "
        "gross_amount double, discount_amount double")
    rows = {r["order_id"]: r for r in build_sales_order_transformations(df).collect()}
    assert (rows["ORD001"]["net_amount"], rows["ORD001"]["status_flag"], rows["ORD001"]["order_value_bucket"]) == (85.0, "PENDING", "LOW")
    assert (rows["ORD002"]["net_amount"], rows["ORD002"]["status_flag"]) == (5.0, "COMPLETED")
    assert (rows["ORD003"]["net_amount"], rows["ORD003"]["order_value_bucket"]) == (175.0, "MEDIUM")
    assert rows["ORD001"]["order_month"] == "2024-09"
    assert rows["O4"]["gross_amount"] == 0.0 and rows["O4"]["net_amount"] == 0.0 and rows["O4"]["status_flag"] == "REVIEW"
    assert rows["O5"]["discount_amount"] == 0.0 and rows["O5"]["net_amount"] == 40.0 and rows["O5"]["status_flag"] == "REVIEW"
    assert rows["O6"]["net_amount"] == 0.0 and rows["O6"]["status_flag"] == "PENDING"
    assert rows["O7"]["net_amount"] == 800.0 and rows["O7"]["order_value_bucket"] == "HIGH"
