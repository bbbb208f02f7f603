from pyspark.sql import functions as F

from strata.config import ORDER_SCHEMA, LayerTables
from strata.operators.orders import build_sales_order_transformations
from strata.plans.job import run_medallion
from strata.session import scratch_path
from strata.sources.synth import generate_customers
from strata.streaming.file_load import incremental_file_load

ORDER = ORDER_SCHEMA


def test_file_stream_loads_each_file_once_with_row_transform(spark, tmp_path):
    landing, target, ckpt = (str(tmp_path / n) for n in ("landing", "target", "ckpt"))
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.csv").write_text("order_id,customer_id,order_date,order_status,gross_amount,discount_amount\n"
                                                "o1,c1,2024-09-10,shipped,100,10\n")
    load = dict(spark=spark, source_path=landing, target_path=target, checkpoint_path=ckpt, schema=ORDER,
                transform=build_sales_order_transformations)
    incremental_file_load(**load)
    (tmp_path / "landing" / "b.csv").write_text("order_id,customer_id,order_date,order_status,gross_amount,discount_amount\n"
                                                "o2,c2,2024-09-11,pending,50,80\n")
    incremental_file_load(**load)
    incremental_file_load(**load)                      # nothing new: no duplicate
    out = {r["order_id"]: r for r in spark.read.parquet(target).collect()}
    assert set(out) == {"O1", "O2"} and out["O1"]["status_flag"] == "COMPLETED" and out["O2"]["net_amount"] == 0.0


def test_medallion_layers_round_trip(spark):
    src = generate_customers(spark, rows=300)
    tables = LayerTables("bronze.raw_t", "silver.op_t", "gold.cur_t")
    layers = run_medallion(spark, src, tables, location_root=scratch_path(spark, "medallion"), as_of="2026-01-01")
    assert layers["raw"].count() == 300 and layers["operational"].count() == 300
    cur = layers["curated"]
    n_keys = src.select(F.trim("customer_id").alias("k")).distinct().count()
    assert cur.count() == n_keys
    assert [f.name for f in cur.schema] == ["customer_id", "total_amount", "avg_amount", "latest_signup_date",
                                            "first_signup_date", "total_records", "active_record_count",
                                            "high_value_record_count", "customer_tier", "review_flag"]
    assert cur.where(F.col("customer_id").isNull()).first()["total_records"] == 0   # blank ids collapse, count 0


def test_medallion_with_partitioned_and_bucketed_layers(spark):
    src = generate_customers(spark, rows=300)
    tables = LayerTables("bronze.raw_p", "silver.op_p", "gold.cur_p")
    layers = run_medallion(spark, src, tables, location_root=scratch_path(spark, "medallion_p"), as_of="2026-01-01",
                           layer_options={"operational": {"partition_by": ["signup_month"]},
                                          "curated": {"bucket_by": (4, ["customer_id"])}})
    op = layers["operational"]
    pruned = op.where(F.col("signup_month") == "2022-03")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(signup_month" in plan
    assert pruned.count() == src.where(F.date_format("signup_date", "yyyy-MM") == "2022-03").count()
    cur = layers["curated"]
    agg_plan = cur.groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in agg_plan       # bucketed on the key: no shuffle
