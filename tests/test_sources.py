from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import RAW_CUSTOMER_SCHEMA, LayerTables
from strata.session import scratch_path
from strata.sources.readers import DataReader, from_rows, read_csv, read_raw_csv, read_sql, read_table, read_txt
from strata.sources.sinks import copy_into, create_layer_schemas, create_layer_tables, ddl_columns, write_table
from strata.sources.synth import generate_customers, generate_dataset


def test_csv_txt_and_multiline(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name,amount\n1,x,1.5\n2,,2\n")
    (tmp_path / "b.txt").write_text("id|name\n1|p q\n")
    (tmp_path / "c.csv").write_text('id,body\n1,"line one\nline two"\n2,plain\n')
    df = read_csv(spark, str(tmp_path / "a.csv"))
    assert dict(df.dtypes) == {"id": "int", "name": "string", "amount": "double"}
    assert df.where(F.col("name").isNull()).count() == 1            # empty field -> NULL
    assert read_txt(spark, str(tmp_path / "b.txt")).first()["name"] == "p q"
    ml = read_raw_csv(spark, str(tmp_path / "c.csv"))
    assert ml.count() == 2 and ml.where("id = 1").first()["body"] == "line one\nline two"
    typed = read_csv(spark, str(tmp_path / "a.csv"), schema="id long, name string, amount double")
    assert typed.dtypes[0] == ("id", "bigint")
    reader = DataReader(spark)
    assert reader.read_csv(str(tmp_path / "a.csv")).count() == 2
    assert reader.read_txt(str(tmp_path / "b.txt")).count() == 1


def test_sql_with_bound_args_and_literal_rows(spark):
    rows = from_rows(spark, [("a", 1), ("b", 5)], T.StructType([T.StructField("k", T.StringType()),
                                                                 T.StructField("v", T.IntegerType())]))
    rows.createOrReplaceTempView("lit_rows")
    assert read_sql(spark, "SELECT k FROM lit_rows WHERE v > :m", {"m": 2}).collect()[0]["k"] == "b"
    assert DataReader(spark).read_sql("SELECT count(*) AS n FROM lit_rows").first()["n"] == 2


def test_layer_ddl_and_sinks(spark, tmp_path):
    root = str(tmp_path / "lake")
    create_layer_schemas(spark, ["bronze_t", "silver_t", "gold_t"], location_root=root)
    tables = LayerTables("bronze_t.raw", "silver_t.op", "gold_t.cur")
    create_layer_tables(spark, tables, location_root=root)
    assert [f.name for f in spark.table("bronze_t.raw").schema] == RAW_CUSTOMER_SCHEMA.names
    assert "customer_id STRING" in ddl_columns(RAW_CUSTOMER_SCHEMA)
    df = spark.createDataFrame([("1", "x")], "customer_id string, first_name string")
    write_table(df.select("customer_id", "first_name", *[F.lit(None).alias(c) for c in RAW_CUSTOMER_SCHEMA.names[2:]]),
                "bronze_t.raw", mode="append", schema=RAW_CUSTOMER_SCHEMA)
    assert read_table(spark, "bronze_t.raw").count() == 1
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.csv").write_text("k,v\na,1\nb,2\n")
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.IntegerType())])
    copy_into(spark, str(tmp_path / "in"), "copy_target", schema, path=str(tmp_path / "copy_target"))
    copy_into(spark, str(tmp_path / "in"), "copy_target", schema, path=str(tmp_path / "copy_target"))
    assert spark.table("copy_target").count() == 4    # batch append: no file bookkeeping
    write_table(spark.range(10).withColumn("g", F.col("id") % 3), "bucketed_t", bucket_by=(4, ["g"]),
                sort_by=["g"], path=str(tmp_path / "bucketed"))
    assert spark.table("bucketed_t").count() == 10


def test_scratch_paths_are_unique_and_under_checkpoint_dir(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_synthetic_generator(spark):
    df = generate_customers(spark, rows=400, num_partitions=4)
    rows = {r["record_no"]: r for r in df.collect()}
    assert len(rows) == 400
    assert rows[7]["scenario"] == "blank_identity" and rows[7]["customer_id"] is None and rows[7]["last_name"] == "Guest"
    assert rows[77]["scenario"] == "blank_identity"                       # 7 before 11
    assert rows[11]["scenario"] == "invalid_email" and rows[11]["email"] == "invalid-email"
    assert rows[11]["customer_id"] == "C00012"
    assert rows[13]["scenario"] == "missing_email" and rows[13]["email"] is None
    assert rows[19]["scenario"] == "invalid_status" and rows[19]["status"] in (None, "BLOCKED", "SUSPENDED", "UNKNOWN")
    assert rows[1]["scenario"] == "normal" and rows[1]["customer_id"] == "C00001"
    assert rows[1]["email"] == f"{rows[1]['first_name'].lower()}.{rows[1]['last_name'].lower()}@" + rows[1]["email"].split("@")[1]
    normal = [r for r in rows.values() if r["scenario"] == "normal"]
    assert all(-120 <= r["amount"] <= 4200 and r["status"] in ("ACTIVE", "INACTIVE", "PENDING", "NEW") for r in normal)
    assert all(1 <= (r["updated_at"].date() - r["signup_date"]).days <= 180 for r in normal)
    assert len({r["first_name"] for r in normal}) > 10                    # draws spread over the pool
    again = {r["record_no"]: r for r in generate_customers(spark, rows=400, num_partitions=3).collect()}
    assert again == rows                                                  # pure function of the record number


def test_generated_csv_source_reads_back_as_raw_layer(spark):
    path = generate_dataset(spark, scratch_path(spark, "source_csv"), rows=200)
    raw = read_raw_csv(spark, path)
    assert raw.columns == ["customer_id", "first_name", "last_name", "email", "status", "signup_date", "amount",
                           "updated_at", "region", "source_system"]
    assert raw.count() == 200 and dict(raw.dtypes)["amount"] == "double"
    assert raw.where("customer_id IS NULL").count() == len([n for n in range(1, 201) if n % 7 == 0])


def test_generated_methods_stay_compilable(spark):
    """The JVM leaves methods above 8,000 bytes of bytecode interpreted."""
    from strata.plans.queries import QUERIES
    from strata.sources.synth import generate_customers
    for df in (generate_customers(spark, 10), QUERIES["customer_operational"](spark, "/root/testdata/sf0.001")):
        stages = df._jdf.queryExecution().debug().codegenToSeq()
        assert max(stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.length())) < 8000


def test_no_shared_folder_is_an_error(spark, monkeypatch):
    import pytest

    from strata import session

    class Bare:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None), "master": "spark://host:7077"})

    with pytest.raises(RuntimeError, match="share"):
        session.checkpoint_dir(Bare)


def test_a_failing_plan_is_not_hidden(spark):
    import pytest

    from strata.session import materialize
    with pytest.raises(Exception, match="boom"):
        materialize(spark.range(1).selectExpr("raise_error('boom') AS x"))
