"""Checked layer writes and published versions."""

import uuid

import pytest
from pyspark.sql import functions as F

from strata.operators import quality as Q
from strata.operators.quarantine import checked_rows, failed_rules, write_checked
from strata.session import scratch_path
from strata.sources.publish import publish_table

ROWS = [("a", "1", "NEW"), ("b", "x", "OLD"), (None, "2", "NEW"), ("c", None, None), ("d", "y", "NEW"), ("a", "3", "OLD")]
SHAPE = "k string, amount string, status string"


def rules():
    return [Q.not_null("k"), Q.allowed_values("status", ["NEW"], null_is_violation=True)]


def typed(df):
    return df.withColumn("amount", F.col("amount").try_cast("double"))


def name():
    return f"checked_{uuid.uuid4().hex[:8]}"


def everything(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rows_are_split_and_counted_in_one_job(spark):
    path = scratch_path(spark, "checked-source")
    spark.createDataFrame(ROWS, SHAPE).write.parquet(path)
    source = spark.read.parquet(path)
    table, group = name(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "one write")
    try:
        out = write_checked(source, table, scratch_path(spark, table), rules(), build=typed,
                            source_rules=[Q.parse_failures("amount", "double")], expected_rows=6)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 1
    assert everything(out.good) == [("a", 1.0, "NEW")]
    assert everything(out.quarantined) == everything(spark.createDataFrame([
        ("b", None, "OLD", ["parse_failures(amount)", "allowed_values(status)"]), (None, 2.0, "NEW", ["not_null(k)"]),
        ("c", None, None, ["allowed_values(status)"]), ("d", None, "NEW", ["parse_failures(amount)"]), ("a", 3.0, "OLD", ["allowed_values(status)"])],
        "k string, amount double, status string, failed_rules array<string>"))
    assert {tuple(r) for r in out.report.collect()} == {
        ("not_empty", None, 0, True), ("record_count", None, 0, True), ("parse_failures", "amount", 2, False), ("not_null", "k", 1, False),
        ("allowed_values", "status", 3, False)}
    assert (out.rows, out.n_quarantined) == (6, 5)
    plan = checked_rows(source, rules(), build=typed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Python" not in plan


def test_empty_frames_and_frames_of_one_kind(spark):
    table = name()
    root = scratch_path(spark, table)
    none = write_checked(spark.createDataFrame([], SHAPE), table, root, rules())
    assert none.good.count() == none.quarantined.count() == 0
    assert {r.check_name: r.violations for r in none.report.collect()} == {"not_empty": 1, "not_null": 0, "allowed_values": 0}
    good = write_checked(spark.createDataFrame(ROWS[:1] * 3, SHAPE), table, root, rules())
    assert good.good.count() == 3 and good.quarantined.count() == 0
    bad = write_checked(spark.createDataFrame(ROWS[1:3], SHAPE), table, root, rules())
    assert bad.good.count() == 0 and bad.quarantined.count() == 2 and spark.table(table).count() == 0


def test_names_and_columns_that_clash(spark):
    df = spark.createDataFrame([("a", 1, "x"), (None, 2, "y")], "k string, rows long, quarantined string")
    out = write_checked(df, name(), scratch_path(spark, "clash"), [Q.not_null("k")])
    assert everything(out.good) == [("a", 1, "x")] and out.rows == 2
    with pytest.raises(ValueError):
        write_checked(df, name(), scratch_path(spark, "clash"), [Q.not_null("k"), Q.not_null("k")])
    assert df.select(failed_rules([]).alias("f")).first().f == []


def test_a_failed_write_leaves_the_layer_readable(spark):
    table = name()
    root = scratch_path(spark, table)
    good = spark.createDataFrame(ROWS[:1], SHAPE)
    write_checked(good, table, root, rules())
    broken = good.withColumn("amount", F.raise_error(F.lit("source gone")).cast("string"))
    with pytest.raises(Exception, match="source gone"):
        write_checked(broken, table, root, rules())
    assert everything(spark.table(table)) == [ROWS[0]]


def test_publishing_moves_the_table_and_keeps_versions(spark):
    table = name()
    root = scratch_path(spark, table)
    first = publish_table(spark.range(3).toDF("n"), table, root)
    held = spark.table(table)
    second = publish_table(spark.range(5).toDF("n"), table, root)
    assert first != second and spark.table(table).count() == 5
    assert spark.read.parquet(first).count() == 3 and held.count() in (3, 5)
    with pytest.raises(Exception, match="half way"):
        publish_table(spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("half way"))).alias("n")), table, root)
    assert spark.table(table).count() == 5
    same = publish_table(spark.table(table).union(spark.range(2).toDF("n")), table, root)      # a layer built from itself
    assert spark.table(table).count() == 7 and same != second
