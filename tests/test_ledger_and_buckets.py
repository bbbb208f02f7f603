"""Load-once copies and comparison by checksums."""

import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.reconcile import bucket_fingerprints, compare_by_bucket, compare_by_key, differing_buckets, key_bucket
from strata.session import scratch_path
from strata.sources import ledger
from strata.sources.ledger import copy_into_once, loaded_files, read_loaded

SHAPE = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def drop(spark, path, *numbers):
    spark.createDataFrame([(n, f"v{n}") for n in numbers], SHAPE).coalesce(1).write.mode("append").option("header", "true").csv(path)


def run(spark, landing, root):
    return copy_into_once(spark, landing, root, SHAPE, pattern="*.csv")


def test_every_file_once_and_changed_files_are_reported(spark):
    landing, root = scratch_path(spark, "in"), scratch_path(spark, "out")
    drop(spark, landing, 1, 2)
    first = run(spark, landing, root)
    assert first.load and first.taken.count() == 1 and rows(read_loaded(spark, root, SHAPE)) == [(1, "v1"), (2, "v2")]
    again = run(spark, landing, root)
    assert again.load is None and again.changed.count() == 0 and read_loaded(spark, root, SHAPE).count() == 2
    drop(spark, landing, 3)
    drop(spark, landing, 4)
    assert run(spark, landing, root).taken.count() == 2 and read_loaded(spark, root, SHAPE).count() == 4
    name = loaded_files(spark, root).where(F.col("_load") == first.load).first().path.removeprefix("file:")
    with open(name, "a", encoding="utf-8") as f:
        f.write("9,v9\n")
    changed = run(spark, landing, root)
    found = changed.changed.first()
    assert changed.load is None and found.path.endswith(name) and found.size == found.size_then + 5 and read_loaded(spark, root, SHAPE).count() == 4


def test_a_load_that_died_is_done_again(spark, monkeypatch):
    landing, root = scratch_path(spark, "in"), scratch_path(spark, "out")
    drop(spark, landing, 1)
    run(spark, landing, root)
    drop(spark, landing, 2)
    whole = ledger._load

    def dies(spark_, root_, load, *rest):
        spark_.createDataFrame([(-1, "half")], SHAPE).write.parquet(f"{root_}/data/_load={load}")       # half of the data, and no word that it is done
        raise RuntimeError("died")

    monkeypatch.setattr(ledger, "_load", dies)
    with pytest.raises(RuntimeError):
        run(spark, landing, root)
    monkeypatch.setattr(ledger, "_load", whole)
    assert rows(read_loaded(spark, root, SHAPE)) == [(1, "v1")]
    drop(spark, landing, 3)
    after = run(spark, landing, root)
    assert after.taken.count() == 1 and rows(read_loaded(spark, root, SHAPE)) == [(1, "v1"), (2, "v2"), (3, "v3")]


def test_differences_are_those_of_the_full_comparison(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([None, i]), rnd.choice([None, float(i)]), f"t{i}") for i in range(300)]
    data = list({r[0]: r for r in data}.values())
    other = [(k, v if rnd.random() > 0.02 else 5.5, t) for k, v, t in data if rnd.random() > 0.02] + [(1000, 1.0, "new")]
    a, b = (spark.createDataFrame(x, "k long, v double, t string").repartition(3) for x in (data, other))
    got = compare_by_bucket(a, b, ["k"], ["v", "t"], buckets=64)
    assert rows(got) == rows(compare_by_key(a, b, ["k"], ["v", "t"])) and got.count() > 3
    assert 0 < len(differing_buckets(a, b, ["k"], ["v", "t"], 64)) < 40
    assert differing_buckets(a, a.repartition(7).orderBy(F.desc("t")), ["k"], ["v", "t"], 64) == [] and compare_by_bucket(a, a, ["k"], ["v"]).count() == 0
    twice = a.union(a.where("k = 5"))
    assert len(differing_buckets(a, twice, ["k"], ["v", "t"], 64)) == 1
    swapped = a.withColumn("v", F.when(F.col("k").isin(1, 2), 3 - F.col("k")).otherwise(F.col("v")))
    assert bucket_fingerprints(swapped, ["k"], ["v", "t"], F.lit(0)).first() != bucket_fingerprints(a, ["k"], ["v", "t"], F.lit(0)).first()


def test_equal_buckets_are_not_read_again(spark):
    frame = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    paths = [scratch_path(spark, "side") for _ in range(2)]
    for path, df in zip(paths, (frame, frame.withColumn("v", F.when(F.col("k") == 77, 0).otherwise(F.col("v"))))):
        df.withColumn("b", key_bucket(["k"], 16)).write.partitionBy("b").parquet(path)
    a, b = (spark.read.parquet(p) for p in paths)
    differ = differing_buckets(a, b, ["k"], ["v"], bucket_col="b")
    assert differ == [frame.where("k = 77").select(key_bucket(["k"], 16)).first()[0]]
    out = compare_by_bucket(a, b, ["k"], ["v"], bucket_col="b")
    assert rows(out) == [(77, 154, 0, "value_mismatch")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    found = re.findall(r"PartitionFilters: \[([^\]]*)", plan)
    assert len(found) >= 2 and all(f"= {differ[0]})" in f for f in found)
