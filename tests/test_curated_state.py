"""Curated KPIs kept by batches of changes against the full recomputation."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from strata.operators.curated import build_curated_customer_metrics
from strata.operators.curated_state import apply_changes, curated_of, read_rows, read_state
from strata.session import scratch_path

SHAPE = "customer_id string, amount double, signup_date date, is_active boolean, is_high_value boolean, needs_review boolean"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def draw(rnd):
    amount = rnd.choice([None, 0.1, 99.99, 1e-12, 1e20, float("nan"), float("inf"), round(rnd.random() * 900, 2)])
    return (rnd.choice(["a", "b", "c", None, f"k{rnd.randint(0, 30)}"]), amount, rnd.choice([None, dt.date(2020, 1, rnd.randint(1, 28))]),
            rnd.choice([True, False, None]), rnd.choice([True, False]), rnd.choice([True, False, None]))


def same(got, want):
    got, want = list(map(tuple, got)), list(map(tuple, want))
    def plain(r):
        return tuple("nan" if isinstance(v, float) and v != v else round(v, 6) if isinstance(v, float) and abs(v) < 1e15 else v for v in r)
    assert sorted(map(plain, got), key=str) == sorted(map(plain, want), key=str)


def test_batches_with_corrections_equal_the_full_recomputation(spark):
    rnd = random.Random(12)
    root, now = scratch_path(spark, "state"), []
    for number in range(1, 5):
        gone = rnd.sample(range(len(now)), len(now) // 3)
        fresh = [draw(rnd) for _ in range(60)]
        if number == 4:                                   # everything of one customer goes
            gone = sorted({*gone, *(i for i, r in enumerate(now) if r[0] == "a")})
            fresh = [r for r in fresh if r[0] != "a"]
        batch = [(*now[i], -1) for i in gone] + [(*r, 1) for r in fresh]
        now = [r for i, r in enumerate(now) if i not in set(gone)] + fresh
        frame = spark.createDataFrame(batch, SHAPE + ", change int")
        for _ in range(1 + number % 2):                   # some batches are run twice
            apply_changes(frame, root, number, buckets=8)
        want = build_curated_customer_metrics(spark.createDataFrame(now, SHAPE))
        same(rows(curated_of(read_state(spark, root))), rows(want))
        assert curated_of(read_state(spark, root)).schema.simpleString() == want.schema.simpleString()
    assert "a" not in {r[0] for r in now}
    same(rows(read_rows(spark, root, list(range(8)), 4).select(*spark.createDataFrame(now, SHAPE).columns)), now)


def test_a_batch_reads_and_writes_its_buckets_alone(spark):
    root = scratch_path(spark, "state")
    base = spark.range(400).select(F.concat(F.lit("c"), "id").alias("customer_id"), (F.col("id") / 4).alias("amount"), F.lit(dt.date(2020, 1, 1)).alias("signup_date"),
                                   F.lit(True).alias("is_active"), F.lit(False).alias("is_high_value"), F.lit(False).alias("needs_review"), F.lit(1).alias("change"))
    apply_changes(base, root, 1, buckets=16)
    before = set(read_state(spark, root).inputFiles())
    bucket = read_state(spark, root).where("customer_id = 'c7'").first().bucket
    apply_changes(base.where("customer_id = 'c7'").withColumn("amount", F.lit(1000.0)), root, 2, buckets=16)
    after = set(read_state(spark, root).inputFiles())
    assert before ^ after and all(f"/bucket={bucket}/" in f for f in before ^ after)
    plan = read_state(spark, root, [bucket])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert {r.total_amount for r in curated_of(read_state(spark, root)).where("customer_id = 'c7'").collect()} == {1001.75}
    assert read_state(spark, root).where("batch = 2").count() == 1 and read_state(spark, root).count() == 400


def test_dates_are_computed_again_only_when_they_may_have_gone(spark):
    root = scratch_path(spark, "state")
    days = [dt.date(2020, 1, d) for d in (1, 5, 9)]
    frame = spark.createDataFrame([("k", 1.0, d, True, False, False, 1) for d in days] + [(None, 2.0, None, None, None, None, 1)], SHAPE + ", change int")
    apply_changes(frame, root, 1, buckets=2)
    out = apply_changes(spark.createDataFrame([("k", 1.0, days[0], True, False, False, -1)], SHAPE + ", change int"), root, 2, buckets=2)
    assert rows(out.where("customer_id = 'k'").select("first", "last", "n_rows")) == [(days[1], days[2], 2)]
    empty = apply_changes(frame.limit(0), root, 3, buckets=2)
    assert empty.count() == 0 and curated_of(read_state(spark, root)).count() == 2
