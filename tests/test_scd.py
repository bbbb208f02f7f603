from strata.config import SCD2_DIM_SCHEMA
from strata.operators.scd import apply_scd_type_2

DIM = SCD2_DIM_SCHEMA
INC = "customer_id string, status string, updated_at string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple("" if v is None else str(v) for v in t))


def test_a_change_closes_and_a_repeat_does_nothing(spark):
    dim = spark.createDataFrame([("P7", "gold", "2019-03-04", "9999-12-31", True, 6), ("P8", "tin", "2020-10-10", None, True, 2)], DIM)
    inc = spark.createDataFrame([("P8", "tin", "2021-01-02"), ("P7", "lead", "2021-01-01")], INC)
    out = apply_scd_type_2(dim, inc)
    assert out.columns == dim.columns and out.schema == dim.schema
    assert rows(out) == [("P7", "gold", "2019-03-04", "2021-01-01", False, 6), ("P7", "lead", "2021-01-01", None, True, 7),
                         ("P8", "tin", "2020-10-10", None, True, 2)]


def test_every_change_of_a_batch_is_kept(spark):
    dim = spark.createDataFrame([("K", "A", "2023-01-01", None, True, 1)], DIM)
    inc = spark.createDataFrame([("K", v, f"2024-{m:02d}-01") for m, v in enumerate("ABBAACB", 1)] + [("N", "X", "2024-05-01"), ("N", "Y", "2024-06-01")], INC)
    assert rows(apply_scd_type_2(dim, inc)) == rows(apply_scd_type_2(dim, inc, window_rows=0)) == [
        ("K", "A", "2023-01-01", "2024-02-01", False, 1), ("K", "A", "2024-04-01", "2024-06-01", False, 3),
        ("K", "B", "2024-02-01", "2024-04-01", False, 2), ("K", "B", "2024-07-01", None, True, 5),
        ("K", "C", "2024-06-01", "2024-07-01", False, 4),
        ("N", "X", "2024-05-01", "2024-06-01", False, 1), ("N", "Y", "2024-06-01", None, True, 2)]


def test_other_columns_and_a_key_over_many_ranges(spark):
    from pyspark.sql import functions as F
    dim = spark.createDataFrame([(None, "s0", 0, None, True, 1, "kept")],
                                "customer_id int, status string, valid_from int, valid_to int, is_current boolean, version_no long, note string")
    inc = spark.range(1, 4001, 1, 5).select(F.lit(None).cast("int").alias("customer_id"), F.concat(F.lit("s"), F.col("id") % 7).alias("status"),
                                            F.col("id").cast("int").alias("updated_at"), F.lit("given").alias("note"))
    inc = inc.union(inc.withColumn("customer_id", F.lit(5)).where("updated_at < 3"))
    out = apply_scd_type_2(dim, inc, window_rows=100)       # the key has more: its rows are spread over ranges
    assert sorted(map(str, apply_scd_type_2(dim, inc).collect())) == sorted(map(str, out.collect()))
    hot = out.where("customer_id IS NULL")
    assert hot.count() == 4001 and hot.where("is_current").first().version_no == 4001
    assert hot.where("NOT is_current AND valid_to <> valid_from + 1").count() == 0
    assert {r.note for r in hot.collect()} == {"kept"} and {r.note for r in out.where("customer_id = 5").collect()} == {"given"}


def test_new_vanished_null_cases_and_history(spark):
    dim = spark.createDataFrame([
        ("K1", "A", "2023-01-01", None, True, None),        # NULL version counts as 1
        ("K1", "OLD", "2022-01-01", "2023-01-01", False, 0),  # closed history
        ("K2", None, "2023-01-01", None, True, 1),          # NULL attribute
        ("K3", "C", "2023-01-01", None, True, 4),           # vanished from incoming
        (None, "N", "2023-01-01", None, True, 1),           # NULL key, matched null-safely
    ], DIM)
    inc = spark.createDataFrame([
        ("K1", "B", "2024-01-01"), ("K1", "Z", "2024-03-01"),  # two rows: two versions
        ("K2", None, "2024-01-01"),                            # NULL == NULL: unchanged
        ("K9", "NEW", "2024-01-01"),                           # new key
        (None, "M", "2024-01-01"),                             # NULL key changes
    ], INC)
    full = rows(apply_scd_type_2(dim, inc))
    assert full == rows(apply_scd_type_2(dim, inc, window_rows=0))
    assert full == rows(spark.createDataFrame([
        ("K1", "A", "2023-01-01", "2024-01-01", False, None),
        ("K1", "B", "2024-01-01", "2024-03-01", False, 2),
        ("K1", "Z", "2024-03-01", None, True, 3),
        ("K1", "OLD", "2022-01-01", "2023-01-01", False, 0),
        ("K2", None, "2023-01-01", None, True, 1),
        ("K3", "C", "2023-01-01", None, True, 4),
        ("K9", "NEW", "2024-01-01", None, True, 1),
        (None, "N", "2023-01-01", "2024-01-01", False, 1),
        (None, "M", "2024-01-01", None, True, 2),
    ], DIM))
    current_only = rows(apply_scd_type_2(dim, inc, keep_history=False))
    assert ("K1", "OLD", "2022-01-01", "2023-01-01", False, 0) not in current_only
    assert len(current_only) == len(full) - 1


def test_invariants_hold_after_apply(spark):
    from strata.operators.quality import check_scd2
    dim = spark.createDataFrame([(f"K{i}", "A", "2023-01-01", None, True, 1) for i in range(50)], DIM)
    inc = spark.createDataFrame([(f"K{i}", "B" if i % 2 else "A", "2024-01-01") for i in range(0, 80, 3)], INC)
    out = apply_scd_type_2(dim, inc)
    assert {r["check_name"]: r["violations"] for r in check_scd2(out).collect()} == {
        "one_current_row_per_key": 0, "unique_version_per_key": 0, "closed_row_has_successor": 0, "interval_not_backwards": 0}


def test_broken_histories_are_reported(spark):
    from strata.operators.quality import check_scd2
    dim = spark.createDataFrame([("K", "A", "2023-01-01", None, True, 1), ("L", "A", "2020-01-01", "2021-01-01", False, 1)], DIM)
    out = apply_scd_type_2(dim, spark.createDataFrame([("K", "B", "2022-01-01")], INC))
    assert {r["check_name"]: r["violations"] for r in check_scd2(out).collect()} == {
        "one_current_row_per_key": 1, "unique_version_per_key": 0, "closed_row_has_successor": 1, "interval_not_backwards": 1}


def test_nothing_to_apply_returns_dimension_unchanged(spark):
    closed = spark.createDataFrame([("K1", "A", "2023-01-01", "2023-06-01", False, 1)], DIM)
    empty = spark.createDataFrame([], INC)
    assert rows(apply_scd_type_2(closed, empty, keep_history=False)) == rows(closed)
    assert rows(apply_scd_type_2(closed, empty, keep_history=True)) == rows(closed)
