"""Late rows of a type-2 dimension in any order, and interval checks, against plain folds."""

import random

import pytest
from pyspark.sql import functions as F

from strata.config import SCD2_DIM_SCHEMA as DIM
from strata.operators.history import apply_late_rows, check_scd2_intervals, interval_faults
from strata.operators.quality import check_scd2

INC = "customer_id string, status string, updated_at string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def fold(dim, batches):
    """The history of every touched key from all its observations at once."""
    touched = {k for b in batches for k, _, _ in b}
    out = [r for r in dim if r[0] not in touched]
    for key in touched:
        own = [r for r in dim if r[0] == key]
        events = {}
        low = lambda v: (v is not None, v or "")
        for _, value, start, end, _, _ in own:
            for at, state in ((start, (True, value)), (end, (False, None))):
                if state[0] or at is not None:
                    events[at] = max(events.get(at, (False, None)), state, key=lambda s: (s[0], low(s[1])))
        for b in batches:
            for k, value, at in b:
                if k == key:
                    events[at] = max(events.get(at, (False, None)), (True, value), key=lambda s: (s[0], low(s[1])))
        changes, last = [], (False, "start")
        for at in sorted(events, key=low):
            if events[at] != last and not (last == (False, "start") and not events[at][0]):
                changes.append((at, events[at]))
                last = events[at]
        number = min([1 if r[5] is None else r[5] for r in own], default=1)
        for i, (at, (is_open, value)) in enumerate(changes):
            if is_open:
                after = changes[i + 1][0] if i + 1 < len(changes) else None
                out.append((key, value, at, after, i + 1 == len(changes), number))
                number += 1
    return sorted(out, key=str)


def apply_all(spark, dim, batches, **options):
    now, hidden = spark.createDataFrame(dim, DIM), None
    for b in batches:
        now, hidden = apply_late_rows(now, spark.createDataFrame(b, INC), hidden, **options)
    return now


def test_a_late_row_splits_the_version_it_falls_into(spark):
    dim = [("P", "gold", "2020-01-01", "2022-01-01", False, 4), ("P", "lead", "2022-01-01", None, True, 5), ("Q", "tin", "2020-01-01", None, True, 1)]
    out = apply_all(spark, dim, [[("P", "iron", "2021-01-01")]])
    assert rows(out) == [("P", "gold", "2020-01-01", "2021-01-01", False, 4), ("P", "iron", "2021-01-01", "2022-01-01", False, 5),
                         ("P", "lead", "2022-01-01", None, True, 6), ("Q", "tin", "2020-01-01", None, True, 1)]
    before = apply_all(spark, dim, [[("P", "lead", "2021-06-01"), ("P", "old", "2019-01-01")]])
    assert rows(before) == [("P", "gold", "2020-01-01", "2021-06-01", False, 5), ("P", "lead", "2021-06-01", None, True, 6),
                            ("P", "old", "2019-01-01", "2020-01-01", False, 4), ("Q", "tin", "2020-01-01", None, True, 1)]


def test_a_repeat_counts_when_something_comes_between(spark):
    dim = [("K", "A", "2020", None, True, 1)]
    for order in ([("K", "A", "2022")], [("K", "B", "2021")]), ([("K", "B", "2021")], [("K", "A", "2022")]):
        assert rows(apply_all(spark, dim, list(order))) == [
            ("K", "A", "2020", "2021", False, 1), ("K", "A", "2022", None, True, 3), ("K", "B", "2021", "2022", False, 2)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_any_order_of_the_batches_gives_the_fold(spark, seed):
    rnd = random.Random(seed)
    dim = []
    for key in ("a", "b", "c", None):
        cuts = sorted(rnd.sample(range(20, 80, 5), 4))
        for n, (start, end) in enumerate(zip(cuts, cuts[1:] + [None])):
            if rnd.random() < 0.25 and end is not None:
                end -= 2                                 # a version that ends before the next one starts
            dim.append((key, rnd.choice(["x", "y", "z", None]), f"20{start}", None if end is None else f"20{end}", end is None, n + 2))
    batches = [[(rnd.choice(["a", "b", "n", None]), rnd.choice(["x", "y", None]), rnd.choice([None, *(f"20{i}" for i in range(10, 99))]))
                for _ in range(rnd.randint(1, 12))] for _ in range(3)]
    batches.append(batches[0][:2])                       # rows that come twice
    want = fold(dim, batches)
    rnd.shuffle(batches)
    out = apply_all(spark, dim, batches, **({"broadcast_max_bytes": 0} if seed == 2 else {}))
    assert rows(out) == want
    touched = out.where(F.col("customer_id").isin("a", "b", "n"))
    assert {r.violations for r in check_scd2(touched).where("check_name <> 'closed_row_has_successor'").collect()} == {0}
    assert [r.violations for r in check_scd2_intervals(touched).where("check_name = 'intervals_do_not_overlap'").collect()] == [0]


def test_empty_batches_other_columns_and_a_key_over_many_ranges(spark):
    dim = spark.createDataFrame([("h", "s", 0, None, True, 1, "first"), ("h", "t", 5000, None, True, 2, "second"), ("o", "s", 0, None, True, 1, "other")],
                                "customer_id string, status string, valid_from int, valid_to int, is_current boolean, version_no long, note string")
    dim = dim.withColumn("valid_to", F.when(F.col("note") == "first", 5000).otherwise(F.col("valid_to"))).withColumn("is_current", F.col("valid_to").isNull())
    same, none = apply_late_rows(dim, spark.createDataFrame([], "customer_id string, status string, updated_at int"))
    assert rows(same) == rows(dim) and none.count() == 0
    batch = spark.range(1, 4001, 1, 5).select(F.lit("h").alias("customer_id"), F.concat(F.lit("s"), F.col("id") % 7).alias("status"), F.col("id").cast("int").alias("updated_at"))
    out, hidden = apply_late_rows(dim, batch.orderBy(F.desc("updated_at")))
    assert out.count() == 4003 and hidden.count() == 0 and out.schema == dim.schema
    hot = out.where("customer_id = 'h'")
    assert hot.where("valid_from BETWEEN 1 AND 3999 AND valid_to = valid_from + 1 AND version_no = valid_from + 1 AND note = 'first'").count() == 3999
    assert rows(hot.where("is_current")) == [("h", "t", 5000, None, True, 4002, "second")]
    given, _ = apply_late_rows(dim, batch.limit(1).withColumn("note", F.lit("given")))
    assert given.where("note = 'given'").count() == 1


def test_intervals_against_a_scan_in_order(spark):
    rnd = random.Random(4)
    data = []
    for key in [None, *range(6)]:
        at = 0
        for _ in range(60 if key == 3 else 8):
            start = at + rnd.choice([0, 0, 0, 0, -2, 3])
            end = start + rnd.randint(0, 5)
            at = max(at, end)
            data.append((key, start, end))
        data.append((key, at, None))
        if key in (1, 4):
            data += [(key, at + 5, at + 6), (key, None, 1)]
    want = []
    for key in {r[0] for r in data}:
        reach = None
        for _, start, end in sorted((r for r in data if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is None, r[2] or 0)):
            if reach is not None:
                if reach == "open" or start is None or reach > start:
                    want.append((key, start, None if reach == "open" else reach, "overlap"))
                elif reach < start:
                    want.append((key, start, reach, "gap"))
            reach = "open" if end is None or reach == "open" else end if reach is None else max(reach, end)
    df = spark.createDataFrame(data, "customer_id int, valid_from int, valid_to int").repartition(5)
    assert rows(interval_faults(df)) == sorted(want, key=str) and len(want) > 20
    found = {r.check_name: r.violations for r in check_scd2_intervals(df).collect()}
    assert found == {"intervals_do_not_overlap": sum(w[3] == "overlap" for w in want), "intervals_leave_no_gap": sum(w[3] == "gap" for w in want)}
    assert rows(interval_faults(df.limit(0))) == []
