"""Measure task balance of the keyed operators when ONE key holds a third of the rows.

Usage: python tools/skew_report.py [sf_dir]
Input: ``lineitem`` of the given scale with every third row re-keyed onto key 1.
Each operator runs as its own labelled job with Spark's event log written to a
fresh scratch folder; the report lists, per operator, the largest number of
shuffle records any single reduce task read against the median task.  A hot key that reached one reducer whole would
show up as a task reading about a third of all rows.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from strata.operators.curated import build_curated_customer_metrics  # noqa: E402
from strata.operators.enrich import enrich_with_reference_data  # noqa: E402
from strata.operators.scd import apply_scd_type_2  # noqa: E402
from strata.operators.incremental import create_cdc_incremental_load, deduplicate_customer_records  # noqa: E402
from strata.operators.keymap import join_key_map, key_map  # noqa: E402
from strata.operators.reconcile import key_differences, reconcile_fact_dimension  # noqa: E402
from strata.session import build_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="strata-skew-")
    os.makedirs(f"{scratch}/events", exist_ok=True)   # must exist before the context starts
    spark = build_session("local[8]", app_name="strata-skew", shuffle_partitions=16, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{scratch}/events",
        "spark.eventLog.rolling.enabled": "false", "spark.eventLog.compress": "false",
        "spark.checkpoint.dir": f"{scratch}/checkpoint", "spark.sql.warehouse.dir": f"{scratch}/wh",
        # measure the shuffled paths: no size-based automatic broadcast, and no
        # coalescing of (tiny) reduce partitions, so one partition = one task
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    # spread the single input file over 16 tasks, as a multi-file table would be
    hot = li.select(F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("l_orderkey")).alias("k"),
                    "l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", "l_returnflag").repartition(16)
    total = hot.count()
    hot_rows = hot.where("k = 1").count()

    ops = {
        "curated KPIs (groupBy)": lambda: build_curated_customer_metrics(hot.select(
            F.col("k").alias("customer_id"), F.round("l_extendedprice", 2).alias("amount"),
            F.col("l_shipdate").cast("date").alias("signup_date"), (F.col("l_returnflag") == "N").alias("is_active"),
            (F.col("l_extendedprice") > 50000).alias("is_high_value"), (F.col("l_returnflag") == "R").alias("needs_review"))),
        "dedup latest per key": lambda: deduplicate_customer_records(hot, ["k"], ["l_shipdate"]),
        "key reconciliation": lambda: key_differences(hot.select("k"), hot.where("k % 4 <> 0").select("k"), ["k"]),
        "CDC delta": lambda: create_cdc_incremental_load(
            hot.where("l_linenumber % 2 = 0").select(F.col("k").alias("customer_id"), F.col("l_shipdate").alias("updated_at")),
            hot.where("l_linenumber % 2 = 1").select(F.col("k").alias("customer_id"), F.col("l_shipdate").alias("updated_at"),
                                                     "l_orderkey", "l_linenumber"),
            broadcast_max_bytes=0),
        "orphan facts": lambda: reconcile_fact_dimension(
            hot.select(F.col("k").alias("customer_id"), "l_orderkey"),
            hot.where("k % 4 <> 0 AND k <> 1").select(F.col("k").alias("customer_id")), broadcast_max_bytes=0),
        "key-map left join, hot split": lambda: join_key_map(
            hot, "k", key_map(hot, "k", hot.where("l_linenumber = 1").select(F.col("k").alias("kk"), F.col("l_shipdate").alias("t")),
                              "kk", {"t": F.max("t")}), "left", broadcast_max_bytes=0),
        "lookup enrichment (large lookup)": lambda: enrich_with_reference_data(
            hot, hot.where("l_linenumber = 1").select("k", F.col("l_returnflag").alias("seg")),
            join_key="k", lookup_key="k", value_col="seg", broadcast_max_bytes=0),
        "SCD2 apply": lambda: apply_scd_type_2(
            hot.where("l_linenumber = 1").groupBy("k").agg(F.max("l_returnflag").alias("status")).select(
                F.col("k").alias("customer_id"), "status", F.lit("2023-01-01").alias("valid_from"),
                F.lit(None).cast("string").alias("valid_to"), F.lit(True).alias("is_current"),
                F.lit(1).cast("long").alias("version_no")),
            hot.select(F.col("k").alias("customer_id"), F.col("l_returnflag").alias("status"),
                       F.col("l_shipdate").cast("string").alias("updated_at"))),
    }
    for label, build in ops.items():
        spark.sparkContext.setJobDescription(label)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_label, tasks = {}, defaultdict(list)
    for path in glob.glob(f"{scratch}/events/**/*", recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    label = (ev.get("Properties") or {}).get("spark.job.description")
                    for sid in ev.get("Stage IDs", []):
                        if label:
                            stage_label[sid] = label
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    recs = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                    tasks[ev["Stage ID"]].append(recs)
    worst: dict[str, tuple] = {}
    for sid, recs in tasks.items():
        label = stage_label.get(sid)
        if not label or len(recs) < 2 or max(recs) == 0:
            continue
        med = statistics.median(recs)
        ratio = max(recs) / med if med else float("inf")
        if label not in worst or max(recs) > worst[label][0]:
            worst[label] = (max(recs), med, len(recs), ratio)
    lines = ["# Task balance with one key holding a third of the rows", "",
             f"Generated by `tools/skew_report.py` on `{sf}/lineitem.parquet`: {total:,} rows, of which {hot_rows:,} "
             f"({hot_rows / total:.0%}) re-keyed onto one key; local[8], 16 shuffle partitions, automatic broadcast "
             "off (the shuffled paths are measured) and AQE partition coalescing off (one reduce partition = one "
             "task), key maps forced past their broadcast bound; the input is first "
             "spread round-robin over 16 tasks, as a multi-file table would be. Records per task = shuffle records "
             "read (the reduce side, where a hot key would land), from Spark's event log. For each operator the "
             "reduce stage whose busiest task read the most records is shown; a hot key reaching one reducer "
             "whole would show as about 200,000 records in one task.", "",
             "| operator | busiest task (records) | median task | tasks in stage | busiest / median | busiest / hot-key rows |",
             "| --- | --- | --- | --- | --- | --- |"]
    for label in ops:
        if label in worst:
            mx, med, n, ratio = worst[label]
            lines.append(f"| {label} | {mx:,} | {med:,.0f} | {n} | {ratio:.1f} | {mx / hot_rows:.2f} |")
    out = "\n".join(lines) + "\n"
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "SKEW.md"), "w") as fh:
        fh.write(out)
    print(out)


if __name__ == "__main__":
    main()
