"""Slowly changing dimension, type 2 (D5), with every change of a batch.

The batch is reduced to one row per key and instant.  When no key has more rows
than one task may well order (the largest is counted first), a window per key
compares neighbours.  Otherwise the rows are range-partitioned by (key,
instant) and written.  A key that holds much of the batch spreads over
several ranges: neighbours are compared within a range by a window over
(key, range), and across ranges through one summary row per key and range.  So
no task has to hold all rows of one key, and no row leaves the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.session import stored


def _with(rows: DataFrame, side: DataFrame, *keys: str, how: str = "left") -> DataFrame:
    """``rows`` joined null-safely on ``keys`` with ``side``, whose keys are dropped."""
    right = side.withColumnsRenamed({c: f"{c}_side" for c in keys})
    on = [F.col(c).eqNullSafe(F.col(f"{c}_side")) for c in keys]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    return rows.join(right, condition, how).drop(*[f"{c}_side" for c in keys])


#: Rows of one key up to which a window per key orders a batch.
WINDOW_ROWS = 200_000


def _plain_changes(rows: DataFrame, before: DataFrame) -> DataFrame:
    """The versions that ``rows`` open, by one window per key."""
    order = Window.partitionBy("_k").orderBy(F.col("_ts").asc_nulls_first())
    # the struct tells "no earlier row" from "an earlier NULL"
    compared = _with(rows, before, "_k").withColumn(
        "_before", F.coalesce(F.lag(F.struct("_val")).over(order), F.when(F.col("_current").isNotNull(), F.struct(F.col("_current.val").alias("_val")))))
    kept = compared.where(F.col("_before").isNull() | ~F.col("_val").eqNullSafe(F.col("_before._val")))
    after = F.lead(F.struct("_ts")).over(order)
    return kept.select("_k", "_ts", "_val", after.getField("_ts").alias("_until"),
                       (F.coalesce("_current.version", F.lit(0)) + F.row_number().over(order)).alias("_version"), after.isNull().alias("_last"))


def _changes(dim: DataFrame, incoming: DataFrame, key: str, attribute: str, ts: str, current: Column, version: str, window_rows: int) -> DataFrame:
    """``_k, _ts, _val, _until, _version, _last``: the versions that the batch opens, in the dimension's types."""
    rows = incoming.groupBy(F.col(key).alias("_k"), F.col(ts).alias("_ts")).agg(F.max(attribute).alias("_val"))
    rows = rows.withColumns({"_k": F.col("_k").cast(dim.schema[key].dataType), "_val": F.col("_val").cast(dim.schema[attribute].dataType)})
    before = dim.where(current).groupBy(F.col(key).alias("_k")).agg(
        F.max(F.struct(F.coalesce(F.col(version), F.lit(1)).cast("long").alias("version"), F.col(attribute).alias("val"))).alias("_current"))
    largest = incoming.groupBy(key).count().agg(F.max("count")).first()[0] or 0
    if largest <= window_rows:
        return _plain_changes(rows, before)
    order = (F.col("_k").asc_nulls_first(), F.col("_ts").asc_nulls_first())
    rows = stored(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "scd-changes")

    within = Window.partitionBy("_k", "_range").orderBy(F.col("_ts").asc_nulls_first())
    across = Window.partitionBy("_k").orderBy("_range")
    ends = rows.groupBy("_k", "_range").agg(F.max(F.struct("_ts", "_val")).alias("_end"))
    ends = _with(ends, before, "_k").select("_k", "_range", "_current", F.lag("_end").over(across).alias("_earlier"))
    # the struct tells "no earlier row" from "an earlier NULL"
    compared = rows.withColumn("_previous", F.lag(F.struct("_val")).over(within))
    compared = _with(compared, ends, "_k", "_range").select(
        "_k", "_range", "_ts", "_val", F.col("_current.version").alias("_base"),
        F.coalesce("_previous", F.when(F.col("_earlier").isNotNull(), F.struct(F.col("_earlier._val").alias("_val"))),
                   F.when(F.col("_current").isNotNull(), F.struct(F.col("_current.val").alias("_val")))).alias("_before"))
    kept = stored(compared.where(F.col("_before").isNull() | ~F.col("_val").eqNullSafe(F.col("_before._val"))).drop("_before"), "scd-versions")

    counts = kept.groupBy("_k", "_range").agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct("_ts")).alias("_first"))
    counts = counts.select("_k", "_range", (F.sum("_n").over(across) - F.col("_n")).alias("_passed"), F.lead("_first").over(across).alias("_next_first"))
    numbered = kept.withColumns({"_row": F.row_number().over(within), "_next": F.lead(F.struct("_ts")).over(within)})
    numbered = _with(numbered, counts, "_k", "_range").select(
        "_k", "_ts", "_val", F.coalesce("_next", "_next_first").alias("_after"),
        (F.coalesce("_base", F.lit(0)) + F.col("_passed") + F.col("_row")).alias("_version"))
    return stored(numbered.select("_k", "_ts", "_val", F.col("_after._ts").alias("_until"), "_version", F.col("_after").isNull().alias("_last")), "scd-opened")


def apply_scd_type_2(
    dim_df: DataFrame,
    incoming_df: DataFrame,
    business_key: str = "customer_id",
    change_col: str = "status",
    effective_start_col: str = "valid_from",
    effective_end_col: str = "valid_to",
    is_current_col: str = "is_current",
    version_col: str = "version_no",
    incoming_ts_col: str = "updated_at",
    keep_history: bool = True,
    window_rows: int = WINDOW_ROWS,
) -> DataFrame:
    """Apply an incoming batch to a type-2 dimension.

    * a key's incoming rows count in the order of their timestamps (of one instant the greatest attribute); rows that
      repeat the attribute before them open nothing;
    * every other row opens a version, numbered on from the current one (NULL counts as 1; a new key starts at 1), which
      the next one closes; the last one is open and current;
    * the current row is closed at the first such version; unchanged and absent keys are carried through;
    * of several rows with one key, instant and attribute the one with the greatest other columns (as JSON) fills them;
    * ``keep_history``: already-closed rows of ``dim_df`` are kept as well (``False``: only current rows and the
      transitions, or ``dim_df`` unchanged when it has no current row and the batch is empty).

    Keys and attributes compare null-safely.  The output keeps the dimension's schema and column order; columns that
    the batch has too are filled from the row that opens a new key, other columns of a further version are carried from
    the current row.  A batch row older than the current row makes an interval that ends before it starts, which
    :func:`strata.operators.quality.check_scd2` reports.
    """
    schema, cols, k, c = dim_df.schema, dim_df.columns, business_key, change_col
    current = F.col(is_current_col).eqNullSafe(F.lit(True))
    managed = {k, c, effective_start_col, effective_end_col, is_current_col, version_col}
    others = [x for x in cols if x not in managed]
    opened = _changes(dim_df, incoming_df, k, c, incoming_ts_col, current, version_col, window_rows)
    first = opened.groupBy(F.col("_k").alias("_fk")).agg(F.min(F.struct("_ts")).alias("_closed_at"))

    def row(frame: DataFrame, overrides: dict) -> DataFrame:
        return frame.select(*[(overrides[n] if n in overrides else F.col(n)).cast(schema[n].dataType).alias(n) for n in cols])

    now = dim_df.where(current)
    now = now.join(first, now[k].eqNullSafe(first["_fk"]), "left")
    closes = F.col("_closed_at").isNotNull()
    carried = row(now, {effective_end_col: F.when(closes, F.col("_closed_at._ts").cast(schema[effective_end_col].dataType)).otherwise(F.col(effective_end_col)),
                        is_current_col: ~closes})
    extra = {x: F.lit(None) for x in others}
    if others:
        filled = [x for x in others if x in incoming_df.columns]
        kept = dim_df.where(current).groupBy(F.col(k).alias("_ok")).agg(
            F.max_by(F.struct(*others), F.struct(F.coalesce(F.col(version_col), F.lit(1)), F.col(c), F.to_json(F.struct(*others)))).alias("_kept"))
        opened = opened.join(kept, opened["_k"].eqNullSafe(kept["_ok"]), "left")
        extra = {x: F.col(f"_kept.{x}") for x in others}
        if filled:
            given = incoming_df.groupBy(F.col(k).cast(schema[k].dataType).alias("_gk"), F.col(incoming_ts_col).alias("_gts")).agg(
                F.max_by(F.struct(*filled), F.struct(F.col(c), F.to_json(F.struct(*filled)))).alias("_given"))
            opened = opened.join(given, opened["_k"].eqNullSafe(given["_gk"]) & opened["_ts"].eqNullSafe(given["_gts"]), "left")
            extra |= {x: F.when(F.col("_kept").isNull(), F.col(f"_given.{x}")).otherwise(extra[x]) for x in filled}
    versions = row(opened, extra | {k: F.col("_k"), c: F.col("_val"), effective_start_col: F.col("_ts"), effective_end_col: F.col("_until"),
                                    is_current_col: F.col("_last"), version_col: F.col("_version")})
    result = carried.unionByName(versions)
    if keep_history:
        return result.unionByName(dim_df.where(~current))
    # Nothing comes out exactly when there is no current row and no incoming row; then the dimension is returned
    # unchanged.  Two emptiness probes (each stops at the first row found) decide it.
    if incoming_df.isEmpty() and dim_df.where(current).isEmpty():
        return dim_df
    return result
