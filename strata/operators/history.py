"""Histories of a type-2 dimension that do not depend on the order in which rows arrive, and checks of their intervals.

A history is the fold of a key's observations in the order of their instants:
an observation that differs from the one before opens a version, which the
next one closes.  A late row therefore splits the version that it falls into.
Rows are range-partitioned by (key, instant); neighbours are compared within a
range, and across ranges through one summary row per key and range, so a key
that holds much of the table spreads over many tasks.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality import _finish
from strata.operators.scd import _with
from strata.operators.keymap import broadcast_bytes
from strata.session import stored


class History(NamedTuple):
    """The dimension after a batch, and the observations that it does not show (rows that repeat the value before them)."""

    dimension: DataFrame
    hidden: DataFrame


def _ranged(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` written in the order of key and instant, with the number of the range that each is in."""
    return stored(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")


def _events(dim: DataFrame, key: str, attribute: str, start: str, end: str, others: list[str]) -> DataFrame:
    """``_k, _ts, _open, _val, _number, _rest``: what the dimension shows: each version's start, and ends that no version follows."""
    rest = F.struct(*others) if others else F.struct(F.lit(True).alias("_none"))
    starts = dim.select(F.col(key).alias("_k"), F.col(start).alias("_ts"), F.lit(True).alias("_open"), F.col(attribute).alias("_val"), rest.alias("_rest"))
    ends = dim.where(F.col(end).isNotNull()).select(
        F.col(key).alias("_k"), F.col(end).cast(dim.schema[start].dataType).alias("_ts"), F.lit(False).alias("_open"), F.lit(None).cast(dim.schema[attribute].dataType).alias("_val"),
        F.lit(None).cast(starts.schema["_rest"].dataType).alias("_rest"))
    return starts.unionByName(ends)


def _fold(rows: DataFrame, base: DataFrame) -> DataFrame:
    """``rows`` (one per ``_k, _ts``) with ``_changes`` (differs from the one before), ``_full`` (``_rest`` carried on), ``_after`` (next change), ``_version``."""
    rows = _ranged(rows, F.col("_k").asc_nulls_first(), F.col("_ts").asc_nulls_first())
    within = Window.partitionBy("_k", "_range").orderBy(F.col("_ts").asc_nulls_first())
    across = Window.partitionBy("_k").orderBy("_range")
    state = F.struct("_open", "_val")
    ends = rows.groupBy("_k", "_range").agg(F.max(F.struct(F.struct("_ts"), state.alias("state"))).alias("_end"),
                                            F.max_by("_rest", F.struct(F.col("_rest").isNotNull().alias("given"), F.col("_ts"))).alias("_known"))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_k", "_range", F.lag("_end").over(across).alias("_earlier"), F.last("_known", ignorenulls=True).over(before).alias("_carried"))
    seen = rows.withColumns({"_previous": F.lag(state).over(within), "_filled": F.last("_rest", ignorenulls=True).over(within)})
    seen = _with(seen, ends, "_k", "_range").withColumn("_previous", F.coalesce("_previous", "_earlier.state"))
    # the first observation of a key changes something unless it is an end
    changes = F.when(F.col("_previous").isNull(), F.col("_open")).otherwise(~state.eqNullSafe(F.col("_previous")))
    seen = stored(seen.select("_k", "_range", "_ts", "_open", "_val", "_rest", F.coalesce("_filled", "_carried").alias("_full"), changes.alias("_changes")), "observed")

    changed = seen.where("_changes")
    counts = changed.groupBy("_k", "_range").agg(F.count_if("_open").alias("_n"), F.min(F.struct("_ts")).alias("_head"))
    counts = counts.select("_k", "_range", (F.sum("_n").over(across) - F.col("_n")).alias("_passed"), F.lead("_head").over(across).alias("_next_head"))
    counts = _with(counts, base, "_k")
    running = within.rowsBetween(Window.unboundedPreceding, 0)
    numbered = changed.withColumns({"_row": F.count_if("_open").over(running), "_next": F.lead(F.struct("_ts")).over(within)})
    numbered = _with(numbered, counts, "_k", "_range").withColumns({"_after": F.coalesce("_next", "_next_head"), "_version": F.coalesce("_base", F.lit(1)) + F.col("_passed") + F.col("_row") - 1})
    return numbered.unionByName(seen.where("NOT _changes"), allowMissingColumns=True)


def apply_late_rows(dim_df: DataFrame, incoming_df: DataFrame, hidden: DataFrame | None = None, business_key: str = "customer_id", change_col: str = "status",
                    effective_start_col: str = "valid_from", effective_end_col: str = "valid_to", is_current_col: str = "is_current",
                    version_col: str = "version_no", incoming_ts_col: str = "updated_at", broadcast_max_bytes: int = 16 << 20) -> History:
    """Apply a batch to a type-2 dimension wherever in time its rows fall.

    * a row that differs from the value at its instant opens a version there, up to the next observation that differs;
      one that repeats it opens nothing, but is kept in ``hidden`` and counts when a later batch comes between;
    * of one key and instant the greatest attribute counts; a version that had ended without a successor stays ended;
    * versions of the touched keys are numbered anew from the smallest number that the key had (a NULL counts as 1);
      the last one is current if it has not ended.  Other keys stay as they are;
    * columns beyond the managed ones come from the batch row that opens a version if the batch has all of them, else
      from the version before it.

    With ``hidden`` from the batch before handed to the next one, the history after several batches is the same in
    whatever order they came.  Keys and attributes compare null-safely; an empty batch returns what there was.
    """
    schema, columns, k, c = dim_df.schema, dim_df.columns, business_key, change_col
    managed = {k, c, effective_start_col, effective_end_col, is_current_col, version_col}
    others = [x for x in columns if x not in managed]
    events = _events(dim_df, k, c, effective_start_col, effective_end_col, others)
    kinds = {f.name: f.dataType for f in events.schema}
    # what the batch has, and the dimension's other columns where it has them; the rest is carried from the version before
    given = [F.col(x).cast(schema[x].dataType).alias(x) if x in incoming_df.columns else F.lit(None).cast(schema[x].dataType).alias(x) for x in others]
    whole = bool(others) and all(x in incoming_df.columns for x in others)
    rest = F.struct(*given) if whole else F.lit(None).cast(kinds["_rest"])
    batch = incoming_df.select(F.col(k).cast(kinds["_k"]).alias("_k"), F.col(incoming_ts_col).cast(kinds["_ts"]).alias("_ts"), F.lit(True).alias("_open"),
                               F.col(c).cast(kinds["_val"]).alias("_val"), rest.alias("_rest"))
    batch = stored(batch.groupBy("_k", "_ts").agg(F.max("_open").alias("_open"), F.max("_val").alias("_val"), F.max_by("_rest", "_val").alias("_rest")), "late-batch")
    earlier = batch.limit(0) if hidden is None else hidden.select(*batch.columns)

    keys = stored(batch.select("_k").distinct(), "late-keys")
    small = broadcast_bytes(keys) <= broadcast_max_bytes
    touched = keys.withColumnRenamed("_k", "_touched")
    touched = F.broadcast(touched) if small else touched

    def split(frame: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
        on = frame[column].eqNullSafe(touched["_touched"])
        return frame.join(touched, on, "left_semi"), frame.join(touched, on, "left_anti")

    own, untouched = split(dim_df, k)
    own_hidden, other_hidden = split(earlier, "_k")
    base = own.groupBy(F.col(k).alias("_k")).agg(F.min(F.coalesce(F.col(version_col), F.lit(1))).cast("long").alias("_base"))
    every = _events(own, k, c, effective_start_col, effective_end_col, others).unionByName(own_hidden).unionByName(batch)
    # of one instant an observation beats an end, the greatest value the others
    rows = every.groupBy("_k", "_ts").agg(
        F.max(F.struct("_open", "_val")).alias("_state"),
        F.max_by("_rest", F.struct(F.col("_rest").isNotNull().alias("given"), F.col("_open"), F.col("_val"))).alias("_rest")).select("_k", "_ts", "_state.*", "_rest")
    folded = stored(_fold(rows, base), "folded")
    shown = folded.where("_changes AND _open")
    made = {k: F.col("_k"), c: F.col("_val"), effective_start_col: F.col("_ts"), effective_end_col: F.col("_after._ts"),
            is_current_col: F.col("_after").isNull(), version_col: F.col("_version"), **{x: F.col(f"_full.{x}") for x in others}}
    versions = shown.select(*[made[x].cast(schema[x].dataType).alias(x) for x in columns])
    kept = folded.where("NOT _changes AND _open").select(*batch.columns)
    return History(untouched.unionByName(versions), other_hidden.unionByName(kept))


def interval_faults(df: DataFrame, business_key: str = "customer_id", start_col: str = "valid_from", end_col: str = "valid_to") -> DataFrame:
    """Versions that do not start where the ones before them (of their key, by start) end: ``business_key, start_col, reached, fault``.

    ``fault`` is ``overlap`` (an earlier version reaches beyond the start; a NULL end reaches to the end of time, and
    ``reached`` is NULL) or ``gap`` (all earlier ones end before it).  Versions without a start come first; of two that
    start together the second one overlaps, unless the first is empty.
    """
    rows = df.select(F.col(business_key).alias("_k"), F.col(start_col).alias("_from"), F.struct(F.col(end_col).isNull().alias("open"), F.col(end_col).alias("end")).alias("_to"))
    order = (F.col("_k").asc_nulls_first(), F.col("_from").asc_nulls_first(), F.col("_to").asc())
    rows = _ranged(rows, *order)
    within = Window.partitionBy("_k", "_range").orderBy(F.col("_from").asc_nulls_first(), F.col("_to").asc()).rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy("_k", "_range").agg(F.max("_to").alias("_reach"))
    ends = ends.select("_k", "_range", F.max("_reach").over(across).alias("_earlier"))
    seen = _with(rows.withColumn("_own", F.max("_to").over(within)), ends, "_k", "_range")
    # greatest skips NULLs: no version before within the range, or in earlier ranges
    reached = F.when(F.col("_own").isNull(), F.col("_earlier")).when(F.col("_earlier").isNull() | (F.col("_own") >= F.col("_earlier")), F.col("_own")).otherwise(F.col("_earlier"))
    seen = seen.withColumn("_reached", reached).where(F.col("_reached").isNotNull())
    first = F.col("_from").isNull()
    fault = (F.when(F.col("_reached.open") | first | (F.col("_reached.end") > F.col("_from")), "overlap")
             .when(F.col("_reached.end") < F.col("_from"), "gap"))
    return seen.select(F.col("_k").alias(business_key), F.col("_from").alias(start_col), F.col("_reached.end").alias("reached"), fault.alias("fault")).where("fault IS NOT NULL")


def check_scd2_intervals(df: DataFrame, business_key: str = "customer_id", start_col: str = "valid_from", end_col: str = "valid_to") -> DataFrame:
    """V15 on neighbouring versions: none overlaps an earlier one of its key, none starts after a gap."""
    found = interval_faults(df, business_key, start_col, end_col).agg(*[F.count_if(F.col("fault") == f).alias(f) for f in ("overlap", "gap")])
    return _finish(found.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.lit(column).alias("column_name"), F.col(n).cast("long").alias("violations"))
        for name, column, n in (("intervals_do_not_overlap", start_col, "overlap"), ("intervals_leave_no_gap", start_col, "gap"))]))))
