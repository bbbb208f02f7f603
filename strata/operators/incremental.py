"""Incremental-load operators: load markers (B8), CDC delta (D2) and
deterministic per-key deduplication (F1)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import UPSERT
from strata.operators.keymap import DEFAULT_BROADCAST_BYTES, is_small, join_key_map, key_map
from strata.session import materialize


# -- B8 ---------------------------------------------------------------------
def create_incremental_load_markers(df: DataFrame, load_date: str | None = None) -> DataFrame:
    """``load_date`` as text (given, or today when None / '') and ``is_latest_load`` = true."""
    effective = F.lit(load_date) if load_date else F.current_date().cast("string")
    return df.withColumns({"load_date": effective, "is_latest_load": F.lit(True)})


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


# -- F1 ---------------------------------------------------------------------
def deduplicate_customer_records(df: DataFrame, key_columns: Iterable[str],
                                 order_by: Iterable[str] | None = None, keep: str = "last") -> DataFrame:
    """One row per business key.

    Without ``order_by`` the survivor is arbitrary (``dropDuplicates``).
    With ``order_by`` the survivor is the row with the greatest (``keep='last'``)
    or smallest (``keep='first'``) ``order_by`` tuple; the remaining columns,
    in frame order, break ties (columns that cannot be ordered, such as maps, do not:
    among rows that differ in those alone any survives), and NULL orders below any value.  This is an
    aggregation of ``max(struct(...))``: every map task first reduces its own
    rows to one per key, so a key holding a third of all rows is collapsed
    before the shuffle instead of landing in one task as a window would.
    """
    keys = list(key_columns)
    if not order_by:
        return df.dropDuplicates(subset=keys)
    order = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    ties = [c for c in rest if _orderable(df.schema[c].dataType)]
    rank = F.struct(*[F.col(c) for c in order + ties])
    if len(ties) == len(rest):       # the rank is the whole row
        pick = (F.max if keep == "last" else F.min)(rank)
    else:
        pick = (F.max_by if keep == "last" else F.min_by)(F.struct(*[F.col(c) for c in order + rest]), rank)
    return (df.groupBy(*keys).agg(pick.alias("__survivor"))
              .select(*[F.col(k) for k in keys], *[F.col(f"__survivor.{c}").alias(c) for c in order + rest])
              .select(*df.columns))


# -- D2 ---------------------------------------------------------------------
def create_cdc_incremental_load(current_df: DataFrame, incoming_df: DataFrame, key_col: str = "customer_id",
                                timestamp_col: str = "updated_at",
                                broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Upsert delta: incoming rows whose key is new, or newer than the current version.

    The current side is reduced to its latest timestamp per key, restricted
    to the keys of the incoming batch (one grouped pass with map-side
    combining over both sides), so duplicate current keys cannot fan out the
    delta and no incoming hot key can skew a shuffle.  That key map is
    broadcast when proven small (the incoming batch is then never shuffled);
    otherwise hot keys are joined map-side and the rest by a shuffle (see
    :mod:`strata.operators.keymap`).  Equal timestamps are not newer (strict ``>``).
    Incoming rows with a NULL key can never match and are kept.

    A batch of few keys (by their measured bytes) filters the current table where it is read, so a small batch
    shuffles only the current rows of its own keys.
    """
    cur_ts = "__current_ts"
    keys = materialize(incoming_df.select(key_col).where(F.col(key_col).isNotNull()).distinct())
    if is_small(keys, broadcast_max_bytes):
        current_df = current_df.join(F.broadcast(keys), key_col, "left_semi")
    kmap = key_map(incoming_df, key_col, current_df.select(key_col, F.col(timestamp_col).alias(cur_ts)), key_col,
                   {cur_ts: F.max(cur_ts)})
    joined = join_key_map(incoming_df, key_col, kmap, "left", broadcast_max_bytes=broadcast_max_bytes)
    return (joined.where(F.col(cur_ts).isNull() | (F.col(timestamp_col) > F.col(cur_ts)))
            .select(key_col, *[c for c in incoming_df.columns if c != key_col], F.lit(UPSERT).alias("row_action")))
