"""Reference-data enrichment (D1): left lookup join with a default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.config import UNKNOWN
from strata.operators.keymap import DEFAULT_BROADCAST_BYTES, is_small, join_key_map, key_map
from strata.session import materialize

__all__ = ["enrich_with_reference_data"]


def enrich_with_reference_data(df: DataFrame, lookup_df: DataFrame, join_key: str = "customer_id",
                               lookup_key: str = "customer_id", value_col: str = "customer_segment",
                               default=UNKNOWN, broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Bring ``value_col`` from ``lookup_df`` (``default`` when absent), keep ``df``'s key.

    The lookup side is renamed (no ambiguity when both frames share names)
    and reduced to one value per key (greatest value), so duplicate lookup
    keys cannot multiply rows.  The reduced lookup is written once; when its
    measured bytes are within ``broadcast_max_bytes`` it is broadcast.  A larger one is
    first reduced to the keys ``df`` actually uses (one grouped pass with
    map-side combining, see :mod:`strata.operators.keymap`); that key map is
    broadcast when small, otherwise hot keys are joined map-side and
    the rest by a shuffle.  Rows whose key is NULL never match and bypass the
    join.  ``default`` takes the value's type (a text that cannot be cast to it is NULL).
    """
    lk, lv = "__lookup_key", "__lookup_value"
    out_cols = [c for c in df.columns if c != value_col] + [value_col]
    fallback = F.lit(default).try_cast(lookup_df.schema[value_col].dataType)

    def finish(frame: DataFrame) -> DataFrame:
        return frame.withColumn(value_col, F.coalesce(F.col(lv), fallback)).select(*out_cols)

    lookup = materialize(lookup_df.select(F.col(lookup_key).alias(lk), F.col(value_col).alias(lv))
                         .where(F.col(lk).isNotNull()).groupBy(lk).agg(F.max(lv).alias(lv)))
    if is_small(lookup, broadcast_max_bytes):
        return finish(df.join(F.broadcast(lookup), df[join_key] == lookup[lk], "left"))
    kmap = key_map(df, join_key, lookup, lk, {lv: F.max(lv)})
    return finish(join_key_map(df, join_key, kmap, "left", broadcast_max_bytes=broadcast_max_bytes))
