"""Key maps: the one-row-per-key side of a lookup-style join, reduced to the
keys the driving frame actually uses.

A lookup-style join (left join / semi join where the other side has, or is
reduced to, one row per key) is skew-prone when it is a shuffled join: a
driving key that holds a third of all rows lands in one reducer.  Instead:

1. ``key_map``: tag the driving keys and the side rows, union them and group
   by key once -- a partial aggregate before the shuffle collapses any hot key
   to one row per map task -- and keep the keys the driving frame has;
2. ``join_key_map``: materialize that map in the shared checkpoint folder,
   measure its bytes, and broadcast it when they are few, so the driving
   frame is joined where it is read, without being shuffled; otherwise split
   the keys by heat -- hot keys (the map knows each key's driving row count)
   are joined map-side against a broadcast of their entries, the rest by a
   shuffled join in which no key is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

# Broadcast bound in bytes of the values (a row counts 16 bytes more); the size is measured, not estimated.
DEFAULT_BROADCAST_BYTES = 16 << 20
# A key is "hot" when it holds more driving rows than HOT_FACTOR average reduce
# partitions; hot keys are joined map-side against a broadcast of their entries
# instead of landing in one reducer.
HOT_FACTOR = 2
#: Columns that key maps add and drop again; frames with such a column are refused.
MAP_KEY, MAP_ROWS = "__map_key", "__map_rows"


def broadcast_bytes(df: DataFrame) -> int:
    """Bytes that broadcasting ``df`` would ship, from one distributed aggregate over it (pass a materialized frame)."""
    width = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns]
    size = df.agg(F.sum(sum(width, F.lit(16)).cast("long")).alias("n")).first()["n"]
    return size or 0


def is_small(df: DataFrame, most: int | None) -> bool:
    """Whether a materialized frame may be broadcast under a bound of ``most`` bytes (None: never)."""
    return most is not None and broadcast_bytes(df) <= most


def _refuse_reserved(df: DataFrame, *names: str) -> None:
    clash = sorted(set(df.columns) & set(names))
    if clash:
        raise ValueError(f"column names {clash} are reserved for key maps; rename them")


def key_map(driving_df: DataFrame, driving_key: str, side_df: DataFrame, side_key: str,
            aggs: dict[str, Column], key_alias: str = MAP_KEY) -> DataFrame:
    """``DataFrame[key_alias, __map_rows, *aggs]``: one row per non-NULL driving key.

    ``__map_rows`` is the number of driving rows with that key.  ``aggs`` maps output
    names to aggregate expressions over ``side_df`` columns (e.g.
    ``{"ts": F.max("updated_at")}``); they see NULL for the driving rows, so
    ignore-NULL aggregates (max, min, sum, count(col)) give the side's value,
    or NULL for a key the side lacks.
    """
    _refuse_reserved(side_df, key_alias, MAP_ROWS, "__drives")
    side_cols = sorted({c for c in side_df.columns if c != side_key})
    driving = driving_df.select(F.col(driving_key).alias(key_alias), F.lit(1).alias("__drives"),
                                *[F.lit(None).cast(side_df.schema[c].dataType).alias(c) for c in side_cols])
    side = side_df.select(F.col(side_key).alias(key_alias), F.lit(0).alias("__drives"), *side_cols)
    tagged = driving.unionByName(side).where(F.col(key_alias).isNotNull())
    return (tagged.groupBy(key_alias).agg(F.sum("__drives").cast("long").alias(MAP_ROWS),
                                          *[expr.alias(name) for name, expr in aggs.items()])
            .where(F.col(MAP_ROWS) > 0))


def hot_threshold(kmap: DataFrame) -> int:
    """Rows above which a key is hot: HOT_FACTOR x the average reduce partition.

    The total comes from one aggregate over the (materialized, one row per
    key) map; the partition count is the session's shuffle partition count.
    """
    total = kmap.agg(F.sum(MAP_ROWS).alias("t")).first()["t"] or 0
    try:
        parts = int(kmap.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    except (TypeError, ValueError):
        parts = 200
    return max(1, HOT_FACTOR * total // max(parts, 1))


def join_key_map(df: DataFrame, df_key: str, kmap: DataFrame, how: str = "left", key_alias: str = MAP_KEY,
                 broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES,
                 hot_key_rows: int | None = None) -> DataFrame:
    """Join ``df`` with a key map (``how`` = ``left`` or ``left_semi``).

    * map proven small: broadcast it, ``df`` is joined where it is read;
    * otherwise split by heat: keys with more than ``hot_key_rows`` driving
      rows (default: :func:`hot_threshold`, twice an average reduce partition;
      at most ``rows / hot_key_rows`` keys, measured) are broadcast
      and joined map-side; every other key goes through a shuffled join in
      which no key outweighs a couple of average partitions, so no reducer
      receives a hot key;
    * rows with a NULL key bypass the join: appended unchanged (map columns
      NULL) for ``left``, dropped for ``left_semi`` -- they can never match.
    """
    if how not in ("left", "left_semi"):
        raise ValueError("join_key_map supports how='left' or 'left_semi'")
    _refuse_reserved(df, key_alias, MAP_ROWS, "__hot_key")
    kmap = materialize(kmap)
    keyed = df.where(F.col(df_key).isNotNull())
    if is_small(kmap, broadcast_max_bytes):
        joined = keyed.join(F.broadcast(kmap), keyed[df_key] == kmap[key_alias], how)
    else:
        if hot_key_rows is None:
            hot_key_rows = hot_threshold(kmap)
        hot = kmap.where(F.col(MAP_ROWS) > hot_key_rows)
        cold = kmap.where(F.col(MAP_ROWS) <= hot_key_rows)
        if is_small(hot, broadcast_max_bytes or DEFAULT_BROADCAST_BYTES):
            marked = keyed.join(F.broadcast(hot.select(F.col(key_alias).alias("__hot_key"))),
                                keyed[df_key] == F.col("__hot_key"), "left")
            hot_rows = (marked.where(F.col("__hot_key").isNotNull()).drop("__hot_key")
                        .join(F.broadcast(hot), F.col(df_key) == hot[key_alias], how))
            cold_rows = (marked.where(F.col("__hot_key").isNull()).drop("__hot_key")
                         .join(cold, F.col(df_key) == cold[key_alias], how))
            joined = hot_rows.unionByName(cold_rows)
        else:  # pragma: no cover - more hot keys than the broadcast bound: plain shuffled join (AQE splits skew)
            joined = keyed.join(kmap, keyed[df_key] == kmap[key_alias], how)
    if how == "left":
        joined = joined.unionByName(df.where(F.col(df_key).isNull()), allowMissingColumns=True)
    return joined.drop(key_alias, MAP_ROWS)
