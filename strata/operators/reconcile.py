"""Key reconciliation (D3/V8), orphan facts (D4/V9) and expected-vs-actual
comparison by key (D6/D7/V10/V11)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.keymap import DEFAULT_BROADCAST_BYTES, MAP_ROWS, join_key_map, key_map
from strata.operators.quality import _finish, assert_checks


def key_differences(source_df: DataFrame, target_df: DataFrame, key_columns: Iterable[str]) -> DataFrame:
    """Distinct keys present on only one side: ``DataFrame[side, *keys]``.

    ``side`` is ``missing_in_target`` (in source, not in target) or
    ``unexpected_in_target``.  Both sides are tagged, unioned and grouped
    once -- a single shuffle with map-side combining, so a hot key costs one
    partial row per task.  A key with a NULL part never matches an equi-join,
    so it is reported for every side it occurs on.
    """
    keys = list(key_columns)
    tagged = (source_df.select(*keys, F.lit(1).alias("_s"), F.lit(0).alias("_t"))
              .unionByName(target_df.select(*keys, F.lit(0).alias("_s"), F.lit(1).alias("_t"))))
    grouped = tagged.groupBy(*keys).agg(F.max("_s").alias("_s"), F.max("_t").alias("_t"))
    has_null = reduce_or([F.col(k).isNull() for k in keys])
    missing = (F.col("_s") == 1) & (has_null | (F.col("_t") == 0))
    unexpected = (F.col("_t") == 1) & (has_null | (F.col("_s") == 0))
    sides = F.filter(F.array(F.when(missing, F.lit("missing_in_target")),
                             F.when(unexpected, F.lit("unexpected_in_target"))),
                     lambda x: x.isNotNull())
    return (grouped.where(missing | unexpected)
            .select(F.explode(sides).alias("side"), *keys))


def reduce_and(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def reduce_or(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def check_key_reconciliation(source_df: DataFrame, target_df: DataFrame, key_columns: Iterable[str]) -> DataFrame:
    """V8: counts of missing and unexpected keys, two check rows."""
    keys = list(key_columns)
    diff = key_differences(source_df, target_df, keys)
    counts = diff.agg(F.count_if(F.col("side") == "missing_in_target").alias("m"),
                      F.count_if(F.col("side") == "unexpected_in_target").alias("u"))
    return _finish(counts.select(F.inline(F.array(
        F.struct(F.lit("keys_missing_in_target").alias("check_name"), F.lit(",".join(keys)).alias("column_name"),
                 F.col("m").alias("violations")),
        F.struct(F.lit("keys_unexpected_in_target").alias("check_name"), F.lit(",".join(keys)).alias("column_name"),
                 F.col("u").alias("violations"))))))


class Reconciliation:
    @staticmethod
    def validate_key_reconciliation(source_df: DataFrame, target_df: DataFrame, key_columns: Iterable[str]) -> None:
        assert_checks(check_key_reconciliation(source_df, target_df, key_columns))


def orphan_key_map(fact_df: DataFrame, dim_df: DataFrame, fact_key: str = "customer_id",
                   dim_key: str = "customer_id", key_alias: str = "__orphan_key") -> DataFrame:
    """Key map (see :mod:`strata.operators.keymap`) of the non-NULL fact keys
    absent from the dimension, with each key's fact row count ``__map_rows``.

    One union + grouped aggregate over fact keys and dimension keys: map-side
    combining reduces every task's rows to one per key before the shuffle,
    so no hot key can skew it and the shuffle carries keys, not fact rows.
    """
    dim_side = dim_df.select(F.col(dim_key).alias("_dim_key"), F.lit(1).alias("_in_dim"))
    kmap = key_map(fact_df, fact_key, dim_side, "_dim_key", {"_in_dim": F.max("_in_dim")}, key_alias=key_alias)
    return kmap.where(F.col("_in_dim").isNull()).drop("_in_dim")


def orphan_keys(fact_df: DataFrame, dim_df: DataFrame, fact_key: str = "customer_id",
                dim_key: str = "customer_id") -> DataFrame:
    """Distinct non-NULL fact keys absent from the dimension: ``DataFrame[fact_key]``."""
    return orphan_key_map(fact_df, dim_df, fact_key, dim_key).select(F.col("__orphan_key").alias(fact_key))


def reconcile_fact_dimension(fact_df: DataFrame, dim_df: DataFrame, fact_key: str = "customer_id",
                             dim_key: str = "customer_id", metric_col: str | None = "amount",
                             sort: bool = True, broadcast_max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Fact rows whose key is absent from the dimension (NULL keys are orphans).

    Two steps: the orphan *keys* come from one grouped pass over the keys
    (:func:`orphan_key_map`), then the fact rows are semi-joined with them
    (:func:`strata.operators.keymap.join_key_map`): broadcast when the key
    set is proven small -- orphans are normally few, and the fact table is
    then never shuffled -- else hot keys map-side and the rest shuffled.
    NULL fact keys never match and are kept directly.  ``metric_col`` is
    accepted for call compatibility.
    """
    kmap = orphan_key_map(fact_df, dim_df, fact_key, dim_key)
    orphans = join_key_map(fact_df, fact_key, kmap, "left_semi", key_alias="__orphan_key",
                           broadcast_max_bytes=broadcast_max_bytes)
    orphans = orphans.unionByName(fact_df.where(F.col(fact_key).isNull()))
    if not sort:
        return orphans
    # a row hash behind the key lets the range exchange cut a hot key into several tasks
    return orphans.orderBy(F.col(fact_key).asc_nulls_first(), F.xxhash64(*_hashable(orphans)))


def _hashable(df: DataFrame) -> list:
    """The columns of ``df`` as values that can be hashed (maps as text)."""
    return [F.to_json(F.col(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema]


def check_orphans(fact_df: DataFrame, dim_df: DataFrame, fact_key: str = "customer_id",
                  dim_key: str = "customer_id") -> DataFrame:
    """V9: number of orphan fact rows, from the per-key counts (no second join with the facts)."""
    counts = orphan_key_map(fact_df, dim_df, fact_key, dim_key).select(MAP_ROWS).unionByName(
        fact_df.agg(F.count_if(F.col(fact_key).isNull()).alias(MAP_ROWS)))
    n = counts.agg(F.sum(MAP_ROWS).alias("n"))
    return _finish(n.select(F.lit("orphan_facts").alias("check_name"), F.lit(fact_key).alias("column_name"),
                            F.col("n").alias("violations")))


def compare_by_key(expected_df: DataFrame, actual_df: DataFrame, key_columns: Iterable[str],
                   columns: Iterable[str]) -> DataFrame:
    """Keys whose compared columns differ null-safely, or that exist on one side only.

    Output: keys, ``expected_<c>`` / ``actual_<c>`` for each column, and
    ``issue`` in (``missing_in_actual``, ``missing_in_expected``,
    ``value_mismatch``).  One full outer join on the keys; both frames are
    expected to hold one row per key (aggregate them first otherwise), which
    also means neither side can carry a hot key into the join.  A NULL key
    matches a NULL key.
    """
    keys = list(key_columns)
    cols = list(columns)
    e = expected_df.select(*keys, *[F.col(c).alias(f"expected_{c}") for c in cols], F.lit(True).alias("_e"))
    a = actual_df.select(*[F.col(k).alias(f"_actual_{k}") for k in keys], *[F.col(c).alias(f"actual_{c}") for c in cols],
                         F.lit(True).alias("_a"))
    same = reduce_and([F.col(k).eqNullSafe(F.col(f"_actual_{k}")) for k in keys])
    j = e.join(a, same, "full_outer").withColumns({k: F.coalesce(F.col(k), F.col(f"_actual_{k}")) for k in keys})
    differs = reduce_or([~F.col(f"expected_{c}").eqNullSafe(F.col(f"actual_{c}")) for c in cols])
    issue = (F.when(F.col("_a").isNull(), F.lit("missing_in_actual"))
             .when(F.col("_e").isNull(), F.lit("missing_in_expected"))
             .when(differs, F.lit("value_mismatch")))
    out_cols = keys + [x for c in cols for x in (f"expected_{c}", f"actual_{c}")]
    return j.withColumn("issue", issue).where(F.col("issue").isNotNull()).select(*out_cols, "issue")


def check_compare_by_key(expected_df: DataFrame, actual_df: DataFrame, key_columns: Iterable[str],
                         columns: Iterable[str], check_name: str = "compare_by_key") -> DataFrame:
    """V10/V11: number of keys that differ."""
    cols = list(columns)
    n = compare_by_key(expected_df, actual_df, key_columns, cols).agg(F.count(F.lit(1)).alias("n"))
    return _finish(n.select(F.lit(check_name).alias("check_name"), F.lit(",".join(cols)).alias("column_name"),
                            F.col("n").alias("violations")))


# -- by checksums -------------------------------------------------------------
def bucket_fingerprints(df: DataFrame, keys: Iterable[str], columns: Iterable[str], bucket: Column) -> DataFrame:
    """``_bucket, _rows, _sum, _xor``: per bucket what does not depend on the order of its rows, from one aggregate."""
    whole = F.xxhash64(*[part for c in (*keys, *columns) for part in (F.col(c).isNull(), F.col(c))])
    # halves of the hash add up without overflow; the exclusive or tells apart what the sums do not
    return df.groupBy(bucket.alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(F.shiftrightunsigned(whole, 32)).alias("_high"),
        F.sum(whole.bitwiseAND(F.lit(0xFFFFFFFF))).alias("_low"), F.bit_xor(F.xxhash64(whole, F.lit(7))).alias("_xor"))


def differing_buckets(expected: DataFrame, actual: DataFrame, keys: Iterable[str], columns: Iterable[str], buckets: int = 1024,
                      bucket_col: str | None = None) -> list[int]:
    """Buckets of the key whose rows are not the same on both sides; at most ``buckets`` numbers."""
    keys, columns = list(keys), list(columns)
    bucket = F.col(bucket_col) if bucket_col else key_bucket(keys, buckets)
    e, a = (bucket_fingerprints(df, keys, columns, bucket) for df in (expected, actual))
    names = [c for c in e.columns if c != "_bucket"]
    both = e.unionByName(a).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_sides"), *[F.min(c).eqNullSafe(F.max(c)).alias(c) for c in names])
    same = F.col("_sides") == 2
    for c in names:
        same = same & F.col(c)
    return sorted(r["_bucket"] for r in both.where(~same).select("_bucket").collect())


def key_bucket(keys: Iterable[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def compare_by_bucket(expected: DataFrame, actual: DataFrame, keys: Iterable[str], columns: Iterable[str], buckets: int = 1024,
                      bucket_col: str | None = None) -> DataFrame:
    """:func:`compare_by_key`, row by row only in the buckets whose fingerprints differ.

    Both sides are read once for the fingerprints, which is an aggregate of ``buckets`` rows; equal buckets are not
    joined.  With ``bucket_col``, a partition column that holds :func:`key_bucket` on both sides, equal buckets are not
    even read again.  Keys must have one type on both sides; rows that repeat differ from a single one.
    """
    keys, columns = list(keys), list(columns)
    differ = differing_buckets(expected, actual, keys, columns, buckets, bucket_col)
    bucket = F.col(bucket_col) if bucket_col else key_bucket(keys, buckets)
    return compare_by_key(expected.where(bucket.isin(differ)).select(*keys, *columns), actual.where(bucket.isin(differ)).select(*keys, *columns), keys, columns)
