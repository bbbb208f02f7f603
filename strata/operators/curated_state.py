"""Curated KPIs kept up to date by batches of changes (E1, E2).

The state of a customer is what sums and counts need to be added to and taken
from: an exact decimal total, counts, the first and last date.  A batch of
inserted and retracted rows is aggregated by customer and merged into the
state.  What cannot be taken back is computed again from the customer's rows:
a first or last date that a retracted row may have held, and totals of amounts
that decimals do not write exactly.

State and rows are partitioned by a bucket of the customer, so that a batch
reads and replaces only the buckets of its customers.  Each state row carries
the number of the batch that wrote it: a batch that is run again, after a job
that died half way, changes nothing twice.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import CURATED_CUSTOMER_SCHEMA, Thresholds
from strata.functions.columns import as_double, tier_of
from strata.session import stored

EXACT = "decimal(28,10)"
COUNTS = ("n_exact", "n_rest", "n_rows", "n_active", "n_high", "n_review")


def _review(rule: str) -> Column:
    if rule not in ("needs_review", "high_risk"):
        raise ValueError(f"unknown review_rule {rule!r}")
    return F.col("needs_review") if rule == "needs_review" else F.col("risk_flag") == "HIGH"


def _exact() -> Column:
    """The amount as a decimal, where ten decimals write it exactly."""
    x = as_double("amount")
    decimal = F.when(F.abs(x) < 1e15, x).try_cast("decimal(38,10)")
    return F.when(decimal.cast("double") == x, decimal)


def _inexact() -> Column:
    return as_double("amount").isNotNull() & _exact().isNull()


def _measures(sign: Column, review_rule: str) -> dict[str, Column]:
    """Signed aggregates of rows: what :func:`strata.functions.columns.money_sum` and the counts need."""
    ones = {"n_exact": _exact().isNotNull(), "n_rest": _inexact(), "n_rows": F.lit(True), "n_active": F.col("is_active"), "n_high": F.col("is_high_value"),
            "n_review": _review(review_rule)}
    return {"exact": F.coalesce(F.try_sum(F.when(sign > 0, _exact()).otherwise(-_exact())), F.lit(0)).try_cast(EXACT),
            **{name: F.sum(F.when(condition, sign).otherwise(F.lit(0))).cast("long") for name, condition in ones.items()}}


def state_of(rows: DataFrame, key: str = "customer_id", review_rule: str = "needs_review") -> DataFrame:
    """The state of every customer from all its rows."""
    rest = F.sum(F.when(_inexact(), as_double("amount")))
    return rows.groupBy(key).agg(*[m.alias(name) for name, m in _measures(F.lit(1), review_rule).items()], rest.alias("rest"),
                                 F.min("signup_date").alias("first"), F.max("signup_date").alias("last"))


def curated_of(state: DataFrame, key: str = "customer_id", thresholds: Thresholds | None = None) -> DataFrame:
    """The curated layer's rows of a state, as :func:`strata.operators.curated.build_curated_customer_metrics` makes them of the rows."""
    exact = F.when(F.col("n_exact") > 0, F.col("exact").cast("double"))
    total = F.when(F.col("n_rest") == 0, exact).otherwise(F.coalesce(exact, F.lit(0.0)) + F.col("rest"))
    made = {"total_amount": F.col("_total"), "avg_amount": F.try_divide(F.col("_total"), (F.col("n_exact") + F.col("n_rest")).cast("double")),
            "latest_signup_date": F.col("last"), "first_signup_date": F.col("first"), "total_records": F.when(F.col(key).isNull(), 0).otherwise(F.col("n_rows")),
            "active_record_count": F.col("n_active"), "high_value_record_count": F.col("n_high"), "review_flag": (F.col("n_review") > 0).cast("int"),
            "customer_tier": tier_of("_total", thresholds or Thresholds())}
    return state.where("n_rows > 0").withColumn("_total", total).select(
        key, *[made[f.name].cast(f.dataType).alias(f.name) for f in CURATED_CUSTOMER_SCHEMA if f.name != "customer_id"])


def _merged(state: DataFrame, batch: DataFrame, number: int, key: str, review_rule: str) -> DataFrame:
    """State rows of the batch's customers with ``again``: whether they have to be computed from their rows."""
    sign = F.col("change")
    dates = {"gained_first": F.min(F.when(sign > 0, F.col("signup_date"))), "gained_last": F.max(F.when(sign > 0, F.col("signup_date"))),
             "lost_first": F.min(F.when(sign < 0, F.col("signup_date"))), "lost_last": F.max(F.when(sign < 0, F.col("signup_date")))}
    delta = batch.groupBy(key).agg(*[m.alias(f"d_{name}") for name, m in _measures(sign, review_rule).items()], *[m.alias(name) for name, m in dates.items()],
                                   F.count_if(_inexact()).alias("inexact"))
    right = delta.withColumnRenamed(key, "_key")
    # state rows of other customers in the same buckets come along unchanged; one row per customer on either side
    both = state.withColumn("_had", F.lit(True)).join(right, state[key].eqNullSafe(right["_key"]), "full")
    new = F.col("d_n_rows").isNotNull() & F.coalesce(F.col("batch") < number, F.lit(True))
    first, last = F.least("first", "gained_first"), F.greatest("last", "gained_last")
    merged = both.select(
        F.when(F.col("_had"), F.col(key)).otherwise(F.col("_key")).alias(key),
        F.when(new, (F.coalesce("exact", F.lit(0).cast(EXACT)) + F.col("d_exact")).try_cast(EXACT)).otherwise(F.col("exact")).alias("exact"),
        *[F.when(new, F.coalesce(c, F.lit(0)) + F.col(f"d_{c}")).otherwise(F.col(c)).cast("long").alias(c) for c in COUNTS],
        F.col("rest"), F.when(new, first).otherwise(F.col("first")).alias("first"), F.when(new, last).otherwise(F.col("last")).alias("last"),
        F.when(new, number).otherwise(F.col("batch")).cast("long").alias("batch"),
        F.coalesce(new & ((F.col("lost_first") <= first) | (F.col("lost_last") >= last) | (F.col("inexact") > 0)), F.lit(False)).alias("again"))
    return merged.withColumn("again", F.col("again") | F.col("exact").isNull())


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def read_state(spark: SparkSession, root: str, buckets: list[int] | None = None) -> DataFrame:
    """The state below ``root`` (of some buckets only, whose folders alone are read)."""
    state = spark.read.parquet(f"{root}/state")
    if buckets is not None:
        state = state.where(F.col("bucket").isin(buckets))
    return state


def read_rows(spark: SparkSession, root: str, buckets: list[int], up_to: int) -> DataFrame:
    """Rows that the changes up to a batch leave, each as often as it was inserted more than retracted."""
    log = spark.read.parquet(f"{root}/changes").where(F.col("bucket").isin(buckets) & (F.col("number") <= up_to))
    columns = [c for c in log.columns if c not in ("change", "bucket", "number")]
    left = log.groupBy(*columns).agg(F.sum("change").alias("_n")).where("_n > 0")
    return left.select(*columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_copy")).drop("_copy")


def apply_changes(batch: DataFrame, root: str, number: int, key: str = "customer_id", review_rule: str = "needs_review", buckets: int = 64) -> DataFrame:
    """Merge a batch into the state below ``root``; returns the state's rows of the batch's buckets.

    ``batch`` has the operational columns and ``change``: 1 for a row that comes, -1 for one that goes with the values
    it came with (a correction is both).  ``number`` grows from batch to batch; one that is applied again is taken as
    the same batch and changes nothing that it has changed before.  A NULL key is a customer of its own.
    """
    spark = batch.sparkSession
    needed = [key, "amount", "signup_date", "is_active", "is_high_value", "needs_review" if review_rule == "needs_review" else "risk_flag", "change"]
    rows = batch.select(*needed).withColumn("bucket", bucket_of(key, buckets))
    # the batch's folder is replaced as a whole, so a second run does not add to the first
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/changes/number={number}")
    rows = spark.read.schema(rows.schema).parquet(f"{root}/changes/number={number}")
    touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().collect())       # at most the number of buckets
    if not touched:
        return state_of(rows.limit(0), key, review_rule)
    empty = state_of(rows.limit(0), key, review_rule).withColumns({"batch": F.lit(0).cast("long"), "bucket": F.lit(0)})
    state = _state_or(spark, root, touched, empty)
    merged = stored(_merged(state.drop("bucket"), rows, number, key, review_rule), "merged-state")
    again = stored(merged.where("again").select(F.col(key).alias("_again")), "keys-again")
    wanted = sorted(r[0] for r in again.select(F.pmod(F.xxhash64("_again"), F.lit(buckets)).cast("int").alias("b")).distinct().collect())
    out = merged.where("NOT again").drop("again")
    if wanted:
        left = read_rows(spark, root, wanted, number)
        left = left.join(again, left[key].eqNullSafe(again["_again"]), "left_semi")
        fresh = state_of(left, key, review_rule).withColumn("batch", F.lit(number).cast("long"))
        # a customer without rows keeps a row of zeros, which says that the batch was applied
        gone = merged.where("again").select(key).join(fresh.select(F.col(key).alias("_there"), F.lit(True).alias("_is")), F.col(key).eqNullSafe(F.col("_there")), "left").where("_is IS NULL")
        zeros = {"exact": F.lit(0).cast(EXACT), **{c: F.lit(0).cast("long") for c in COUNTS}, "batch": F.lit(number).cast("long")}
        kinds = dict(out.dtypes)
        gone = gone.select(key, *[zeros.get(c, F.lit(None).cast(kinds[c])).alias(c) for c in out.columns if c != key])
        out = out.unionByName(fresh.select(*out.columns)).unionByName(gone)
    out = stored(out.withColumn("bucket", bucket_of(key, buckets)), "new-state")
    out.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{root}/state")
    return out


def _state_or(spark: SparkSession, root: str, buckets: list[int], empty: DataFrame) -> DataFrame:
    try:
        return read_state(spark, root, buckets=buckets).select(*empty.columns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty                                   # the first batch
