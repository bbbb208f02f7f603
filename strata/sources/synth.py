"""Synthetic dirty customer source (A10) as a Spark job.

Record numbers come from a DataFrame column (``spark.range`` or the key of
an existing table), so generation is spread over all partitions.  Every
"random" draw is a pure integer hash of (record number, field, seed) -- a
multiply / xor-shift mixer over 32-bit values -- so a row is reproducible
from its record number alone, in any engine that has integer arithmetic.

Scenarios, first match wins: n%7 blank identity, n%11 reused id + invalid
e-mail, n%13 missing e-mail, n%19 reused id + invalid status, else normal.
Blank CSV fields are produced as NULL (what a CSV reader yields for them).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import (
    SYNTH_DOMAINS,
    SYNTH_FIRST_NAMES,
    SYNTH_INVALID_STATUSES,
    SYNTH_LAST_NAMES,
    SYNTH_REGIONS,
    SYNTH_SOURCE_SYSTEMS,
    SYNTH_VALID_STATUSES,
)

_U32 = 4294967296
_U31 = 2147483648


_N_FIRST, _N_LAST, _N_STATUS, _N_REGION, _DAYS = len(SYNTH_FIRST_NAMES), len(SYNTH_LAST_NAMES), 4, len(SYNTH_REGIONS), 2192
#: Which of the four hashes a field is drawn from, and the divisor that passes over the fields before it.
_DRAWS = {1: (1, 1), 2: (1, _N_FIRST), 5: (1, _N_FIRST * _N_LAST),
          3: (2, 1), 4: (2, _N_FIRST), 6: (2, _N_FIRST * _N_LAST), 11: (2, _N_FIRST * _N_LAST * _N_STATUS),
          12: (2, _N_FIRST * _N_LAST * _N_STATUS * _N_REGION),
          7: (3, 1), 9: (3, _DAYS), 10: (3, _DAYS * _DAYS), 8: (4, 1)}


def mix(n: Column, field: int, seed: int) -> Column:
    """32-bit integer hash of (n, field, seed); all steps stay below 2**63."""
    h = ((n % _U31) * 1103515245 + F.lit(field * 12345 + seed)).bitwiseAND(_U32 - 1)
    for _ in range(2):
        h = h.bitwiseXOR(F.shiftright(h, 16))
        h = (h * 73244475).bitwiseAND(_U32 - 1)
    return h.bitwiseXOR(F.shiftright(h, 16))


def pick(values, h: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (h % len(values) + 1).cast("int"))


def random_date(h: Column, start: _dt.date, end: _dt.date) -> Column:
    span = (end - start).days + 1
    return F.date_add(F.lit(start.isoformat()).cast("date"), (h % span).cast("int"))


SCENARIOS = ("blank_identity", "invalid_email", "missing_email", "invalid_status", "normal")
BLANK, BAD_EMAIL, NO_EMAIL, BAD_STATUS, NORMAL = range(5)


def scenario_of(n: Column) -> Column:
    """Number of the scenario in :data:`SCENARIOS`."""
    return (F.when(n % 7 == 0, F.lit(BLANK))
            .when(n % 11 == 0, F.lit(BAD_EMAIL))
            .when(n % 13 == 0, F.lit(NO_EMAIL))
            .when(n % 19 == 0, F.lit(BAD_STATUS))
            .otherwise(F.lit(NORMAL)))


def synthesize_customers(df: DataFrame, record_col: str = "id", seed: int = 42) -> DataFrame:
    """Dirty raw customer rows, one per record number in ``record_col``."""
    # Four hashes per row, computed once in their own projection; each is divided up between the fields
    # drawn from it (the sizes of the pools before a field are its divisor), which keeps the generated code
    # within what the JVM compiles.
    base = df.select(F.col(record_col).cast("long").alias("record_no"))
    base = base.select("record_no", scenario_of(F.col("record_no")).alias("_scenario"),
                       *[mix(F.col("record_no"), f, seed).alias(f"_g{f}") for f in range(1, 5)])
    n = F.col("record_no")
    sc = F.col("_scenario")

    def h(f: int) -> Column:
        source, divisor = _DRAWS[f]
        return F.col(f"_g{source}") if divisor == 1 else F.expr(f"_g{source} div {divisor}")

    d2020, d2021, d2025 = _dt.date(2020, 1, 1), _dt.date(2021, 1, 1), _dt.date(2025, 12, 31)

    def cid(x: Column) -> Column:
        # "C" + number zero-padded to at least 5 digits (same text as "C%05d"
        # for non-negative numbers, without a per-row String.format)
        return F.concat(F.lit("C"), F.when(x < 100000, F.lpad(x.cast("string"), 5, "0")).otherwise(x.cast("string")))

    # Draws that several fields use have a projection of their own: an operator of its own is a method of its own.
    amounts = {BLANK: (-1500, 800), BAD_EMAIL: (-500, 3500), NO_EMAIL: (-150, 2000), BAD_STATUS: (0, 9000), NORMAL: (-120, 4200)}
    later = {BLANK: 365, BAD_EMAIL: 220, NO_EMAIL: 300, BAD_STATUS: 45, NORMAL: 180}

    def by_scenario(values) -> Column:
        return F.element_at(F.array(*[F.lit(values[i]) for i in range(len(SCENARIOS))]), sc + 1)

    low, span = by_scenario({i: lo * 100 for i, (lo, _) in amounts.items()}), by_scenario({i: (hi - lo) * 100 + 1 for i, (lo, hi) in amounts.items()})
    drawn = base.select(
        "record_no", "_scenario", "_g2",
        pick(SYNTH_FIRST_NAMES, h(1)).alias("_first"), pick(SYNTH_LAST_NAMES, h(2)).alias("_last"), pick(SYNTH_DOMAINS, h(5)).alias("_domain"),
        F.when(sc == NORMAL, random_date(h(7), d2021, d2025)).otherwise(random_date(h(7), d2020, d2025)).alias("_signup"),
        random_date(h(9), d2020, d2025).alias("_day"), (h(10) % by_scenario(later) + 1).cast("int").alias("_later"),
        ((low + h(8) % span).cast("double") / F.lit(100.0)).alias("_amount"))
    first, last, domain, signup = F.col("_first"), F.col("_last"), F.col("_domain"), F.col("_signup")
    no_identity, no_email = sc == BLANK, (sc == BLANK) | (sc == NO_EMAIL)
    status = F.when((sc == BLANK) | (sc == BAD_STATUS), pick(SYNTH_INVALID_STATUSES, h(6))).otherwise(pick(SYNTH_VALID_STATUSES, h(6)))
    # the owner of the address: another drawn person where the status is invalid
    given = F.when(sc == BAD_STATUS, pick(SYNTH_FIRST_NAMES, h(3))).otherwise(first)
    family = F.when(sc == BAD_STATUS, pick(SYNTH_LAST_NAMES, h(4))).otherwise(last)
    number = F.when(sc == BAD_EMAIL, n % 12000 + 1).when(sc == BAD_STATUS, n % 8000 + 1).otherwise(n)
    return drawn.select(
        "record_no", F.element_at(F.array(*map(F.lit, SCENARIOS)), sc + 1).alias("scenario"),
        F.when(~no_identity, cid(number)).alias("customer_id"),
        F.when(~no_identity, first).alias("first_name"),
        F.when(no_identity, F.lit("Guest")).otherwise(last).alias("last_name"),
        F.when(sc == BAD_EMAIL, F.lit("invalid-email")).when(~no_email, F.concat(F.lower(F.concat(given, F.lit("."), family)), F.lit("@"), domain)).alias("email"),
        F.nullif(status, F.lit("")).alias("status"),
        signup.alias("signup_date"),
        F.col("_amount").alias("amount"),
        F.date_add(F.when(sc == NORMAL, signup).otherwise(F.col("_day")), F.col("_later")).cast("timestamp_ntz").alias("updated_at"),
        pick(SYNTH_REGIONS, h(11)).alias("region"),
        pick(SYNTH_SOURCE_SYSTEMS, h(12)).alias("source_system"),
    )


def generate_customers(spark: SparkSession, rows: int = 100_000, seed: int = 42,
                       num_partitions: int | None = None) -> DataFrame:
    """``rows`` synthetic records numbered 1..rows (``spark.range``, fully parallel)."""
    ids = spark.range(1, rows + 1, numPartitions=num_partitions)
    return synthesize_customers(ids, "id", seed)


SOURCE_COLUMNS = ("customer_id", "first_name", "last_name", "email", "status", "signup_date", "amount",
                  "updated_at", "region", "source_system")


def write_customer_source(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write synthetic rows as the raw CSV source (header, the 10 source columns).

    Written by all tasks in parallel (one part file per partition); NULL
    fields come out empty, as blank fields of the source file.
    """
    (df.select(*SOURCE_COLUMNS).write.mode(mode).option("header", "true")
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))


def generate_dataset(spark: SparkSession, path: str, rows: int = 100_000, seed: int = 42) -> str:
    """Generate ``rows`` synthetic source records as CSV under ``path``; returns ``path``."""
    write_customer_source(generate_customers(spark, rows, seed), path)
    return path
