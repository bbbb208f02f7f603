"""Layer writes that check every row on the way in (V1-V3, V5-V7, V12-V14, V16).

One job reads the rows, names the rules that each breaks, writes the good and
the quarantined rows to a folder each and counts what it saw: the counts are an
:class:`~pyspark.sql.Observation` on the rows being written, so the report
costs no further pass.  Both tables then move to the new files in one step
each (see :mod:`strata.sources.publish`).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality import CHECK_SCHEMA, RowRule
from strata.sources.publish import new_version, point_table
from strata.sources.sinks import conform

#: Column of the quarantine table that lists the rules a row breaks.
FAILED = "failed_rules"
_SOURCE, _SPLIT = "_failed_in_source", "_quarantined"


@dataclass(frozen=True)
class CheckedLayer:
    """The tables of a checked write, its report (one row per check) and the rows seen and quarantined."""

    good: DataFrame
    quarantined: DataFrame
    report: DataFrame
    rows: int
    n_quarantined: int


def rule_name(rule: RowRule) -> str:
    return rule.check_name if rule.column_name is None else f"{rule.check_name}({rule.column_name})"


def failed_rules(rules: Iterable[RowRule]) -> Column:
    """Names of the rules that the row breaks, in the rules' order; a violation that is NULL is none."""
    named = [F.when(F.coalesce(r.violation, F.lit(False)), F.lit(rule_name(r))) for r in rules]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def checked_rows(df: DataFrame, rules: Iterable[RowRule] = (), schema: T.StructType | None = None,
                 build: Callable[[DataFrame], DataFrame] | None = None, source_rules: Iterable[RowRule] = ()) -> DataFrame:
    """The layer's rows with :data:`FAILED`: ``source_rules`` judge ``df``'s rows, ``rules`` the built ones.

    ``build`` makes layer rows of ``df``'s one by one; with ``source_rules`` it has to keep columns that it does not know.
    """
    source_rules = list(source_rules)
    marked = df.withColumn(_SOURCE, failed_rules(source_rules)) if source_rules else df
    built = build(marked) if build else marked
    failed = failed_rules(rules)
    if source_rules:
        failed = F.concat(F.col(_SOURCE), failed)
    flagged = built.withColumn(FAILED, failed).drop(_SOURCE)
    if schema is None:
        return flagged
    return flagged.select(*conform(flagged, schema).columns, FAILED).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema], FAILED)


def observed_counts(rules: Iterable[RowRule]) -> list[Column]:
    """Aggregates over :func:`checked_rows`: rows, quarantined rows, rows that break each rule."""
    return [F.count(F.lit(1)).alias("rows"), F.count_if(F.size(FAILED) > 0).alias("quarantined"),
            *[F.count_if(F.array_contains(FAILED, rule_name(r))).alias(f"rule_{i}") for i, r in enumerate(rules)]]


def write_checked(df: DataFrame, table_name: str, root: str, rules: Iterable[RowRule] = (), schema: T.StructType | None = None,
                  build: Callable[[DataFrame], DataFrame] | None = None, source_rules: Iterable[RowRule] = (), expected_rows: int | None = None,
                  quarantine_name: str | None = None) -> CheckedLayer:
    """Write a layer's good rows as ``table_name`` and the others as ``{table_name}_quarantine``, in one pass over ``df``.

    The report has one row per rule, ``not_empty`` (V1) and, with ``expected_rows``, ``record_count`` (V2: rows seen
    against it).  Files are Parquet below ``root``, in a folder of their own for each write; the tables move to them
    after the write has succeeded, so a failed write changes neither.
    """
    spark = df.sparkSession
    source_rules, rules = list(source_rules), list(rules)
    every = source_rules + rules
    if len({rule_name(r) for r in every}) < len(every):
        raise ValueError("two rules have one name")
    rows = checked_rows(df, rules, schema, build, source_rules)
    seen = Observation()
    location = new_version(root)
    rows.withColumn(_SPLIT, F.size(FAILED) > 0).observe(seen, *observed_counts(every)).write.partitionBy(_SPLIT).parquet(location)
    counts = seen.get
    layer, other = T.StructType([f for f in rows.schema if f.name != FAILED]), quarantine_name or f"{table_name}_quarantine"
    for name, part, shape, n in ((table_name, "false", layer, counts["rows"] - counts["quarantined"]), (other, "true", rows.schema, counts["quarantined"])):
        folder = f"{location}/{_SPLIT}={part}"
        if not n:                                      # no row of this kind, so no file and no folder yet
            spark.createDataFrame([], shape).write.parquet(folder)
        point_table(spark, name, shape, folder, "parquet")
    return CheckedLayer(spark.table(table_name), spark.table(other), _report(spark, every, counts, expected_rows), counts["rows"], counts["quarantined"])


def _report(spark: SparkSession, rules: list[RowRule], counts: dict, expected_rows: int | None) -> DataFrame:
    found = [("not_empty", None, int(not counts["rows"]))]
    if expected_rows is not None:
        found.append(("record_count", None, abs(counts["rows"] - expected_rows)))
    found += [(r.check_name, r.column_name, counts[f"rule_{i}"]) for i, r in enumerate(rules)]
    return spark.createDataFrame([(name, column, n, n == 0) for name, column, n in found], CHECK_SCHEMA)
