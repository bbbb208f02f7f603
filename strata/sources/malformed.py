"""Delimited files with broken records (A1, A5): every record is read or kept as text with what is wrong with it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import stored

RECORD = "_record"


class Records(NamedTuple):
    """Records that fit the schema, and the others: ``record, reason, file``."""

    good: DataFrame
    broken: DataFrame


def n_fields(record: Column, delimiter: str = ",") -> Column:
    """Fields of a record; delimiters within quotes do not count."""
    bare = F.regexp_replace(record, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1


def reason_of(record: Column, schema: T.StructType, delimiter: str = ",", **options) -> Column:
    """Why a record does not fit: its number of fields, or the first column whose text is not of the column's type."""
    expected = len(schema.fields)
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(expected)])
    fields = F.from_csv(record, text.simpleString()[len("struct<"):-1].replace(":", " "), {"sep": delimiter, **options})
    n = n_fields(record, delimiter)
    reason = F.when(n < expected, F.concat(F.lit("too few fields: "), n.cast("string"))).when(n > expected, F.concat(F.lit("too many fields: "), n.cast("string")))
    for i, f in enumerate(schema.fields):
        value = fields[f"c{i}"]
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(value.isNotNull() & value.try_cast(f.dataType).isNull(), F.lit(f"not a {f.dataType.simpleString()}: {f.name}"))
    return reason.otherwise(F.lit("unreadable"))


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", header: bool = True, multi_line: bool = False,
                     **options) -> Records:
    """Read delimited files; records with too few or too many fields, or with a value of another type, go to ``broken``.

    The files are parsed once, to a written table of all records, of which both frames are a part; so the two add up to
    the records in the files.  ``file`` is the path that a broken record came from.
    """
    if RECORD in schema.names:
        raise ValueError(f"{RECORD} is a reserved column name")
    whole = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    read = spark.read.options(**options).csv(path, schema=whole, sep=delimiter, header=header, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=RECORD)
    rows = stored(read.select("*", F.col("_metadata.file_path").alias("_file")), "records")
    broken = rows.where(F.col(RECORD).isNotNull())
    return Records(rows.where(F.col(RECORD).isNull()).select(*schema.names),
                   broken.select(F.col(RECORD).alias("record"), reason_of(F.col(RECORD), schema, delimiter, **options).alias("reason"), F.col("_file").alias("file")))


def broken_by_file(records: Records) -> DataFrame:
    """``file, reason, records``: broken records counted, for a report."""
    return records.broken.groupBy("file", F.regexp_replace("reason", ": [0-9]+$", "").alias("reason")).agg(F.count(F.lit(1)).alias("records"))
