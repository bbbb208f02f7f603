"""Batch file loads that take every file once (A9).

A load is planned before it runs: its files go to the ledger, then the data is
written to a folder of the load's own, then the ledger says that it is done.
A run that finds a planned load that is not done does that one again, with the
same files into the same folder, so a job that died half way neither loses nor
doubles a file.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import stored
from strata.sources.sinks import conform

#: Column by which the target is partitioned: the load that brought a row.
LOAD = "_load"
FILES = "path string, size long, modified timestamp"
_PLANNED = T.StructType([T.StructField("path", T.StringType()), T.StructField("size", T.LongType()), T.StructField("modified", T.TimestampType()),
                         T.StructField(LOAD, T.StringType())])


class Copied(NamedTuple):
    """What a run did: its load (None without new files), the files that it took, and known files that have changed since."""

    load: str | None
    taken: DataFrame
    changed: DataFrame


def source_files(spark: SparkSession, source_path: str, pattern: str | None = None) -> DataFrame:
    """``path, size, modified`` of the files below a folder; only their metadata is read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(source_path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def loaded_files(spark: SparkSession, root: str) -> DataFrame:
    """Files of the loads that are done, with their load."""
    done = _read(spark, f"{root}/done", T.StructType([T.StructField(LOAD, T.StringType())]))
    return _read(spark, f"{root}/planned", _PLANNED).join(F.broadcast(done.distinct()), LOAD, "left_semi")


def read_loaded(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Rows of the loads that are done."""
    done = _read(spark, f"{root}/done", T.StructType([T.StructField(LOAD, T.StringType())]))
    rows = _read(spark, f"{root}/data", T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())]))
    return rows.join(F.broadcast(done.distinct()), LOAD, "left_semi").select(*schema.names)


def copy_into_once(spark: SparkSession, source_path: str, root: str, schema: T.StructType, fmt: str = "csv", pattern: str | None = None, **options) -> Copied:
    """Append the files below ``source_path`` that no load below ``root`` has taken; ``root`` holds data and ledger.

    A file is known by its path.  One that was taken and has another size or modification time now is not taken again
    but returned in ``changed``, so that its rows do not count twice.  Read the rows with :func:`read_loaded`.  One run
    at a time: two at once could plan the same files.
    """
    if fmt == "csv":
        options = {"header": "true", **options}
    planned = _read(spark, f"{root}/planned", _PLANNED)
    done = _read(spark, f"{root}/done", T.StructType([T.StructField(LOAD, T.StringType())]))
    open_loads = [r[LOAD] for r in planned.select(LOAD).distinct().join(done, LOAD, "left_anti").collect()]      # none, or the one that died
    for load in open_loads:
        _load(spark, root, load, schema, fmt, options)
    known = loaded_files(spark, root).groupBy("path").agg(F.max(F.struct("modified", "size")).alias("was"))
    seen = stored(source_files(spark, source_path, pattern).join(known, "path", "left"), "source-files")
    changed = seen.where(F.col("was").isNotNull() & ((F.col("was.size") != F.col("size")) | (F.col("was.modified") != F.col("modified")))).select(
        "path", "size", "modified", F.col("was.size").alias("size_then"), F.col("was.modified").alias("modified_then"))
    new = seen.where("was IS NULL").drop("was")
    if new.isEmpty():
        return Copied(None, new, changed)
    load = f"load-{uuid.uuid4().hex[:12]}"
    new.withColumn(LOAD, F.lit(load)).write.mode("append").parquet(f"{root}/planned")
    _load(spark, root, load, schema, fmt, options)
    return Copied(load, new, changed)


def _load(spark: SparkSession, root: str, load: str, schema: T.StructType, fmt: str, options: dict) -> None:
    # the paths go through the driver, which lists the files of any scan
    paths = [r["path"] for r in _read(spark, f"{root}/planned", _PLANNED).where(F.col(LOAD) == load).select("path").toLocalIterator()]
    rows = conform(spark.read.format(fmt).schema(schema).options(**options).load(paths), schema)
    rows.write.mode("overwrite").parquet(f"{root}/data/{LOAD}={load}")
    spark.createDataFrame([(load,)], f"{LOAD} string").coalesce(1).write.mode("append").parquet(f"{root}/done")
