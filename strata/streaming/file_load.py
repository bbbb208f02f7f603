"""Load-once file-to-table append (the COPY INTO pattern) as a file stream.

A file-source stream with ``trigger(availableNow=True)`` processes every
file that arrived since the last run and then stops; the checkpoint (in the
shared folder) records which files were committed, so re-running the load
never appends a file twice and a failed run resumes where it stopped.  The
row-wise cleaning operators of :mod:`strata.operators.customer` and
:mod:`strata.operators.orders` are plain projections and can be applied to
the streaming frame unchanged through ``transform``.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def incremental_file_load(spark: SparkSession, source_path: str, target_path: str, checkpoint_path: str,
                          schema: T.StructType, fmt: str = "csv", transform: Callable[[DataFrame], DataFrame] | None = None,
                          sink_format: str = "parquet", max_files_per_trigger: int | None = None,
                          **options) -> None:
    """Append every not-yet-loaded file under ``source_path`` to ``target_path``."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        options.setdefault("header", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    for k, v in options.items():
        reader = reader.option(k, v)
    stream = reader.load(source_path)
    if transform is not None:
        stream = stream.transform(transform)
    query = (stream.writeStream.format(sink_format)
             .option("path", target_path)
             .option("checkpointLocation", checkpoint_path)
             .outputMode("append")
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced for the caller
        raise query.exception()
