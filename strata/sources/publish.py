"""Tables whose files change in one step.

A layer is written to a folder of its own for every load, and only when all of
its files are there does the table's location move to it.  A reader, or a job
that fails half way, finds the files of the load before.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from strata.sources.sinks import conform, create_layer_table, default_table_format


def new_version(root: str) -> str:
    """A folder below ``root`` that no load has used."""
    return f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"


def point_table(spark: SparkSession, table_name: str, schema: T.StructType, location: str, fmt: str | None = None) -> None:
    """Create the table over ``location``, or move the existing one there."""
    if spark.catalog.tableExists(table_name):
        spark.sql(f"ALTER TABLE {table_name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table_name)
    else:
        create_layer_table(spark, table_name, schema, fmt, location)


def publish_table(df: DataFrame, table_name: str, root: str, schema: T.StructType | None = None, fmt: str | None = None) -> str:
    """Write ``df`` as a new version below ``root``, then make it the table; returns the version's folder.

    The table must be one of :func:`publish_table`'s own (not partitioned).  Earlier versions stay until their folders
    are deleted, so running readers finish and ``point_table`` can go back to one.
    """
    out = conform(df, schema) if schema is not None else df
    fmt = fmt or default_table_format(df.sparkSession)
    location = new_version(root)
    out.write.format(fmt).save(location)
    point_table(df.sparkSession, table_name, out.schema, location, fmt)
    return location
