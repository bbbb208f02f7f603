"""Layer schemas, table DDL and table sinks (A6-A9).

One ``StructType`` per layer drives both the DDL and the final projection
of the writer.  Tables are Delta when the session has the Delta extension
configured and parquet otherwise (``fmt`` overrides).  Every writer can place
the table files explicitly (``path``), which is how jobs keep their data in
the shared folder of the cluster.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.config import (
    CURATED_CUSTOMER_SCHEMA,
    OPERATIONAL_CUSTOMER_SCHEMA,
    RAW_CUSTOMER_SCHEMA,
    LayerTables,
)

LAYER_SCHEMAS = {"raw": RAW_CUSTOMER_SCHEMA, "operational": OPERATIONAL_CUSTOMER_SCHEMA,
                 "curated": CURATED_CUSTOMER_SCHEMA}


def default_table_format(spark: SparkSession) -> str:
    """``delta`` when the session has the Delta extension configured, else ``parquet``."""
    extensions = spark.conf.get("spark.sql.extensions", "") or ""
    return "delta" if "delta" in extensions.lower() else "parquet"


def create_layer_schemas(spark: SparkSession, schemas: Iterable[str] = ("bronze", "silver", "gold"),
                         location_root: str | None = None) -> None:
    """CREATE SCHEMA IF NOT EXISTS per layer (catalog creation is a platform command)."""
    for name in schemas:
        loc = f" LOCATION '{location_root}/{name}.db'" if location_root else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{loc}")


def ddl_columns(schema: T.StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema)


def create_layer_table(spark: SparkSession, table_name: str, schema: T.StructType, fmt: str | None = None,
                       location: str | None = None, partition_by: Iterable[str] = ()) -> None:
    fmt = fmt or default_table_format(spark)
    part = f" PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table_name} ({ddl_columns(schema)}) USING {fmt}{part}{loc}")


def create_layer_tables(spark: SparkSession, tables: LayerTables | None = None, fmt: str | None = None,
                        location_root: str | None = None) -> None:
    t = tables or LayerTables()
    for layer, name in (("raw", t.raw), ("operational", t.operational), ("curated", t.curated)):
        loc = f"{location_root}/{name.replace('.', '/')}" if location_root else None
        create_layer_table(spark, name, LAYER_SCHEMAS[layer], fmt, loc)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: column order, names and types of the layer."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def write_table(df: DataFrame, table_name: str, mode: str = "overwrite", schema: T.StructType | None = None,
                fmt: str | None = None, path: str | None = None, partition_by: Iterable[str] = (),
                bucket_by: tuple[int, list[str]] | None = None, sort_by: Iterable[str] = ()) -> None:
    """Table sink, overwrite by default.

    ``bucket_by=(n, keys)`` writes the table bucketed (and optionally
    sorted) on its join key, so later joins/aggregations on that key read
    it co-partitioned without a shuffle of this side.
    """
    out = conform(df, schema) if schema is not None else df
    writer = out.write.format(fmt or default_table_format(df.sparkSession)).mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        n, keys = bucket_by
        writer = writer.bucketBy(n, *keys)
        if sort_by:
            writer = writer.sortBy(*sort_by)
    writer.saveAsTable(table_name)


write_delta_table = write_table


def copy_into(spark: SparkSession, source_path: str, table_name: str, schema: T.StructType,
              fmt: str = "csv", header: bool = True, path: str | None = None, **options) -> None:
    """Batch file-to-table append (one pass, no file bookkeeping).

    For load-once semantics across repeated runs use
    :func:`strata.streaming.file_load.incremental_file_load`.
    """
    reader = spark.read.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", str(header).lower())
    for k, v in options.items():
        reader = reader.option(k, v)
    write_table(reader.load(source_path), table_name, mode="append", schema=schema, path=path)
