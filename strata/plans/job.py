"""End-to-end layer load (A12): raw -> operational -> curated.

Each layer is written, then read back from its table before the next layer
is derived.  The written table cuts the lineage: a lost executor re-reads a
committed table instead of recomputing the whole chain from the source
files, and the source is scanned once instead of once per layer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import (
    ACTIVE_STATUSES,
    ALLOWED_STATUSES,
    CURATED_CUSTOMER_SCHEMA,
    CUSTOMER_TIERS,
    OPERATIONAL_CUSTOMER_SCHEMA,
    RAW_CUSTOMER_SCHEMA,
    LayerTables,
    Thresholds,
)
from strata.operators.curated import create_curated_df
from strata.operators import quality as Q
from strata.operators.customer import create_operational_df, standardize_raw_df
from strata.operators.quarantine import CheckedLayer, write_checked
from strata.session import scratch_path
from strata.sources.sinks import create_layer_schemas, write_table


def run_medallion(spark: SparkSession, source_df: DataFrame, tables: LayerTables | None = None,
                  location_root: str | None = None, as_of=None, thresholds: Thresholds | None = None,
                  fmt: str | None = None, layer_options: dict | None = None) -> dict[str, DataFrame]:
    """Load the three layers from ``source_df``; returns the written tables.

    ``location_root`` defaults to a folder under the session's shared
    checkpoint location.  ``layer_options`` maps ``raw`` / ``operational`` /
    ``curated`` to extra :func:`write_table` arguments, e.g.
    ``{"operational": {"partition_by": ["signup_month"]}}`` for partition
    pruning downstream, or ``{"curated": {"bucket_by": (512, ["customer_id"])}}``
    so later joins on the key read that side without a shuffle.
    """
    opts = {k: dict(v) for k, v in (layer_options or {}).items()}
    t = tables or LayerTables()
    root = location_root or scratch_path(spark, "layers")
    create_layer_schemas(spark, sorted({n.split(".")[0] for n in (t.raw, t.operational, t.curated) if "." in n}),
                         location_root=root)

    write_table(standardize_raw_df(source_df), t.raw, schema=RAW_CUSTOMER_SCHEMA, fmt=fmt,
                path=f"{root}/{t.raw.replace('.', '/')}", **opts.get("raw", {}))
    raw = spark.table(t.raw)
    write_table(create_operational_df(raw, as_of, thresholds), t.operational,
                schema=OPERATIONAL_CUSTOMER_SCHEMA, fmt=fmt, path=f"{root}/{t.operational.replace('.', '/')}",
                **opts.get("operational", {}))
    operational = spark.table(t.operational)
    write_table(create_curated_df(operational, thresholds), t.curated, schema=CURATED_CUSTOMER_SCHEMA,
                fmt=fmt, path=f"{root}/{t.curated.replace('.', '/')}", **opts.get("curated", {}))
    return {"raw": raw, "operational": operational, "curated": spark.table(t.curated)}


def raw_source_rules() -> list[Q.RowRule]:
    """What the text of a source row must be for the raw layer: an id, and a date and amount that can be read if given."""
    return [Q.not_null("customer_id"), Q.parse_failures("signup_date", "date"), Q.parse_failures("amount", "double")]


def operational_rules() -> list[Q.RowRule]:
    """Row rules of the operational layer (V6, V12-V14, V16)."""
    return [Q.allowed_values("status", ALLOWED_STATUSES, null_is_violation=True),
            Q.predicate("valid_email", ~F.coalesce(F.col("has_valid_email"), F.lit(False)), "email"),
            Q.predicate("active_status_is_active", F.col("status").isin(*ACTIVE_STATUSES) & ~F.col("is_active"), "is_active"),
            Q.allowed_values("customer_tier", CUSTOMER_TIERS, null_is_violation=True)]


def curated_rules() -> list[Q.RowRule]:
    return [Q.not_null("customer_id"), Q.allowed_values("customer_tier", CUSTOMER_TIERS, null_is_violation=True),
            Q.predicate("active_within_total", "active_record_count > total_records", "active_record_count"),
            Q.predicate("total_is_a_number", F.isnan("total_amount"), "total_amount")]


def run_checked_medallion(spark: SparkSession, source_df: DataFrame, tables: LayerTables | None = None, location_root: str | None = None,
                          as_of=None, thresholds: Thresholds | None = None) -> dict[str, CheckedLayer]:
    """The three layers, each written by :func:`~strata.operators.quarantine.write_checked`; only good rows go on to the next.

    Every layer is one pass over the one before: its rows, its quarantine and its report come from the same job.
    """
    t = tables or LayerTables()
    root = location_root or scratch_path(spark, "checked-layers")
    create_layer_schemas(spark, sorted({n.split(".")[0] for n in (t.raw, t.operational, t.curated) if "." in n}), location_root=root)

    def at(name: str) -> str:
        return f"{root}/{name.replace('.', '/')}"

    raw = write_checked(source_df, t.raw, at(t.raw), schema=RAW_CUSTOMER_SCHEMA, build=standardize_raw_df, source_rules=raw_source_rules())
    operational = write_checked(raw.good, t.operational, at(t.operational), operational_rules(), OPERATIONAL_CUSTOMER_SCHEMA,
                                build=lambda df: create_operational_df(df, as_of, thresholds), expected_rows=raw.rows - raw.n_quarantined)
    curated = write_checked(create_curated_df(operational.good, thresholds), t.curated, at(t.curated), curated_rules(), CURATED_CUSTOMER_SCHEMA)
    return {"raw": raw, "operational": operational, "curated": curated}


def checked_report(layers: dict[str, CheckedLayer]) -> DataFrame:
    """The reports of all layers in one, with the layer's name."""
    return Q.union_checks([layer.report.select(F.lit(name).alias("layer"), "*") for name, layer in layers.items()])
