"""Session construction and the shared scratch location.

On a cluster the scratch location is the folder the cluster names in
``spark.checkpoint.dir`` (a shared filesystem); a private temporary folder
is only created for a single-process session that has none.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SCALE_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch joins to broadcast only when the measured
    # shuffle output is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # coalesce towards the advisory size rather than towards max parallelism
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "strata",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the operators assume."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from ``spark.checkpoint.dir`` or the context's checkpoint directory.
    Only a single-process (``local``) session without either gets a private
    temporary folder; on a cluster a folder that the executors do not share
    would lose data, so its absence is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="strata-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder name under the shared checkpoint location (Spark's writers create it)."""
    return f"{checkpoint_dir(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Reliable checkpoint of ``df`` in the shared checkpoint folder.

    Cuts the lineage (a lost executor re-reads the written partitions
    instead of recomputing the plan) and lets several actions share one
    computation.  A failing plan or an unwritable folder is an error.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df, name: str):
    """``df`` written as Parquet in the shared scratch location and read back.

    Like :func:`materialize`, but columnar and compressed: the form for
    intermediate tables that grow with the input.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
