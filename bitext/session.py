"""Session helpers: one place for the configs every job relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DRIVER_MEMORY = "16g"

# Configs that hold at any scale. Shuffle partition counts are left to the
# caller/cluster: AQE coalesces small ones and splits skewed ones at runtime.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove checkpoint files once the DataFrames referencing them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "bitext",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode: the driver JVM is the only executor.
            builder = builder.config("spark.driver.memory", LOCAL_DRIVER_MEMORY)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names a shared folder there; it is read from the session and
    only set here when nothing is configured in local mode (tests). On a
    cluster an unset folder is an error, never a machine-local fallback.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns the setting
        return configured or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local"):
            # Executors can be lost; a machine-local folder would not survive it.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/object storage)")
        configured = tempfile.mkdtemp(prefix="bitext-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df, eager: bool = True):
    """Cut lineage by writing ``df`` to the shared checkpoint folder.

    Used where recomputation would repeat an expensive or non-replayable step
    (model calls). Never a machine-local checkpoint: executors may be lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written_table(df, name: str):
    """``df`` written once as Parquet below the shared checkpoint folder, and read back.

    Columnar and split-sized, where ``reliable_checkpoint`` keeps whole rows. The folder
    stays until the checkpoint folder is cleaned.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)
