"""Session helpers: one place for the Spark settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings that matter for the plans this library builds.  They are applied
# with ``setdefault`` semantics: a value the cluster already set wins.
PLAN_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers (once a Spark context), so that
    they can import it wherever the driver found it."""
    context = spark.sparkContext
    if getattr(context, "_objectlake_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    packed = os.path.join(tempfile.mkdtemp(prefix="objectlake-package-"), "objectlake.zip")
    with zipfile.ZipFile(packed, "w") as out:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    out.write(full, os.path.join("objectlake", os.path.relpath(full, here)))
    context.addPyFile(packed)
    context._objectlake_shipped = True


def tune(spark: SparkSession) -> SparkSession:
    """Apply PLAN_DEFAULTS where the session leaves them unset, and send the
    package to the workers."""
    ship_package(spark)
    for key, value in PLAN_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    # Results are compared in UTC; the session zone must be pinned.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "objectlake") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("OBJECTLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", os.environ.get(
            "OBJECTLAKE_WAREHOUSE", tempfile.mkdtemp(prefix="objectlake-warehouse-")))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names shared storage and is used as given.  Only
    when it is unset (local tests) a scratch folder is created and registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a shared folder (HDFS, S3, ...): "
                               "lineage cuts and staged tables are written there")
        configured = tempfile.mkdtemp(prefix="objectlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for staged tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def scale_settings(input_bytes: int, executor_cores_total: int,
                   target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of Parquet: file splits
    of ``target_partition_bytes``; shuffle partitions so a shuffle of the whole
    input lands near the target per partition (never fewer than two waves of
    the cores); AQE then coalesces small partitions and splits skewed ones."""
    parts = max(2 * executor_cores_total, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        # startup setting: drop checkpoint files once their data is no longer referenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def apply_settings(spark: SparkSession, settings: dict[str, str], override: bool = False) -> None:
    """Set the SQL ``settings`` on a running session; values the cluster
    already set are kept unless ``override``.  Startup-only settings (the
    ``spark.cleaner.*`` one) belong in the submit configuration and are
    skipped here."""
    for k, v in settings.items():
        if k.startswith("spark.cleaner."):
            continue
        if override or spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
