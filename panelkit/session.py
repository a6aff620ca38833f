"""Session helpers."""

from __future__ import annotations

import io
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "panelkit") -> SparkSession:
    """Session for tests and the benchmark; on a cluster use the session the cluster gives."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; they may start anywhere, without the driver's path."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    target = Path(tempfile.mkdtemp(prefix="panelkit-package-")) / "panelkit.zip"  # read by the driver only, which serves it
    target.write_bytes(packed.getvalue())
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for reliable checkpoints: the configured shared one, a temporary one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="panelkit-checkpoint-")
    sc.setCheckpointDir(configured)
    return configured


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage, so that every later use sees the same rows in the same partitions."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Redistribute an input that has fewer partitions than the session has cores, before costly row work.

    Tables of any size have more partitions than that and pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
