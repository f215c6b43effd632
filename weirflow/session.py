"""Session factory and the SQL settings every job here relies on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings. Cluster sizing (executors, memory, initial shuffle
# partitions) is left to the submitter; adaptive execution coalesces small
# shuffle partitions and splits skewed ones.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def create_session(
    app_name: str = "weirflow",
    *,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; `master` stays unset under spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors share one process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="weirflow-package-")) / package.name),
        "zip",
        root_dir=package.parent,
        base_dir=package.name,
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
