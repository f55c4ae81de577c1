"""Session settings, the UTC pin and the shared scratch folder.

Every time key in this library is compared as a UTC instant or a UTC wall
clock.  Spark converts between ``TIMESTAMP`` and ``TIMESTAMP_NTZ`` in the
session zone, so a session in any other zone silently shifts keys by the
zone offset (one hour in winter, two in summer for Central Europe).  The
session is therefore pinned to UTC and every entry point asserts it.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SESSION_ZONE = "UTC"

# Settings a job needs whatever the cluster; sizes (shuffle partitions,
# maxPartitionBytes, memory) are left to the cluster's own defaults.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": SESSION_ZONE,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Spark's default, INT96, has no statistics in Parquet footers: no row
    # group could be skipped by an instant, and no footer could answer for one
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
}


class SessionZoneError(RuntimeError):
    """Raised when the session zone is not UTC."""


def builder(app_name: str = "gridmart", master: str | None = None,
            extra: dict[str, str] | None = None) -> SparkSession.Builder:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    return b


def get_session(app_name: str = "gridmart", master: str | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    spark = builder(app_name, master, extra).getOrCreate()
    # getOrCreate may hand back an existing session; enforce the pin.
    spark.conf.set("spark.sql.session.timeZone", SESSION_ZONE)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    tune_listing(spark)
    assert_utc(spark)
    return spark


def tune_listing(spark: SparkSession) -> None:
    """Bound the tasks of the parallel partition-discovery job.

    Layers are partitioned by day; reading one lists every day folder, and
    by default Spark runs one listing task per folder (up to 10,000).  Unless
    the cluster sets its own value, use the default parallelism: every core
    lists a share of the folders instead of paying task overhead per folder.
    """
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    if spark.sparkContext.getConf().get(key, None) is None:
        spark.conf.set(key, str(max(8, spark.sparkContext.defaultParallelism)))


def assert_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise SessionZoneError(
            f"spark.sql.session.timeZone is {zone!r}; gridmart requires UTC "
            "because hour keys are compared across TIMESTAMP and TIMESTAMP_NTZ")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Used for reliable checkpoints and staging tables, so lineage is cut on
    storage that survives the loss of any executor.  Raises if the setting is
    absent: a machine-local fallback is wrong on a cluster.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; gridmart needs a "
                           "shared folder for checkpoints and staging tables")
    return d


def ship(spark: SparkSession) -> None:
    """Sends this package's source files to the executors (once a session), for
    the Python workers of a stateful stream.  Spark copies the archive itself;
    nothing else reads it."""
    sc = spark.sparkContext
    if getattr(sc, "_gridmart_shipped", False):
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="gridmart-"), f"{package.name}.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(archive)
    sc._gridmart_shipped = True


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this session wrote."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def staging_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder for one staging write."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/gridmart-staging/{purpose}-{uuid.uuid4().hex}"
