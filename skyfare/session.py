"""Session construction and shared-storage scratch locations."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every plan in this package assumes. Times are truncated and
# partitioned in UTC unless a function is given an explicit ``zone``.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "skyfare", extra: dict | None = None) -> SparkSession:
    """Session for tests, benchmarks and local runs.

    On a cluster the launcher normally provides the session; library code
    only ever receives one and never builds its own.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is a shared filesystem visible to every executor.
    Only when the setting is absent (unit tests on one machine) do we pick
    a private temporary directory and register it as the checkpoint dir.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        existing = spark.sparkContext.getCheckpointDir()
        if existing:
            return existing
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            # A machine-local folder is invisible to other executors.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the "
                               "cluster's distributed filesystem) before writing")
        root = tempfile.mkdtemp(prefix="skyfare-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/skyfare/{name}-{uuid.uuid4().hex[:12]}"
