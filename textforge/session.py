"""Spark session helpers.

Library code never builds its own session; callers pass one in. ``get_session``
is for tests, the bench and the command line. ``checkpoint_dir`` reads the
cluster's shared ``spark.checkpoint.dir`` and only falls back to a fresh scratch
folder when the setting is missing (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package relies on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Python's json keeps the last of duplicate keys; so does Variant with this on.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Texts go to Python workers in batches of this many rows: the batches take memory beside the heap, for each task.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "textforge") -> SparkSession:
    builder = (
        SparkSession.builder.master(master or os.environ.get("TEXTFORGE_MASTER", "local[8]"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("TEXTFORGE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the session settings the operators depend on (idempotent)."""
    for k, v in REQUIRED_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the cluster's setting, else a new local scratch dir."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share: intermediate tables go there")
        # Local runs and tests only: a cluster names its shared folder.
        d = tempfile.mkdtemp(prefix="textforge-ckpt-", dir="/tmp")
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # core confs may be read-only at run time
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir for written intermediate tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []  # folders of this driver process


def remove_scratch(spark: SparkSession) -> int:
    """Deletes the intermediate tables that this process wrote; call it when no result that reads them is needed any more.

    Returns how many folders it removed."""
    removed = 0
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        removed += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return removed


CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, name: str, compression: str | None = None, tidy: bool = False):
    """Write ``df`` as Parquet (by the session's codec, or ``compression``) under the shared checkpoint folder and read it back.
    ``tidy``: the shuffle files of this write go when it ends; else they stay until the driver collects its garbage.

    Cuts lineage (a lost executor re-reads the table instead of recomputing
    the text chain) and lets several branches of a plan share one computation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEAN_UP, "false")
    try:
        spark.conf.set(CLEAN_UP, "true" if tidy else before)
        df.write.mode("overwrite").parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.parquet(path)
