"""Session helpers.

The library never creates a session behind the caller's back; ``local_session`` is for
tests, benchmarks and examples only.  ``checkpoint_dir`` reads the cluster's shared
``spark.checkpoint.dir`` and only falls back to a scratch folder in local mode.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the mart workloads (AQE for runtime join choice, skew
# splitting and partition coalescing).  Shuffle partitions are sized by the caller.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "martkit",
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring the context from the
    session setting ``spark.checkpoint.dir`` when needed.

    On a cluster the directory must be a shared file system named by the cluster
    configuration; only a local-mode session gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="martkit-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder (HDFS/S3/ABFS)")
