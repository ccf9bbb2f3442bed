"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every session gets unless the caller (or the cluster) set them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # month labels such as 2024-Jan are parsed and printed in English
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "patchlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system location and is
    used as is (unset on a cluster is an error).  Only when it is unset on a
    local master (tests) is ``fallback`` (or a folder under
    ``$PATCHLENS_SCRATCH``/``/tmp``) installed.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not fallback and not spark.sparkContext.master.startswith("local"):
        # a machine-local folder is not shared by the executors of a cluster
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or S3)")
    path = fallback or os.path.join(os.environ.get("PATCHLENS_SCRATCH", "/tmp"),
                                    "patchlens-checkpoints")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
