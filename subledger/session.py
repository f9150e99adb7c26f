"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session settings the library relies on. AQE is what turns a join against
# a month/plan/method-sized aggregate into a broadcast at run time, *after*
# measuring the shuffled size, and what splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Small shuffles feeding CPU-heavy windows keep several tasks; at scale
    # partitions are far above this floor and the setting has no effect.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of a DataFrame are deleted once it is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "subledger",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_dir(spark: SparkSession, local_fallback: bool | None = None) -> str:
    """The shared folder for lineage cuts and intermediate tables.

    Taken from ``spark.checkpoint.dir`` as the cluster sets it. Only when it is
    unset *and* the session runs in local mode (tests, bench) is a fresh
    scratch folder created and registered; a cluster without the setting is an
    error, because a machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    is_local = sc.master.startswith("local")
    if local_fallback is None:
        local_fallback = is_local
    if not local_fallback:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage"
        )
    path = tempfile.mkdtemp(prefix="subledger-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path

