"""Session helpers for tests and the benchmark (library code takes ``spark``)."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the loads are designed around: AQE re-plans joins at runtime
# (broadcast when the stored keys turn out small, split skewed partitions of
# the anti-join and the distinct), and the session zone is fixed.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "strata", **conf) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = dict(RECOMMENDED_CONF)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.setdefault("spark.driver.memory", "8g")
    # A task for every folder would make listing a layer of many small days slow.
    settings.setdefault("spark.sql.sources.parallelPartitionDiscovery.parallelism", "32")
    settings.update({k: str(v) for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; set one only where it is unset.

    The fallback (a fresh local temp folder) is for local runs and tests only.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    folder = fallback or tempfile.mkdtemp(prefix="strata-ckpt-")
    sc.setCheckpointDir(folder)
    return folder
