"""Spark session and checkpoint-directory helpers.

Library code never builds its own session: every public function takes the
caller's ``SparkSession`` (or a DataFrame bound to one).  ``get_spark`` is for
tests, the bench and command-line use only.
"""

from __future__ import annotations

import gc
import logging
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)


def get_spark(master: str | None = None, app: str = "brandlink",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Local session tuned for tests and the bench.

    On a cluster the deployment supplies master, memory and
    ``spark.checkpoint.dir``; the settings below are the ones the library relies
    on (AQE for skewed joins and partition coalescing, UTC, Arrow for the two
    pandas functions).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BRANDLINK_DRIVER_MEMORY", "16g"))
        .config("spark.python.worker.reuse", "true")
        # checkpoint files of collected DataFrames are removed by the cleaner
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is read
    from the session and used as is.  Only when nothing is configured (local
    tests) a fresh folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="brandlink-checkpoint-")
    log.warning("spark.checkpoint.dir is not set; using local folder %s "
                "(configure a shared folder on a cluster)", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_shuffles(spark: SparkSession) -> None:
    """Have the shuffle files of steps that nothing refers to any more removed
    now.  Python's cycles hold the JVM's objects, so they go first; the JVM hears
    of them a little later, and its cleaner works after a collection (measured:
    without the pauses the files of two or three steps stay)."""
    gc.collect()
    for _ in range(2):
        time.sleep(0.5)
        spark._jvm.System.gc()
