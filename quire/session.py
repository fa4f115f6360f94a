"""SparkSession construction and the few settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quire", driver_memory: str = "12g") -> SparkSession:
    """Build (or reuse) a session tuned for the operators in this package.

    On a cluster the master and most settings come from spark-submit; the
    values here only fill what is unset."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if master and master.startswith("local"):
        # Local mode runs everything in the driver JVM.
        b = b.config("spark.driver.memory", driver_memory)
    b =(b.config("spark.ui.enabled", "false")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.session.timeZone", "UTC"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder. A cluster names a shared folder
    in ``spark.checkpoint.dir``; only when it is unset (local tests) do we
    pick a scratch folder of our own."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local)
    return local


def stage_once(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under the checkpoint folder and read it back, for a table that
    several branches of a plan use: Spark would work it out again for each of them, as
    they use different columns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/quire-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
